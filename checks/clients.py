"""A client whose failures follow from the text."""

from __future__ import annotations

from checks.offline_client import digest_byte, reviewed_text, text_digest

# By digest: the errors before a success, or one error for ever.
FAILURES = (
    (),
    ("429 rate limit",),
    ("503", "503"),
)
LASTING = ("401", "boom", "429")


def failing_client():
    failed = 0

    def client(prompt: str, temperature: float, max_tokens: int) -> str:
        nonlocal failed
        case = digest_byte(text_digest(reviewed_text(prompt)), 7) % 6
        if case >= len(FAILURES):
            raise RuntimeError(LASTING[case - len(FAILURES)])
        if failed < len(FAILURES[case]):
            failed += 1
            raise RuntimeError(FAILURES[case][failed - 1])
        failed = 0
        return "SENTIMENT: Neutral"

    return client
