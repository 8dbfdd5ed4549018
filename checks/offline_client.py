"""A completion client without a model: the answer is a fixed function of the text.

It stands in for a provider in tests and dry runs. About one answer in six is
missing or empty and about half of the others break the asked format in some
way, so that everything downstream is exercised.
"""

from __future__ import annotations

import hashlib

from reviewloom.operators.prompts import REVIEW_CLOSING, REVIEW_OPENING

LABELS = ("Positive", "Negative", "Neutral", "Mixed")


def reviewed_text(prompt: str) -> str:
    """The text between the prompt's review marks."""
    start = prompt.index(REVIEW_OPENING) + len(REVIEW_OPENING)
    return prompt[start : prompt.rindex(REVIEW_CLOSING)]


def text_digest(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def digest_byte(digest: str, position: int) -> int:
    """Value of the two hex digits from a position counted from 1."""
    return int(digest[position - 1 : position + 1], 16)


def canned_answer(text: str) -> str | None:
    digest = text_digest(text)
    label = LABELS[digest_byte(digest, 1) % 4]
    percent = digest_byte(digest, 3) % 101
    sentiment = f"SENTIMENT: {label}"
    confidence = f"CONFIDENCE: {percent / 100:.2f}"
    summary = f"SUMMARY: s {digest[:8]}"
    first, second, third = (text.split(" ", 3) + ["", "", ""])[:3]

    well_formed = [
        sentiment, confidence, "KEY_POINTS:", f"- {first}", f"- {second}", f"- {third}", summary,
    ]
    variants = {
        2: [sentiment.replace("SENTIMENT", "sentiment"),
            confidence.replace("CONFIDENCE", "confidence")],
        3: [sentiment, f"CONFIDENCE: {percent}%", summary],
        4: [confidence, "KEY_POINTS:", f"- {first}", summary],
        5: [sentiment, confidence, "KEY_POINTS: - lost", f"* {first}", "SUMMARY:"],
        6: [sentiment, "KEY_POINTS:", f"- {first}", confidence, f"- {second}", "KEY_POINTS:",
            "note", f"-- {third}", summary],
        7: [f"SENTIMENT: {sentiment}", confidence, "CONFIDENCE: n/a"],
    }
    variant = digest_byte(digest, 5) % 12
    if variant == 0:
        return None
    if variant == 1:
        return ""
    if variant == 8:
        lines = [f"  {sentiment}", "", confidence, "KEY_POINTS:", f"- {first}", summary, ""]
        return "\r\n".join(lines)
    return "\n".join(variants.get(variant, well_formed))


def offline_batch_client():
    """The same for calls of many prompts."""

    def client(prompts: list[str], temperature: float, max_tokens: int) -> list[str | None]:
        return [canned_answer(reviewed_text(prompt)) for prompt in prompts]

    return client


def offline_client():
    """Client factory: the default of every completion operator."""

    def client(prompt: str, temperature: float, max_tokens: int) -> str | None:
        return canned_answer(reviewed_text(prompt))

    return client
