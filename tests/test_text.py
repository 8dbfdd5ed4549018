import math
import random

from pyspark.sql import functions as F

from reviewloom.functions import text
from reviewloom.functions.rounding import round3
from reviewloom.functions.tokens import bpe_tokens, estimate_tokens

PIECES = ["a", "bc", "\u00E9", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0",
          "\u2003", "\u2028", "\u3000", "\u200B", "\uFEFF", "\U0001f600", "."]


def random_texts(count=400, seed=7, pieces=PIECES):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(count)]


def test_whitespace_is_pythons():
    spaces = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(text.WHITESPACE) == spaces


def test_space_class_matches_the_same_characters(apply):
    codes = [chr(c) for c in range(1, 0xD800)]
    pattern = f"{text.UNICODE}^[{text.WS}]$"
    # Tested between letters, as $ also matches before a final line break.
    found = apply(lambda x: x.rlike(pattern.replace("^", "^a").replace("$", "b$")),
                  [f"a{c}b" for c in codes])
    assert {c for c, hit in zip(codes, found) if hit} == {c for c in codes if c.isspace()}


def test_strip_and_words(apply):
    texts = random_texts()
    assert apply(text.strip, texts) == [t.strip() for t in texts]
    assert apply(text.word_count, texts) == [len(t.split()) for t in texts]
    assert apply(estimate_tokens, texts) == [int(len(t.split()) * 1.3) for t in texts]
    assert apply(text.is_blank, texts) == [not t.strip() for t in texts]


def test_token_estimate_is_the_float_product(apply):
    texts = ["w " * n for n in range(0, 300)]
    assert apply(estimate_tokens, texts) == [int(n * 1.3) for n in range(0, 300)]


def test_lines(apply):
    texts = random_texts()
    expected = [[s for s in (p.strip() for p in t.splitlines()) if s] for t in texts]
    assert apply(text.stripped_lines, texts) == expected


def as_float(value):
    try:
        return float(value)
    except ValueError:
        return None


def test_python_float(apply):
    values = [
        "0.9", "+0.9", "-.5", "5", "5.", ".", "", "1e-1", "1E5", "1e", "e5", "92%", "0.9d", "0.9f",
        "0x1p3", "1_0", "1__0", "_1", "1_", "1_0.2_5", "inf", "-Infinity", "nan", "+NaN", "infin",
        "1e400", "n/a", "0,9", "\uFF10.\uFF19", "\u0661\u0662", "1 2", "--1", "0.30000000000000004",
    ]
    for value, found in zip(values, apply(text.python_float, values)):
        expected = as_float(value)
        if expected is not None and math.isnan(expected):
            assert math.isnan(found), value
        else:
            assert found == expected, value


def test_round3_is_pythons(apply):
    rng = random.Random(3)
    means = {
        sum(values) / len(values)
        for n in range(1, 14)
        for values in (
            [rng.randint(0, 100) / 100 for _ in range(n)] for _ in range(600)
        )
    }
    values = sorted(means) + [0.0625, 0.9135, 0.7125, 0.0005, 0.0, -0.0625, -0.9135, 1e300, 5.0]
    values += [k / 2000 for k in range(1, 4001, 2)]
    values += [rng.uniform(-5, 5) for _ in range(2000)]
    values += [rng.uniform(-(2.0**e), 2.0**e) for e in range(60) for _ in range(20)]
    values += [2.0**43 + 0.0625, 2.0**46 + 0.015625, float("inf"), float("-inf")]
    found = apply(round3, values, "double")
    wrong = [(v, f) for v, f in zip(values, found) if f != (round(v, 3) if abs(v) < 1e308 else v)]
    assert wrong == []
    assert math.isnan(apply(round3, [float("nan")], "double")[0])
    assert apply(round3, [None], "double") == [None]


def test_bpe_counter_and_its_fallback(apply):
    import tiktoken

    def load():
        ranks = {bytes([b]): b for b in range(256)}
        ranks[b"ab"] = 256
        return tiktoken.Encoding(
            "tiny", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={"<|end|>": 257}
        )

    def missing():
        raise OSError("no vocabulary here")

    texts = [["abab", "a b"], ["one two<|end|>"], [], None]
    # The encoder refuses special tokens; that text is counted by words.
    assert apply(bpe_tokens(load), texts, "array<string>") == [[2, 3], [2], [], None]
    assert apply(bpe_tokens(missing), texts, "array<string>") == [[1, 2], [2], [], None]
    assert apply(bpe_tokens("no-such-encoding"), [["a b c"]], "array<string>") == [[3]]


def test_stepwise(apply):
    def twice(value):
        return F.concat(value, value)

    assert apply(lambda x: text.stepwise(x, twice, twice, F.upper), ["a", None]) == ["AAAA", None]
