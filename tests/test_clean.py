import random
import re
import time
import unicodedata

from pyspark.sql import functions as F

from reviewloom.operators import clean

PIECES = [
    "a", "Bc", "\u00E9", "e\u0301", "\u1100\u1161", "\u212B", "\u0344", " ", "  ", "\t", "\n", "\n\n\n", "\r",
    "\x07", "\x1d", "\x85", "\xa0", "\u2003", "\u200B", "\uFEFF", "\U0001f600", "\U0001d15e", "\u2019",
    "\u201C", "\u2013", "\u2014", "\u2026", ".", " ,", "!", "<b>", "</p >", "<", ">", "\u6F22", "\u0939\u093C", "&amp;",
]


def texts(count=600, seed=11):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 16))) for _ in range(count)]


def fixed(text):
    text = unicodedata.normalize("NFC", text)
    for character, plain in clean.REPLACEMENTS:
        text = text.replace(character, plain)
    return text


STEPS = [
    (clean.fix_encoding, fixed),
    (clean.strip_tags, lambda t: re.sub("<[^>]+>", " ", t)),
    (
        clean.drop_control_characters,
        lambda t: "".join(
            c for c in t if c in "\t\n\r" or " " <= c <= "~" or "\xa0" <= c <= "\uFFFF"
        ),
    ),
    (clean.collapse_blanks, lambda t: re.sub("[ \t]+", " ", t)),
    (clean.collapse_blank_lines, lambda t: re.sub("\n{3,}", "\n\n", t)),
    (clean.tighten_punctuation, lambda t: re.sub(r"\s+([.,!?;:])", r"\1", t)),
]


def test_each_step(apply):
    samples = texts()
    for step, expected in STEPS:
        assert apply(step, samples) == [expected(t) for t in samples], step.__name__


def test_whole_chain(apply):
    samples = texts(seed=12)
    expected = samples
    for _, step in STEPS:
        expected = [step(t) for t in expected]
    assert apply(clean.clean_text, samples) == [t.strip() for t in expected]


def test_empty_and_missing(apply):
    assert apply(clean.clean_text, [None, "", " \n "]) == ["", "", ""]


def test_named_cases(apply):
    cases = {
        "a < b and c > d": "a d",
        "a\n \n \nb": "a\n \n \nb",
        "end \u2003! x\n.": "end! x.",
        "ok \U0001f600 done": "ok done",
        "&amp; stays": "&amp; stays",
    }
    assert apply(clean.clean_text, list(cases)) == list(cases.values())


def test_open_tags_do_not_take_quadratic_time(apply):
    # Half a million marks, each of which would be followed to the end.
    text = "a <b> " + "<" * 500_000
    assert apply(clean.strip_tags, [text]) == ["a   " + "<" * 500_000]


def test_characters_left_alone_by_composition():
    """The guard's class holds nothing that composes with or reorders a neighbour."""
    inside = re.compile(f"[{clean.ALWAYS_COMPOSED}]")
    second = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(chr(int(parts[1], 16)))
    for code in range(0x10000):
        character = chr(code)
        if not 0xD800 <= code < 0xE000 and inside.match(character):
            assert unicodedata.normalize("NFC", character) == character, hex(code)
            assert unicodedata.combining(character) == 0, hex(code)
            assert character not in second, hex(code)


def test_composition_of_every_letter(apply):
    characters = [chr(c) for c in range(0xA0, 0x30000) if not 0xD800 <= c < 0xE000]
    characters = [c for c in characters if unicodedata.decomposition(c)]
    decomposed = [unicodedata.normalize("NFD", c) for c in characters]
    assert apply(clean.compose, decomposed) == [
        unicodedata.normalize("NFC", t) for t in decomposed
    ]


def test_the_guard_is_all_other_characters(apply):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    always = re.compile(f"[{clean.ALWAYS_COMPOSED}]")
    found = apply(lambda x: x.rlike(f"[{clean.MAYBE_COMPOSED}]"), characters)
    assert found == [always.match(c) is None for c in characters]


def test_the_guard_costs_little_on_latin_text(spark):
    text = F.repeat(F.concat(F.lit("Caf\u00e9 na\u00efve, and some plain words. "), F.col("id").cast("string")), 25_000)
    rows = spark.range(0, 24, 1, 4).select(text.alias("x"))

    def seconds(column):
        found = []
        for _ in range(3):
            started = time.perf_counter()
            rows.select(column).write.format("noop").mode("overwrite").save()
            found.append(time.perf_counter() - started)
        return min(found)

    plain = seconds(F.col("x").rlike("[\u0300-\uffff]"))
    assert seconds(F.length(clean.compose(F.col("x")))) < 5 * plain + 0.5
