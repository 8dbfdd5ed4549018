import random

from reviewloom.operators.responses import parse_answers, parse_responses


def parsed(apply, raws):
    return [row.asDict() for row in apply(parse_answers, [raws], "array<string>")[0]]


CASES = {
    "": {},
    "  \n\r\n": {},
    "no tag at all": {},
    "sentiment: Positive": {},
    "SENTIMENT: Positive": {"sentiment": "Positive"},
    "SENTIMENT:": {"sentiment": ""},
    "SENTIMENT: SENTIMENT: x": {"sentiment": "x"},
    "SENTIMENT: a\nSENTIMENT: b": {"sentiment": "b"},
    "The SENTIMENT: a": {},
    "CONFIDENCE: 0.5\nCONFIDENCE: high": {},
    "CONFIDENCE: 7": {"confidence": 7.0},
    "CONFIDENCE:  .5 ": {"confidence": 0.5},
    "CONFIDENCE: 92%": {},
    "KEY_POINTS: - lost\n- kept": {"key_points": ["kept"]},
    "KEY_POINTS:\n-\n- -5 stars\n* no\n1. no\n- yes": {"key_points": ["", "5 stars", "yes"]},
    "- early\nKEY_POINTS:\n- a\nCONFIDENCE: 1\n- late": {"key_points": ["a"], "confidence": 1.0},
    "KEY_POINTS:\n- a\nsome text\n- b\nKEY_POINTS:\n- c": {"key_points": ["a", "b", "c"]},
    "SUMMARY: one\nmore": {"llm_summary": "one"},
    "SUMMARY: a\nSUMMARY:": {"llm_summary": ""},
    "KEY_POINTS:\n-\xa0padded": {"key_points": ["padded"]},
}


def test_named_cases(apply):
    default = {"sentiment": "Unknown", "confidence": None, "key_points": [], "llm_summary": ""}
    for row in parsed(apply, list(CASES)):
        raw = row.pop("raw_response")
        assert row == default | CASES[raw], raw


WORDS = ["good", "a b", "5 stars", "n/a: x", "so-so", "KEY", "1_0", "*"]


def made_answer(rng):
    """An answer built from fields, in any order and with noise, and what it says."""
    said = {"sentiment": "Unknown", "confidence": None, "key_points": [], "llm_summary": ""}
    lines = []
    for _ in range(rng.randint(0, 7)):
        kind = rng.choice(["sentiment", "confidence", "points", "summary", "noise"])
        space = rng.choice(["", " ", "\t", "  "])
        if kind == "sentiment":
            said["sentiment"] = rng.choice(WORDS)
            lines.append(f"SENTIMENT:{space}{said['sentiment']}")
        elif kind == "confidence":
            shown, said["confidence"] = rng.choice(
                [("0.75", 0.75), (".5", 0.5), ("1e-1", 0.1), ("7", 7.0), ("1_0", 10.0), ("0.9d", None),
                 ("92%", None), ("", None)]
            )
            lines.append(f"CONFIDENCE:{space}{shown}")
        elif kind == "summary":
            said["llm_summary"] = rng.choice([*WORDS, ""])
            lines.append(f"SUMMARY:{space}{said['llm_summary']}")
        elif kind == "noise":
            # Not before a block of points has begun, nor within one.
            lines += ["- stray"] if not said["key_points"] and not lines else ["sentiment: x", ""]
        else:
            points = [rng.choice(WORDS) for _ in range(rng.randint(0, 3))]
            said["key_points"] += points
            lines.append("KEY_POINTS:" + rng.choice(["", " - not a point"]))
            for point in points:
                lines += [rng.choice(["-", "- ", "--", "- - "]) + point]
                lines += rng.choice([[], ["* not one"], [""], ["some text"]])
    ends = ["\n", "\r\n", "\r", "\n\n", "\x0b", "\x85", " \n "]
    return "".join(line + rng.choice(ends) for line in lines), said


def test_answers_made_from_fields(apply):
    rng = random.Random(5)
    made = [made_answer(rng) for _ in range(500)]
    for (raw, said), row in zip(made, parsed(apply, [raw for raw, _ in made])):
        assert row == said | {"raw_response": raw}, raw


def test_table_form(spark):
    rows = spark.createDataFrame(
        [(1, "SENTIMENT: Mixed\nKEY_POINTS:\n- a\n- b")], "review_key int, raw_response string"
    )
    row = parse_responses(rows).first()
    assert (row.sentiment, row.key_points_str, row.llm_summary) == ("Mixed", "a | b", "")
    assert row.raw_response.startswith("SENTIMENT")
