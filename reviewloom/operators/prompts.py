"""The analysis prompt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prompt's wording and layout.
AUTHOR_SENTENCE = ("Written by: ", ".")
RATING_SENTENCE = ("The reviewer gave a rating of ", "/5.")
PROMPT_OPENING = (
    "You are a product review analyst. Analyze the following customer review"
    " and return a structured analysis.\n\n"
)
REVIEW_OPENING = '\n\nREVIEW:\n"""\n'
REVIEW_CLOSING = '\n"""\n\nRespond in exactly this format (no extra text):\n\n'
ANSWER_FORMAT = """\
SENTIMENT: <Positive | Negative | Neutral | Mixed>
CONFIDENCE: <a score from 0.0 to 1.0>
KEY_POINTS:
- <point 1>
- <point 2>
- <point 3 if applicable>
SUMMARY: <one concise sentence summarizing the review>
"""


def _sentence(parts: tuple[str, str], value: Column, present: Column) -> Column:
    before, after = parts
    filled = F.concat(F.lit(before), value.cast("string"), F.lit(after))
    return F.when(present, filled).otherwise("")


def build_prompt(text: Column, rating: Column, author: Column) -> Column:
    """Author and rating are named only where there is one; a rating of 0 is none."""
    return F.concat(
        F.lit(PROMPT_OPENING),
        _sentence(AUTHOR_SENTENCE, author, author != ""),
        F.lit(" "),
        _sentence(RATING_SENTENCE, rating, rating != 0),
        F.lit(REVIEW_OPENING),
        text,
        F.lit(REVIEW_CLOSING + ANSWER_FORMAT),
    )
