"""What quality operators measure of a text: plain counts, exact on whole texts."""

from __future__ import annotations

from collections import Counter
from operator import eq
from typing import NamedTuple

import numpy as np

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# What parts words: the space and the control characters from tab to return.
BLANKS = " \t\n\x0b\x0c\r"


class Signals(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_distinct: int
    n_top: int
    n_adjacent: int
    n_upper: int
    n_marks: int
    n_bars: int
    n_digits: int
    n_stops: int
    n_capital: int
    longest: int


def repeated_words(numbers: np.ndarray) -> int:
    """Words that stand in a window of five words found twice or more; ``numbers`` tell
    equal words. Windows may overlap."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    # Windows with different mixes differ; only where mixes repeat are windows compared.
    mix = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mix = mix * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + n].astype(np.uint64)
    ordered = np.sort(mix)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    codes = numbers[:n].astype(np.int64)
    base = int(numbers.max()) + 1
    for i in range(1, WINDOW):
        pairs = codes * base + numbers[i : i + n]
        codes = np.unique(pairs, return_inverse=True)[1]
    covered = np.zeros(len(numbers) + 1, np.int64)
    places = np.flatnonzero(np.bincount(codes)[codes] > 1)
    np.add.at(covered, places, 1)
    np.add.at(covered, places + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1]) > 0))


def signals(text: str) -> Signals:
    coded = text.encode()
    words = coded.split()
    n = len(words)
    counts = Counter(words)
    numbers = {word: i for i, word in enumerate(counts)}
    coding = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    bytes_ = np.bincount(np.frombuffer(coded, np.uint8), minlength=128)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    firsts = bytes(word[0] for word in words)
    return Signals(
        n_words=n,
        word_chars=len(text) - sum(int(bytes_[ord(c)]) for c in BLANKS),
        n_symbols=sum(int(bytes_[ord(c)]) for c in SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(coding),
        n_lines=len(lines),
        n_distinct=len(counts),
        n_top=max(counts.values(), default=0),
        n_adjacent=sum(map(eq, words, words[1:])),
        n_upper=int(bytes_[65:91].sum()),
        n_marks=int(bytes_[ord("!")] + bytes_[ord("?")]),
        n_bars=int(bytes_[ord("|")]),
        n_digits=int(bytes_[48:58].sum()),
        n_stops=int(bytes_[ord(".")] + bytes_[ord(",")]),
        n_capital=sum(65 <= b <= 90 for b in firsts),
        longest=max(map(len, counts), default=0),
    )
