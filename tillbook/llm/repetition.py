"""Repetition within a text by suffix arrays over its words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of texts worked on at once; a longer text is on its own.
BATCH = 1 << 18
#: Beyond this many words the ranks of all doublings are too much to hold: a slower rule, of the
#: same result, takes one.
LONG = 1 << 20
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict; the defaults are those of the registered query."""

    #: Words a repeated substring must have to count.
    shortest: int = 5
    #: Greatest share of words in repeated substrings, in percent.
    covered: int = 30
    #: Longest repeated substring, in words, whatever the length of the text.
    longest: int = 50


def suffix_array(symbols: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling, and the rank of every position after each doubling.

    Equal ranks at level k mean equal runs of 2**k symbols.  Only suffixes that are still tied
    are sorted again, so the levels are as many as the longest repeat has doublings.  Without
    ``keep`` only the last is returned: the place of every position in the array.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    values = symbols[order]
    rank[order] = _starts(np.r_[True, values[1:] != values[:-1]] if n else np.empty(0, bool))
    levels = [rank.astype(np.int32)]
    step = 1
    while True:
        ranked = rank[order]
        tied = np.zeros(n, bool)
        same = ranked[1:] == ranked[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        places = np.flatnonzero(tied)
        if not len(places):
            return order, levels
        items = order[places]
        ahead = items + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[items]
        sort = np.lexsort((follow, group))
        items, follow, group = items[sort], follow[sort], group[sort]
        order[places] = items
        new = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        # Members of a group lie side by side, from the place that is the group's rank on.
        rank[items] = places[first]
        if not keep:
            levels.clear()
        levels.append(rank.astype(np.int32))
        step *= 2


def _starts(new: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else new.astype(int)


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Longest common prefix of each suffix, in suffix-array order, with the one before it."""
    n = len(order)
    out = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    length = out[1:]
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = (a < n) & (b < n)
        equal = np.zeros(len(a), bool)
        equal[inside] = rank[a[inside]] == rank[b[inside]]
        jump = equal.astype(np.int64) << k
        length += jump
        a += jump
        b += jump
    return out


def neighbour_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The same from the places of the suffixes alone, by Kasai's rule.

    Going through the text, a suffix shares all but one symbol of what the one before it shared.
    """
    n = len(order)
    out = np.zeros(n, np.int64)
    text, before, place = symbols.tolist(), order.tolist(), rank.tolist()
    same = 0
    for at in range(n):
        if place[at] == 0:
            same = 0
            continue
        other = before[place[at] - 1]
        while max(at, other) + same < n and text[at + same] == text[other + same]:
            same += 1
        out[place[at]] = same
        same = max(0, same - 1)
    return out


def repeats(symbols: np.ndarray) -> np.ndarray:
    """For every position the longest run starting there that also starts elsewhere.

    That run ends the deepest LCP interval holding the suffix, one maximal repeat; the union of
    these runs is the union of all maximal repeats.
    """
    long = len(symbols) > LONG
    order, levels = suffix_array(symbols, keep=not long)
    if long:
        before = neighbour_prefixes(symbols, order, levels[-1])
    else:
        before = common_prefixes(order, levels)
    after = np.r_[before[1:], 0] if len(before) else before
    out = np.empty(len(symbols), np.int64)
    out[order] = np.maximum(before, after)
    return out


def covered(runs: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Mask of the positions in the runs ``[i, i + length[i])``, for the positions ``runs``."""
    n = len(length)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs, 1)
    np.add.at(edge, runs + length[runs], -1)
    return np.cumsum(edge[:n]) > 0


def measure(texts: list[str | None], limits: Limits) -> pd.DataFrame:
    """The measures of some texts, through one suffix array in which no two texts share a
    symbol, so that no repeat crosses from one text to another."""
    words = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbols = np.empty(int(sizes.sum()), np.int64)
    at = base = 0
    for some in words:
        number: dict[bytes, int] = {}
        symbols[at : at + len(some)] = [base + number.setdefault(w, len(number)) for w in some]
        at += len(some)
        base += len(number)
    run = repeats(symbols)
    triples = covered(np.flatnonzero(run >= 3), np.minimum(run, 3))
    spans = covered(np.flatnonzero(run >= limits.shortest), run)
    cuts = np.r_[0, np.cumsum(sizes)]
    total = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][cuts])
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, np.repeat(np.arange(len(texts)), sizes), run)
    return pd.DataFrame(
        {
            "n_words": sizes,
            "word_chars": [len(t) - sum(map(t.count, _SPACES)) if t else 0 for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) if t else 0 for t in texts],
            "n_dup_lines": [_repeated_lines(t) if t else 0 for t in texts],
            "n_repeat_words": total(triples),
            "n_covered": total(spans),
            "longest_repeat": longest,
        }
    )


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            n += line in seen
            seen.add(line)
    return n


def quality(
    docs: DataFrame,
    limits: Limits = Limits(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, the measures, ``base_failed`` and ``kept``.

    Kept are texts that pass the base rules and of which repeated substrings cover at most
    ``limits.covered`` percent of the words, the longest having at most ``limits.longest``
    words.  A null text has no words and fails.  Repeated rows stay.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = list(frame["text"])
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (size < 6 * BATCH or stop == start):
                    size += len(texts[stop] or "")
                    stop += 1
                out = measure(texts[start:stop], limits)
                out.insert(0, "id", frame["id"].iloc[start:stop].to_numpy())
                yield out
                start = stop

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(
        measured, f"id {id_type}, " + ", ".join(f"{n} bigint" for n in names)
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    long = F.col("longest_repeat") > limits.longest
    much = 100 * F.col("n_covered") > limits.covered * F.col("n_words")
    return rows.select(
        F.col("id").alias(id_col), *names, failed.alias("base_failed"),
        (~failed & ~long & ~much).alias("kept"),
    )
