"""Benchmark decontamination with an Aho-Corasick automaton over word windows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, stored

#: Words after lower-casing A-Z: runs of ASCII letters and digits and of anything not ASCII.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLAIN = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32
    for b in range(256)
)
_ORIGINAL_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_PLAIN).split() if data else []


def windows(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct ``(item, window)``: every ``width`` consecutive words of an item, joined by
    spaces; the whole of a shorter item; nothing of one without words."""
    words = F.regexp_extract_all(
        F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(WORD_CLASS), 0,
    )
    listed = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    return (
        listed.select("item", "words", F.explode(starts).alias("at"))
        .select("item", F.array_join(F.slice("words", F.col("at"), width), " ").alias("window"))
        .distinct()
    )


class Automaton:
    """Aho-Corasick over windows as sequences of word numbers, built from (item, window) rows.

    A word that no window holds has number 0, which leads back to the root.
    """

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.numbers: dict[bytes, int] = {}
        items: dict[tuple[int, ...], list[str]] = {}
        for item, window in rows:
            words = window.encode().split(b" ")
            key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            items.setdefault(key, []).append(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in items.items():
            self.machine.add_word(key, (len(key), found))
        if items:
            self.machine.make_automaton()
        self.empty = not items

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans hit by any occurrence of a window, and the items hit."""
        if self.empty:
            return [], set()
        get = self.numbers.get
        numbers = tuple([get(w, 0) for w in words])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for last, (length, found) in self.machine.iter(numbers):
            spans.append((last + 1 - length, last + 1))
            items.update(found)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def character_spans(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as character offsets into the original text."""
    if not spans:
        return []
    found = [m.span() for m in _ORIGINAL_WORD.finditer(data)]
    cuts = [c for a, b in spans for c in (found[a][0], found[b - 1][1])]
    steps = [len(data[a:b].decode()) for a, b in zip([0, *cuts], cuts)]
    at = list(accumulate(steps))
    return list(zip(at[::2], at[1::2]))


def automaton_parts(
    benchmark: DataFrame,
    *,
    id_col: str = "item_id",
    text_col: str = "text",
    width: int = 13,
    part_windows: int = 200_000,
) -> list[Broadcast]:
    """The windows as broadcast lists of about ``part_windows`` each.

    A part bounds what the driver and a task hold, however large the benchmark is; every
    document meets every part.
    """
    spark = benchmark.sparkSession
    rows = windows(benchmark, id_col, text_col, width)
    parts = max(1, -(-rows.count() // part_windows))
    part = F.pmod(F.xxhash64("item", "window"), F.lit(parts))
    return [
        spark.sparkContext.broadcast(
            [tuple(r) for r in rows.where(part == k).select("item", "window").collect()]
        )
        for k in range(parts)
    ]


class Hits(NamedTuple):
    """Names of the added columns."""

    n_words: str = "__n_words"
    spans: str = "__spans"
    items: str = "__items"

    @classmethod
    def beside(cls, docs: DataFrame) -> Hits:
        return cls(*free_names(docs, *cls()))

    def hit_words(self) -> Column:
        return F.aggregate(
            self.spans, F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"]
        )

    def contaminated(self, share: int = 20) -> Column:
        """True where at least one word in ``share`` is hit."""
        return (self.hit_words() > 0) & (share * self.hit_words() >= F.col(self.n_words))


def benchmark_hits(
    docs: DataFrame, parts: list[Broadcast], text_col: str, names: Hits
) -> DataFrame:
    """Add the number of words, the character and word spans hit and the items hit.

    Each text is scanned once a part; what a part finds joins what the parts before it have
    found.  A benchmark of several parts has the table stored in between, so that a task holds
    one part's automaton at a time.
    """
    out = docs.withColumns(
        {
            names.n_words: F.lit(0).cast("long"),
            names.spans: F.array().cast(SPANS),
            names.items: F.array().cast("array<string>"),
        }
    )
    for k, rows in enumerate(parts):
        if k:
            out = stored(out, "benchmark-hits")
        out = out.mapInArrow(_scanner(rows, text_col, names), out.schema)
    return out


#: Words ``[first, past)`` of a text at its characters ``[start, stop)``.
SPANS = "array<struct<first:bigint,past:bigint,start:bigint,stop:bigint>>"


def _scanner(rows: Broadcast, text_col: str, names: Hits):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rows.value)
        for batch in batches:
            n_words, spans, items = [], [], []
            texts = batch.column(text_col).cast(pa.binary())
            before = zip(batch.column(names.spans).to_pylist(), batch.column(names.items).to_pylist())
            for text, (known, had) in zip(texts, before):
                data = text.as_py()
                words = words_of(data)
                hit, found = automaton.scan(words)
                n_words.append(len(words))
                if found:
                    hit = merged(hit + [(s["first"], s["past"]) for s in known])
                    at = character_spans(data, hit)
                    known = [
                        {"first": a, "past": b, "start": c, "stop": d}
                        for (a, b), (c, d) in zip(hit, at)
                    ]
                    had = sorted(found.union(had))
                spans.append(known)
                items.append(had)
            new = {names.n_words: n_words, names.spans: spans, names.items: items}
            columns = [
                pa.array(new[f.name], f.type) if f.name in new else batch.column(i)
                for i, f in enumerate(batch.schema)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return scan


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    width: int = 13,
    part_windows: int = 200_000,
) -> DataFrame:
    """One row per document: id, word and hit counts, spans, items, ``contaminated``.

    A null text has no words and is clean.  Items without words never occur; a null item id
    is listed as an empty string; items of the same id count once.  An empty benchmark hits
    nothing.  Repeated documents stay; other columns are not read.
    """
    parts = automaton_parts(
        benchmark, id_col=item_col, text_col="text", width=width, part_windows=part_windows
    )
    names = Hits()
    found = benchmark_hits(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")),
        parts, "__text", names,
    )
    return found.select(
        F.col("__id").alias(id_col),
        F.col("__n_words").alias("n_words"),
        names.hit_words().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.col("__items").alias("items"),
        F.col("__spans").alias("spans"),
        names.contaminated().alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", width: int = 13
) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Null texts and texts without a word are clean and stay, as do all where the benchmark is
    empty; texts are scanned whole; repeated rows stay or go together; an empty table gives an
    empty one; no column's name matters but the text's.
    """
    names = Hits.beside(docs)
    found = benchmark_hits(docs, automaton_parts(benchmark, width=width), text_col, names)
    return found.where(~names.contaminated()).select(*[f"`{c}`" for c in docs.columns])
