"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ``order`` bytes long is counted on a bounded
sample of labelled texts and then frozen.  A byte is coded in the longest context, which either
predicts it, at c/(n + d), or escapes to the next shorter one, at d/(n + d), with n bytes of d
kinds seen there; below the empty context all 256 bytes are alike.  The code length of a text
under each language decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, remainder

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Bytes of one step of scoring: bounds a task's arrays.
STEP = 1 << 19


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; the defaults are those of the registered query."""

    #: Bytes of context; a context and its byte fit 32 bits.
    order: int = 3
    #: Labelled texts taken per language, roughly; whole texts, chosen by a hash.
    sample: int = 600
    #: More labels than this are refused: the model would not be small.
    languages: int = 200


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the ``order`` bytes before it as one number, and each text's start.

    A text begins after ``order`` line ends, which are context only.
    """
    pad = b"\n" * order
    data = np.frombuffer(b"".join([pad + t for t in texts]), np.uint8).astype(np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    key = np.zeros(max(0, len(data) - order), np.uint32)
    for back in range(order + 1):
        key |= data[order - back : len(data) - back] << np.uint32(8 * back)
    starts = np.cumsum(lengths + order) - lengths - order
    own = np.ones(len(key) + order, bool)
    for k in range(order):
        own[starts + lengths + k] = False
    return key[own[: len(key)]], np.cumsum(np.r_[0, lengths[:-1]])


class ContextTrees:
    """Frozen statistics of all languages as tables of code lengths in bits.

    ``grams[k]`` are the sorted numbers of the context-and-byte strings of k + 1 bytes seen in
    any language and ``bits[k]`` the code length of the byte in its k-byte context, one column a
    language; ``contexts[k]`` and ``escapes[k]`` give the cost of leaving a context.
    """

    def __init__(self, counted: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> None:
        self.languages = sorted(counted, key=lambda s: s.encode())
        orders = range(len(next(iter(counted.values()), [])))
        self.grams: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for k in orders:
            seen = [counted[name][k] for name in self.languages]
            grams = np.unique(np.concatenate([keys for keys, _ in seen]))
            contexts = np.unique(grams >> np.uint32(8))
            bits = np.zeros((len(grams), len(seen)))
            escapes = np.zeros((len(contexts), len(seen)))
            shorter = self._shorter(grams, k, len(seen))
            for column, (keys, n) in enumerate(seen):
                context = np.searchsorted(contexts, keys >> np.uint32(8))
                total = np.bincount(context, n, len(contexts))
                kinds = np.bincount(context, minlength=len(contexts))
                room = np.where(total > 0, total + kinds, 1)
                escapes[:, column] = np.where(total > 0, np.log2(room / np.maximum(kinds, 1)), 0)
                at = np.searchsorted(contexts, grams >> np.uint32(8))
                bits[:, column] = escapes[at, column] + shorter[:, column]
                own = np.searchsorted(grams, keys)
                bits[own, column] = np.log2(room[context] / n)
            self.grams.append(grams)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escapes.append(escapes)

    def _shorter(self, grams: np.ndarray, k: int, columns: int) -> np.ndarray:
        if k == 0:
            return np.full((len(grams), columns), 8.0)
        # Whatever follows a context also follows its shorter ones.
        return self.bits[k - 1][np.searchsorted(self.grams[k - 1], grams & _mask(k))]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits to code each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        order = len(self.grams) - 1
        full = np.flatnonzero([len(t) > 0 for t in texts])
        if not len(full) or order < 0:
            return out
        keys, starts = grams([texts[i] for i in full], order)
        for start in range(0, len(keys), STEP):
            bits = self._bits(keys[start : start + STEP], order)
            first = np.searchsorted(starts, start, "right") - 1
            last = np.searchsorted(starts, start + len(bits), "left")
            cuts = np.maximum(starts[first:last] - start, 0)
            out[full[first:last]] += np.add.reduceat(bits, cuts)
        return out

    def _bits(self, keys: np.ndarray, order: int) -> np.ndarray:
        known, at = _find(self.grams[order], keys)
        if known.all():
            return self.bits[order][at]
        out = np.zeros((len(keys), len(self.languages)))
        out[known] = self.bits[order][at[known]]
        rest = keys[~known]
        seen, context = _find(self.contexts[order], rest >> np.uint32(8))
        cost = np.where(seen[:, None], self.escapes[order][context], 0.0)
        out[~known] = cost + (self._bits(rest & _mask(order), order - 1) if order else 8.0)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of least code length, the first by code point among equals, and its
        share of the probability; a text without a letter is unknown, with score 0."""
        letters = [t if t and self.languages and _LETTER.search(t) else None for t in texts]
        lengths = self.code_lengths([folded(t) if t else b"" for t in letters])
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = lengths.argmin(axis=1)
        score = 1.0 / np.exp2(lengths.min(axis=1)[:, None] - lengths).sum(axis=1)
        has = np.array([t is not None for t in letters], bool)
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
        return names, np.where(has, score, 0.0)


def _mask(k: int) -> np.uint32:
    return np.uint32((1 << 8 * k) - 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
    if not len(table):
        return np.zeros(len(keys), bool), at
    return table[at] == keys, at


def fit(
    labelled: DataFrame,
    parameters: Fit = Fit(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> ContextTrees:
    """Count the contexts of a bounded sample of the rows whose label is not null.

    ``labelled`` may repeat texts and hold null or empty ones.  Raises ValueError beyond
    ``parameters.languages`` labels.  Without any label the model knows no language.
    """
    named = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)).alias("draw"),
    )
    sizes = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    found = sizes.limit(parameters.languages + 1).count()
    if found > parameters.languages:
        raise ValueError(f"more than {parameters.languages} languages")
    share = sizes.select("lang", (parameters.sample / F.col("n") * (1 << 30)).alias("most"))
    drawn = named.join(F.broadcast(share), "lang").where("draw < most and length(text) > 0")

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = [folded(t) for t in rows["text"]]
        out = []
        for k in range(parameters.order + 1):
            keys, n = np.unique(grams(texts, parameters.order)[0] & _mask(k + 1), return_counts=True)
            out.append(
                {"lang": key[0], "k": k, "keys": keys.astype("<u4").tobytes(),
                 "n": n.astype("<i8").tobytes()}
            )
        return pd.DataFrame(out)

    counted: dict[str, list] = {}
    rows = drawn.groupBy("lang").applyInPandas(count, "lang string, k int, keys binary, n binary")
    for row in sorted(rows.collect(), key=lambda r: r["k"]):
        table = np.frombuffer(row["keys"], "<u4"), np.frombuffer(row["n"], "<i8")
        counted.setdefault(row["lang"], []).append(table)
    return ContextTrees(counted)


def predicted(text: Column, trees: ContextTrees, spark) -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column."""
    model = spark.sparkContext.broadcast(trees)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        names: list[str] = []
        scores: list[np.ndarray] = []
        start = 0
        while start < len(values):
            stop, size = start, 0
            while stop < len(values) and (size < STEP or stop == start):
                size += len(values[stop] or "")
                stop += 1
            some, score = model.value.predict(values[start:stop])
            names += some
            scores.append(score)
            start = stop
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]))],
            ["lang_pred", "score"],
        )

    return predict(text)


def identified(
    docs: DataFrame,
    trees: ContextTrees,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``held_out`` (crc32 of the id is 1 modulo 3), ``lang_pred``
    and ``score``.  Null texts and texts without a letter are ``und``; repeated rows stay."""
    return docs.select(
        id_col,
        (remainder(id_col, 3) == 1).alias("held_out"),
        predicted(F.col(text_col), trees, docs.sparkSession).alias("__p"),
    ).select(id_col, "held_out", "__p.lang_pred", "__p.score")


def fit_fold(docs: DataFrame, parameters: Fit = Fit()) -> ContextTrees:
    """Fit on the documents that are not held out."""
    return fit(docs.where(remainder("doc_id", 3) != 1), parameters)


def drop_unidentified(docs: DataFrame, trees: ContextTrees, text_col: str = "text") -> DataFrame:
    """The documents with an identified language, with all their columns.

    Null texts and texts without a letter go, of any length; repeated rows stay or go together;
    an empty table gives an empty one; no column's name matters but the text's.
    """
    names = [f"`{c}`" for c in docs.columns]
    (own,) = free_names(docs, "predicted")
    found = docs.withColumn(own, predicted(F.col(text_col), trees, docs.sparkSession))
    return found.where(F.col(f"{own}.lang_pred") != UNKNOWN).select(*names)
