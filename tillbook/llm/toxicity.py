"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Texts are folded to a skeleton: letters that look alike and digits that stand for letters
become one letter.  The lexicon holds word beginnings and whole words that mark toxic texts in
a bounded labelled sample, each weighing its log-odds; exception phrases are lexicon words with
a neighbour that only clean texts hold.  A text's weight, less its exceptions, plain and
normalised by its length, gives the score by logistic regression.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored

# Characters of other scripts that look like Latin letters, then the digits and
# signs that stand for letters.  i, l and 1 cannot be told apart and are one.
_LOOKALIKES = "аaаaвbсcеeнhіlјjкkмmоoрpѕsтtуyхxαaβbεeιlκkνvοoρpτtυuχxılil"
_DIGITS = "0o1l3e4a5s7t8b9g@a$s!l|l"
_FOLD = {ord(a): b for a, b in zip(_LOOKALIKES[::2], _LOOKALIKES[1::2])}
_SIGNS = {ord(a): b for a, b in zip(_DIGITS[::2], _DIGITS[1::2])}
_MASKED = re.compile(r"[\w@$!|]*[0-9@$!|][\w@$!|]*")
_WORD = re.compile(r"\w+")
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; the defaults are those of the registered query."""

    #: Labelled texts taken, roughly; whole texts, chosen by a hash.
    sample: int = 16_000
    #: Shortest and longest word beginning.
    shortest: int = 3
    longest: int = 9
    #: Toxic texts of the sample that must hold an entry, and its least log-odds.
    texts: int = 6
    log_odds: float = 3.0
    entries: int = 5_000
    exceptions: tuple[str, ...] = ()


def folded_words(text: str | None) -> list[str]:
    """Folded words; digits and signs stand for letters only in a word with a letter."""
    if not text:
        return []
    plain = text.lower()
    if not plain.isascii():
        plain = unicodedata.normalize("NFKC", plain)
    return _WORD.findall(_MASKED.sub(_unmasked, plain.translate(_FOLD)))


def _unmasked(match: re.Match) -> str:
    word = match[0].strip("!|")
    return word.translate(_SIGNS) if _LETTER.search(word) else word


@dataclass
class Lexicon:
    """Entries with weights: ``^abc`` is a word beginning, ``abc`` a whole word."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    #: Intercept and slopes of the logistic score.
    slopes: tuple[float, ...] = (-4.0, 4.0, 0.0)
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_machine": None}

    def machine(self):
        if self._machine is None:
            machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                key = " " + entry[1:] if entry.startswith("^") else f" {entry} "
                machine.add_word(key, ("entry", len(key), weight))
            for phrase in self.exceptions:
                machine.add_word(f" {phrase} ", ("exception", len(phrase) + 2, 0.0))
            if len(machine):
                machine.make_automaton()
            self._machine = machine
        return self._machine

    def hits(self, words: list[str]) -> dict[int, float]:
        """For each word hit its heaviest entry's weight; words inside an exception don't count.

        Positions are offsets into the words joined by spaces, with one in front.
        """
        machine = self.machine()
        if not len(machine) or not words:
            return {}
        line = f" {' '.join(words)} "
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for last, (kind, length, weight) in machine.iter(line):
            start = last + 1 - length
            if kind == "entry":
                found[start] = max(weight, found.get(start, 0.0))
            else:
                excepted.append((start, last))
        return without(found, excepted) if excepted else found

    def features(self, words: list[str]) -> tuple[float, float]:
        weight = sum(self.hits(words).values())
        return math.log1p(weight), math.log1p(10.0 * weight / math.sqrt(len(words) + 1.0))

    def score(self, text: str | None) -> float:
        a, b = self.features(folded_words(text))
        z = self.slopes[0] + self.slopes[1] * a + self.slopes[2] * b
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def without(found: dict[int, float], spans: list[tuple[int, int]]) -> dict[int, float]:
    """What lies in none of the spans ``[start, stop)``, in one pass over both in order."""
    spans = sorted(spans)
    out: dict[int, float] = {}
    k = reach = 0
    for at in sorted(found):
        while k < len(spans) and spans[k][0] <= at:
            reach = max(reach, spans[k][1])
            k += 1
        if at >= reach:
            out[at] = found[at]
    return out


def entries_of(words: Iterable[str], shortest: int, longest: int) -> set[str]:
    out: set[str] = set()
    for word in set(words):
        out.add(word)
        out.update("^" + word[:n] for n in range(shortest, min(longest, len(word)) + 1))
    return out


def family(words: list[str]) -> int:
    """Equal for copies and, mostly, for near copies: the least hash of three words in a row."""
    rows = zip(words, words[1:], words[2:]) if len(words) > 2 else [tuple(words)]
    return min(zlib.crc32(" ".join(r).encode()) for r in rows)


def _drawn(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """``(words, toxic)`` of a bounded sample of labelled texts, one of each family."""
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    most = fit.sample / max(1, marked.count()) * (1 << 30)
    picked = marked.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < most)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [folded_words(t) for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "words": [" ".join(w) for w in words],
                    "toxic": frame["toxic"],
                    "family": [family(w) for w in words],
                }
            )

    folded = docs.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic")
    folded = folded.mapInPandas(fold, "words string, toxic int, family bigint")
    # Copies would make every rare word of a toxic text look like a mark of toxicity.
    single = folded.groupBy("toxic", "family").agg(F.min("words").alias("words"))
    return stored(single.select("words", "toxic"), "toxicity-sample")


def _counted(rows: DataFrame, keys) -> DataFrame:
    """``(key, toxic, clean)``: in how many texts of either kind each key lies."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for frame in frames:
            for line, toxic in zip(frame["words"], frame["toxic"]):
                for key in keys(line.split(" ") if line else []):
                    counts[key][0 if toxic else 1] += 1
        yield pd.DataFrame(
            [(k, a, b) for k, (a, b) in counts.items()], columns=["key", "toxic", "clean"]
        )

    return (
        rows.mapInPandas(count, "key string, toxic bigint, clean bigint")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def fit(docs: DataFrame, labels: DataFrame, parameters: Fit = Fit()) -> Lexicon:
    """Learn lexicon, exceptions and slopes from ``docs(doc_id, text)`` with ``labels``.

    Labels without a document, null labels and null texts are harmless; a document labelled
    twice is toxic if either says so.  Without labelled texts the lexicon is empty.
    """
    p = parameters
    rows = _drawn(docs, labels, p)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sum(n for kind, n in sizes.items() if kind != 1)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1.0)
    )
    marks = (
        _counted(rows, lambda words: entries_of(words, p.shortest, p.longest))
        .withColumn("odds", odds)
        .where((F.col("toxic") >= p.texts) & (F.col("odds") >= p.log_odds))
        .orderBy(F.col("toxic").desc(), F.length("key"), "key")
        .limit(p.entries)
    )
    lexicon = Lexicon(_shortest([(r["key"], r["odds"]) for r in marks.collect()]))

    def phrases(words: list[str]) -> set[str]:
        return set(neighbours(words, lexicon))

    innocent = (
        _counted(rows, phrases).where((F.col("toxic") == 0) & (F.col("clean") >= 3))
        .orderBy(F.col("clean").desc(), "key").limit(p.entries)
    )
    given = {" ".join(folded_words(e)) for e in p.exceptions}
    lexicon = Lexicon(
        lexicon.weights, frozenset(given | {r["key"] for r in innocent.collect()})
    )

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = [lexicon.features(w.split(" ") if w else []) for w in frame["words"]]
            yield pd.DataFrame(
                {"a": [x for x, _ in pairs], "b": [y for _, y in pairs], "toxic": frame["toxic"]}
            )

    sample = rows.mapInPandas(featured, "a double, b double, toxic int").collect()
    data = np.array([[1.0, r["a"], r["b"]] for r in sample]).reshape(-1, 3)
    wanted = np.array([float(r["toxic"] == 1) for r in sample])
    return Lexicon(lexicon.weights, lexicon.exceptions, logistic(data, wanted))


def _shortest(marks: list[tuple[str, float]]) -> dict[str, float]:
    """Leave out an entry that begins with a kept one at least as heavy, up to a tenth."""
    kept: dict[str, float] = {}
    for key, odds in sorted(marks, key=lambda m: (len(m[0].lstrip("^")), not m[0].startswith("^"), m[0])):
        bare = key.lstrip("^")
        covered = max((kept.get("^" + bare[:n], 0.0) for n in range(1, len(bare) + 1)), default=0.0)
        if covered < odds - 0.1 * abs(odds) or covered == 0.0:
            kept[key] = odds
    return kept


def neighbours(words: list[str], lexicon: Lexicon) -> Counter:
    """Phrases of a word hit and the word before or after it."""
    out: Counter = Counter()
    at, starts = 0, {}
    for i, word in enumerate(words):
        starts[at] = i
        at += len(word) + 1
    for offset in lexicon.hits(words):
        i = starts[offset]
        if i:
            out[f"{words[i - 1]} {words[i]}"] += 1
        if i + 1 < len(words):
            out[f"{words[i]} {words[i + 1]}"] += 1
    return out


def logistic(data: np.ndarray, wanted: np.ndarray, penalty: float = 1e-2) -> tuple[float, ...]:
    """Newton's method with a small ridge penalty; a few dozen steps on a bounded sample."""
    slopes = np.zeros(data.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(data @ slopes, -50, 50)))
        gradient = data.T @ (wanted - p) - penalty * slopes
        curve = (data * (p * (1 - p))[:, None]).T @ data + penalty * np.eye(len(slopes))
        step = np.linalg.solve(curve, gradient)
        slopes += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(s) for s in slopes)


def scored(
    docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``held_out`` (crc32 of the id is 0 modulo 5), ``score`` and
    ``predicted``.  A null text scores as an empty one.  Repeated rows stay."""
    model = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.value.score(t.as_py()) for t in texts], pa.float64())

    return docs.select(
        id_col,
        (remainder(id_col, 5) == 0).alias("held_out"),
        score(F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit_fold(docs: DataFrame, labels: DataFrame, parameters: Fit = Fit()) -> Lexicon:
    """Fit on the documents that are not held out."""
    return fit(
        docs.where(remainder("doc_id", 5) != 0),
        labels.where(remainder("doc_id", 5) != 0),
        parameters,
    )
