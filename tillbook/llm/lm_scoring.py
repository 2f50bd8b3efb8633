"""Bigram language model by deleted interpolation, scored over the whole corpus.

Texts are packed into blocks of a few million tokens: token numbers and the hashes of the
block's own words.  Each block sends its distinct n-grams with their counts, packed by range of
hash, to where the corpus totals are summed, and gets the totals back in the same order.  So
what moves is a block's distinct n-grams, not its tokens, and no task holds the model.  Common
n-grams come from every block, so past ``fan_in`` blocks these are dealt to crowds: a crowd's
counts are summed first, the totals are summed over crowds, and go back by the same way.

P(w | v) = l(v) c(vw)/c(v) + (1 - l(v)) (c(w) + 1)/(N + V + 1).  The weight l depends on the
bucket of c(v), a power of two.  A tenth of the training texts is deleted from the counts and
the weights are fitted to it by expectation-maximisation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored

HELD_OUT, RETAINED, DELETED = 0, 1, 2
#: The end token and the context before a first word; no word has these hashes but by chance.
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BUCKETS = 65


@dataclass(frozen=True)
class Model:
    """Parameters of the fit; the defaults are those of the registered query."""

    #: UTF-8 bytes of text in a block: bounds a task's memory and the n-grams sent per token.
    block_bytes: int = 6 << 20
    #: Tokens of the corpus per range of hashes.
    range_tokens: int = 1 << 21
    #: Blocks whose counts of a range are summed at once.
    fan_in: int = 1 << 12
    deleted: int = 10
    rounds: int = 12


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, so that equal high bytes lie together, then compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _blocks(limit: int):
    """Pack texts into blocks; deleted ones go to blocks of their own."""

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        made = 0
        open_ = {False: _Block(), True: _Block()}
        for frame in frames:
            for id_, text, role in zip(frame["id"], frame["text"], frame["role"]):
                block = open_[role == DELETED]
                block.add(id_, text, role)
                if block.size >= limit:
                    yield block.row(first + made, role == DELETED)
                    made += 1
                    open_[role == DELETED] = _Block()
        for deleted, block in open_.items():
            if block.roles:
                yield block.row(first + made, deleted)
                made += 1

    return blocks


class _Block:
    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids: list[object] = []
        self.roles: list[int] = []
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, id_: object, text: bytes | None, role: int) -> None:
        words = text.lower().split() if text else []
        number = self.number
        # Number 0 is the end token.
        numbers = [number.setdefault(w, len(number) + 1) for w in words]
        numbers.append(0)
        self.ids.append(id_)
        self.roles.append(role)
        self.texts.append(np.array(numbers, np.int32))
        self.size += len(text or b"") + 1

    def row(self, block: int, deleted: bool) -> pd.DataFrame:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.number), np.uint64, len(self.number))
        lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        ids = [None if pd.isna(i) else i for i in self.ids]
        return pd.DataFrame(
            {
                "block": [block],
                "deleted": [deleted],
                "train": [int(lengths[np.array(self.roles) != HELD_OUT].sum())],
                "starts": [sum(r != HELD_OUT for r in self.roles)],
                "retained_starts": [sum(r == RETAINED for r in self.roles)],
                "retained": [int(lengths[np.array(self.roles) == RETAINED].sum())],
                "tokens": [int(lengths.sum())],
                "ids": [ids],
                "roles": [bytes(self.roles)],
                "lengths": [pack(lengths)],
                "words": [pack(hashes)],
                "text": [pack(np.concatenate(self.texts))],
            }
        )


class _Grams:
    """Distinct hashes of a block's words and word pairs, and where its tokens are in them."""

    def __init__(self, row: pd.Series) -> None:
        self.roles = np.frombuffer(row["roles"], np.uint8)
        self.lengths = unpack(row["lengths"], "<i8")
        text = unpack(row["text"], "<i4")
        hashes = np.r_[END, unpack(row["words"], "<u8")]
        one = hashes[text]
        before = np.r_[START, one[:-1]]
        self.first = np.cumsum(np.r_[0, self.lengths[:-1]])
        before[self.first] = START
        two = _mixed(before, one)
        self.role = np.repeat(self.roles, self.lengths)
        self.orders = [np.unique(keys, return_inverse=True) for keys in (one, two)]

    def counts(self, order: int, role: int) -> np.ndarray:
        keys, at = self.orders[order]
        return np.bincount(at[self.role == role], minlength=len(keys)).astype(np.int64)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B185EBCA87)) ^ (b + np.uint64(0x165667B19E3779F9))
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x165667B19E3779F9)
        return x ^ (x >> np.uint64(32))


def _sent(bits: int):
    """A block's distinct n-grams and counts, one row per order and range of hashes."""

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                grams = _Grams(row)
                for order in (0, 1):
                    keys = grams.orders[order][0]
                    kept = grams.counts(order, RETAINED)
                    gone = grams.counts(order, DELETED)
                    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(1 << bits)) if bits else np.array([0])
                    cuts = np.r_[cuts, len(keys)]
                    filled = np.flatnonzero(np.diff(cuts))
                    part = [slice(cuts[k], cuts[k + 1]) for k in filled]
                    yield pd.DataFrame(
                        {
                            "range": (order << 32) + filled,
                            "block": row["block"],
                            "deleted": row["deleted"],
                            "keys": [pack(np.diff(keys[p], prepend=np.uint64(0))) for p in part],
                            "kept": [pack(kept[p]) for p in part],
                            "gone": [pack(gone[p]) for p in part],
                        }
                    )

    return sent


class _Union:
    """The n-grams that some blocks, or crowds of them, sent for one range, and their sums."""

    def __init__(self, rows: pd.DataFrame) -> None:
        with np.errstate(over="ignore"):
            keys = [np.cumsum(unpack(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
        self.cuts = np.cumsum([0, *map(len, keys)])
        self.keys, self.at = np.unique(np.concatenate(keys), return_inverse=True)

    def summed(self, column: pd.Series) -> np.ndarray:
        return _summed(self.at, [unpack(c, "<i8") for c in column], len(self.keys))

    def answers(self, rows: pd.DataFrame, every: np.ndarray, kept: np.ndarray) -> pd.DataFrame:
        """The totals of its n-grams for each row, in the order in which it sent them."""
        own = [self.at[a:b] for a, b in zip(self.cuts, self.cuts[1:])]
        return pd.DataFrame(
            {
                "block": rows["block"],
                "range": rows["range"],
                "deleted": rows["deleted"],
                "every": [pack(every[a]) for a in own],
                # Only blocks of deleted texts are asked for the counts without them.
                "kept": [pack(kept[a]) if d else b"" for a, d in zip(own, rows["deleted"])],
            }
        )


def _totalled(rows: pd.DataFrame) -> pd.DataFrame:
    """Sum the counts of one range over all its rows and answer each."""
    union = _Union(rows)
    kept = union.summed(rows["kept"])
    every = kept + union.summed(rows["gone"])
    first_order = rows["range"].iat[0] >> 32 == 0
    zeros = [0] * (len(rows) - 1)
    return union.answers(rows, every, kept).assign(
        kinds=[int((every > 0).sum()) if first_order else 0, *zeros],
        kept_kinds=[int((kept > 0).sum()) if first_order else 0, *zeros],
    )


def _crowded(rows: pd.DataFrame) -> pd.DataFrame:
    """Sum the counts of one range over a crowd, which then asks like a block."""
    union = _Union(rows)
    return pd.DataFrame(
        {
            "range": [rows["range"].iat[0]],
            "block": [rows["crowd"].iat[0]],
            "deleted": [bool(rows["deleted"].any())],
            "keys": [pack(np.diff(union.keys, prepend=np.uint64(0)))],
            "kept": [pack(union.summed(rows["kept"]))],
            "gone": [pack(union.summed(rows["gone"]))],
        }
    )


def _passed_on(rows: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """Answer the blocks of a crowd from what the crowd was answered."""
    every = unpack(totals["every"].iat[0], "<i8")
    kept = unpack(totals["kept"].iat[0], "<i8") if totals["deleted"].iat[0] else every
    return _Union(rows).answers(rows, every, kept)


SENT = "range bigint, block bigint, deleted boolean, keys binary, kept binary, gone binary"
ANSWER = "block bigint, range bigint, deleted boolean, every binary, kept binary"


def _exchanged(blocks: DataFrame, bits: int, crowds: int) -> tuple[DataFrame, DataFrame]:
    """Corpus counts for every block and range, and the table that has the number of kinds."""

    def totals(asked: DataFrame, purpose: str) -> DataFrame:
        kinds = "kinds bigint, kept_kinds bigint"
        return stored(asked.groupBy("range").applyInPandas(_totalled, f"{ANSWER}, {kinds}"), purpose)

    sent = blocks.mapInPandas(_sent(bits), SENT)
    if crowds == 1:
        answers = totals(sent, "lm-answers")
        return answers, answers
    # What blocks send is made twice, as it is larger than what makes it.
    sent = sent.withColumn("crowd", F.pmod(F.xxhash64("block"), F.lit(crowds)))
    answered = totals(sent.groupBy("range", "crowd").applyInPandas(_crowded, SENT), "lm-totals")
    back = answered.select("range", F.col("block").alias("crowd"), "deleted", "every", "kept")
    answers = (
        sent.drop("kept", "gone")
        .groupBy("range", "crowd")
        .cogroup(back.groupBy("range", "crowd"))
        .applyInPandas(_passed_on, ANSWER)
    )
    return stored(answers, "lm-answers"), answered


def _summed(at: np.ndarray, parts: list[np.ndarray], n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, np.concatenate(parts))
    return out


def _answered(grams: _Grams, answers: pd.DataFrame, name: str) -> list[np.ndarray]:
    """Corpus counts of every token's word and of the pair it ends."""
    rows = answers.sort_values("range")
    counts = np.concatenate([unpack(c, "<i8") for c in rows[name]])
    n = len(grams.orders[0][0])
    return [counts[:n][grams.orders[0][1]], counts[n:][grams.orders[1][1]]]


def _parts(grams: _Grams, counts: list[np.ndarray], tokens: int, kinds: int, starts: int):
    """Bucket, bigram and unigram probability of every token."""
    one, two = counts
    context = np.r_[0, one[:-1]]
    context[grams.first] = starts
    bucket = np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(np.int64), 0)
    return bucket, two / np.maximum(context, 1), (one + 1.0) / (tokens + kinds + 1.0)


def _weights(deleted: DataFrame, rounds: int) -> np.ndarray:
    """Expectation-maximisation over the deleted texts; one bigram weight a bucket.

    Every bucket has one made-up token split evenly, so an unseen bucket weighs one half.  A
    context that was never seen has bucket 0, whose weight is 0.
    """
    spark = deleted.sparkSession
    weights = np.full(BUCKETS, 0.5)
    weights[0] = 0.0
    for _ in range(rounds):
        known = spark.sparkContext.broadcast(weights)

        def expected(frames: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            total, share = np.zeros(BUCKETS), np.zeros(BUCKETS)
            for frame in frames:
                for _, row in frame.iterrows():
                    bucket = unpack(row["bucket"], "<i8")
                    two, one = unpack(row["two"], "<f8"), unpack(row["one"], "<f8")
                    a = known.value[bucket] * two
                    n = unpack(row["n"], "<i8")
                    b = (1 - known.value[bucket]) * one
                    total += np.bincount(bucket, n, BUCKETS)
                    share += np.bincount(bucket, n * a / (a + b), BUCKETS)
            yield pd.DataFrame({"bucket": np.arange(BUCKETS), "total": total, "share": share})

        sums = (
            deleted.mapInPandas(expected, "bucket bigint, total double, share double")
            .groupBy("bucket")
            .agg(F.sum("total").alias("total"), F.sum("share").alias("share"))
            .collect()
        )
        for row in sums:
            if row["bucket"]:
                weights[row["bucket"]] = (row["share"] + 0.5) / (row["total"] + 1.0)
    return weights


def score_texts(
    docs: DataFrame,
    held_out: Column,
    model: Model = Model(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``held_out``, token counts, ``base_score`` and ``score``.

    The model learns from the rows where ``held_out`` is false or null.  Scores are log10
    probabilities of all words and the end token.  A null text is an empty one: its end token
    alone.  Repeated rows count and are scored one by one; an empty table gives none; without
    training text every probability is that of the uniform remainder.  Words and pairs are
    known by 64-bit hashes.  Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    deleted = F.pmod(F.xxhash64(F.lit(3), id_col, text_col), F.lit(model.deleted)) == 0
    role = F.when(held_out, HELD_OUT).when(deleted, DELETED).otherwise(RETAINED)
    blocks = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), role.alias("role")
        ).mapInPandas(
            _blocks(model.block_bytes),
            "block bigint, deleted boolean, train bigint, starts bigint, retained_starts bigint, "
            f"retained bigint, tokens bigint, ids array<{id_type}>, roles binary, lengths binary, "
            "words binary, text binary",
        ),
        "lm-blocks",
    )
    size = blocks.agg(
        F.count(F.lit(1)).alias("blocks"),
        *[F.sum(c).alias(c) for c in ("tokens", "train", "starts", "retained", "retained_starts")],
    ).first()
    ranges = max(1, (size["tokens"] or 0) // model.range_tokens)
    crowds = max(1, -(-size["blocks"] // model.fan_in))
    answers, totals = _exchanged(blocks, (ranges - 1).bit_length(), crowds)
    kinds = totals.agg(F.sum("kinds").alias("every"), F.sum("kept_kinds").alias("kept")).first()
    train, starts = size["train"] or 0, size["starts"] or 0
    every_kinds = kinds["every"] or 0
    kept_size = (size["retained"] or 0, kinds["kept"] or 0, size["retained_starts"] or 0)

    def fitted(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams = _Grams(block.iloc[0])
        bucket, two, one = _parts(grams, _answered(grams, answers, "kept"), *kept_size)
        _, cell, n = np.unique(grams.orders[1][1], return_index=True, return_counts=True)
        return pd.DataFrame(
            {
                "bucket": [pack(bucket[cell])],
                "two": [pack(two[cell])],
                "one": [pack(one[cell])],
                "n": [pack(n.astype(np.int64))],
            }
        )

    deleted_parts = stored(
        _together(blocks.where("deleted"), answers.where("deleted").select("block", "range", "kept"))
        .applyInPandas(fitted, "bucket binary, two binary, one binary, n binary"),
        "lm-deleted",
    )
    weights = docs.sparkSession.sparkContext.broadcast(_weights(deleted_parts, model.rounds))

    def scored(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        grams = _Grams(row)
        counts = _answered(grams, answers, "every")
        bucket, two, one = _parts(grams, counts, train, every_kinds, starts)
        share = weights.value[bucket]
        base = np.log10((counts[0] + 1.0) / (train + every_kinds + 1.0))
        return pd.DataFrame(
            {
                id_col: pd.Series(list(row["ids"]), dtype=object),
                "held_out": grams.roles == HELD_OUT,
                "n_tokens": grams.lengths,
                "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), grams.first),
                "train_tokens": train,
                "base_score": np.add.reduceat(base, grams.first),
                "score": np.add.reduceat(np.log10(share * two + (1 - share) * one), grams.first),
            }
        )

    return _together(blocks, answers.select("block", "range", "every")).applyInPandas(
        scored,
        f"`{id_col}` {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double",
    )


def _together(blocks: DataFrame, answers: DataFrame):
    return blocks.groupBy("block").cogroup(answers.groupBy("block"))


def fold_scores(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """Score ``documents``, holding out those whose crc32 of the id is 2 modulo 7."""
    return score_texts(docs, remainder("doc_id", 7) == 2, model)
