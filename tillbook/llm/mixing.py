"""Mixing sources to target weights by Sainte-Laguë apportionment.

Only DataFrame functions run here.  Sizes are words.  The sources' targets are paid out in
blocks of ``block`` words.  The blocks go to the sources, and a source's blocks to groups of its
shards and on to the shards, by the highest quotients ``share / (2k + 1)``.  A shard's documents lie end to end in a seeded
order, closed to a ring that is cut into blocks from a seeded start on; the shard takes as
many of these as its quota says, going round again when the quota exceeds the ring.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored, with_running


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix; the defaults are those of the registered query."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    #: No source, and so no document, is taken more than this many times.
    repeats: int = 3
    block: int = 64
    #: Words and documents of a shard, roughly: what one window sorts.
    shard_words: int = 1 << 20
    shard_docs: int = 1 << 12
    #: Shards of a source that are apportioned at once; more of them form groups.
    group_shards: int = 1 << 12
    seed: int = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Add ``src`` (rank by code point, null last) and ``target`` to one row per source.

    A source whose share by weight exceeds ``repeats`` times its size stops there and the
    excess is shared anew by weight, until none exceeds.  The driver sees three sums a round.
    """
    ranked = with_running(
        sources,
        [F.col("source").isNull(), F.encode(F.col("source").cast("string"), "utf-8")],
        "source_size", "src", "__before", "mix-sources",
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in mix.weights]),
        (F.col("src") % len(mix.weights) + 1).cast("int"),
    )
    most = (F.col("source_size") * mix.repeats).cast("double")
    ranked = stored(ranked.drop("__before").withColumns({"w": weight, "most": most}), "mix-weights")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("w") * level
        spent, open_weight, n = ranked.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("w"))),
            F.count(F.when(full, 1)),
        ).first()
        if n == stopped or not open_weight:
            break
        level, stopped = (total - spent) / open_weight, n
    return ranked.withColumn("target", F.least("most", F.col("w") * level)).drop("w", "most")


def apportioned(parts: DataFrame) -> DataFrame:
    """``(group, part, quota)`` from ``parts(group, part, share, most, seats)``.

    The ``seats`` of a group go to its parts by the highest quotients ``share / (2k + 1)``,
    no part getting more than ``most``; equal quotients go in the order of ``part``.  Rounding
    each part's proportional share misses the group's seats by at most half its number of
    parts, so only a few quotients either side of that rounding can decide.  Those are ranked,
    the ones before them are granted: about three rows a part however many seats there are.
    """
    group = Window.partitionBy("group")
    known = parts.withColumns(
        {"__all": F.sum("share").over(group), "__rows": F.count(F.lit(1)).over(group)}
    )
    part_of = F.when(F.col("__all") > 0, F.col("share") / F.col("__all")).otherwise(0.0)
    rough = F.round(part_of * F.col("seats")).cast("long")
    slack = F.ceil(part_of * F.col("__rows") / 2).cast("long") + 1
    near = (
        known.withColumns(
            {
                "__low": F.greatest(F.least(rough, "most") - slack, F.lit(0)),
                "__high": F.when(part_of > 0, F.least(rough + slack, "most")).otherwise(0),
            }
        )
        .withColumn("__granted", F.sum("__low").over(group))
        .withColumn(
            "__k",
            F.explode_outer(
                F.when(F.col("__high") > F.col("__low"), F.sequence("__low", F.col("__high") - 1))
            ),
        )
    )
    quotient = F.col("share") / (2 * F.col("__k") + 1)
    place = F.row_number().over(group.orderBy(quotient.desc_nulls_last(), "part"))
    won = F.col("__k").isNotNull() & (F.col("__place") <= F.col("seats") - F.col("__granted"))
    return (
        near.withColumn("__place", place)
        .groupBy("group", "part")
        .agg((F.first("__low") + F.count(F.when(won, 1))).alias("quota"))
    )


def shard_quotas(rings: DataFrame, mix: Mix) -> DataFrame:
    """``(__src, __shard, quota)`` from ``rings(__src, __shard, __ring, most, seats)``.

    The seats of a source go to groups of its shards, then those of a group to its shards, so
    that no window holds more than ``group_shards`` rows or a source's number of groups.
    """
    rings = rings.withColumn("team", F.floor(F.col("__shard") / mix.group_shards))
    teams = apportioned(
        rings.groupBy(F.col("__src").alias("group"), F.col("team").alias("part")).agg(
            F.sum("__ring").cast("double").alias("share"),
            F.sum("most").alias("most"),
            F.first("seats").alias("seats"),
        )
    ).select(F.col("group").alias("__src"), F.col("part").alias("team"), F.col("quota").alias("seats"))
    quotas = apportioned(
        rings.drop("seats")
        .join(teams, ["__src", "team"])
        .select(
            F.struct("__src", "team").alias("group"),
            F.col("__shard").alias("part"),
            F.col("__ring").cast("double").alias("share"),
            "most",
            "seats",
        )
    )
    return quotas.select(F.col("group.__src").alias("__src"), F.col("part").alias("__shard"), "quota")


def sized(docs: DataFrame, id_col: str, text_col: str, mix: Mix) -> DataFrame:
    """Add ``__size`` in words and the seeded ``__hash`` that shards and orders documents."""
    return docs.withColumns(
        {
            "__size": word_count(F.col(text_col)),
            "__hash": F.xxhash64(F.lit(mix.seed), id_col, text_col),
        }
    )


def planned(rows: DataFrame, source_col: str, mix: Mix) -> DataFrame:
    """Add to sized rows what the mix takes of them.

    ``__rounds`` whole passes, then words ``[__from1, __to1)`` and ``[__from2, __to2)``, both
    often empty; ``__taken`` is their sum; ``source_size`` and ``target`` are the source's.
    """
    sources = rows.groupBy(F.col(source_col).alias("source")).agg(
        F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    targets = stored(source_targets(sources, mix), "mix-targets")
    blocks = F.round(F.sum("source_size").over(Window.partitionBy()) / mix.block).cast("long")
    shards = F.greatest(
        F.ceil(F.col("source_size") / mix.shard_words), F.ceil(F.col("docs") / mix.shard_docs)
    )
    quotas = apportioned(
        targets.select(
            F.lit(0).alias("group"),
            F.col("src").alias("part"),
            F.col("target").alias("share"),
            _most("source_size", mix).alias("most"),
            blocks.alias("seats"),
        )
    ).select(F.col("part").alias("src"), F.col("quota").alias("seats"))
    targets = stored(
        targets.join(quotas, "src").withColumn("shards", shards.cast("long")), "mix-quotas"
    ).withColumnsRenamed(
        {c: f"__{c}" for c in ("src", "source", "docs", "seats", "shards")}
        | {"source_size": "__source_size", "target": "__target"}
    )

    dealt = rows.join(targets, F.col(source_col).eqNullSafe(F.col("__source"))).withColumn(
        "__shard", F.pmod("__hash", "__shards")
    )
    rings = stored(
        dealt.groupBy("__src", "__shard").agg(
            F.sum("__size").alias("__ring"), F.first("__seats").alias("seats")
        ),
        "mix-rings",
    ).withColumn("most", _most("__ring", mix))
    rings = stored(
        rings.join(shard_quotas(rings, mix), ["__src", "__shard"])
        .withColumn("__words", F.col("quota") * mix.block)
        .drop("seats", "most", "quota"),
        "mix-shards",
    )

    order = (
        Window.partitionBy("__src", "__shard")
        .orderBy("__hash", "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    laid = dealt.withColumn("__at", F.coalesce(F.sum("__size").over(order), F.lit(0)))
    laid = laid.join(rings, ["__src", "__shard"])
    ring = F.col("__ring")
    rest = F.when(ring > 0, F.col("__words") % ring).otherwise(0)
    start = F.when(
        ring > 0, F.pmod(F.xxhash64(F.lit(mix.seed), "__src", "__shard"), ring)
    ).otherwise(0)
    laid = laid.withColumns(
        {
            "__rounds": F.when(ring > 0, F.floor(F.col("__words") / ring)).otherwise(0),
            "__start": start,
            "__stop": start + rest,
        }
    )

    def within(word: Column) -> Column:
        return F.least(F.greatest(word - F.col("__at"), F.lit(0)), "__size")

    laid = laid.withColumns(
        {
            "__from1": within(F.col("__start")),
            "__to1": within(F.least("__stop", "__ring")),
            "__from2": F.lit(0).cast("long"),
            "__to2": within(F.col("__stop") - ring),
        }
    )
    cut = F.col("__to1") - F.col("__from1") + F.col("__to2")
    return laid.withColumn("__taken", F.col("__rounds") * F.col("__size") + cut)


def _most(size: str, mix: Mix) -> Column:
    return F.floor(F.col(size) * mix.repeats / mix.block).cast("long")


def mix_plan(
    docs: DataFrame,
    mix: Mix = Mix(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, ``size``, its source's ``source_size`` and ``target``, ``taken``.

    A null or blank text has size 0 and nothing is taken of it.  A null source is a source,
    the last one.  Repeated rows count and are taken one by one.  An empty table gives none;
    other columns are not read.
    """
    rows = sized(docs.select(id_col, text_col, source_col), id_col, text_col, mix)
    light = stored(rows.drop(text_col), "mix-sizes")
    return planned(light, source_col, mix).select(
        id_col,
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    mix: Mix = Mix(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """The mix itself: a row for each time a document is taken, with the columns of ``docs``.

    Where a quota ends inside a document, the row has the text of the words taken and, in
    ``length_col``, its length.  Documents of which nothing is taken, blank ones and null texts
    included, are left out.  Null sources are a source; repeated rows are taken one by one; an
    empty table gives an empty one; no column's name matters but the four given.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col, source_col)]
    # Other columns travel as one, so that their names meet none of the plan's.
    carried = [F.struct(*[f"`{c}`" for c in others]).alias("rest")] if others else []
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), *carried
    )
    laid = planned(sized(rows, "id", "text", mix), "source", mix)
    whole = F.array_repeat(
        F.struct(F.lit(0).cast("long").alias("lo"), F.col("__size").alias("hi")),
        F.col("__rounds").cast("int"),
    )
    parts = F.array(
        F.struct(F.col("__from1").alias("lo"), F.col("__to1").alias("hi")),
        F.struct(F.col("__from2").alias("lo"), F.col("__to2").alias("hi")),
    )
    spans = F.filter(F.concat(whole, parts), lambda s: s["hi"] > s["lo"])
    taken = laid.where("__taken > 0").withColumn("__span", F.explode(spans))
    partial = F.col("__span.hi") - F.col("__span.lo") < F.col("__size")
    cut = F.when(partial, words_between(F.col("text"))).otherwise(F.col("text"))
    taken = taken.withColumn("text", cut).withColumn("__partial", partial)
    values = {id_col: F.col("id"), text_col: F.col("text"), source_col: F.col("source")}
    values |= {c: F.col("rest").getField(c) for c in others}
    if length_col in others:
        length = F.length("text").cast(docs.schema[length_col].dataType)
        values[length_col] = F.when(F.col("__partial"), length).otherwise(values[length_col])
    return taken.select(*[values[c].alias(c) for c in docs.columns])


def words_between(text: Column) -> Column:
    """The text from word ``__span.lo`` to before word ``__span.hi``, white space as it is."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    lo = F.col("__span.lo").cast("int")
    pieces = F.slice(ends, lo + 1, F.col("__span.hi").cast("int") - lo)
    return F.ltrim(F.array_join(pieces, ""), F.lit(" \t\n\x0b\x0c\r"))
