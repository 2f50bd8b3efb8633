"""Enrichment by left lookups.

No broadcast is forced here.  A dimension is broadcast only when Catalyst's estimate or
the size adaptive execution measures stays under ``spark.sql.autoBroadcastJoinThreshold``;
beyond it the join is a sort-merge join whose hot partitions adaptive execution splits.
``salted_lookup`` splits hot keys without adaptive execution.  The named lookups below take
either of the two as ``join``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terminals import bank_prefix
from ..functions.text import canonical_state, match_key


Join = Callable[[DataFrame, DataFrame, Column, str, Mapping[str, str]], DataFrame]


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: Column,
    dim_key: str,
    take: Mapping[str, str],
    *,
    unique: bool = False,
) -> DataFrame:
    """Left join that adds ``take`` (output name to dimension column) to every fact row.

    Duplicate dimension keys multiply fact rows; ``unique=True`` fails on them instead.
    """
    payload = dim.select(
        F.col(dim_key).alias("__key"), *[F.col(src).alias(out) for out, src in take.items()]
    )
    joined = (
        facts.withColumn("__fact_key", fact_key)
        .join(payload, F.col("__fact_key") == F.col("__key"), "left")
        .drop("__fact_key", "__key")
    )
    return joined.unionByName(duplicate_guard(dim, dim_key, joined)) if unique else joined


def duplicate_guard(df: DataFrame, key: str, like: DataFrame) -> DataFrame:
    """No rows, shaped as ``like``; fails the job that unions it when a key repeats.

    Counting keys in a branch of its own reads one column and combines before the shuffle,
    and leaves the join inputs as plain shuffles, which adaptive execution can split.
    """
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    message = F.concat(F.lit(f"duplicate {key}: "), F.col("__key").cast("string"))
    repeated = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(False)
    # The key keeps its value: a constant null would let a later join drop the branch.
    return counts.where(repeated).select(
        *[
            (F.col("__key") if f.name == key else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in like.schema.fields
        ]
    )


def heavy_keys(df: DataFrame, key: Column, share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: at most ``1/share`` of them.

    One pass over the key column; the total is the sum of the counts.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    counts = df.groupBy(key.alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n"))
    return counts.where(
        F.col("__hot").isNotNull() & (F.col("__n") >= F.lit(share) * total.scalar())
    ).select("__hot")


def salted_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: Column,
    dim_key: str,
    take: Mapping[str, str],
    *,
    share: float = 0.01,
    salts: int = 64,
    hot: DataFrame | None = None,
    row_id: Column | None = None,
) -> DataFrame:
    """``lookup`` that spreads each hot key, and null keys, over ``salts`` partitions.

    Only hot dimension rows are copied.  The salt is a hash, not random, so a recomputed task
    sends its rows where the lost one did.  ``row_id`` tells rows apart and is hashed for it.
    Without one, equal rows are counted first, which costs a shuffle of the facts but combines
    inside each task; the counts are spread over the salts, joined and written out again, so
    that a key held by equal rows is split as well.  For several lookups in a row on the same
    key, find the hot keys once with ``heavy_keys`` and pass them as ``hot``.
    """
    if hot is None:
        # At most 1/share rows, so this broadcast has a fixed bound.
        hot = F.broadcast(heavy_keys(facts, fact_key, share))
    columns = [F.col(_quoted(c)) for c in facts.columns]
    if row_id is None:
        rows = facts.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
        first_salt = F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")
    else:
        rows = facts.withColumn("__rows", F.lit(1).cast("long"))
        first_salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    spread = F.col("__hot").isNotNull() | F.col("__fact_key").isNull()
    pieces = F.when(spread, F.least("__rows", F.lit(salts).cast("long"))).otherwise(F.lit(1))
    salted_facts = (
        rows.withColumn("__fact_key", fact_key)
        .join(hot, F.col("__fact_key") == F.col("__hot"), "left")
        .withColumns({"__spread": spread, "__pieces": pieces})
        .withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__pieces") - 1)))
        .withColumns(
            {
                "__fact_salt": F.when(
                    F.col("__spread"), ((first_salt + F.col("__piece")) % salts).cast("int")
                ).otherwise(0),
                # Shares of the count differ by one at most.
                "__share": F.floor(F.col("__rows") / F.col("__pieces"))
                + (F.col("__piece") < F.col("__rows") % F.col("__pieces")).cast("long"),
            }
        )
        .drop("__hot", "__rows", "__spread", "__pieces", "__piece")
    )
    payload = dim.select(
        F.col(dim_key).alias("__key"), *[F.col(src).alias(out) for out, src in take.items()]
    )
    copies = F.when(
        F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    # A null key matches nothing, but would in a pair.
    salted_dim = (
        payload.where(F.col("__key").isNotNull())
        .join(hot, F.col("__key") == F.col("__hot"), "left")
        .withColumn("__salt", F.explode(copies))
        .drop("__hot")
    )
    # As one value: two conditions would be met by rows that lie together by the key alone.
    joined = salted_facts.join(
        salted_dim,
        F.struct(F.col("__fact_key").alias("k"), F.col("__fact_salt").alias("s"))
        == F.struct(F.col("__key").alias("k"), F.col("__salt").alias("s")),
        "left",
    )
    if row_id is None:
        joined = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__share")))
        joined = joined.drop("__copy")
    return joined.drop("__fact_key", "__fact_salt", "__key", "__salt", "__share")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def add_agent(
    facts: DataFrame, agents: DataFrame, take: Mapping[str, str], join: Join = lookup
) -> DataFrame:
    """Attach agent columns by wallet."""
    return join(facts, agents, F.col("wallet"), "wallet_id", take)


def prepare_agent_states(agents: DataFrame) -> DataFrame:
    """Agents with their canonical state."""
    return agents.withColumn("agent_state", canonical_state(F.col("state_of_residence")))


def add_state_by_name(
    facts: DataFrame, states: DataFrame, state: str = "agent_state", join: Join = lookup
) -> DataFrame:
    """Attach state and region by state name, ignoring case and outer spaces."""
    keyed = states.withColumn("state_key", match_key(F.col("state")))
    taken = {"state": "state", "region": "region"}
    return join(facts, keyed, match_key(F.col(state)), "state_key", taken)


def add_region(facts: DataFrame, states: DataFrame, join: Join = lookup) -> DataFrame:
    """State initials to state and region."""
    taken = {"state": "state", "region": "region"}
    return join(facts, states, F.col("state_initials"), "state_initials", taken)


def add_state_region(
    facts: DataFrame, terminals: DataFrame, states: DataFrame, join: Join = lookup
) -> DataFrame:
    """Terminal to state initials to state and region."""
    taken = {"state_initials": "state_initials"}
    located = join(facts, terminals, F.col("terminal_id"), "terminal_id", taken)
    return add_region(located, states, join)


def add_bank(
    facts: DataFrame,
    banks: DataFrame,
    *,
    output: str = "bank",
    dotted: int = 5,
    plain: int = 4,
    join: Join = lookup,
) -> DataFrame:
    """Attach the bank named by the id prefix."""
    prefix = bank_prefix(F.col("terminal_id"), dotted, plain)
    return join(facts, banks, prefix, "bank_code", {output: "bank"})


def add_device(
    facts: DataFrame, devices: DataFrame, take: Mapping[str, str], join: Join = lookup
) -> DataFrame:
    """Attach device-inventory columns; inventory ids must be cleaned already."""
    return join(facts, devices, F.col("terminal_id"), "trm_termid", take)


def flag_membership(
    df: DataFrame,
    members: DataFrame | None,
    flag: str,
    key: str = "terminal_id",
    join: Join = lookup,
) -> DataFrame:
    """Column ``flag``: 1 where the key occurs in ``members``, else 0 (0 for all if None).

    Adaptive execution cannot split a hot key of ``df`` here, because the other side is
    aggregated on the way in: deduplicate ``df`` first or pass ``salted_lookup``.
    """
    if members is None:
        return df.withColumn(flag, F.lit(0))
    ids = members.select(key).distinct().withColumn("__hit", F.lit(1))
    flagged = join(df, ids, F.col(key), key, {"__hit": "__hit"})
    return flagged.withColumn(flag, F.coalesce("__hit", F.lit(0))).drop("__hit")


def flag_memberships(
    df: DataFrame, sets: Mapping[str, DataFrame | None], key: str = "terminal_id", join: Join = lookup
) -> DataFrame:
    """A 0/1 column for each set, all from one join; a set of None flags nothing.

    The ids of all sets become one table with a bit for each set that holds the id, so the
    rows of ``df`` are joined once however many sets there are.
    """
    bits = {flag: 1 << k for k, (flag, ids) in enumerate(sets.items()) if ids is not None}
    if not bits:
        return df.withColumns({flag: F.lit(0) for flag in sets})
    tagged = [sets[flag].select(key, F.lit(bit).cast("long").alias("__sets")) for flag, bit in bits.items()]
    ids = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.bit_or("__sets").alias("__sets"))
    joined = join(df, ids, F.col(key), key, {"__sets": "__sets"})
    held = F.coalesce("__sets", F.lit(0).cast("long"))
    flags = {
        flag: (held.bitwiseAND(F.lit(bits[flag]).cast("long")) != 0).cast("int") if flag in bits else F.lit(0)
        for flag in sets
    }
    return joined.withColumns(flags).drop("__sets")


def add_last_activity(
    df: DataFrame,
    activity: DataFrame | None,
    column: str = "last_transaction_time",
    key: str = "terminal_id",
    join: Join = lookup,
) -> DataFrame:
    """Attach the last activity time, or a null text column when there is no activity set."""
    if activity is None:
        return df.withColumn(column, F.lit(None).cast("string"))
    return join(df, activity, F.col(key), key, {column: column})


def without_match(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null keys never match."""
    return df.join(other.select(key), key, "left_anti")


def match_stats(df: DataFrame, column: str) -> DataFrame:
    """Matched and unmatched row counts of a looked-up column, in one pass."""
    return df.agg(
        F.count_if(F.col(column).isNotNull()).alias("matched"),
        F.count_if(F.col(column).isNull()).alias("unmatched"),
    )


def override_when(df: DataFrame, column: str, condition: Column, value: str) -> DataFrame:
    """Replace a column's value where the condition holds."""
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))
