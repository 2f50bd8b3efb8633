"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.functions.money import (
    DAILY_RATE_SCALE,
    MONTHLY_RATE_SCALE,
    fee,
    minor_to_major,
    parse_amount,
)
from tillbook.functions.periods import day_of
from tillbook.functions.terminals import (
    bank_prefix,
    clean_terminal_id,
    normalise_terminal_id,
    round_terminal_id,
)
from tillbook.functions.text import canonical_state, first_non_empty, is_blankish, match_key
from tillbook.operators.lookup import add_bank, override_when
from tillbook.sources.columns import strip_nul

from . import sql
from .inputs import load, with_inputs
from .registry import register


@register(
    "tid_clean8",
    with_inputs(
        "pos_txn",
        f"SELECT retrieval_ref, terminal_id AS raw, {sql.clean('terminal_id', 8)} AS terminal_id FROM pos_txn",
    ),
)
def tid_clean8(spark, sf_dir):
    return load(spark, sf_dir, "pos_txn").select(
        "retrieval_ref", F.col("terminal_id").alias("raw"),
        clean_terminal_id(F.col("terminal_id"), 8).alias("terminal_id"),
    )


@register(
    "tid_clean9",
    with_inputs(
        "journal",
        f"SELECT _id, terminalId AS raw, {sql.clean('terminalId', 9)} AS terminal_id FROM journal",
    ),
)
def tid_clean9(spark, sf_dir):
    return load(spark, sf_dir, "journal").select(
        "_id", F.col("terminalId").alias("raw"),
        clean_terminal_id(F.col("terminalId"), 9).alias("terminal_id"),
    )


@register(
    "tid_normalise",
    with_inputs(
        "registered",
        f"SELECT merchant_name, terminal_id AS raw, {sql.normalise('terminal_id')} AS terminal_id FROM registered",
    ),
)
def tid_normalise(spark, sf_dir):
    return load(spark, sf_dir, "registered").select(
        "merchant_name", F.col("terminal_id").alias("raw"),
        normalise_terminal_id(F.col("terminal_id")).alias("terminal_id"),
    )


@register(
    "tid_round5",
    with_inputs(
        "terminal_v1",
        f"SELECT terminal_id AS raw, {sql.rounded('terminal_id')} AS terminal_id, amount FROM terminal_v1",
    ),
)
def tid_round5(spark, sf_dir):
    return load(spark, sf_dir, "terminal_v1").select(
        F.col("terminal_id").alias("raw"),
        round_terminal_id(F.col("terminal_id")).alias("terminal_id"), "amount",
    )


@register(
    "bank_prefix",
    with_inputs(
        "pos_txn", f"SELECT retrieval_ref, {sql.prefix('terminal_id')} AS bank_code FROM pos_txn"
    ),
)
def bank_prefix_query(spark, sf_dir):
    return load(spark, sf_dir, "pos_txn").select(
        "retrieval_ref", bank_prefix(F.col("terminal_id")).alias("bank_code")
    )


@register(
    "bank_prefix_fixed5",
    with_inputs(
        "terminal_v1", "SELECT terminal_id, substr(terminal_id, 1, 5) AS bank_code FROM terminal_v1"
    ),
)
def bank_prefix_fixed5(spark, sf_dir):
    return load(spark, sf_dir, "terminal_v1").select(
        "terminal_id", bank_prefix(F.col("terminal_id"), 5, 5).alias("bank_code")
    )


@register(
    "amount_parse",
    with_inputs("service_txn", f"SELECT txn_id, {sql.amount('amount')} AS amount FROM service_txn"),
)
def amount_parse(spark, sf_dir):
    return load(spark, sf_dir, "service_txn").select(
        "txn_id", parse_amount(F.col("amount")).alias("amount")
    )


@register(
    "amount_minor_to_major",
    with_inputs("journal", f"SELECT _id, {sql.major('amount')} AS amount FROM journal"),
)
def amount_minor_to_major(spark, sf_dir):
    return load(spark, sf_dir, "journal").select(
        "_id", minor_to_major(F.col("amount")).alias("amount")
    )


def _fee(name: str, scale: int, rate: str) -> None:
    text = f"""SELECT retrieval_ref, amount,
                      CAST(amount * CAST({rate} AS DECIMAL(10,6)) AS DECIMAL(28,8)) AS msc FROM pos_txn"""

    @register(name, with_inputs("pos_txn", text))
    def query(spark, sf_dir):
        return load(spark, sf_dir, "pos_txn").select(
            "retrieval_ref", "amount",
            fee(F.col("amount"), scale).cast("decimal(28,8)").alias("msc"),
        )


_fee("fee_scale4", DAILY_RATE_SCALE, "0.0013")
_fee("fee_scale6", MONTHLY_RATE_SCALE, "0.00125")


@register(
    "strip_nul",
    with_inputs(
        "journal",
        """SELECT _id, terminalId AS "terminalId", replace(customData, chr(0), '') AS "customData" FROM journal""",
    ),
)
def strip_nul_query(spark, sf_dir):
    return strip_nul(load(spark, sf_dir, "journal").select("_id", "terminalId", "customData"))


@register(
    "is_empty",
    with_inputs(
        "agent",
        f"""SELECT wallet_id, {sql.empty('bvn')} AS no_bvn, {sql.empty('nin')} AS no_nin,
                   {sql.empty('address')} AS no_address FROM agent""",
    ),
)
def is_empty(spark, sf_dir):
    return load(spark, sf_dir, "agent").select(
        "wallet_id", is_blankish(F.col("bvn")).alias("no_bvn"),
        is_blankish(F.col("nin")).alias("no_nin"),
        is_blankish(F.col("address")).alias("no_address"),
    )


@register(
    "fallback_chain",
    with_inputs(
        "agent",
        f"""SELECT wallet_id,
                   CASE WHEN NOT {sql.empty('bvn')} THEN bvn WHEN NOT {sql.empty('nin')} THEN nin
                        ELSE '' END AS bvn,
                   CASE WHEN {sql.empty('phone_number')} THEN '' ELSE phone_number END AS phone_number,
                   CASE WHEN {sql.empty('address')} THEN '' ELSE address END AS address
            FROM agent""",
    ),
)
def fallback_chain(spark, sf_dir):
    own = F.lit("")
    return load(spark, sf_dir, "agent").select(
        "wallet_id", first_non_empty(own, F.col("bvn"), F.col("nin")).alias("bvn"),
        first_non_empty(own, F.col("phone_number")).alias("phone_number"),
        first_non_empty(own, F.col("address")).alias("address"),
    )


@register(
    "state_canonical",
    with_inputs(
        "agent",
        f"""SELECT wallet_id, {sql.state('state_of_residence')} AS state,
                   upper(trim({sql.state('state_of_residence')})) AS state_key FROM agent""",
    ),
)
def state_canonical(spark, sf_dir):
    state = canonical_state(F.col("state_of_residence"))
    return load(spark, sf_dir, "agent").select(
        "wallet_id", state.alias("state"), match_key(state).alias("state_key")
    )


@register(
    "day_of",
    with_inputs("service_txn", "SELECT txn_id, CAST(updated_at AS DATE) AS day FROM service_txn"),
)
def day_of_query(spark, sf_dir):
    # From text, as documents carry it.
    return load(spark, sf_dir, "service_txn").select(
        "txn_id", day_of(F.col("updated_at").cast("string")).alias("day")
    )


@register(
    "bank_override",
    with_inputs(
        "pos_txn bank_code",
        f"""SELECT retrieval_ref, merchant,
                   CASE WHEN starts_with(merchant, 'NOVA') THEN 'NOVA BANK' ELSE bank END AS bank
            FROM pos_txn LEFT JOIN bank_code b ON {sql.prefix('terminal_id')} = b.bank_code""",
    ),
)
def bank_override(spark, sf_dir):
    banked = add_bank(load(spark, sf_dir, "pos_txn"), load(spark, sf_dir, "bank_code"))
    return override_when(
        banked, "bank", F.col("merchant").startswith("NOVA"), "NOVA BANK"
    ).select("retrieval_ref", "merchant", "bank")
