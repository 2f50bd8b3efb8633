from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook.functions import money, periods, terminals, text


@pytest.fixture
def apply(frame):
    """Results of a column function over values of one type."""

    def run(function, values, kind="string"):
        df = frame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
        out = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in out]

    return run


IDS = ["2.035123456E+10", "2.03", "2035AB12", " 2035 12", "", None, ".E1", "2.0351E7"]


def test_clean_terminal_id_width_8(apply):
    assert apply(terminals.clean_terminal_id, IDS) == [
        "2.035123", "2.030000", "2035AB12", " 2035 12", "", None, ".0000000", "2.035100",
    ]


def test_clean_terminal_id_width_9(apply):
    cleaned = apply(lambda c: terminals.clean_terminal_id(c, 9), IDS[:2])
    assert cleaned == ["2.0351234", "2.0300000"]


def test_normalise_terminal_id(apply):
    values = [
        "02035123", " 2035 1234 ", "2.03E+10", "20AB", " 20AB ", "+5", "-007", "2035.12",
        "99999999999999999999", "", None,
    ]
    assert apply(terminals.normalise_terminal_id, values) == [
        "2035123", "20351234", "2.030000", "20AB", " 20AB ", "5", "-7", "2035.120",
        "99999999999999999999", "", None,
    ]


def test_normalise_can_drop_the_fraction(apply):
    out = apply(
        lambda c: terminals.normalise_terminal_id(c, drop_fraction=True),
        ["2035.12", "2035.", "02035", "2.03E+10", "x", None],
    )
    assert out == ["2035", "2035", "2035", "2.030000", "x", None]


def test_normalise_accepts_numbers(apply):
    assert apply(terminals.normalise_terminal_id, [20351234, None], "BIGINT") == ["20351234", None]


def test_round_terminal_id(apply):
    values = ["2.0312345", "2.000001", "20AB", "2035", "x.5", "2.", None]
    assert apply(terminals.round_terminal_id, values) == [
        "2.03123", "2.0", "20AB", "2035", None, "2.", None,
    ]


def test_bank_prefix(apply):
    values = ["2.0351234", "20351234", "20", "", None]
    assert apply(terminals.bank_prefix, values) == ["2.035", "2035", "20", "", None]
    fixed = apply(lambda c: terminals.bank_prefix(c, 5, 5), values)
    assert fixed == ["2.035", "20351", "20", "", None]


def test_parse_amount(apply):
    values = [
        "12.5", " 7 ", "1e3", ".5", "5.", "-3.456", "+1", "n/a", "", "1,000", "1e30", "\t2\n", "١", None,
    ]
    d = Decimal
    assert apply(money.parse_amount, values) == [
        d("12.50"), d("7.00"), d("1000.00"), d("0.50"), d("5.00"), d("-3.46"), d("1.00"),
        None, None, None, None, d("2.00"), None, None,
    ]


def test_minor_to_major(apply):
    assert apply(money.minor_to_major, ["655", "1", "x", None]) == [
        Decimal("6.5500"), Decimal("0.0100"), None, None,
    ]


def test_fee_scales(apply):
    amounts = [Decimal("100.00"), Decimal("0.01"), None]
    four = apply(lambda c: money.fee(c, money.DAILY_RATE_SCALE), amounts, "DECIMAL(18,2)")
    six = apply(lambda c: money.fee(c, money.MONTHLY_RATE_SCALE), amounts, "DECIMAL(18,2)")
    assert four == [Decimal("0.130000"), Decimal("0.000013"), None]
    assert six == [Decimal("0.12500000"), Decimal("0.00001250"), None]


@pytest.mark.parametrize("scale", [4, 6])
def test_total_fee_equals_sum_of_fees(frame, scale):
    amounts = [(Decimal(n * 7919 % 1000003) / 100,) for n in range(500)]
    amounts.append((Decimal("9999999999999999.99"),))
    df = frame(amounts, "a DECIMAL(18,2)")
    got = df.agg(
        F.sum(money.fee(F.col("a"), scale)).cast(f"decimal(38,{scale + 2})").alias("rows"),
        money.total_fee(F.sum("a"), scale).alias("total"),
    ).first()
    assert got["rows"] == got["total"]


def test_emptiness(apply):
    assert apply(text.is_blankish, ["", "0", None, " ", "00", "x"]) == [
        True, True, True, False, False, False,
    ]


def test_first_non_empty(frame):
    df = frame(
        [("", "B1", "N1"), ("", "0", "N1"), ("own", "B1", "N1"), ("0", None, ""), (None, "", None)],
        "own STRING, bvn STRING, nin STRING",
    )
    out = df.select(text.first_non_empty(F.col("own"), F.col("bvn"), F.col("nin")).alias("r"))
    assert [r["r"] for r in out.collect()] == ["B1", "N1", "own", "0", None]


def test_states(apply):
    values = [" federal capital Territory ", " Lagos", "ABUJA", "", None]
    assert apply(text.canonical_state, values) == ["Abuja", "Lagos", "ABUJA", "", None]
    assert apply(text.match_key, values) == ["FEDERAL CAPITAL TERRITORY", "LAGOS", "ABUJA", "", None]


def test_without_nul(apply):
    assert apply(text.without_nul, ["a\x00b\x00", "\x00", "ab", None]) == ["ab", "", "ab", None]


TIMES = [
    datetime(2025, 1, 1), datetime(2025, 3, 31, 23, 59, 59), datetime(2024, 2, 29),
    datetime(1999, 12, 31), None,
]


def test_period_keys(apply):
    kind = "TIMESTAMP_NTZ"
    assert apply(periods.quarter_span_key, TIMES, kind) == [
        "journals_25_01_03", "journals_25_01_03", "journals_24_01_03", "journals_99_10_12", None,
    ]
    assert apply(periods.quarter_start_key, TIMES, kind) == [
        "purchases_25_01", "purchases_25_01", "purchases_24_01", "purchases_99_10", None,
    ]
    assert apply(periods.month_key, TIMES, kind) == [
        "daily_transactions_2025_01", "daily_transactions_2025_03", "daily_transactions_2024_02",
        "daily_transactions_1999_12", None,
    ]
    assert apply(periods.week_of, TIMES, kind) == [
        date(2024, 12, 30), date(2025, 3, 31), date(2024, 2, 26), date(1999, 12, 27), None,
    ]


def test_day_of_text(apply):
    values = ["2025-01-02T03:04:05.678", "2025-01-02", "2025-01-02 23:59:59", "junk", "", None]
    day = date(2025, 1, 2)
    assert apply(periods.day_of, values) == [day, day, day, None, None, None]


@pytest.mark.parametrize(
    ("as_of", "start", "report"),
    [
        (date(2025, 6, 9), datetime(2025, 6, 2), "2025-06-08"),   # Monday
        (date(2025, 6, 11), datetime(2025, 6, 2), "2025-06-08"),  # Wednesday
        (date(2025, 6, 15), datetime(2025, 6, 2), "2025-06-08"),  # Sunday: last completed week
        (date(2025, 1, 1), datetime(2024, 12, 23), "2024-12-29"),
    ],
)
def test_previous_week(as_of, start, report):
    period = periods.previous_week(as_of)
    assert (period.start, period.report_date) == (start, report)
    assert (period.end - period.start).days == 7


def test_previous_month():
    leap = periods.previous_month(date(2024, 3, 15))
    assert (leap.start, leap.end) == (datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert leap.report_date == "2024-02-29"
    assert periods.previous_month(date(2025, 1, 31)).start == datetime(2024, 12, 1)


def test_month_and_fallback_bounds():
    assert periods.month_of(date(2024, 12, 31)).end == datetime(2025, 1, 1)
    assert periods.end_of_previous_month(date(2024, 3, 5)) == datetime(2024, 2, 29, 23, 59, 59, 999000)
    assert periods.lagged_day(date(2024, 3, 2)).start == datetime(2024, 2, 28)


def test_quarters_between_covers_every_overlapped_quarter():
    assert periods.quarters_between(date(2024, 11, 15), date(2025, 4, 1)) == [
        "journals_24_10_12", "journals_25_01_03", "journals_25_04_06",
    ]


def test_period_is_half_open(frame):
    df = frame(
        [(datetime(2025, 1, 1),), (datetime(2025, 1, 1, 23, 59, 59, 999999),), (datetime(2025, 1, 2),)],
        "ts TIMESTAMP_NTZ",
    )
    assert df.where(periods.single_day(date(2025, 1, 1)).contains(F.col("ts"))).count() == 2


def test_periods_stay_pushable_on_zoned_timestamps(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).select(F.timestamp_seconds("id").alias("ts")).write.parquet(path)
    df = spark.read.parquet(path).where(periods.single_day(date(2025, 1, 1)).contains(F.col("ts")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_trailing_days_includes_both_ends(frame):
    as_of = datetime(2025, 5, 1, 12)
    df = frame(
        [(as_of,), (datetime(2025, 1, 1, 12),), (datetime(2025, 1, 1, 11, 59),), (datetime(2025, 5, 1, 13),)],
        "ts TIMESTAMP_NTZ",
    )
    assert df.where(periods.trailing_days(F.col("ts"), as_of, 120)).count() == 2


def test_ordinal_suffix(apply):
    days = [1, 2, 3, 4, 10, 11, 12, 13, 20, 21, 22, 23, 30, 31]
    assert apply(periods.ordinal_suffix, days, "INT") == [
        "ST", "ND", "RD", "TH", "TH", "TH", "TH", "TH", "TH", "ST", "ND", "RD", "TH", "ST",
    ]


# Properties: the same rules written out in Python

ID_TEXT = st.text(alphabet="0123456789.E+- AB", max_size=14)
PROPERTY = settings(
    max_examples=5, deadline=None, database=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def plain_clean(value, width):
    return value.split("E")[0][:width].ljust(width, "0") if "." in value else value


def plain_normalise(value, width=8):
    digits = value.replace(" ", "")
    body = digits[1:] if digits[:1] in ("+", "-") else digits
    if body.isdigit() and -(2**63) <= int(digits) < 2**63:
        return str(int(digits))
    return plain_clean(value, width)


@PROPERTY
@given(st.lists(ID_TEXT, min_size=50, max_size=200))
def test_id_rules_hold_for_any_text(apply, values):
    assert apply(lambda c: terminals.clean_terminal_id(c, 9), values) == [
        plain_clean(v, 9) for v in values
    ]
    assert apply(terminals.normalise_terminal_id, values) == [plain_normalise(v) for v in values]


@PROPERTY
@given(st.lists(st.sampled_from(["", "0", " ", "x", "00", None]), min_size=3, max_size=60))
def test_first_non_empty_for_any_texts(frame, values):
    rows = [(i, *values[i:i + 3]) for i in range(len(values) - 2)]
    df = frame(rows, "i INT, a STRING, b STRING, c STRING")
    out = df.select("i", text.first_non_empty(F.col("a"), F.col("b"), F.col("c")).alias("r"))
    expected = [
        next((v for v in row[1:] if v not in (None, "", "0")), row[1]) for row in rows
    ]
    assert [r["r"] for r in out.orderBy("i").collect()] == expected
