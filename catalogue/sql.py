"""SQL fragments of the checks, written for DuckDB."""

from __future__ import annotations


def clean(t: str, width: int = 8) -> str:
    return f"CASE WHEN contains({t}, '.') THEN rpad(split_part({t}, 'E', 1), {width}, '0') ELSE {t} END"


def normalise(t: str, width: int = 8) -> str:
    digits = f"replace(trim({t}), ' ', '')"
    number = f"coalesce(CAST(TRY_CAST({digits} AS BIGINT) AS VARCHAR), {t})"
    whole = f"(CASE WHEN regexp_full_match({digits}, '[+-]?[0-9]+') THEN {number} ELSE {t} END)"
    return clean(whole, width)


def prefix(t: str, dotted: int = 5, plain: int = 4) -> str:
    return f"CASE WHEN contains({t}, '.') THEN substr({t}, 1, {dotted}) ELSE substr({t}, 1, {plain}) END"


def rounded(t: str) -> str:
    number = f"CAST(CAST(round(CAST({t} AS DECIMAL(18,8)), 5) AS DOUBLE) AS VARCHAR)"
    return f"CASE WHEN regexp_matches({t}, '\\.[0-9]+') THEN {number} ELSE {t} END"


def empty(c: str) -> str:
    return f"({c} IS NULL OR {c} IN ('', '0'))"


def amount(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(18,2))"


def state(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) = 'FEDERAL CAPITAL TERRITORY' THEN 'Abuja' ELSE trim({c}) END"


def two(n: str) -> str:
    return f"lpad(CAST({n} AS VARCHAR), 2, '0')"


def quarter_span(ts: str) -> str:
    q = f"quarter({ts})"
    return (
        f"concat('journals_', {two(f'year({ts}) % 100')}, '_', {two(f'{q} * 3 - 2')}, '_', "
        f"{two(f'{q} * 3')})"
    )


def major(c: str) -> str:
    return f"CAST({amount(c)} * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,4))"
