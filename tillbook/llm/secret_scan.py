"""Secrets: fixed patterns, and strings that pass a battery of randomness tests."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of the same start are listed.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I
)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")

# Alphabets of common encodings, the narrower first.
_ALPHABETS = (
    ("decimal", b"0123456789"),
    ("hex", b"0123456789abcdef"),
    ("hex", b"0123456789ABCDEF"),
    ("base32", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", b"0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_CLASSES = bytes(
    97 if 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 45 for c in range(256)
)
_NOT_LETTERS = bytes(c for c in range(256) if not bytes([c]).isalpha())
_PLACES = tuple((name, {c: i for i, c in enumerate(chars)}) for name, chars in _ALPHABETS)


@dataclass(frozen=True)
class Battery:
    """Parameters of the randomness tests; the defaults are those of the registered query."""

    #: Each test must not reject randomness at this level, shared among the three.
    level: float = 0.01
    #: Excess of the index of coincidence of words over uniform characters, as a share.
    skew: float = 0.7
    #: Share of neighbours of another class (small, capital, digit, sign) in strings made of
    #: words in both cases, and share of vowels among the letters of words.
    changes: float = 0.35
    vowels: float = 0.34
    #: False discoveries allowed among the strings of a text that are called random.
    discoveries: float = 0.05


@dataclass(frozen=True)
class Tests:
    """p-values of one string under randomness, and under being made of words."""

    encoding: str
    uniform: float
    runs: float
    serial: float
    words: float


def _normal(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def tests(token: bytes, battery: Battery = Battery()) -> Tests | None:
    """Test a string in the narrowest encoding that holds it; None for decimal numbers, for
    strings of one kind of letter alone and for those that no encoding holds.

    Under randomness the chi-squared statistic of ``n`` characters of an alphabet of ``a`` has
    mean ``a - 1`` and variance ``2 (a - 1)(1 - 1/n)``.  Characters of words are skewed, which
    adds ``skew * n`` to the mean and ``4 skew n`` to the variance: the longer a string, the
    better the two are told apart.  In short strings case and vowels tell more: words change
    class seldom and have many vowels.  The normal scores of what an encoding shows are summed.
    """
    body = token.rstrip(b"=")
    if not body or body.isalpha() and (body.islower() or body.isupper()):
        return None
    used = set(body)
    for encoding, places in _PLACES:
        if used <= places.keys():
            break
    else:
        return None
    if encoding == "decimal":
        return None
    n, a = len(body), len(places)
    values = [places[c] for c in body]
    squares = sum(k * k for k in Counter(values).values())
    chi = squares * a / n - n
    spread = math.sqrt(2 * (a - 1) * (1 - 1 / n))
    uniform = 2 * min(_normal((chi - a + 1) / spread), _normal((a - 1 - chi) / spread))
    skew = battery.skew
    scores = [(chi - (a - 1) - skew * n) / math.sqrt(spread**2 + 4 * skew * n)]
    if a >= 62:
        kinds = body.translate(_CLASSES)
        changes = sum(x != y for x, y in zip(kinds, kinds[1:]))
        scores.append(-_score(changes, n - 1, battery.changes))
    letters = len(body.translate(None, _NOT_LETTERS))
    if a >= 32 and letters:
        scores.append(_score(n - len(body.translate(None, b"aeiouAEIOU")), letters, battery.vowels))
    words = _normal(sum(scores) / math.sqrt(len(scores)))
    return Tests(encoding, uniform, _runs(values, a), _serial(values, a), words)


def _score(count: int, n: int, share: float) -> float:
    return (count - share * n) / math.sqrt(share * (1 - share) * max(1, n))


def _runs(values: list[int], a: int) -> float:
    """Wald-Wolfowitz runs above and below the middle of the alphabet."""
    high = [2 * v >= a for v in values]
    n, up = len(high), sum(high)
    down = n - up
    if not up or not down:
        return 2.0 ** (1 - n)
    mean = 2 * up * down / n + 1
    variance = (mean - 1) * (mean - 2) / max(1, n - 1)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    if variance <= 0:
        return 1.0
    return 2 * _normal(-max(0.0, abs(runs - mean) - 0.5) / math.sqrt(variance))


def _serial(values: list[int], a: int) -> float:
    """Lag-one correlation about the alphabet's middle."""
    mean, variance, n = (a - 1) / 2, (a * a - 1) / 12, len(values)
    total = sum((x - mean) * (y - mean) for x, y in zip(values, values[1:]))
    return 2 * _normal(-abs(total) / (variance * math.sqrt(max(1, n - 1))))


def random_spans(data: bytes, battery: Battery) -> list[tuple[int, int]]:
    """Byte spans of the strings of a text that are called random.

    A string must stand all three tests of randomness.  Of those that do, the ones least like
    words are taken by Benjamini and Hochberg's step-up rule over all strings of the text that were tested.
    """
    found = []
    total = 0
    for match in _CANDIDATE.finditer(data):
        result = tests(match[0], battery)
        total += result is not None
        if result and min(result.uniform, result.runs, result.serial) >= battery.level / 3:
            found.append((result.words, match.span()))
    found.sort()
    taken = 0
    for k, (p, _) in enumerate(found, 1):
        if p <= battery.discoveries * k / total:
            taken = k
    return [span for _, span in found[:taken]]


def pattern_spans(data: bytes) -> list[tuple[int, int, str]]:
    spans = []
    folded = data.lower()
    if any(w in folded for w in _ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(data) if len(m[2]) >= 6]
    if b"AKIA" in data:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(data) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(data)]
    return spans


def scan(data: bytes | None, battery: Battery = Battery()) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all spans in code points, by start, then kind as listed.

    Random strings that touch a span of a pattern are that span's own and not listed again.
    """
    if not data:
        return []
    spans = pattern_spans(data)
    fixed = list(spans)
    for start, end in random_spans(data, battery):
        if all(end <= a or b <= start for a, b, _ in fixed):
            spans.append((start, end, "random"))
    if not spans:
        return []
    cuts = sorted({c for a, b, _ in spans for c in (a, b)})
    place, at, last = {}, 0, 0
    for cut in cuts:
        at += len(data[last:cut].decode())
        place[cut] = at
        last = cut
    out = [(kind, place[a], place[b]) for a, b, kind in spans]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secrets(
    docs: DataFrame,
    battery: Battery = Battery(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id and ``found``, an array of ``kind``, ``start`` and ``stop``.

    A null text is an empty one and holds nothing.  Repeated rows stay; other columns are not
    read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                [{"kind": k, "start": a, "stop": b} for k, a, b in scan(t, battery)]
                for t in frame["text"]
            ]
            yield pd.DataFrame({"id": frame["id"], "found": found})

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
        .mapInPandas(scanned, f"id {id_type}, found array<struct<kind:string,start:bigint,stop:bigint>>")
        .select(F.col("id").alias(id_col), "found")
    )
