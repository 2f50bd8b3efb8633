"""Fill-in-the-middle against a plain version, and exact round trips."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook.llm import fill_middle, queries
from tillbook.llm.common import steps

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def draws_of(doc_id, seed=42):
    text = f"{seed}:" + ("" if doc_id is None else str(doc_id))
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def plain_version(text, numbers):
    h1, h2, h3, h4 = numbers
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_plain_version(spark, sf_dir, texts):
    rows = queries.QUERIES["op11_fill_in_middle"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, pre, mid, out = plain_version(texts[r["doc_id"]], draws_of(r["doc_id"]))
        assert tuple(r)[1:] == (n, form, pre, mid, sha(out), sha(texts[r["doc_id"]] or ""))
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(st.sampled_from("ab<PSM> \n\t\x0b\x00é中\x85\xa0"), max_size=24),
            st.tuples(*[st.integers(0, 2**32 - 1)] * 4),
        ),
        max_size=8,
    )
)
def test_any_batch(rows):
    texts = pa.array([t.encode() for t, _ in rows], pa.large_binary())
    drawn = [pa.array([d[k] for _, d in rows], pa.int64()) for k in range(4)]
    made = fill_middle.rearranged(texts, drawn, fill_middle.Middle())
    found = list(zip(*(column.to_pylist() for column in made.values())))
    assert found == [plain_version(t, d) for t, d in rows]


def test_restored_from_output_and_form(spark):
    words = ["<", "<P", "S>", "P>", "<S", "\n", "M", ">", " ", "é"]
    texts = ["".join(words[i * k % 10] for i in range(k % 13 + 1)) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = fill_middle.fill_in_middle(docs, fill_middle.Middle(plain=100))
    back = made.select("doc_id", "form", fill_middle.restored(F.col("output"), F.col("form")))
    rows = back.collect()
    assert {r[0]: r[2] for r in rows} == dict(enumerate(texts))
    assert {r[1] for r in rows} == {"plain", "psm", "spm"}


def test_odd_rows(odd, nothing, monkeypatch):
    rows = fill_middle.fill_in_middle(odd).collect()
    given_ = odd.select("doc_id", "text").collect()
    expected = [(i, *plain_version(t, draws_of(i))) for i, t in given_]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert fill_middle.fill_in_middle(nothing).collect() == []


def test_long_text_and_small_steps():
    runs = list(steps(np.array([10, 60, 1000, 0, 0, 5, 70]), 64))
    assert runs == [(0, 1), (1, 2), (2, 3), (3, 6), (6, 7)]
    long = "wort " * 2_000_000
    numbers = (7_654_321, 1_234_567, 3, 90)
    made = fill_middle.rearranged(
        pa.array([long.encode()], pa.large_binary()),
        [pa.array([h], pa.int64()) for h in numbers],
        fill_middle.Middle(),
    )
    assert tuple(c[0].as_py() for c in made.values()) == plain_version(long, numbers)


@pytest.mark.parametrize("plain, form", [(0, {"plain"}), (100, {"spm"})])
def test_shares_are_parameters(spark, plain, form):
    docs = spark.range(50).selectExpr("id AS doc_id", "'one two three' AS text")
    made = fill_middle.fill_in_middle(docs, fill_middle.Middle(plain=plain, spm=100))
    assert {r["form"] for r in made.collect()} == form
