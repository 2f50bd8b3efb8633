"""Texts that the longest repeat alone rejects."""

from __future__ import annotations

from tillbook.llm import repetition


def test_long_texts_with_a_long_repeat_are_not_kept(spark):
    fresh = [f"w{i}" for i in range(17_800)]
    passage = [f"p{i}" for i in range(3000)]
    texts = [fresh, fresh + passage, passage + fresh + passage, fresh + fresh[:51], fresh + fresh[:50]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in repetition.quality(docs).collect()}
    assert [rows[i]["kept"] for i in range(5)] == [True, True, False, False, True]
    assert all(100 * r["n_covered"] <= 30 * r["n_words"] for r in rows.values())
