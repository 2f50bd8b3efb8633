"""Documents as VARIANT, tables in pages and drop folders as streams."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from tillbook.sources.documents import DAMAGED, described, document_columns, read_documents
from tillbook.sources.pages import page_files, read_page, write_pages
from tillbook.streaming import loads


def lines(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))


def test_a_field_of_two_types_keeps_both(spark, tmp_path, rows):
    lines(tmp_path / "in", "a.json", [{"id": 1, "code": 7, "sum": 1.50}, {"id": 2, "it's": [1]}])
    lines(tmp_path / "in", "b.json", [{"id": 3, "code": "B7", "sum": "2.25"}, "{broken", "", "null"])
    docs = read_documents(spark, str(tmp_path / "in"))
    table = document_columns(docs, {"id": "bigint", "code": "string", "sum": "decimal(18,2)", "it's": "string"})
    assert rows(table.where("id IS NOT NULL")) == [
        (1, "7", Decimal("1.50"), None), (2, None, None, "[1]"), (3, "B7", Decimal("2.25"), None)
    ]
    assert [r[0] for r in docs.where(f"{DAMAGED} IS NOT NULL").select(DAMAGED).collect()] == ["{broken"]
    assert "code: VARIANT" in described(docs)


def test_documents_are_scanned_once_and_never_inferred(spark, tmp_path):
    lines(tmp_path / "in", "a.json", [{"id": n, "name": f"n{n}"} for n in range(50)])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    table = document_columns(read_documents(spark, str(tmp_path / "in")), {"id": "bigint", "name": "string"})
    after = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert len(after) == len(before) and plan.count("FileScan") == 1
    assert table.count() == 50


def test_no_documents(spark, tmp_path):
    lines(tmp_path / "in", "a.json", [""])
    docs = read_documents(spark, str(tmp_path / "in"))
    assert document_columns(docs, {"id": "bigint"}).collect() == []


def test_pages_follow_one_another(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = [k * 3 for k in range(500)]
    spark.createDataFrame([(k, f"v{k}") for k in keys] + [(None, "none")], "k INT, v STRING").write.parquet(f"{path}-in")
    write_pages(spark.read.parquet(f"{path}-in"), path, "k", 8)
    after, found = None, []
    while (page := read_page(spark, path, "k", after, 60)) is not None:
        own = [r["k"] for r in page.collect()]
        found += own
        after = own[-1]
        assert own == sorted(own) and len(own) <= 60
    assert found == keys


@pytest.mark.parametrize("after", [None, 0, 700, 1400])
def test_a_page_opens_few_files(spark, tmp_path, after):
    path = str(tmp_path / "t")
    spark.range(1500).withColumnRenamed("id", "k").write.parquet(f"{path}-in")
    write_pages(spark.read.parquet(f"{path}-in"), path, "k", 16)
    files = page_files(spark, path, after, 50)
    assert 1 <= len(files) <= 3
    page = read_page(spark, path, "k", after, 50)
    assert len(page.inputFiles()) == len(files)
    first = 0 if after is None else after + 1
    assert [r["k"] for r in page.collect()] == list(range(first, first + 50))


def test_pages_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([], "k INT, v STRING").write.parquet(f"{path}-in")
    write_pages(spark.read.parquet(f"{path}-in"), path, "k", 4)
    assert read_page(spark, path, "k", None, 10) is None


def test_a_drop_folder_is_handled_once(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    schema = "id BIGINT"

    def drain():
        rows = loads.drop_stream(spark, "json", str(drop), str(tmp_path / "done"), schema, max_files=1)
        query = loads.write_batches(rows, f"{out}/rows", f"{out}/checkpoint")
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    lines(drop, "a.json", [{"id": 1}, {"id": 2}])
    lines(drop, "b.json", [{"id": 3}])
    assert drain() == 3
    assert drain() == 0
    lines(drop, "c.json", [{"id": 4}])
    assert drain() == 1
    found = loads.appended_rows(spark, f"{out}/rows").collect()
    assert sorted((r["id"], r["source_file"].rsplit("/", 1)[1]) for r in found) == [
        (1, "a.json"), (2, "a.json"), (3, "b.json"), (4, "c.json")
    ]
    assert all(r["source_time"] is not None for r in found)
    assert any((tmp_path / "done").rglob("a.json"))
