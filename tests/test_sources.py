import json

import pytest
from pyspark.sql import functions as F

from triagelake.operators.ingest import normalise, records
from triagelake.schemas import (
    CLASSIFICATION,
    CLASSIFICATION_BASE,
    REVIEW_SHEET,
    USAGE,
    ensure_columns,
)
from triagelake.sources import pages, sheets, tables


def node(i, **changes):
    return {
        "databaseId": i, "number": i, "title": f"t{i}", "body": None, "state": "OPEN",
        "createdAt": "2026-01-01T00:00:00Z", "updatedAt": "2026-01-02T00:00:00Z", "closedAt": None,
        "labels": {"nodes": [{"name": "bug"}, {"name": "x"}]}, **changes,
    }


def page(nodes, **extra):
    return {
        "data": {
            "repository": {
                "issues": {"nodes": nodes, "pageInfo": {"hasNextPage": False, "endCursor": "c"}}
            },
            "rateLimit": {"cost": 1, "remaining": 10, "resetAt": "x"},
        },
        **extra,
    }


def land(path, directory, *documents, indent=2):
    (path / directory).mkdir(parents=True, exist_ok=True)
    for i, doc in enumerate(documents):
        (path / directory / f"p{i}.json").write_text(json.dumps(doc, indent=indent))


def test_pages(spark, tmp_path):
    land(tmp_path, "own_re_po", page([node(1), node(2, body="é\n\"x\"", state="CLOSED", labels={"nodes": []})]))
    land(tmp_path, "a_b", page([]), page([node(3)]))
    got = normalise(records(pages.scan_pages(spark, str(tmp_path)))).orderBy("id").collect()
    assert [(r["repo"], r["id"], r["state"], r["body"], r["labels"]) for r in got] == [
        ("own/re_po", 1, "open", "", ["bug", "x"]),
        ("own/re_po", 2, "closed", "é\n\"x\"", []),
        ("a/b", 3, "open", "", ["bug", "x"]),
    ]


def test_pages_one_per_line(spark, tmp_path):
    (tmp_path / "a_b").mkdir()
    lines = "\n".join(json.dumps(page([node(i)])) for i in range(5))
    (tmp_path / "a_b" / "all.json").write_text(lines)
    assert pages.scan_pages(spark, str(tmp_path), multi_line=False).count() == 5


def test_page_with_errors_fails(spark, tmp_path):
    land(tmp_path, "a_b", page([node(1)], errors=[{"message": "rate limited"}]))
    with pytest.raises(Exception, match="rate limited"):
        pages.scan_pages(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("data", ["null", '{"repository": null}'])
def test_page_without_records_fails(spark, tmp_path, data):
    (tmp_path / "a_b").mkdir()
    (tmp_path / "a_b" / "p.json").write_text('{"data": %s}' % data)
    with pytest.raises(Exception, match="page without records: a/b"):
        pages.scan_pages(spark, str(tmp_path)).collect()


def test_unfinished_landing(spark, tmp_path, rows):
    open_page = page([node(1)])
    open_page["data"]["repository"]["issues"]["pageInfo"] = {"hasNextPage": True, "endCursor": "x"}
    unknown = page([node(4)])
    unknown["data"]["repository"]["issues"]["pageInfo"] = None
    land(tmp_path, "a_done", open_page, page([node(2)]))
    assert pages.scan_pages(spark, str(tmp_path), finished=True).count() == 2
    land(tmp_path, "b_cut", open_page, open_page)
    land(tmp_path, "c_unknown", unknown)
    states = pages.landing_states(spark, str(tmp_path))
    assert rows(states) == [("a/done", 2, 1, True), ("b/cut", 2, 0, False), ("c/unknown", 1, 0, False)]
    with pytest.raises(Exception, match="landing is not finished: b/cut"):
        pages.scan_pages(spark, str(tmp_path), finished=True).collect()
    assert pages.scan_pages(spark, str(tmp_path)).count() == 5


def test_broken_page_fails(spark, tmp_path):
    (tmp_path / "a_b").mkdir()
    (tmp_path / "a_b" / "p.json").write_text('{"data": {"repository": ')
    with pytest.raises(Exception):
        pages.scan_pages(spark, str(tmp_path)).collect()


def test_raw_batches(spark, tmp_path, rows):
    land(tmp_path / "in", "own_name", page([node(1), node(2)]))
    raw = records(pages.scan_pages(spark, str(tmp_path / "in")))
    pages.write_raw(raw, str(tmp_path / "raw"))
    pages.write_raw(raw.where("id = 1").withColumn("id", F.lit(9).cast("long")), str(tmp_path / "raw"))
    back = pages.scan_raw(spark, str(tmp_path / "raw"))
    assert rows(back, "repo", "id", "title") == [("own/name", 1, "t1"), ("own/name", 2, "t2"), ("own/name", 9, "t1")]
    pruned = back.where("repo = 'own/name'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(repo" in pruned


def test_raw_arrays(spark, tmp_path, rows):
    stored = [{"id": i, "number": i, "title": "t", "body": "", "state": "open", "created_at": "c",
               "updated_at": "u", "closed_at": None, "labels": [{"name": "l"}]} for i in (1, 2)]
    land(tmp_path, "own_na_me", stored, stored[:1])
    got = normalise(pages.scan_raw_batches(spark, str(tmp_path)))
    assert rows(got, "repo", "id") == [("own/na_me", 1), ("own/na_me", 1), ("own/na_me", 2)]
    assert got.first()["labels"] == ["l"]


def test_sheet_keeps_texts(spark, tmp_path, rows):
    texts = ['a "quoted" word', "two\nlines", "cr\r\nlf", "back\\slash\\", ',;"', "", "ü", '"', "\\\"", " x "]
    df = spark.createDataFrame(
        [(i, "o/r", i, t, t, "a|b", "bug", "docs", 0.1, "") for i, t in enumerate(texts)], REVIEW_SHEET
    )
    sheets.write_sheet(df, str(tmp_path / "s"))
    back = sheets.read_sheet(spark, str(tmp_path / "s")).orderBy("issue_id").collect()
    assert [r["body"] for r in back] == texts
    assert [r["title"] for r in back] == texts
    assert {r["gold_label"] for r in back} == {None}


def test_ensure_columns(spark):
    old = spark.createDataFrame([(1, "bug", 0.5)], CLASSIFICATION_BASE)
    new = ensure_columns(old, CLASSIFICATION)
    assert new.schema.fieldNames() == CLASSIFICATION.fieldNames()
    assert new.first()["issue_type"] == "bug" and new.first()["classified_at"] is None
    assert ensure_columns(new, CLASSIFICATION).first() == new.first()


def test_snapshots(spark, tmp_path, rows):
    root = str(tmp_path / "state")
    assert tables.read_snapshot(spark, root, CLASSIFICATION_BASE).count() == 0
    one = spark.createDataFrame([(1, "bug", 0.5)], CLASSIFICATION_BASE)
    assert tables.write_snapshot(one, root) == 0
    current = tables.read_snapshot(spark, root, CLASSIFICATION)  # columns added since
    assert tables.write_snapshot(current.withColumn("issue_type", F.lit("docs")), root) == 1
    assert rows(tables.read_snapshot(spark, root, CLASSIFICATION), "issue_type") == [("docs",)]
    # a writer that is lost leaves no _SUCCESS file: readers stay with the snapshot before
    (tmp_path / "state" / "v00000002").mkdir()
    assert rows(tables.read_snapshot(spark, root, CLASSIFICATION), "issue_type") == [("docs",)]
    assert tables.write_snapshot(one, root) == 2


def test_ledger(spark, tmp_path, rows):
    root = str(tmp_path / "usage")
    assert tables.read_ledger(spark, root, USAGE).count() == 0
    row = spark.createDataFrame([(1, "v2", "m", 5, 0.1, None)], USAGE)
    tables.append_ledger(row, root, "a")
    tables.append_ledger(row, root, "a")
    tables.append_ledger(row, root, "b")
    assert rows(tables.read_ledger(spark, root, USAGE), "issue_id", "run_id") == [(1, "a"), (1, "b")]
    assert tables.has_run(spark, root, "a") and not tables.has_run(spark, root, "c")
    # a run whose writer was lost is not read, and is written again
    (tmp_path / "usage" / "run_id=b" / "_SUCCESS").unlink()
    assert rows(tables.read_ledger(spark, root, USAGE), "run_id") == [("a",)]
    assert not tables.has_run(spark, root, "b")
    with pytest.raises(ValueError):
        tables.append_ledger(row, root, "../x")


def test_read_or_empty_and_mixed_schemas(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_or_empty(spark, path, CLASSIFICATION).count() == 0
    spark.createDataFrame([(1, "bug", 0.5)], CLASSIFICATION_BASE).write.parquet(path)
    spark.createDataFrame([(2, "bug", 0.5, "u", 1, "m", "v2", 0.1, None)], CLASSIFICATION).write.mode("append").parquet(path)
    got = {r["issue_id"]: r["model"] for r in tables.read_or_empty(spark, path, CLASSIFICATION).collect()}
    assert got == {1: None, 2: "m"}


def test_upsert(spark, rows):
    schema = "issue_id long, issue_type string, classifier_version string, classified_at string"
    old = spark.createDataFrame([(1, "a", "v1", "1"), (1, "a", "v2", "1"), (2, "b", "v2", "1"), (None, "n", "v2", "1")], schema)
    new = spark.createDataFrame([(1, "c", "v2", "2"), (1, "d", "v2", "3"), (3, "e", "v2", "2")], schema)
    once = tables.upsert_latest(old, new)
    got = {(r["issue_id"], r["issue_type"]) for r in once.collect()}
    assert got == {(1, "d"), (2, "b"), (3, "e"), (None, "n")} and once.count() == 4
    assert {tuple(r) for r in tables.upsert_latest(once, new).collect()} == {tuple(r) for r in once.collect()}


def test_replace_table(spark):
    tables.replace_table(spark.range(3), "issues_t")
    tables.replace_table(spark.range(5), "issues_t")
    assert spark.table("issues_t").count() == 5
    spark.sql("DROP TABLE issues_t")
