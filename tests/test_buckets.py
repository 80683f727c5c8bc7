"""Bucketed tables: what is committed, what is read, and what is written anew."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.session import materialise
from triagelake.sources.buckets import BucketedTable

SCHEMA = T.StructType().add("id", "long").add("at", "integer").add("name", "string")


@pytest.fixture
def table(spark, tmp_path):
    return lambda **kw: BucketedTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], **({"buckets": 8, "most_files": 3} | kw))


def made(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_empty(spark, table, rows):
    assert rows(table().read()) == [] and not table().has_run("a")
    assert table().append(made(spark), "a") and table().has_run("a")
    assert rows(table().read()) == []


def test_append_counts_a_run_once(spark, table, rows):
    t = table()
    assert t.append(made(spark, (1, 1, "x"), (None, 1, "y")), "a")
    assert not t.append(made(spark, (1, 1, "x")), "a")
    assert t.append(made(spark, (1, 2, None)), "b")
    assert sorted(map(tuple, t.read().collect()), key=str) == [(1, 1, "x", "a"), (1, 2, None, "b"), (None, 1, "y", "a")]
    assert rows(t.read_for(materialise(made(spark, (None, 0, "")).select("id"))), "name") == [("y",)]


def test_lost_writer_leaves_nothing(spark, table, rows, monkeypatch):
    t = table()
    t.append(made(spark, (1, 1, "x")), "a")
    monkeypatch.setattr(BucketedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.append(made(spark, (2, 1, "x")), "b")
    monkeypatch.undo()
    assert rows(t.read(), "id") == [(1,)] and not t.has_run("b")
    old = t.manifest()
    t.append(made(spark, (2, 1, "x")), "b")
    with pytest.raises(RuntimeError, match="another writer"):  # one that still holds the old version
        t._commit(old, old.files, old.runs)
    # a head that was not written after its manifest
    t._put(f"{t.root}/manifest/head", "1")
    assert rows(t.read(), "id") == [(1,), (2,)]


def test_fifty_batches_read_one_manifest_and_few_files(spark, table, rows):
    t, most = table(), 0
    for batch in range(50):
        ids = materialise(made(spark, (batch, 0, ""), (batch // 2, 0, "")).select("id"))
        files = t.files_for(ids)
        most = max(most, len(files))
        assert len({b for b, _ in files}) <= 2
        known = t.read_for(ids)
        opened = {f for f in known.inputFiles() if t.root in f}
        assert opened == {f"file://{t.root}/{p}" for _, p in files}
        new = made(spark, (batch, batch, "x"), (batch // 2, batch, "y")).join(known.select("id", "at"), ["id", "at"], "left_anti")
        t.append(new.select("id", "at", "name"), f"stream-{batch}", stream=True)
    assert most <= 2 * (t.most_files + 1)  # of about 100 files ever written
    now = t.manifest()
    assert len(now.files) <= t.buckets * (t.most_files + 1) and now.runs == {"stream": 49}
    assert t.has_run("stream-49") and t.has_run("stream-3") and not t.has_run("stream-50") and not t.has_run("other-1")
    assert t.read().count() == 100 and t.read().select("run_id").distinct().count() == 50


def test_upsert_writes_only_buckets_with_a_new_key(spark, table, rows):
    t = table()
    t.append(spark.range(100).select("id", F.lit(1).alias("at"), F.lit("old").alias("name")), "a")
    before = dict.fromkeys(p for _, p in t.manifest().files)
    assert t.upsert(made(spark, (7, 2, "new"), (7, 3, "newest"), (7, 3, "a"), (None, 1, "null")), "at", "b") <= 2
    kept = [p for _, p in t.manifest().files if p in before]
    assert len(kept) >= len(before) - 2
    assert t.read().count() == 101
    assert sorted(map(tuple, t.read().where("run_id = 'b'").collect()), key=str) == [
        (7, 3, "newest", "b"), (None, 1, "null", "b")]
    again = t.upsert(made(spark, (7, 3, "newest"), (None, 1, "null")), "at", "c")
    assert again <= 2 and t.read().count() == 101


def test_upsert_has_no_sort_aggregate(spark, table):
    t = table()
    seen = []
    write = t._write
    t._write = lambda rows: (seen.append(rows._jdf.queryExecution().executedPlan().toString()), write(rows))[1]
    t.append(made(spark, (1, 1, "x")), "a")
    t.upsert(made(spark, (1, 2, "y")), "at", "b")
    assert len(seen) == 2 and "SortAggregate" not in seen[1]
