import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from triagelake.llm.shards import HEAD, Layout, op3_training_order, permute, read_layout, read_records, write_shards
from triagelake.llm.tokenise import Encoder


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation(n):
    order = permute(np.arange(n), n, 5)
    assert sorted(order.tolist()) == list(range(n))
    assert (permute(order, n, 5, inverse=True) == np.arange(n)).all()
    if n > 100:
        assert (order != permute(np.arange(n), n, 6)).mean() > 0.9
        assert abs(np.corrcoef(order, np.arange(n))[0, 1]) < 0.2


def test_round_trip(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).repartition(3)
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", None, None, None), (-6, "word " * 30_000, None, None, None)], docs.schema)
    docs = docs.unionByName(extra).persist()
    path = str(tmp_path / "out")
    layout = write_shards(docs, path, length=128, rows=64)
    assert layout == read_layout(spark, path)
    rows = sorted(read_records(spark, path).collect())
    assert [r.slot for r in rows] == list(range(layout.n))
    assert all((r.shard, r.byte_offset) == layout.place(r.slot) for r in rows)
    in_order = sorted(rows, key=lambda r: permute(np.array([r.slot]), layout.n, layout.key, True)[0])
    stream = b"".join(bytes(r.ids) for r in in_order)
    ids = np.frombuffer(stream, "<u2")
    got = sorted(x.tolist() for x in np.split(ids, np.flatnonzero(ids == 49407) + 1) if len(x))
    encode = Encoder(end=49407)
    coded = {r.doc_id: np.frombuffer(encode(r.text), "<u4").tolist() for r in docs.collect()}
    assert got == sorted(coded.values())
    assert all(coded[r.doc_id][r.start : r.start + 5] == np.frombuffer(r.ids, "<u2")[:5].tolist()[: len(coded[r.doc_id][r.start : r.start + 5])] for r in rows)
    some = layout.n // 2 + 7  # a reader that stopped goes on with one seek
    assert sorted(r.slot for r in read_records(spark, path, some).collect()) == list(range(some, layout.n))
    shard, byte = layout.place(some)
    file, = (tmp_path / "out" / "shards" / f"shard={shard}").glob("part-*")
    with file.open("rb") as f:
        f.seek(byte)
        record = f.read(layout.stride)
    assert record[HEAD : HEAD + len(rows[some].ids)] == bytes(rows[some].ids) and record.endswith(b"\n")
    docs.unpersist()


def test_query_and_empty(spark, sf_dir, tmp_path):
    out = op3_training_order(spark, sf_dir).collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    encode = Encoder(end=49407)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sum(r.length for r in out) == sum(len(encode(t)) // 4 for t in texts)
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert write_shards(empty, str(tmp_path / "none")) == Layout(0)
    assert read_records(spark, str(tmp_path / "none")).count() == 0


def test_records_out_of_place_are_noticed(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    path = tmp_path / "out"
    layout = write_shards(docs, str(path), length=64, rows=32)
    file, = (path / "shards" / "shard=1").glob("part-*")
    data = file.read_bytes()
    file.write_bytes(data[layout.stride : 2 * layout.stride] + data[: layout.stride] + data[2 * layout.stride :])
    for check in (path / "shards" / "shard=1").glob(".*.crc"):
        check.unlink()
    with pytest.raises(Exception, match="out of place"):
        read_records(spark, str(path)).collect()



SPILLING = """
import sys
from pyspark.sql import SparkSession
from triagelake.llm.shards import read_records, write_shards
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.warehouse.dir", sys.argv[2] + "/warehouse")
    .config("spark.shuffle.spill.numElementsForceSpillThreshold", "50").getOrCreate())
docs = spark.read.parquet(sys.argv[1] + "/documents.parquet").select("doc_id", "text")
layout = write_shards(docs, sys.argv[2] + "/out", length=128, rows=1024)
print("slots", layout.n, read_records(spark, sys.argv[2] + "/out").select("slot", "ids").distinct().count())
"""


def test_order_holds_when_sorts_spill(sf_dir, tmp_path):
    """The setting that forces spills is fixed for a process, so this is one of its own."""
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run(
        [sys.executable, "-c", SPILLING, sf_dir, str(tmp_path)], capture_output=True, text=True, timeout=300,
        cwd=root, env=os.environ | {"PYTHONPATH": str(root)})
    assert "slots 7057 7057" in out.stdout, out.stderr[-2000:]
