"""Training-order materialisation: fixed-stride shards in a keyed random order.

1. Every task turns its texts into one stream of token ids, each text closed by the end id, and cuts it
   into sequences of ``length`` ids (the task's last may be shorter). They are written once.
2. Counts by task give every sequence a number from 0 to n - 1.
3. A keyed Feistel permutation on the next even number of bits, walked along its cycle until the
   value is below n, takes the number to a global slot. It needs no table and can be inverted.
4. Slots are dealt by range, neighbouring shards to one task: shard k holds slots k * ``rows`` and up, in order, each as a
   record of the same number of bytes. A slot's place is arithmetic, so a reader that stopped goes on
   with one seek, and reads on sequentially. A reader checks that each record holds the slot of its place.

A record: slot (8 bytes), doc_id (8, the first id's document), start (8, the first id's place in it), number of
ids (4), the ids (2 bytes each up to 65,536 ids in the vocabulary), zeros to the stride, a line feed.
Spark's text writer writes the records, so shards commit like any table and need no local file.

A null text is empty; a null doc_id is written as the smallest integer.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import ROWS, table
from triagelake.llm.tokenise import VOCABULARY, encoder
from triagelake.session import materialise, scratch_path

LENGTH = 2048
SHARD_ROWS = 2048
KEY = 20_240_229
END = 49_407
ROUNDS = 6
NO_DOC = -(1 << 63)
HEAD = 28
#: Rows sent to a Python worker at once while shards are written: a batch of long texts stands in memory
#: several times, on both sides.
BATCH = 64


@dataclass(frozen=True)
class Layout:
    n: int
    length: int = LENGTH
    rows: int = SHARD_ROWS
    key: int = KEY
    id_bytes: int = 2

    @property
    def stride(self) -> int:
        return HEAD + self.length * self.id_bytes + 1

    def place(self, slot: int) -> tuple[int, int]:
        """Shard and byte of a slot."""
        return slot // self.rows, slot % self.rows * self.stride


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _feistel(x: np.ndarray, half: int, key: int, inverse: bool) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & low
    for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        round_key = key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03
        if inverse:
            left, right = right ^ (_mix(left, round_key) & low), left
        else:
            left, right = right, left ^ (_mix(right, round_key) & low)
    return left << np.uint64(half) | right


def permute(numbers: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 to n - 1, for each of ``numbers``; ``inverse`` undoes it."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    x = _feistel(np.asarray(numbers, np.int64).astype(np.uint64), half, key, inverse)
    while (out := x >= n).any():
        x[out] = _feistel(x[out], half, key, inverse)
    return x.astype(np.int64)


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END, id_bytes: int = 2) -> DataFrame:
    """(task, number, record): the records of every task's stream, compressed one by one, for they are
    written and shuffled before they reach their shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary, end, id_bytes), TaskContext.get().partitionId()
        size, pad = length * id_bytes, HEAD - 8 + length * id_bytes  # the slot comes later
        pack = zstandard.ZstdCompressor(level=3).compress
        held, head, number = bytearray(), None, 0

        def record(ids: bytes, first: tuple[int, int]) -> bytes:
            start = np.array(first, "<i8").tobytes() + np.array([len(ids) // id_bytes], "<u4").tobytes()
            return pack((start + ids).ljust(pad, b"\0"))

        def made(records: list[bytes]) -> pa.RecordBatch:
            n = len(records)
            numbers = range(number - n, number)
            return pa.RecordBatch.from_arrays(
                [pa.array([task] * n, pa.int32()), pa.array(numbers, pa.int64()), pa.array(records, pa.binary())],
                ["task", "number", "record"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at in range(0, batch.num_rows, BATCH):
                records = []
                for doc, text in zip(ids[at : at + BATCH], batch.column("text").slice(at, BATCH).to_pylist()):
                    doc = NO_DOC if doc is None else doc
                    tokens, used = encode(text), 0
                    while used < len(tokens):
                        if not held:
                            head = doc, used // id_bytes
                        take = min(size - len(held), len(tokens) - used)
                        held += tokens[used : used + take]
                        used += take
                        if len(held) == size:
                            records.append(record(bytes(held), head))
                            held.clear()
                number += len(records)
                if records:
                    yield made(records)
        if held:
            number += 1
            yield made([record(bytes(held), head)])

    return docs.select("doc_id", "text").mapInArrow(run, "task int, number long, record binary")


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH) -> Iterator[None]:
    """Jobs started within send ``rows`` rows at once to Python; the session's own value comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_shards(docs: DataFrame, path: str, length: int = LENGTH, rows: int = SHARD_ROWS, key: int = KEY,
                 vocabulary: str = VOCABULARY, end: int = END) -> Layout:
    """Write ``docs`` (doc_id, text) as shards below ``path``; their layout, also written there."""
    spark = docs.sparkSession
    with small_batches(spark):
        written = materialise(sequences(docs, length, vocabulary, end))
    by_task = written.groupBy("task").agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    by_task = materialise(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    layout = Layout(by_task.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], length, rows, key)
    n = layout.n

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = permute(batch.column("number").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // rows), pa.array(slot), batch.column("record")], ["shard", "slot", "record"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                slot = part.column("slot").to_numpy().astype("<i8")
                records = [s.tobytes() + unpack(r) for s, r in zip(slot, part.column("record").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("slot"), pa.array(records, pa.binary())], ["shard", "slot", "record"])

    numbered = written.join(by_task, "task").select((F.col("number") + F.col("before")).alias("number"), "record")
    placed = numbered.mapInArrow(slots, "shard long, slot long, record binary")
    parts, all_shards = int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows) or 1
    target = F.floor(F.col("shard") * parts / all_shards).cast("int")
    # The sort stands directly below the writer, which needs the rows by shard: it adds none of its own.
    shards = (
        placed.repartitionById(parts, target)
        .mapInArrow(unpacked, "shard long, slot long, record binary")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("record"))
    )
    with small_batches(spark, ROWS * 4):
        shards.write.partitionBy("shard").option("compression", "none").option("lineSep", "\n").text(f"{path}/shards")
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "layout string").coalesce(1).write.text(f"{path}/layout")
    return layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first()[0]))


def read_records(spark: SparkSession, path: str, first_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, start, ids) of the slots from ``first_slot`` on; shards before
    it are not opened."""
    layout = read_layout(spark, path)
    if not layout.n:
        return spark.createDataFrame([], "slot long, shard long, byte_offset long, doc_id long, start long, ids binary")
    files = spark.read.format("binaryFile").load(f"{path}/shards")
    files = files.where(F.col("shard") >= first_slot // layout.rows).select(F.col("shard").cast("long"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                cells = np.frombuffer(data, np.uint8).reshape(-1, layout.stride)
                head = cells[:, :HEAD].copy()
                held, doc, start = head[:, :24].copy().view("<i8").T
                size = head[:, 24:].copy().view("<u4").ravel().astype(np.int64) * layout.id_bytes
                slot = shard * layout.rows + np.arange(len(cells))
                if not np.array_equal(held, slot):
                    raise ValueError(f"shard {shard} holds records out of place")
                for at in range(0, len(cells), 1024):
                    part = slice(max(at, first_slot - shard * layout.rows), at + 1024)
                    ids = [cells[i, HEAD : HEAD + size[i]].tobytes() for i in range(len(cells))[part]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot[part]), pa.array(np.full(len(ids), shard)), pa.array((slot[part] % layout.rows) * layout.stride),
                         pa.array(doc[part], pa.int64(), mask=doc[part] == NO_DOC), pa.array(start[part]), pa.array(ids, pa.binary())],
                        ["slot", "shard", "byte_offset", "doc_id", "start", "ids"])

    return files.mapInArrow(run, "slot long, shard long, byte_offset long, doc_id long, start long, ids binary")


def op3_training_order(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    write_shards(table(spark, sf_dir, "documents", "doc_id", "text"), path)

    # Spark's own functions: a second Python step would keep two more workers, each with its caches.
    return read_records(spark, path).select(
        "slot", "shard", "byte_offset", "doc_id", "start",
        F.floor(F.length("ids") / 2).alias("length"), F.crc32("ids").alias("ids_crc32"),
    )
