"""SimHash near-duplicates found with pivot distance tables.

A fingerprint is 64 bits; two link at ``distance`` (4) or fewer differing bits. Documents of one
fingerprint form a class, and only classes are compared.

* Pivots: a row of distances to ``PIVOTS`` reference fingerprints is a point whose coordinates
  differ by at most the true distance. A pair is discarded when any coordinate differs by more
  than the limit; what survives is verified on all 64 bits.
* Fingerprints meet in blocks: cut in s segments, two within 4 bits agree in s - 4 of them, so
  every choice of s - 4 segments is a key. More fingerprints take more segments, so that a key
  holds few of them at every size; no pair is lost by the choice.
* A block with more than ``TILE`` fingerprints is dealt into tiles, pairs of its parts, which
  are tasks of their own. Within a tile rows lie in the order of the first pivot and are swept
  with a window of that coordinate.

Nulls: a null or blank text has fingerprint zero; a null doc_id gets a fingerprint and links
like others, but names no component (which is null if all its ids are).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import fresh, map_columns, table
from triagelake.llm.graph import components, forest
from triagelake.session import materialise

SHINGLE = 4
DISTANCE = 4
PIVOTS = 16
TILE = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text, over word shingles with repeats."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return int(np.int64(np.uint64(xxhash.xxh64_intdigest(joined, 42))))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :])])
    n = len(hashed) // 8
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        rows = np.frombuffer(hashed, np.uint8, min(4096, n - at) * 8, at * 8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(0, dtype=np.uint16)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, column: str = "fp") -> DataFrame:
    """``docs`` without their texts, with the fingerprint as a long."""

    def make():
        return lambda texts: ([fingerprint(t) for t in texts],)

    return map_columns(docs, ["text"], f"`{column}` long", make, drop=("text",))


def segments(n: int) -> list[int]:
    """Borders of the segments for ``n`` fingerprints: about four, at random, share a key."""
    parts = 6 if n <= 1 << 23 else 7 if n <= 1 << 29 else 8
    return [64 * i // parts for i in range(parts + 1)]


def block_keys(fp: Column, borders: list[int], distance: int = DISTANCE) -> Column:
    parts = len(borders) - 1
    keys = []
    for k, chosen in enumerate(combinations(range(parts), parts - distance)):
        mask = sum(((1 << borders[c + 1]) - (1 << borders[c])) for c in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(k).cast("short").alias("k"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.explode(F.array(*keys))


def sweep(group: np.ndarray, points: np.ndarray, fp: np.ndarray, distance: int = DISTANCE):
    """Pairs (i, j) of a group within ``distance``; rows lie by group, then first coordinate."""
    found_i, found_j, step = [], [], 1
    i = np.arange(len(fp) - 1) if len(fp) else np.arange(0)
    while len(i := i[i + step < len(fp)]):
        j = i + step
        inside = (group[i] == group[j]) & (points[j, 0] - points[i, 0] <= distance)
        i, j = i[inside], j[inside]
        near = np.abs(points[i, 1:] - points[j, 1:]).max(1, initial=0) <= distance
        a, b = i[near], j[near]
        real = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= distance
        found_i.append(a[real])
        found_j.append(b[real])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def link_classes(classes: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` that connect all within ``distance``."""
    spark = classes.sparkSession
    n = classes.count()
    # a bounded sample of the fingerprints themselves: the smallest by hash
    chosen = classes.orderBy(F.xxhash64("fp"), "fp").limit(PIVOTS).collect()
    pivots = np.array([r["fp"] for r in chosen] or [0], np.int64)
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(pivots[0]))))
    keyed = classes.select("fp", block_keys(F.col("fp"), segments(n), distance).alias("key"))
    keyed = keyed.select("fp", F.xxhash64("key.k", "key.bits").alias("key"))
    # a hashed key may hold two blocks: those rows are compared in vain, none is lost
    large = materialise(
        keyed.groupBy("key").count().where(F.col("count") > tile)
        .select("key", F.ceil(F.col("count") / tile).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    tiles = (
        keyed.join(large, "key", "left")
        .withColumn("part", F.coalesce(part, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
        .select(
            F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("tile"),
            "fp", first.cast("byte").alias("first"),
        )
        .repartition("tile")
        .sortWithinPartitions("tile", "first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_tile, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def pairs(group, fp):
            points = np.bitwise_count((fp[:, None] ^ pivots).view(np.uint64)).astype(np.int8)
            i, j = sweep(group, points, fp, distance)
            distinct, back = np.unique(fp, return_inverse=True)
            u, v = forest(back[i], back[j], len(distinct))
            return pa.RecordBatch.from_arrays([pa.array(distinct[u]), pa.array(distinct[v])], ["u", "v"])

        for batch in batches:
            group = np.concatenate([held_tile, batch.column("tile").to_numpy()])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
            if not len(group):
                continue
            cut = np.searchsorted(group, group[-1])  # the last tile may go on in the next batch
            if cut:
                yield pairs(group[:cut], fp[:cut])
            held_tile, held_fp = group[cut:], fp[cut:]
        if len(held_tile):
            yield pairs(held_tile, held_fp)

    return tiles.mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable by links, itself included."""
    marked = materialise(fingerprints(docs.select("doc_id", "text")))
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    labels = components(link_classes(classes.select("fp"), distance))
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("label", "fp").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = materialise(labelled.join(named, "label").select("fp", "component_id"))
    return marked.join(of_class, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group, the one of the smallest doc_id.

    Of rows that repeat a doc_id one stays. Rows without a doc_id stay: nothing names them.
    """
    chosen = near_groups(docs, distance).where("doc_id = component_id").groupBy("doc_id").count()
    count = fresh(docs, "copies")
    chosen = materialise(chosen.select("doc_id", F.col("count").alias(count)))
    # the ids grow with the documents: they are joined by shuffle at every size, never sent whole
    kept = docs.join(chosen.hint("merge"), "doc_id").select(*docs.columns, count)
    single = kept.where(F.col(count) == 1)
    repeated = kept.where(F.col(count) > 1).dropDuplicates(["doc_id"])
    return single.unionByName(repeated).select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def hex_fingerprint(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0").alias("fingerprint")


def op10_simhash_pivots(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", hex_fingerprint("fp"), "component_id")
