"""Best-fit packing of token pieces by exact-complement hashing.

What is packed are lengths, not rows: the plan needs only the number of pieces of every length,
at most ``capacity`` counts. For the longest length left, the sums of single lengths, pairs and
triples that are still there are indexed, and a combination that fills the gap exactly is
consumed as often as its lengths allow. What no combination completes is packed best-fit, longest
first. The plan is a short list of runs (length, first rank, ...); every piece finds its place from
its rank among the pieces of its length.

Ranks need no shuffle of pieces: each task numbers its own, and the counts of (task, length) are
summed up over the tasks. The numbered pieces are a written table, so a repeated task can't
number them otherwise.

A null text is the empty text, whose one piece is the end token. Repeated and null doc_ids are
documents of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from triagelake.llm.common import ROWS, table
from triagelake.llm.tokenise import VOCABULARY, encoder
from triagelake.session import materialise

CAPACITY = 4096
END = 1


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, its task and its rank among
    the task's pieces of that length; with_ids adds the little-endian ids themselves."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long"
    schema += ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary, end), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            ids = batch.column("doc_id")
            for at in range(0, batch.num_rows, ROWS):
                rows = []
                for i, text in enumerate(batch.column("text").slice(at, ROWS).to_pylist(), at):
                    tokens = encode(text)
                    n = len(tokens) // 4
                    for k, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        part = tokens[4 * start : 4 * (start + length)]
                        rows.append((i, k, start, length, zlib.crc32(part), task, seen[length], part))
                        seen[length] += 1
                cols = list(zip(*rows))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                made = [ids.take(pa.array(cols[0]))]
                made += [pa.array(c, t) for c, t in zip(cols[1:], kinds[: 7 if with_ids else 6])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"]
                yield pa.RecordBatch.from_arrays(made, names[: len(made)])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Plan:
    """Runs, ordered by length and first rank: ranks ``first`` to ``last`` - 1 of a length lie ``per``
    to a sequence, from sequence ``base`` on, the first of them at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    last: np.ndarray
    per: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int


def complement(gap: int, there: np.ndarray, most: int = 3) -> list[int] | None:
    """Up to ``most`` lengths that are ``there`` and sum to ``gap``, the longest possible first."""
    if there[gap]:
        return [gap]
    if most < 2:
        return None
    size = 1 << (2 * len(there)).bit_length()
    wave = np.fft.rfft(there, size)
    pairs = np.fft.irfft(wave**2, size)[: len(there)] > 0.5  # sums of two, by their value
    if pairs[gap]:
        return _pair(gap, there)
    if most < 3:
        return None
    third = np.flatnonzero(there[:gap] & pairs[gap:0:-1])
    return [int(third[-1]), *_pair(gap - int(third[-1]), there)] if len(third) else None


def _pair(total: int, there: np.ndarray) -> list[int]:
    a = np.arange(total - 1, (total - 1) // 2, -1)
    a = int(a[there[a] & there[total - a]][0])
    return [a, total - a]


def plan_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for ``counts`` pieces of each length (1 to ``capacity``).

    Combinations of up to three are consumed first. Where that spends short pieces on gaps that
    best-fit would have filled with middling ones, the plan with pairs or singles only is shorter;
    they are tried while the plan is more than a thousandth above the lower bound.
    """
    total = sum(length * n for length, n in counts.items())
    least = max(-(-total // capacity), sum(n for length, n in counts.items() if 2 * length > capacity))
    plans = []
    for most in (3, 2, 1):
        plans.append(lay_out(complete_exactly(counts, capacity, most)))
        if plans[-1].sequences <= least + least // 1000 + 1:
            break
    return min(plans, key=lambda p: p.sequences)


def complete_exactly(counts: dict[int, int], capacity: int, most: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Equal sequences, as ([(length, times in each)], how many)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[list[tuple[int, int]], int]] = []
    for length in range(capacity, 0, -1):
        while left[length]:
            found = complement(capacity - length, left > 0, most) if length < capacity else []
            if found is None:
                break
            need = {x: [length, *found].count(x) for x in {length, *found}}
            times = int(min(left[x] // n for x, n in need.items()))
            if not times:  # a length would have to be there more often than it is
                break
            for x, n in need.items():
                left[x] -= n * times
            patterns.append((sorted(need.items(), reverse=True), times))
    return patterns + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit, longest first; equal sequences are handled together."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        for gap in sorted(g for g in open_ if g >= length):
            while n and open_.get(gap):
                content, times = open_[gap].pop()
                fit = gap // length
                full = min(times, n // fit)
                more = n - full * fit if full < times else 0
                rest = times - full - bool(more)
                for count, k in ((full, fit), (1 if more else 0, more)):
                    if count:
                        open_.setdefault(gap - k * length, []).append(([*content, (length, k)], count))
                        n -= count * k
                if rest:
                    open_[gap].append((content, rest))
                    if not n:
                        break
            if not n:
                break
        if n:
            fit = capacity // length
            if full := n // fit:
                open_.setdefault(capacity - fit * length, []).append(([(length, fit)], full))
            if n % fit:
                open_.setdefault(capacity - n % fit * length, []).append(([(length, n % fit)], 1))
    return [x for same in open_.values() for x in same]


def lay_out(patterns: list[tuple[list[tuple[int, int]], int]]) -> Plan:
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for content, times in patterns:
        offset = 0
        for length, per in content:
            first = used.get(length, 0)
            used[length] = first + per * times
            runs.append((length, first, used[length], per, sequence, offset))
            offset += length * per
        sequence += times
    runs.sort()
    cells = np.array(runs, np.int64).reshape(-1, 6).T
    return Plan(*cells, sequences=sequence)


def place(numbered: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The written ``pieces`` with sequence_id and offset instead of task and rank."""
    by_task = numbered.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = materialise(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    sent = numbered.sparkSession.sparkContext.broadcast(plan_lengths({r["length"]: r["n"] for r in counts}, capacity))
    ranked = numbered.join(by_task.drop("n"), ["task", "length"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    kept = [c for c in numbered.columns if c not in ("task", "rank")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = sent.value
        top = int(p.last.max(initial=0)) + 1
        starts = p.length * top + p.first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, length * top + rank, side="right") - 1
            nth = rank - p.first[at]
            made = [batch.column(c) for c in kept]
            made += [pa.array(p.base[at] + nth // p.per[at]), pa.array(p.offset[at] + nth % p.per[at] * length)]
            yield pa.RecordBatch.from_arrays(made, [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*kept).schema.fields)
    return ranked.select(*kept, "rank").mapInArrow(run, schema + ", sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Where every piece of every document goes."""
    return place(materialise(pieces(docs, capacity, with_ids=with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with ids; a sequence gathers `capacity` tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))["ids"]
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))


def op8_exact_complement(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))
