"""Removal of repeated byte windows by a depth-limited radix sort, most significant digit first.

The suffixes of all texts are ordered through ``WINDOW`` (100) bytes only; equal groups of that order
are exactly the repeated windows. A group that holds one suffix drops out after each pass, so later
passes see only what still agrees with something.

* Pass 1, 53 bytes. A window's first digit is not its first bytes but 53 bytes at a place that its
  own bytes choose (the place, modulo 48, of its smallest five bytes by hash). Equal windows choose equal
  places, and neighbouring windows mostly share one: a run of windows with one place is dealt as one row, about 32
  suffixes. Tasks send each digit at most twice, packed, to its bucket; what occurs once is never moved
  again. Which digits repeat comes back as a bitmap of at most ``FILTER_BITS`` bits. A bit that other digits
  share only lets a run through to the next pass; beyond that size the bitmap gets fuller and the result stays the same.
* Pass 2, the whole run (at most 147 bytes). Runs that agree wholly are one group: but for the first
  of them all windows are repeated. The first one remains, and only where its digit has other groups.
* Pass 3, 100 bytes. The remaining runs meet by digit and their windows are put in order in numpy, 8 bytes a pass
  (``radix_groups``). A digit of more than ``HOT`` remaining runs, such as a line shorter than a window that very many
  texts hold, is dealt by whole windows instead, of which a part of a task sends each once.

Texts stay where they are: passes read them anew, and which runs go on to pass 3 comes back as a second bitmap, a bit for
a run; what passes it by chance is compared and changes no result. Spans are joined to those texts only that have some, by
a third bitmap. A text is known by its doc_id and a hash of both.

Order is (doc_id, start), a null doc_id first. A window at an equal doc_id and start, as in repeated
rows, is not earlier: rows of one doc_id are documents of their own and tie at equal starts.
A null text is empty; texts shorter than the window keep all bytes; a long text is one of many rows of an Arrow
batch and costs memory in proportion to itself. An empty table gives no rows. Of further columns none
is read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triagelake.llm.common import share_file, table
from triagelake.session import materialise

WINDOW = 100
#: Places within a window: a digit has ``WINDOW - PLACES + 1`` bytes.
PLACES = 48
DIGIT = WINDOW - PLACES + 1
#: Bytes that choose the place; ``DIGIT`` modulo ``PLACES``, so that neighbouring windows agree more often.
SEED_BYTES = 5
BLOCK = 1 << 16
FILTER_BITS = 1 << 29
#: Digits a task holds before it sends them.
HELD = 1 << 21
#: Runs of one digit that are compared in one task; beyond it their windows are dealt out.
HOT = 1 << 16
RUNS_AT_ONCE = 1 << 14
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, the first byte the highest."""
    return np.ndarray((max(0, len(data) - 7),), ">u8", data, 0, (1,))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _C1
    x ^= x >> np.uint64(32)
    x *= _C2
    x ^= x >> np.uint64(29)
    return x


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, place) of the runs of windows that share a digit. ``data`` holds texts end to
    end, ``offsets`` their borders; no run crosses one."""
    none = np.zeros(0, np.int64)
    n = len(data) - WINDOW + 1
    if n <= 0:
        return none, none, none
    size = np.diff(offsets)
    whole = size >= WINDOW
    # A run ends where a text has no further window, and a new one begins with a text.
    borders = np.unique(np.concatenate([offsets[:-1][whole], offsets[1:][whole] - WINDOW + 1]))
    borders = borders[borders < n]
    span = WINDOW - SEED_BYTES + 1
    low = np.uint64((1 << 17) - 1)
    starts, places, last = [], [], -1
    for at in range(0, n, BLOCK):
        m = min(BLOCK, n - at)
        block = np.zeros(m + WINDOW + 8, np.uint8)
        part = data[at : at + m + WINDOW - 1]
        block[: len(part)] = part
        order = np.arange(m + span - 1, dtype=np.uint64)
        key = _mix(_words(block)[: len(order)].astype(np.uint64) >> np.uint64(24))
        key = (key & ~low) | order
        width = 1
        while width * 2 <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        least = np.minimum(key[:m], key[span - width : span - width + m])
        own = order[:m].astype(np.int64)
        step = (least & low).astype(np.int64) - own
        place = own + step % PLACES + at
        turn = np.flatnonzero(place[1:] != place[:-1]) + 1 + at
        fixed = borders[np.searchsorted(borders, at) : np.searchsorted(borders, at + m)]
        first = [at] if place[0] != last else []
        points = np.unique(np.concatenate([np.array(first, np.int64), turn, fixed]))
        starts.append(points)
        places.append(place[points - at])
        last = place[-1]
    start, place = np.concatenate(starts), np.concatenate(places)
    count = np.diff(np.append(start, n))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + WINDOW <= offsets[text + 1]
    return start[inside], count[inside], place[inside]


def digits(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``DIGIT`` bytes at each place."""
    word = _words(data)
    out = np.full(len(place), DIGIT, np.uint64)
    for at in [*range(0, DIGIT - 8, 8), DIGIT - 8]:
        out = _mix(out ^ word[place + at].astype(np.uint64))
    return out


def radix_groups(data: np.ndarray, starts: np.ndarray, depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(index, group) of the windows that equal another one: an order of suffixes through ``depth``
    bytes, eight at a pass. Windows alone in their group drop out after every pass."""
    word = _words(data)
    index, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in [*range(0, depth - 8, 8), depth - 8]:
        if not len(index):
            break
        key = word[starts[index] + at]
        order = np.lexsort((key, group))
        index, group, key = index[order], group[order], key[order]
        new = np.ones(len(index), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        index, group = index[several], group[several]
    return index, group


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, borders) of a string column; a null is empty."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    _, borders, data = column.buffers()
    if not len(column) or borders is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def _slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        size = _texts(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, size[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def _numbers(
    rows: DataFrame, numbers: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], buckets_log: int, several: bool = False,
) -> DataFrame:
    """(bucket, numbers): the 64-bit numbers made of ``rows``, or those made more than once, packed and in order. A bucket is
    the highest bits of a number."""
    shift = np.uint64(64 - buckets_log)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            held.clear()
            kept = np.ones(len(found), bool)
            kept[1:] = found[1:] != found[:-1]
            if several:  # a number goes out once, or twice where it is repeated here
                kept[1:] |= kept[:-1]
            found = found[kept]
            bucket = found >> shift if buckets_log else np.zeros(len(found), np.uint64)
            border = np.flatnonzero(np.diff(bucket)) + 1
            parts = np.split(found, border)
            return pa.RecordBatch.from_arrays(
                [pa.array([int(b[0] >> shift) if buckets_log else 0 for b in parts], pa.int32()),
                 pa.array([b.tobytes() for b in parts], pa.binary())], ["bucket", "numbers"])

        for made in numbers(batches):
            if len(made):
                held.append(made)
            if sum(map(len, held)) > HELD:
                yield packed()
        if held:
            yield packed()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[bytes]] = {}
        for batch in batches:
            for b, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got.setdefault(b, []).append(cell)
        for b in sorted(got):
            found = np.sort(np.frombuffer(b"".join(got.pop(b)), np.uint64))
            found = np.unique(found[1:][found[1:] == found[:-1]] if several else found)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["bucket", "numbers"])

    shape = "bucket int, numbers binary"
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(rows.mapInArrow(send, shape).repartition(parts, "bucket").mapInArrow(gather, shape))


def _digits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in _slices(batches):
        data, borders = _texts(batch.column("text"))
        yield digits(_padded(data), runs(data, borders)[2])


def _run_number(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit number of the run that begins at ``start`` of the text of that key."""
    return _mix(key.view(np.uint64) ^ _mix(start.astype(np.uint64)))


def _run_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    return (_run_number(b.column("key").to_numpy(), b.column("start").to_numpy()) for b in batches)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    return (b.column("key").to_numpy().view(np.uint64) for b in batches)


def _filter(found: DataFrame, buckets_log: int, bits: int = FILTER_BITS) -> tuple[str, int]:
    """(file name, log2 of bits) of the bitmap of ``_numbers``, at most ``bits`` bits."""
    spark = found.sparkSession
    n = found.agg(F.coalesce(F.sum(F.length("numbers")), F.lit(0))).first()[0] // 8
    log = max(buckets_log + 3, min(bits.bit_length() - 1, (16 * n + 1).bit_length()))
    per_bucket = 1 << (log - buckets_log)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for cell in batch.column("numbers").to_pylist():
                place = (np.frombuffer(cell, np.uint64) >> np.uint64(64 - log)) & np.uint64(per_bucket - 1)
                block = np.zeros(per_bucket, bool)
                block[place.astype(np.int64)] = True
                made.append(np.packbits(block, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(made, pa.binary())], ["bucket", "bits"])

    out = np.zeros(1 << (log - 3), np.uint8)
    for row in found.mapInArrow(blocks, "bucket int, bits binary").collect():
        out[row["bucket"] * per_bucket // 8 : (row["bucket"] + 1) * per_bucket // 8] = np.frombuffer(row["bits"], np.uint8)
    return share_file(spark, out.tobytes(), "repeated"), log


def _passes(name: str, log: int) -> Callable[[np.ndarray], np.ndarray]:
    """Which numbers pass the bitmap."""
    bits = np.memmap(SparkFiles.get(name), np.uint8, "r")

    def passes(numbers: np.ndarray) -> np.ndarray:
        at = (numbers >> np.uint64(64 - log)).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    return passes


_RUN = pa.struct([("digit", pa.int64()), ("whole", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])
_STRETCH = pa.struct([("start", pa.int32()), ("windows", pa.int32())])


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(is not null, value) of a column of numbers; both together order it, nulls first."""
    return column.is_valid().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()


def _behind(group: np.ndarray, named: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which places come after the first one of their group."""
    by = np.lexsort((start, doc, named, group))
    new = np.ones(len(by), bool)
    new[1:] = group[by[1:]] != group[by[:-1]]
    first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.empty(len(by), bool)
    out[by] = (start[first] != start[by]) | (doc[first] != doc[by]) | (named[first] != named[by])
    return out


def _wholes(data: np.ndarray, at: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of all bytes of each run."""
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    return np.array([digest(view[x : x + w + WINDOW - 1]) for x, w in zip(at.tolist(), windows.tolist())], np.uint64)


def _groups(digit: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A number for each pair that differs."""
    order = np.lexsort((digit, whole))
    new = np.ones(len(order), bool)
    new[1:] = (digit[order[1:]] != digit[order[:-1]]) | (whole[order[1:]] != whole[order[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return group


def _stretches(text: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order of text and start; those that touch become one."""
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + windows[:-1])
    begin = np.flatnonzero(new)
    total = np.append(0, np.cumsum(windows))
    return text[begin], start[begin], total[np.append(begin[1:], len(text))] - total[begin]


def _lists(text: np.ndarray, n: int, cells: pa.Array) -> pa.Array:
    """The cells of each of ``n`` texts; ``text`` is in order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), cells)


def _candidates(texts: DataFrame, name: str, log: int) -> DataFrame:
    """(key, doc_id, parts, known): the runs whose digit passes the bitmap, without their bytes. Of equal runs of one part of
    a task only the first is in ``parts`` and the others in ``known``, joined where they touch, so that a passage that very
    many texts share is sent on once for each part. A repeated row of a part is left out, as is a text without such runs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = _passes(name, log)
        for batch in _slices(batches):
            batch = batch.take(pa.array(np.sort(np.unique(batch.column("key").to_numpy(), return_index=True)[1])))
            data, borders = _texts(batch.column("text"))
            start, count, place = runs(data, borders)
            digit = digits(_padded(data), place)
            passed = passes(digit)
            start, count, digit = start[passed], count[passed], digit[passed]
            keys = _wholes(data, start, count)
            text = np.searchsorted(borders, start, "right") - 1
            start -= borders[text]
            named, doc = _ids(batch.column("doc_id"))
            later = _behind(_groups(digit, keys), named[text], doc[text], start)
            parts = pa.StructArray.from_arrays(
                [pa.array(digit[~later].view(np.int64)), pa.array(keys[~later].view(np.int64)),
                 pa.array(start[~later].astype(np.int32)), pa.array(count[~later].astype(np.int32))], fields=list(_RUN))
            of, begin, windows = _stretches(text[later], start[later], count[later])
            known = pa.StructArray.from_arrays(
                [pa.array(begin.astype(np.int32)), pa.array(windows.astype(np.int32))], fields=list(_STRETCH))
            n = batch.num_rows
            out = pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), _lists(text[~later], n, parts), _lists(of, n, known)],
                ["key", "doc_id", "parts", "known"])
            yield out.filter(pa.array(np.bincount(text, minlength=n) > 0))

    return texts.mapInArrow(find, "key long, doc_id long, parts array<struct<digit:long,whole:long,start:int,windows:int>>, "
                            "known array<struct<start:int,windows:int>>")


def _after_first(parts: DataFrame) -> DataFrame:
    """(key, doc_id, start, windows, digit, first) of pass 2: the digit is null where an earlier (doc_id, start) has the same run;
    ``first`` marks one row of each run. Rows of a run lie side by side in a sorted partition; only the first place of the
    current run is held."""
    out = T._parse_datatype_string("key long, doc_id long, start int, windows int, digit long, first boolean")
    arrow = to_arrow_schema(out)
    run = ["digit", "whole"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(k).to_numpy() for k in run)
            named, doc = _ids(batch.column("doc_id"))
            start = batch.column("start").to_numpy()
            new = np.ones(batch.num_rows, bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (start[first] != start) | (doc[first] != doc) | (named[first] != named)
            if current == (a[0], b[0]):  # goes on from the batch before
                same = first == 0
                later[same] = (start[same] != place[2]) | (doc[same] != place[1]) | (named[same] != place[0])
                new[0] = False
            if current != (a[-1], b[-1]) or first[-1]:
                current, place = (a[-1], b[-1]), (named[first[-1]], doc[first[-1]], start[first[-1]])
            made = {"digit": pa.array(a, mask=later), "first": pa.array(new)}
            yield pa.RecordBatch.from_arrays(
                [made[f.name] if f.name in made else batch.column(f.name) for f in out.fields], schema=arrow)

    shuffles = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = parts.repartition(shuffles, *run).sortWithinPartitions(*run, F.col("doc_id").asc_nulls_first(), "start")
    return ordered.mapInArrow(mark, out)


def _open_runs(texts: DataFrame, repeated: tuple[str, int], open_runs: tuple[str, int], hot_digits: np.ndarray) -> DataFrame:
    """(digit, key, doc_id, start, windows, later, bytes) of the runs to compare, those that pass the bitmaps of repeated digits and
    of open runs; of equal ones of a part of a task only the first. Of a hot digit every window is a row of its own with its hash in the digit's place, and of equal windows of a
    part of a task the first is kept."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digit_passes, run_passes = _passes(*repeated), _passes(*open_runs)
        for batch in _slices(batches, most=1 << 21):
            data, borders = _texts(batch.column("text"))
            keys = batch.column("key").to_numpy()
            named, doc = _ids(batch.column("doc_id"))
            start, windows, place = runs(data, borders)
            text = np.searchsorted(borders, start, "right") - 1
            start -= borders[text]
            digit = digits(_padded(data), place)
            passed = digit_passes(digit) & run_passes(_run_number(keys[text], start))
            text, start, windows, digit = text[passed], start[passed], windows[passed], digit[passed]
            # Open runs are first of their kind: others passed by chance, and a frequent digit has many.
            whole = _wholes(data, start + borders[text], windows)
            first = ~_behind(_groups(digit, whole), named[text], doc[text], start)
            text, start, windows, digit = text[first], start[first], windows[first], digit[first].view(np.int64)
            hot = np.isin(digit, hot_digits)
            later = np.zeros(int((~hot).sum()), bool)
            if hot.any():
                of = np.repeat(text[hot], windows[hot])
                begin = np.concatenate([np.arange(s, s + w) for s, w in zip(start[hot].tolist(), windows[hot].tolist())])
                at = begin + borders[of]
                behind = np.zeros(len(at), bool)
                index, group = radix_groups(_padded(data), at)
                behind[index] = _behind(group, named[of[index]], doc[of[index]], begin[index])
                own = _wholes(data, at, np.ones(len(at), np.int64)).view(np.int64)
                digit, text, start = (np.concatenate(x) for x in ((digit[~hot], own), (text[~hot], of), (start[~hot], begin)))
                windows, later = np.concatenate([windows[~hot], np.ones(len(at), np.int64)]), np.concatenate([later, behind])
            begin, size = start + borders[text], np.where(later, 0, windows + WINDOW - 1)
            text_bytes = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(digit), pa.array(keys[text]), pa.array(doc[text], mask=~named[text]), pa.array(start.astype(np.int32)),
                 pa.array(windows.astype(np.int32)), pa.array(later),
                 pa.array([text_bytes[x : x + z] for x, z in zip(begin.tolist(), size.tolist())], pa.binary())],
                ["digit", "key", "doc_id", "start", "windows", "later", "bytes"])

    return texts.mapInArrow(send, "digit long, key long, doc_id long, start int, windows int, later boolean, bytes binary")


def _repeated_windows(open_runs: DataFrame) -> DataFrame:
    """(key, doc_id, start, windows): stretches of repeated windows. Runs of a digit lie side by side, and some thousands of
    runs, whole digits, are put in order at once."""

    def compare(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys, first, windows = (table_.column(c).to_numpy() for c in ("key", "start", "windows"))
        named, doc = _ids(table_.column("doc_id"))
        known = table_.column("later").to_numpy(zero_copy_only=False)
        data, borders = _texts(table_.column("bytes").cast(pa.large_binary()))
        of = np.repeat(np.arange(len(keys)), windows)
        step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        later, start = known[of], first[of] + step
        ask = np.flatnonzero(~later)
        index, group = radix_groups(_padded(data), (borders[of] + step)[ask])
        index = ask[index]
        later[index] = _behind(group, named[of[index]], doc[of[index]], start[index])
        found = np.flatnonzero(later)
        at, begin, count = _stretches(of[found], start[found], np.ones(len(found), np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[at]), pa.array(doc[at], mask=~named[at]), pa.array(begin.astype(np.int32)), pa.array(count.astype(np.int32))],
            ["key", "doc_id", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            digit = batch.column("digit").to_numpy()
            if sum(b.num_rows for b in held) + len(digit) > RUNS_AT_ONCE:
                new = np.flatnonzero(digit[1:] != digit[:-1]) + 1
                if held and held[-1].column("digit")[-1].as_py() != digit[0]:
                    new = np.append(0, new)
                if len(new):  # the last digit of the batch may go on
                    held.append(batch.slice(0, int(new[-1])))
                    yield compare(held)
                    held, batch = [], batch.slice(int(new[-1]))
            held.append(batch)
        if held:
            yield compare(held)

    parts = int(open_runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return open_runs.repartition(parts, "digit").sortWithinPartitions("digit").mapInArrow(
        run, "key long, doc_id long, start int, windows int")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, spans) of rows with ``found``, stretches as start * 2^32 + windows."""
    for batch in batches:
        found = batch.column("found")
        text = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
        value = found.flatten().to_numpy()
        value = value[np.lexsort((value, text))]
        start, windows = value >> 32, value & 0xFFFFFFFF
        end = start + windows + WINDOW - 1
        far = text << 32  # beyond the end of every text before
        reach = np.maximum.accumulate(far + end) - far if len(text) else end
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(text)) - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(start[begin].astype(np.int32)), pa.array(reach[last].astype(np.int32))], ["start", "end"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("doc_id"), _lists(text[begin], batch.num_rows, spans)], ["key", "doc_id", "spans"])


def _passing(name: str, log: int) -> Callable:
    """A column function: which keys pass the bitmap. Only the keys become Arrow data, not the texts beside them."""

    @F.arrow_udf("boolean")
    def passing(key: pa.Array) -> pa.Array:
        return pa.array(_passes(name, log)(key.to_numpy().view(np.uint64)))

    return passing


def repeated_spans(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text, spans): every row of ``docs`` (doc_id, text) with its repeated bytes as (start, end)
    pairs, in order and apart from each other; empty where there are none. ``docs`` is read five times, each time as one
    scan without its texts being stored; write first what is costly to derive."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets_log = min(20, max(0, (partitions - 1).bit_length()))

    def bitmap(rows: DataFrame, numbers: Callable, several: bool = False) -> tuple[str, int]:
        return _filter(_numbers(rows, numbers, buckets_log, several), buckets_log, filter_bits)

    repeated = bitmap(texts.select("text"), _digits_of, True)
    found = materialise(_candidates(texts, *repeated))
    decided = materialise(_after_first(found.select("key", "doc_id", F.explode("parts").alias("r")).select("key", "doc_id", "r.*")))
    ahead = decided.where(F.col("digit").isNotNull())
    several = materialise(
        ahead.groupBy("digit").agg(F.count_if("first").alias("wholes"), F.count("*").alias("n"))
        .where("wholes > 1").select("digit", (F.col("n") > HOT).alias("hot")))
    # At most one digit for HOT open runs.
    hot = np.array([row["digit"] for row in several.where("hot").select("digit").collect()], np.int64)
    open_runs = ahead.join(several.select("digit"), "digit").select("key", "start")
    more = _repeated_windows(_open_runs(texts, repeated, bitmap(open_runs, _run_numbers), hot))
    place = ["key", "doc_id", "start", "windows"]
    known = found.select("key", "doc_id", F.explode("known").alias("r")).select("key", "doc_id", "r.*")
    stretch = F.shiftleft(F.col("start").cast("long"), 32) + F.col("windows")
    spans = materialise(
        known.unionByName(decided.where(F.col("digit").isNull()).select(*place)).unionByName(more)
        .groupBy("key", "doc_id").agg(F.collect_set(stretch).alias("found"))
        .mapInArrow(_merged, "key long, doc_id long, spans array<struct<start:int,end:int>>"))
    passing = _passing(*bitmap(spans.select("key"), _keys))("key")
    none = F.array().cast("array<struct<start:int,end:int>>")
    touched, of = texts.where(passing), spans.withColumnsRenamed({"key": "of", "doc_id": "of_doc"})
    marked = touched.join(of, (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("of_doc")), "left")
    return texts.where(~passing).select("doc_id", "text", none.alias("spans")).unionByName(
        marked.select("doc_id", "text", F.coalesce("spans", none).alias("spans")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, spans): the remaining bytes of every text. A cut may fall inside a character, so
    they are binary."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            data, borders = _texts(batch.column("text"))
            kept = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text, at, parts = data[borders[i] : borders[i + 1]], 0, []
                for s in spans:
                    parts.append(text[at : s["start"]].tobytes())
                    at = s["end"]
                kept.append(b"".join([*parts, text[at:].tobytes()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(np.diff(borders)), batch.column("spans")],
                ["doc_id", "kept", "n_bytes", "spans"])

    return repeated_spans(docs).mapInArrow(
        cut, "doc_id long, kept binary, n_bytes long, spans array<struct<start:int,end:int>>")


def op11_radix_repeats(spark, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP11_SQL = """
with d as (select doc_id, strlen(coalesce(text, '')) as n_bytes, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, unnest(range(n_bytes - 99)) as s, h from d where n_bytes >= 100),
k as (select doc_id, s, md5(substr(h, 2 * s + 1, 200)) as k from w),
r as (select doc_id, s from (select doc_id, s, row_number() over (partition by k order by doc_id, s) as place from k) where place > 1),
i as (select doc_id, s, case when s > lag(s) over (partition by doc_id order by s) + 100 then 1 else 0 end as fresh from r),
g as (select doc_id, s, sum(fresh) over (partition by doc_id order by s) as g from i),
spans as (select doc_id, min(s) as a, max(s) + 100 as b from g group by doc_id, g),
gaps as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from spans
         union all select doc_id, max(b), null from spans group by doc_id),
kept as (select d.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n_bytes) - a)), '' order by a) as h
         from gaps join d using (doc_id) group by d.doc_id),
sums as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from spans group by doc_id)
select d.doc_id, d.n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join sums using (doc_id) left join kept using (doc_id)
"""
