"""Phrase collocations, counted by dynamic itemset counting.

Documents are dealt into ``SHARDS`` shards by hash, and the shards are scanned in turn, again and again. Words are
counted from the first scan on. A longer phrase becomes active once both phrases it has without its last and its first
word have reached the threshold in the shards scanned so far; from the next shard on it is counted for one full
cycle, so that it meets every shard once. Words, pairs and triples are thus counted in one scan, in stages that
overlap. A phrase that completed its cycle below the threshold is dropped from the counts.

When a phrase became active is held per slot, a hash of the phrase: a byte a slot, ``MAX_SLOTS`` slots at most,
sent to all tasks. Phrases that share a slot become active with the first of them; every phrase is still
counted for exactly one cycle, so counts stay whole, and a fuller table only counts more phrases than needed.

Counts are kept by hash, packed by ranges of hashes, while phrases are looked for. What reached the threshold is then counted
once more with its words, which also parts phrases whose hashes are equal. Scores and ranks are DataFrame operations;
they use decimals of 38 digits, enough for counts up to 10^15.

A null text is empty, a null lang counts as ``und``. Long texts are cut nowhere: a task takes texts in parts of about
``PART`` words, one text at least. Repeated rows count as often as they stand there. Ties of the score go to the greater count, then
to the phrase in byte order. An empty table gives no rows; of further columns none is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import share_file, table
from triagelake.operators.ranking import first_per_group
from triagelake.session import materialise, scratch_path

LONGEST = 3
THRESHOLD = 10
INSIDE_PERCENT = 50
TOP = 2000
SHARDS = 3
MAX_SLOTS = 1 << 26
PART = 1 << 18
#: Words that are hashed at once, and phrases a task adds up before it sends them.
WORDS = 1 << 18
HELD = 1 << 19
NEVER = 255
#: Further bits of a slot for the last count, whose table has a bit a slot instead of a byte.
FINER = 3
#: The lowest bits of a counted phrase hold the step after which it became active.
SINCE = np.uint64(31)
#: ASCII capitals to small letters; the borders of pieces to a byte that UTF-8 does not have.
BORDER = b"\xff"
_CLEAN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + BORDER * 10)
#: Bytes of a word that are hashed together with those of other words; the lowest bytes of eight.
LONG = 64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _C1
    x ^= x >> np.uint64(32)
    x *= _C2
    x ^= x >> np.uint64(29)
    return x


def _numbers(words: pa.Array) -> np.ndarray:
    """A hash of each word, of eight bytes at a time; 0 for a border. Words of over ``LONG`` bytes are hashed one by one."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.concatenate([np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]], np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each place on
    start, size = at[:-1] - at[0], np.diff(at)
    out = _mix(size.astype(np.uint64))
    of = np.arange(len(size))
    for done in range(0, LONG, 8):
        if not len(of):
            break
        out[of] = _mix(out[of] ^ (eight[start[of] + done] & _FIRST[np.minimum(size[of] - done, 8)]))
        of = of[size[of] > done + 8]
    for i in of.tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]])
    out |= np.uint64(1)
    out[data[start] == BORDER[0]] = 0
    return out


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_CLEAN).replace(BORDER, b" \xff ").split()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, list[str]]]:
    """(tokens, lang number, langs) of about ``PART`` words of several texts; a border ends each text."""
    tokens: list[bytes] = []
    sizes: list[int] = []
    langs: list[str] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            rows = batch.slice(at, 64)
            for lang, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist()):
                found = _tokens(text)
                tokens += found
                tokens.append(BORDER)
                sizes.append(len(found) + 1)
                langs.append(lang)
                if len(tokens) >= PART:
                    yield tokens, np.repeat(np.arange(len(langs)), sizes), langs
                    tokens, sizes, langs = [], [], []
    if tokens:
        yield tokens, np.repeat(np.arange(len(langs)), sizes), langs


def _hashes(tokens: pa.Array, lang: np.ndarray, langs: list[str]) -> list[np.ndarray]:
    """For each length, the hash of the phrase that starts at a token, 0 where a border cuts it. The language is part
    of it."""
    words = np.concatenate([_numbers(tokens.slice(at, WORDS)) for at in range(0, len(tokens), WORDS)])
    of = np.array([xxhash.xxh3_64_intdigest(x.encode(), 1) for x in langs], np.uint64)[lang]
    border = words == 0
    phrases, out = _mix(words ^ of) | np.uint64(1), []
    phrases[border] = 0
    out.append(phrases)
    for k in range(1, LONGEST):
        longer = np.zeros(len(words), np.uint64)
        end = len(words) - k
        if end > 0:
            whole = (out[-1][:end] != 0) & ~border[k:]
            longer[:end] = np.where(whole, _mix(out[-1][:end] + words[k:]) | np.uint64(1), np.uint64(0))
        out.append(longer)
    return out


def _share(spark, cells: np.ndarray) -> str:
    """Send a table of slots to all executors; few of its cells differ from the rest, so it packs well."""
    return share_file(spark, zlib.compress(cells.tobytes(), 1), "slots")


@lru_cache(maxsize=LONGEST)
def _shared(name: str) -> np.ndarray:
    """A table of slots, unpacked once for each Python worker."""
    with open(SparkFiles.get(name), "rb") as file:
        return np.frombuffer(zlib.decompress(file.read()), np.uint8)


class Active:
    """The step after which a phrase's slot became active, by length."""

    def __init__(self, log: int, arrays: list[np.ndarray] | None = None):
        self.log = log
        self.arrays = arrays or [np.full(1 << log, NEVER, np.uint8) for _ in range(LONGEST - 1)]

    def __call__(self, k: int, phrases: np.ndarray) -> np.ndarray:
        """Of phrases of ``k`` words."""
        return self.arrays[k - 1][(phrases >> np.uint64(64 - self.log)).astype(np.int64)]

    def since(self, k: int, hashes: list[np.ndarray]) -> np.ndarray:
        """The step after which the phrase of ``k`` words at each token is counted; ``NEVER`` for none."""
        if k == 1:
            return np.where(hashes[0] != 0, 0, NEVER).astype(np.uint8)
        shorter = self(k - 1, hashes[k - 2])
        out = np.full(len(shorter), NEVER, np.uint8)
        out[:-1] = np.maximum(shorter[:-1], shorter[1:])  # without its last and without its first word
        out[hashes[k - 1] == 0] = NEVER
        return out


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def _small(n: np.ndarray) -> bytes:
    """Counts in as few bytes each as the greatest needs."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0)))).tobytes()


def _large(cell: bytes, count: int) -> np.ndarray:
    return np.frombuffer(cell, f"u{len(cell) // count}").astype(np.int64)


def _scan(shard: DataFrame, step: int, shards: int, log: int, buckets_log: int, names: list[str]) -> DataFrame:
    """(k, bucket, phrases, n): how often the active phrases of ``k`` words occur in a shard, packed. A bucket is the
    highest bits of a phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = Active(log, [_shared(x) for x in names])
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(k: int) -> pa.RecordBatch:
            keys, n = held.pop(k)[0]
            bucket = (keys >> np.uint64(64 - buckets_log)).astype(np.int64) if buckets_log else np.zeros(len(keys), np.int64)
            border = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
            parts = list(zip(border, border[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array([k] * len(parts), pa.int32()), pa.array(bucket[border[:-1]].astype(np.int32)),
                 pa.array([keys[i:j].tobytes() for i, j in parts], pa.binary()),
                 pa.array([_small(n[i:j]) for i, j in parts], pa.binary())], ["k", "bucket", "phrases", "n"])

        def together(k: int) -> int:
            held[k] = [_summed(*map(np.concatenate, zip(*held[k])))]
            return len(held[k][0][0])

        for tokens, lang, langs in _parts(batches):
            hashes = _hashes(pa.array(tokens, pa.large_binary()), lang, langs)
            for k in range(1, LONGEST + 1):
                since = active.since(k, hashes)
                now = (since < step) & (step <= since.astype(np.int64) + shards)
                if now.any():
                    keys = (hashes[k - 1][now] & ~SINCE) | since[now]
                    held.setdefault(k, []).append(np.unique(keys, return_counts=True))
                    if sum(len(x[0]) for x in held[k]) > 2 * HELD and together(k) > HELD:
                        yield packed(k)
        for k in sorted(held):
            together(k)
            yield packed(k)

    return shard.mapInArrow(run, "k int, bucket int, phrases binary, n binary")


def _added(counts: DataFrame, step: int, shards: int, threshold: int, log: int, buckets_log: int) -> DataFrame:
    """(k, bucket, phrases, n, flags): counts added up; ``flags`` are the slots of the phrases that reached
    the threshold. A phrase that has met every shard without reaching it goes."""
    per_bucket = 1 << (log - buckets_log)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for k, bucket, keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                if keys:
                    held.setdefault((k, bucket), []).append((np.frombuffer(keys, np.uint64), _large(n, len(keys) // 8)))
        for k, bucket in sorted(held):
            keys, n = _summed(*map(np.concatenate, zip(*held.pop((k, bucket)))))
            kept = (n >= threshold) | ((keys & SINCE).astype(np.int64) + shards > step)
            keys, n = keys[kept], n[kept]
            flags = np.zeros(per_bucket, bool)
            flags[((keys[n >= threshold] >> np.uint64(64 - log)) & np.uint64(per_bucket - 1)).astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([bucket], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                 pa.array([_small(n)], pa.binary()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())],
                ["k", "bucket", "phrases", "n", "flags"])

    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("k", "bucket", "phrases", "n").repartition(parts, "k", "bucket")
    return materialise(dealt.mapInArrow(run, "k int, bucket int, phrases binary, n binary, flags binary"))


def frequent_slots(docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS,
                   max_slots: int = MAX_SLOTS) -> tuple[list[np.ndarray], int]:
    """The slots of all phrases of 1 to ``LONGEST`` words that occur ``threshold`` times or more, a bit each and
    an array a length, by dynamic itemset counting over ``docs`` (lang, text); log2 of the slots."""
    if LONGEST * shards >= SINCE:
        raise ValueError(f"{shards} shards make more steps than a phrase has room for")
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = max(10, min(max_slots.bit_length() - 1, (size // 128).bit_length())) if max_slots > 1 << 10 else max_slots.bit_length() - 1
    buckets_log = max(0, min(log - 3, (parts - 1).bit_length()))
    per_bucket = 1 << (log - buckets_log)
    path = scratch_path(spark, "shards")
    docs.select("lang", "text", F.pmod(F.xxhash64("lang", "text"), F.lit(shards)).cast("int").alias("shard")).write.partitionBy(
        "shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)
    active, counts, grown, step = Active(log), None, [], 0
    names = [_share(spark, a) for a in active.arrays]
    while True:
        step += 1
        shard = dealt.where(F.col("shard") == (step - 1) % shards).select("lang", "text")
        found = _scan(shard, step, shards, log, buckets_log, names)
        found = found if counts is None else counts.select(*found.columns).unionByName(found)
        counts = _added(found, step, shards, threshold, log, buckets_log)
        reached = [np.zeros(1 << (log - 3), np.uint8) for _ in range(LONGEST)]
        for row in counts.select("k", "bucket", "flags").collect():  # a bit a slot and length at most
            at = row["bucket"] * per_bucket // 8
            reached[row["k"] - 1][at : at + per_bucket // 8] = np.frombuffer(row["flags"], np.uint8)
        grew = False
        for i, (array, bits) in enumerate(zip(active.arrays, reached)):
            fresh = np.unpackbits(bits, bitorder="little").astype(bool) & (array == NEVER)
            if fresh.any():
                array[fresh] = step
                names[i] = _share(spark, array)
                grew = True
        grown.append(grew)
        # No slot became active within the last cycle: every phrase has met all shards.
        if step >= shards and not any(grown[-shards:]):
            return _finer(counts.coalesce(4), threshold, log + FINER, buckets_log), log + FINER


def _finer(counts: DataFrame, threshold: int, log: int, buckets_log: int) -> list[np.ndarray]:
    """The slots of the frequent phrases, of 2 ** ``log``, a bit each and an array a length."""
    per_bucket = 1 << (log - buckets_log)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, bucket, keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                keys = np.frombuffer(keys, np.uint64)
                keys = keys[_large(n, len(keys)) >= threshold] if len(keys) else keys
                flags = np.zeros(per_bucket, bool)
                flags[((keys >> np.uint64(64 - log)) & np.uint64(per_bucket - 1)).astype(np.int64)] = True
                packed = np.packbits(flags, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([bucket], pa.int32()), pa.array([packed], pa.binary())], ["k", "bucket", "flags"])

    out = [np.zeros(1 << (log - 3), np.uint8) for _ in range(LONGEST)]
    for row in counts.select("k", "bucket", "phrases", "n").mapInArrow(run, "k int, bucket int, flags binary").toLocalIterator():
        at = row["bucket"] * per_bucket // 8
        out[row["k"] - 1][at : at + per_bucket // 8] = np.frombuffer(row["flags"], np.uint8)
    return out


#: A task's counts of phrases: the language as a number, the phrase with a line feed, which no word has.
_COUNTED = pa.schema([("lang", pa.int64()), ("phrase", pa.large_binary()), ("n", pa.int64())])


def _merged(held: list[tuple[np.ndarray, pa.Table]]) -> tuple[np.ndarray, pa.Table]:
    """Distinct keys in order, and a row for each with its phrase and the sum of its counts."""
    keys = np.concatenate([x for x, _ in held])
    rows = pa.concat_tables([x for _, x in held]).combine_chunks()
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.add.reduceat(rows["n"].to_numpy()[order], new)
    return keys[new], rows.take(pa.array(order[new])).set_column(2, "n", pa.array(n))


def _lines(phrases: bytes, size: int) -> pa.Array:
    """The phrases of a packed row."""
    lines = pa.decompress(phrases, size, "zstd")
    ends = np.flatnonzero(np.frombuffer(lines, np.uint8) == 10) + 1
    at = np.concatenate([np.zeros(1, np.int64), ends])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), lines])


def packed_phrases(docs: DataFrame, frequent: list[np.ndarray], log: int) -> DataFrame:
    """(bucket, langs, lang, phrases, size, n): what each task counted of the phrases in ``frequent`` slots, with their words,
    and in an empty phrase of all words of a language. Packed: a row for a range of hashes, its phrases a line each."""
    spark = docs.sparkSession
    names = [_share(spark, bits) for bits in frequent]
    buckets_log = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [_shared(x) for x in names]
        all_langs: dict[str, int] = {}
        held: list[tuple[np.ndarray, pa.Table]] = []

        def hold(keys: np.ndarray, lang: np.ndarray, phrase: pa.Array, n: np.ndarray) -> None:
            held.append((keys, pa.table([pa.array(lang), phrase, pa.array(n)], schema=_COUNTED)))

        def together() -> int:
            held[:] = [_merged(held)]
            return len(held[0][0])

        def packed() -> Iterator[pa.RecordBatch]:
            keys, rows = held.pop()
            named = list(all_langs)
            lang, n, phrase = rows["lang"].to_numpy(), rows["n"].to_numpy(), rows["phrase"].combine_chunks()
            phrase = phrase.chunk(0) if isinstance(phrase, pa.ChunkedArray) else phrase
            at = np.frombuffer(phrase.buffers()[1], np.int64)[phrase.offset :]
            bucket = (keys >> np.uint64(64 - buckets_log)).astype(np.int32)
            border = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
            for i, j in zip(border, border[1:]):
                mine, number = np.unique(lang[i:j], return_inverse=True)
                lines = phrase.buffers()[2][int(at[i]) : int(at[j])]
                cells = [int(bucket[i]), [named[x] for x in mine.tolist()], _small(number),
                         pa.compress(lines, "zstd", asbytes=True), len(lines), _small(n[i:j])]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, types)], fields)

        fields = ["bucket", "langs", "lang", "phrases", "size", "n"]
        types = [pa.int32(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
        for tokens, lang, langs in _parts(batches):
            words = pa.array(tokens, pa.large_binary())
            ended = pc.binary_join_element_wise(words, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
            hashes = _hashes(words, lang, langs)
            number = np.array([all_langs.setdefault(x, len(all_langs)) for x in langs])[lang]
            mine, n = np.unique(number[hashes[0] != 0], return_counts=True)
            if len(mine):
                named = list(all_langs)
                keys = np.array([xxhash.xxh3_64_intdigest(named[x].encode(), 2) for x in mine.tolist()], np.uint64)
                hold(keys, mine, pa.array([b"\n"] * len(mine), pa.large_binary()), n)
            for k, (of, bits) in enumerate(zip(hashes, maps), 1):
                slot = (of >> np.uint64(64 - log)).astype(np.int64)
                at = np.flatnonzero((of != 0) & (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool))
                if not len(at):
                    continue
                at = at[np.argsort(of[at])]
                new = np.flatnonzero(np.concatenate([[True], of[at[1:]] != of[at[:-1]]]))
                first = at[new]
                phrase = [(words if i < k - 1 else ended).take(pa.array(first + i)) for i in range(k)]
                if k > 1:
                    phrase = [pc.binary_join_element_wise(*phrase, pa.scalar(b" ", pa.large_binary()))]
                hold(of[first], number[first], phrase[0], np.diff(np.append(new, len(at))))
            if sum(len(x) for x, _ in held) > 2 * HELD and together() > HELD:
                yield from packed()
        if held:
            together()
            yield from packed()

    return docs.select("lang", "text").mapInArrow(
        run, "bucket int, langs array<string>, lang binary, phrases binary, size long, n binary")


def count_phrases(docs: DataFrame, frequent: list[np.ndarray], log: int) -> DataFrame:
    """(lang, k, phrase, n): the phrases in ``frequent`` slots, added up by their words, and for k = 0 all words of a language."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for bucket, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append(cells)
        for bucket in sorted(held):
            all_langs: dict[str, int] = {}
            tables = []
            for langs, lang, phrases, size, n in held.pop(bucket):
                lines = _lines(phrases, size)
                number = np.array([all_langs.setdefault(x, len(all_langs)) for x in langs])
                tables.append(pa.table(
                    [pa.array(number[_large(lang, len(lines))]), lines, pa.array(_large(n, len(lines)))], schema=_COUNTED))
            sums = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
            for rows in sums.combine_chunks().to_batches(1 << 16):
                lines = rows.column("phrase")
                k = pc.add(pc.count_substring(lines, " "), 1).to_numpy(zero_copy_only=False).astype(np.int32)
                k[pc.equal(lines, pa.scalar(b"\n", pa.large_binary())).to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(all_langs)).take(rows.column("lang")), pa.array(k),
                     pc.binary_slice(lines, 0, -1).cast(pa.large_string()).cast(pa.string()), rows.column("n_sum")],
                    ["lang", "k", "phrase", "n"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = packed_phrases(docs, frequent, log).repartition(parts, "bucket")
    return materialise(found.mapInArrow(add, "lang string, k int, phrase string, n long"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, inside_percent: int = INSIDE_PERCENT, top: int = TOP,
                 shards: int = SHARDS, max_slots: int = MAX_SLOTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each language of ``docs`` (lang, text)."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    frequent, log = frequent_slots(docs, threshold, shards, max_slots)
    counts = count_phrases(docs, frequent, log)
    totals = counts.where("k = 0").select("lang", F.col("n").alias("total"))
    phrases = counts.where((F.col("k") > 0) & (F.col("n") >= threshold))
    words = F.split("phrase", " ")
    longer = phrases.where("k > 2").select(
        "lang", "n", F.explode(F.array(
            F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " "))).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    candidates = (
        phrases.where("k > 1").join(around, ["lang", "phrase"], "left")
        .where((F.col("k") > 2) | F.col("around").isNull() | (F.col("around") * 100 < F.col("n") * inside_percent))
    )
    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), words.alias("w"), "k",
    ).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    part = phrases.select("lang", F.col("phrase").alias("part"), "n")
    for side, count in (("left", "l"), ("right", "r")):
        of = part.select(F.col("lang").alias("_lang"), F.col("part").alias("_part"), F.col("n").alias(count))
        cuts = cuts.join(of, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    scored = cuts.withColumn("score", F.expr(
        "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    ranked = first_per_group(
        lowest.select("lang", "phrase", "a", "c.score", "c.l", "c.r"), ["lang"],
        [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op12_dynamic_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "lang", "text"))


OP12_SQL = r"""
with d as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
  from documents),
p as (select d, lang, unnest(range(len(pieces))) as piece, unnest(pieces) as text from d),
s as (select d, piece, lang, list_filter(string_split_regex(text, '[\x20\x09]+'), lambda x: x <> '') as w from p),
g as (
  select lang, 1 as k, unnest(w) as phrase from s
  union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from s where len(w) > 1
  union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from s where len(w) > 2),
f as (select lang, k, phrase, count(*) as n from g group by all),
totals as (select lang, sum(n) as n from f where k = 1 group by lang),
c as (select lang, k, phrase, n as a, string_split(phrase, ' ') as w from f where k > 1 and n >= 10),
around as (
  select lang, phrase, max(a) as most from (
    select lang, w[1] || ' ' || w[2] as phrase, a from c where k = 3
    union all select lang, w[2] || ' ' || w[3], a from c where k = 3) group by all),
kept as (
  select c.* from c left join around using (lang, phrase)
  where c.k = 3 or most is null or 100 * most < 50 * a),
cuts as (
  select lang, phrase, a, 1 as cut, w[1] as x, array_to_string(w[2:], ' ') as y from kept
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from kept where k = 3),
scored as (
  select cuts.*, x.n as l, y.n as r,
         cast((1000000::hugeint * a * a) // (x.n::hugeint * y.n::hugeint) as bigint) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x join f y on y.lang = cuts.lang and y.phrase = cuts.y),
lowest as (select *, row_number() over (partition by lang, phrase order by score, cut) as turn from scored),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from lowest where turn = 1)
select lang, rank, phrase, a, l, r, cast(totals.n as bigint) as n, score
from ranked join totals using (lang) where rank <= 2000
"""
