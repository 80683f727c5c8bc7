"""Tables in hash buckets of their key, with a manifest of committed files.

Rows lie in Parquet files below ``data``, each file in one bucket of the key. A manifest names the files that count, the bucket
of each, and the runs that were appended. A writer adds files first and then one manifest, so that a lost
writer leaves files that nobody reads. A reader opens the last manifest, lists no directory, and for given keys opens
only the files of their buckets.

* ``append``: one file a bucket and run at most; a run that is committed is not appended again.
* ``compact``: buckets of more than ``most_files`` files are written anew as one, so that files and manifest stay as
  large as the table needs, however many batches made it.
* ``upsert``: only buckets with a new key are written anew.

One writer at a time: a second one that commits the same version fails and can be repeated.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from triagelake.session import literal_table, materialise, only_keys

BUCKETS = 64
MOST_FILES = 8
_STREAM_RUN = re.compile(r"(.+)-(\d+)")


@dataclass
class Manifest:
    version: int = 0
    #: (bucket, path) of every file that counts.
    files: list[tuple[int, str]] = field(default_factory=list)
    #: Appended runs. Of runs named ``<name>-<number>``, as batches of a stream are, the last number.
    runs: dict[str, int | None] = field(default_factory=dict)

    def has(self, run_id: str) -> bool:
        numbered = _STREAM_RUN.fullmatch(run_id)
        if numbered and self.runs.get(numbered[1]) is not None:
            return int(numbered[2]) <= self.runs[numbered[1]]
        return run_id in self.runs

    def with_run(self, run_id: str, stream: bool) -> dict[str, int | None]:
        if not stream:
            return self.runs | {run_id: None}
        name, number = _STREAM_RUN.fullmatch(run_id).groups()
        return self.runs | {name: int(number)}


class BucketedTable:
    """A table of ``schema`` rows with their ``run_id``, in ``buckets`` hash buckets of ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str],
                 buckets: int = BUCKETS, most_files: int = MOST_FILES):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key
        self.buckets, self.most_files = buckets, most_files
        self.full = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    # The manifest

    def _text(self, path: str) -> str | None:
        """The content of a small file, on any Hadoop file system."""
        at = self._path(path)
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def manifest(self) -> Manifest:
        """The last committed state. ``head`` names a version that is at most a lost writer behind it."""
        version = int(self._text(f"{self.root}/manifest/head") or 0)
        while self._fs.exists(self._path(f"{self.root}/manifest/{version + 1:010d}")):
            version += 1
        if not version:
            return Manifest()
        found = json.loads(self._text(f"{self.root}/manifest/{version:010d}"))
        return Manifest(version, [(b, p) for b, p in found["files"]], found["runs"])

    def _commit(self, old: Manifest, files: list[tuple[int, str]], runs: dict[str, int | None]) -> None:
        version = old.version + 1
        target = self._path(f"{self.root}/manifest/{version:010d}")
        draft = f"{self.root}/manifest/.{uuid.uuid4().hex}"
        self._put(draft, json.dumps({"files": files, "runs": runs}))
        if self._fs.exists(target) or not self._fs.rename(self._path(draft), target):
            raise RuntimeError(f"{self.root}: version {version} was committed by another writer")
        self._put(f"{self.root}/manifest/head", str(version))

    # Rows

    def _bucket(self) -> Column:
        types = {f.name: f.dataType for f in self.schema.fields}
        return F.pmod(F.xxhash64(*[F.col(c).cast(types[c]) for c in self.key]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> list[tuple[int, str]]:
        """(bucket, path) of new files with ``rows``: one a bucket, or several where a key makes it large."""
        place = f"data/{uuid.uuid4().hex}"
        dealt = rows.select(*self.full.fieldNames(), self._bucket().alias("_bucket")).hint("rebalance", F.col("_bucket"))
        dealt.write.partitionBy("_bucket").parquet(f"{self.root}/{place}", compression="zstd")
        found = []
        for folder in self._fs.listStatus(self._path(f"{self.root}/{place}")) or []:
            name = folder.getPath().getName()
            if name.startswith("_bucket="):
                for file in self._fs.listStatus(folder.getPath()):
                    if file.getPath().getName().endswith(".parquet"):
                        found.append((int(name[8:]), f"{place}/{name}/{file.getPath().getName()}"))
        return sorted(found)

    def _read(self, files: list[tuple[int, str]]) -> DataFrame:
        if not files:
            return literal_table(self.spark, self.full, [])
        return self.spark.read.schema(self.full).parquet(*[f"{self.root}/{p}" for _, p in files])

    def read(self) -> DataFrame:
        """All rows with their ``run_id``; columns added to the schema since are NULL."""
        return self._read(self.manifest().files)

    def files_for(self, keys: DataFrame) -> list[tuple[int, str]]:
        """The files that may hold rows of ``keys`` (the key columns)."""
        wanted = {r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()}  # at most ``buckets``
        return [(b, p) for b, p in self.manifest().files if b in wanted]

    def read_for(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys``, a written table of the key columns, from the files of their buckets."""
        return only_keys(self._read(self.files_for(keys)), keys.select(*self.key))

    def has_run(self, run_id: str) -> bool:
        return self.manifest().has(run_id)

    def append(self, rows: DataFrame, run_id: str, stream: bool = False) -> bool:
        """Append the rows of a run, all or none; False, and nothing is computed, if it is there already, so that a
        retry cannot count a cost twice. ``stream``: the run is ``<name>-<batch>`` and batches follow one another."""
        old = self.manifest()
        if old.has(run_id):
            return False
        files = self._write(rows.select(*self.schema.fieldNames()).withColumn("run_id", F.lit(run_id)))
        self._commit(old, old.files + files, old.with_run(run_id, stream))
        self.compact()
        return True

    def compact(self) -> int:
        """Write buckets of more than ``most_files`` files anew; how many there were."""
        old = self.manifest()
        per_bucket: dict[int, int] = {}
        for b, _ in old.files:
            per_bucket[b] = per_bucket.get(b, 0) + 1
        full = {b for b, n in per_bucket.items() if n > self.most_files}
        if full:
            files = self._write(self._read([f for f in old.files if f[0] in full]))
            self._commit(old, [f for f in old.files if f[0] not in full] + files, old.runs)
        return len(full)

    def upsert(self, rows: DataFrame, newest: str, run_id: str) -> int:
        """Put ``rows`` in place of all rows of their keys; of several rows of a key the greatest by ``newest`` stays,
        equal ones are told apart by their content. How many buckets were written: those with a new key."""
        rest = [c for c in self.schema.fieldNames() if c not in self.key and c != newest]
        place = Window.partitionBy(*self.key).orderBy(*[F.col(c).desc_nulls_last() for c in (newest, *rest)])
        # Computed once: a scorer in it would otherwise answer, and be paid, for every use.
        rows = materialise(rows.select(*self.schema.fieldNames()))
        latest = rows.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")
        old = self.manifest()
        touched = {r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()}
        mine = [f for f in old.files if f[0] in touched]
        new_keys = rows.select(*[F.col(c).alias(f"_new_{c}") for c in self.key])
        same = [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in self.key]
        kept = self._read(mine).join(new_keys, same, "left_anti")
        files = self._write(kept.unionByName(latest.withColumn("run_id", F.lit(run_id))))
        self._commit(old, [f for f in old.files if f[0] not in touched] + files, old.with_run(run_id, False))
        return len(touched)
