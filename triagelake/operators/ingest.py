"""Collecting records: new ones only, under per-repository and overall caps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from triagelake.functions.columns import text_or_empty
from triagelake.operators.ranking import running_total_cut
from triagelake.session import literal_table, materialise, only_keys

_CAPS = T.StructType(
    [
        T.StructField("repo", T.StringType()),
        T.StructField("_place", T.IntegerType()),
        T.StructField("_cap", T.LongType()),
    ]
)


def records(nodes: DataFrame) -> DataFrame:
    """(repo, node) rows of scanned pages as raw records."""
    n = F.col("node")
    return nodes.select(
        "repo",
        n["databaseId"].alias("id"),
        n["number"].alias("number"),
        n["title"].alias("title"),
        text_or_empty(n["body"]).alias("body"),
        F.lower(n["state"]).alias("state"),
        n["createdAt"].alias("created_at"),
        n["updatedAt"].alias("updated_at"),
        n["closedAt"].alias("closed_at"),
        F.col("node.labels.nodes").alias("labels"),
    )


def normalise(raw: DataFrame) -> DataFrame:
    """Raw records as rows of the issues table: labels become an array of names."""
    return raw.select(
        "id",
        "repo",
        "number",
        "title",
        text_or_empty(F.col("body")).alias("body"),
        "state",
        "created_at",
        "updated_at",
        "closed_at",
        F.col("labels.name").alias("labels"),
    )


def latest_per_key(
    rows: DataFrame, keys: list[str], newest: list[str] = ("updated_at",)
) -> DataFrame:
    """One row per key, the greatest by ``newest``; equal ones are told apart by their content.

    Each task keeps one row of a key before the shuffle, so a key with very many copies does
    not end up as one big group.
    """
    rest = [c for c in rows.columns if c not in keys and c not in newest]
    place = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*newest, *rest]])
    first = rows.withColumn("_place", F.row_number().over(place)).where(F.col("_place") == 1)
    return first.select(*rows.columns)


def existing_counts(stored: DataFrame) -> DataFrame:
    """Distinct stored ids per repository."""
    return stored.groupBy("repo").agg(F.countDistinct("id").alias("n"))


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select("repo", "id")


def new_records(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per incoming key that is not stored yet, the newest copy of it.

    Incoming rows are read once and move once, and each task keeps one row of a key before that;
    the keys of the stored rows meet them where they are. A key with a NULL is never a stored one.
    """
    newest = latest_per_key(incoming, ["repo", "id"], ["created_at", "updated_at"])
    return newest.join(_keys(stored), ["repo", "id"], "left_anti").select(*incoming.columns)


def new_of_counted(incoming: DataFrame, stored: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``new_records``, of written rows whose keys are counted, and written too: ``counts`` (repo, id, copies).

    A row that is the only one of its key stays where it is; the others alone are regrouped. Where
    they are over a quarter of the rows, all are: that reads and moves fewer.
    """
    copies = F.col("copies")
    several, rows = counts.agg(F.sum(F.when(copies > 1, copies)), F.sum(copies)).first()
    if several and several * 4 > rows:
        return new_records(incoming, stored)
    once, keys = incoming, None
    if several:
        keys = materialise(_keys(counts.where(copies > 1)))
        named = keys.select(F.col("repo").alias("_repo"), F.col("id").alias("_id"))
        same = F.col("repo").eqNullSafe(F.col("_repo")) & F.col("id").eqNullSafe(F.col("_id"))
        once = incoming.join(named, same, "left_anti")
    new = once.join(_keys(stored), ["repo", "id"], "left_anti").select(*incoming.columns)
    return new if keys is None else new.unionByName(new_records(only_keys(incoming, keys), stored))


def edited_records(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """The newest incoming row of each stored key that was updated after every stored row of it.

    Which keys those are is found from keys and times; of the rows only theirs are regrouped.
    """
    last = stored.groupBy("repo", "id").agg(F.max("updated_at").alias("_last"))
    newest = incoming.groupBy("repo", "id").agg(F.max("updated_at").alias("updated_at"))
    edits = newest.join(last, ["repo", "id"]).where(F.col("updated_at") > F.col("_last"))
    keys = materialise(edits.drop("_last"))
    return latest_per_key(only_keys(incoming, keys), ["repo", "id"]).select(*incoming.columns)


def _takes(counts: DataFrame, repo_caps: dict[str, int], total_cap: int | None) -> DataFrame:
    """(repo, _take): how many records the caps leave room for, one row per repository, from
    ``counts`` (repo, _available, _have)."""
    caps = literal_table(
        counts.sparkSession,
        _CAPS,
        [(repo, place, cap) for place, (repo, cap) in enumerate(repo_caps.items())],
    )
    room = F.col("_cap") - F.col("_have")
    found = (
        counts.join(caps, "repo", "full")
        .na.fill(0, ["_have", "_available"])
        .na.fill(len(repo_caps), ["_place"])
        .withColumn("_want", F.greatest(F.lit(0), F.least(F.coalesce(room, "_available"), "_available")))
    )
    if total_cap is None:
        return found.select("repo", F.col("_want").alias("_take"))
    # Windows over one row per repository.
    earlier = Window.orderBy("_place", "repo").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        F.lit(total_cap)
        - F.sum("_have").over(Window.partitionBy())
        - F.coalesce(F.sum("_want").over(earlier), F.lit(0))
    )
    return found.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_want"), left))).select(
        "repo", "_take"
    )


def _seen_keys(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """(repo, created_at, _id, _new, _have): a row for each new key, with its newest creation time, and
    one for each stored key, with its repository alone. Both tables are read once."""
    both = incoming.select("repo", "id", "created_at", F.lit(False).alias("_have")).unionByName(
        _keys(stored.where(F.col("id").isNotNull())).select(
            "repo", "id", F.lit(None).cast(incoming.schema["created_at"].dataType).alias("created_at"),
            F.lit(True).alias("_have"),
        )
    )
    keys = both.groupBy("repo", "id").agg(
        F.max("created_at").alias("created_at"),
        F.bool_or("_have").alias("_have"),
        F.bool_and("_have").alias("_only"),
    )
    new = ~F.col("_only") & (~F.col("_have") | F.col("repo").isNull())
    return keys.select(
        "repo",
        F.when(new, F.col("created_at")).alias("created_at"),
        F.when(new, -F.col("id")).alias("_id"),
        new.alias("_new"),
        "_have",
    )


def ingest(
    incoming: DataFrame,
    stored: DataFrame,
    repo_caps: dict[str, int] | None = None,
    total_cap: int | None = None,
    stored_counts: DataFrame | None = None,
) -> DataFrame:
    """The records to append: new, without copies and, if caps are given, newest first under them.

    A repository that ``repo_caps`` does not name has no cap of its own. The overall cap is used up
    in the order of ``repo_caps``, then by name. Per repository the caps come down to one number of
    records, and that to the key of the last one taken. The keys of both tables alone are grouped
    for it, once, and written; of the records themselves only those up to the cut are shuffled. Under caps,
    a record without repository or creation time has no place and is left out.

    With ``stored_counts`` (repo, n), kept from earlier runs, stored keys are only looked up.
    """
    if not repo_caps and total_cap is None:
        return new_records(incoming, stored)
    if stored_counts is None:
        seen = materialise(_seen_keys(incoming, stored))
        newest = seen.where("_new")
        counts = seen.groupBy("repo").agg(
            F.count_if("_new").alias("_available"), F.count_if("_have").alias("_have")
        )
    else:
        fresh = (
            incoming.groupBy("repo", "id")
            .agg(F.max("created_at").alias("created_at"))
            .join(_keys(stored), ["repo", "id"], "left_anti")
        )
        newest = materialise(fresh.select("repo", "created_at", (-F.col("id")).alias("_id")))
        available = newest.groupBy("repo").agg(F.count("*").alias("_available"))
        counts = available.join(stored_counts.withColumnRenamed("n", "_have"), "repo", "full")
    newest = newest.select("repo", "created_at", "_id")
    cut = running_total_cut(
        newest,
        ["repo"],
        ["created_at", "_id"],
        F.lit(1),
        lambda before: before < F.col("_take"),
        limits=_takes(counts, repo_caps or {}, total_cap),
        descending=True,
    )
    place = F.struct(F.col("created_at"), (-F.col("id")).alias("_id"))
    taken = incoming.join(materialise(cut), "repo").where(place >= F.col("cut"))
    new = only_keys(taken.select(*incoming.columns), newest.select("repo", (-F.col("_id")).alias("id")))
    return latest_per_key(new, ["repo", "id"], ["created_at", "updated_at"])
