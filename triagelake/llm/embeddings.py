"""Near-duplicate vectors found on a robust-pruned flat graph.

1. Equal vectors are one class; only classes go on.
2. Shards: a centroid for every ``SHARD`` classes, fitted by the same rounds of k-means for any number of
   them on a sample of ``SAMPLE`` rows, or ``SPREAD`` a centroid where these are more. Centroids that would link themselves, which lie within one group,
   are one shard. A class goes to its ``OVERLAP`` nearest shards and to all that lie within ``margin`` of
   its cell, so that near vectors meet in one at least (with a margin of 1: without exception). A shard of
   more than ``TILE`` classes is dealt into tiles, pairs of its parts, in which all its pairs still meet.
3. Each tile builds a flat graph: of a row's nearest ones in the tile, robust pruning keeps those that
   no kept one already stands for; edges are made to go both ways, and a few random ones are added.
   (Neighbours proposed by greedy searches on a random graph, the usual way for an index that
   is too large to compare, costs ten times as much here; a tile is small enough.)
4. A class's adjacency lists from all its tiles are united, and every class is searched for in each of
   its tiles on the united graph: greedily from the medoid, then, from what that met and from itself,
   over everything within range. A class with so much in range that lists cost more than the tile is
   compared with the tile.
5. Pairs are verified by their cosine in double precision. A pair that meets in several tiles is counted
   in one; tiles give counts and the edges that connect, not pairs.
6. The links of a sample of classes are counted by brute force. While less than ``RECALL`` of them was found,
   of all or of any stratum of classes with like numbers of links,
   shards and search are widened; the last of ``STEPS`` compares all that could link, and misses nothing.
   The figure is logged.

Vectors that are null, zero, of another length than most, hold null or non-finite components, or have
no vec_id link with nothing. A row without a vec_id has no component and is not kept.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import table
from triagelake.llm.graph import components, forest
from triagelake.session import materialise

LIMIT = 0.9
#: How far below the limit the search still expands.
SLACK = 0.1
SAMPLE = 20_000
#: Rows of the sample for each centroid, where ``SAMPLE`` has fewer.
SPREAD = 4
SHARD = 1_000
TILE = 2_048
OVERLAP = 2
#: How far from its cell a class goes to other shards, as a share of the distance that a link can span.
MARGIN = 0.1
DEGREE = 24
FAR = 4
BEAM = 12
ALPHA = 1.2
QUERIES = 256
#: Share of the links of ``AUDITED`` classes that has to be found.
RECALL = 0.95
AUDITED = 1_000
#: Classes of the sample from which a stratum of like numbers of links has a share of its own.
STRATUM = 20
#: Margin, slack, and whether all rows of a tile are compared: how the search is widened.
STEPS = ((MARGIN, SLACK, False), (0.3, 2 * SLACK, False), (1.0, SLACK, True))

log = logging.getLogger(__name__)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component goes first, so that no square overflows."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread rows of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    block = max(1, (1 << 22) // k)
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        for at in range(0, len(sample), block):
            part = sample[at : at + block]
            np.add.at(sums, (part @ centres.T).argmax(1), part)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres


def beam_search(x: np.ndarray, adjacent: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Greedy searches of all ``queries`` at once: the best ids found and their cosines."""
    n, rows = len(x), np.arange(len(queries))
    seen = np.zeros((len(queries), n + 1), bool)
    seen[:, -1] = True  # the place of missing neighbours
    ids = np.full((len(queries), beam), n)
    sims = np.full((len(queries), beam), -np.inf)
    done = np.ones((len(queries), beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    seen[:, start] = True
    while not done.all():
        at = np.where(done, -np.inf, sims).argmax(1)
        active = ~done[rows, at]
        done[rows, at] = True
        near = np.where(active[:, None], adjacent[np.where(active, ids[rows, at], 0)], n)
        near = np.where(seen[rows[:, None], near], n, near)
        seen[rows[:, None], near] = True
        new = np.einsum("qd,qrd->qr", queries, x[np.minimum(near, n - 1)])
        new[near == n] = -np.inf
        ids, sims = np.hstack([ids, near]), np.hstack([sims, new])
        done = np.hstack([done, near == n])
        best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
        ids, sims, done = ids[rows[:, None], best], sims[rows[:, None], best], done[rows[:, None], best]
    return ids, sims


def robust_prune(x: np.ndarray, node: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` of the ``proposed`` ids (len(x): none) for each node: the nearest first, and then
    only those that are not ``alpha`` times nearer to a kept one."""
    n = len(x)
    ids = np.sort(proposed, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = n
    ids[ids == node[:, None]] = n
    place = x[np.minimum(ids, n - 1)]
    distance = 2 - 2 * np.einsum("bd,bcd->bc", x[node], place)
    distance[ids == n] = np.inf
    out = np.full((len(node), degree), n)
    rows = np.arange(len(node))
    for k in range(degree):
        best = distance.argmin(1)
        there = np.isfinite(distance[rows, best])
        if not there.any():
            break
        out[there, k] = ids[rows, best][there]
        between = 2 - 2 * np.einsum("bd,bcd->bc", place[rows, best], place)
        distance[(alpha * between <= distance) & there[:, None]] = np.inf
        distance[rows, best] = np.inf
    return out


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def build_graph(x: np.ndarray, degree: int = DEGREE, far: int = FAR) -> np.ndarray:
    """Adjacency lists (len(x): no neighbour) of a flat graph over the rows of ``x``, a tile's: pruned
    from the nearest rows, made to go both ways, and ``far`` random edges that lead between clusters."""
    n = len(x)
    if n < 2:
        return np.full((n, degree + far), n)
    found, most = np.full((n, degree), n), min(2 * degree, n - 1)
    for at in range(0, n, QUERIES):
        node = np.arange(at, min(at + QUERIES, n))
        sims = x[node] @ x.T
        sims[np.arange(len(node)), node] = -np.inf
        nearest = np.argpartition(-sims, most - 1, axis=1)[:, :most]
        found[node] = robust_prune(x, node, nearest, degree, ALPHA)
    source, target = np.repeat(np.arange(n), degree), found.ravel()
    source, target = source[target < n], target[target < n]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)  # how many came before
    back = np.full((n, 2 * degree), n)
    fits = place < 2 * degree
    back[target[fits], place[fits]] = source[fits]
    adjacent = np.full((n, degree + far), n)
    adjacent[:, degree:] = np.random.default_rng(n).integers(0, n, (n, far))
    for at in range(0, n, QUERIES):
        node = np.arange(at, min(at + QUERIES, n))
        both = np.hstack([found[node], back[node]])
        adjacent[node, :degree] = robust_prune(x, node, both, degree, ALPHA)
    return adjacent


def range_hits(x: np.ndarray, adjacent: np.ndarray, limit: float = LIMIT, slack: float = SLACK, beam: int = BEAM,
               whole: bool = False):
    """(n, n) booleans: pairs of rows with a cosine of ``limit`` or more that searches on the graph reach.
    A row whose lists would be longer than ``x`` is compared with all rows, which finds no less; with
    ``whole``, every row is."""
    n = len(x)
    hits = np.zeros((n, n), bool)
    start = medoid(x)
    for at in range(0, n, QUERIES):
        node = np.arange(at, min(at + QUERIES, n))
        q = x[node]
        ids, sims = beam_search(x, adjacent, start, q, beam)
        rows = np.arange(len(node))
        seen = np.zeros((len(node), n + 1), bool)  # anew: what fell out of the beam may be in range
        seen[:, -1] = True
        seen[rows[:, None], ids] |= sims >= limit - slack
        seen[rows, node] = True
        who, what = np.nonzero(seen[:, :n])
        near = (q[who] * x[what]).sum(1) >= limit
        hits[node[who[near]], what[near]] = True
        while len(who):
            wide = np.bincount(who, minlength=len(node)) * adjacent.shape[1] > (0 if whole else n)
            hits[node[wide]] = q[wide] @ x.T >= limit
            who, what = who[~wide[who]], what[~wide[who]]
            near = adjacent[what]
            who = np.repeat(who, near.shape[1])
            what = near.ravel()
            new = ~seen[who, what]
            who, what = who[new], what[new]
            key = np.unique(who * (n + 1) + what)
            who, what = key // (n + 1), key % (n + 1)
            seen[who, what] = True
            sim = (q[who] * x[what]).sum(1)
            hits[node[who[sim >= limit]], what[sim >= limit]] = True
            who, what = who[sim >= limit - slack], what[sim >= limit - slack]
    hits |= hits.T
    np.fill_diagonal(hits, False)
    return hits


def range_pairs(x: np.ndarray, adjacent: np.ndarray, limit: float = LIMIT, slack: float = SLACK, beam: int = BEAM):
    """Pairs (i, j), i < j, of ``range_hits``."""
    return np.nonzero(np.triu(range_hits(x, adjacent, limit, slack, beam)))


def classes_of(vectors: DataFrame) -> DataFrame:
    """(cid, embedding, rep, copies): the distinct vectors that can link."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)
    usable = usable.where(F.exists("embedding", lambda c: c != 0))
    sizes = usable.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    usable = usable.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))
    grouped = usable.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    return materialise(grouped.withColumn("cid", F.monotonically_increasing_id()))  # ids hold once written


def merged(centres: np.ndarray, limit: float = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """The centroids ordered by shard, and where each shard starts: those that link, also over others,
    are one, or a large group would be cut between its own centroids."""
    k, label, start = len(centres), np.arange(len(centres)), [np.zeros((2, 0), np.int64)]
    for at in range(0, k, QUERIES):
        i, j = np.nonzero(centres[at : at + QUERIES] @ centres.T >= limit)
        start.append(np.array([i + at, j]))
    moved, low = forest(*np.concatenate(start, axis=1), k)
    label[moved] = low
    order = np.argsort(label, kind="stable")
    return centres[order], np.unique(label[order], return_index=True)[1]


def shards_of(x: np.ndarray, centres: np.ndarray, starts: np.ndarray, margin: float, limit: float = LIMIT) -> np.ndarray:
    """(rows, shards) booleans: a row's nearest shards and those within the margin of its cell.

    The vector half-way between two that link is nearest to some centroid; seen from the other side of
    the plane between that one and their own, both lie within sqrt((1 - limit) / 2) of the plane.
    """
    near = x @ centres.T
    own = near.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * centres[own] @ centres.T, 0))
    behind = near[np.arange(len(x)), own][:, None] - near
    within = np.logical_or.reduceat(behind <= margin * np.sqrt((1 - limit) / 2) * apart + 1e-9, starts, axis=1)
    best = np.maximum.reduceat(near, starts, axis=1)
    k = min(OVERLAP, len(starts))
    np.put_along_axis(within, np.argpartition(-best, k - 1, axis=1)[:, :k], True, axis=1)
    return within


def tiles_of(classes: DataFrame, shard: int = SHARD, tile: int = TILE, margin: float = MARGIN, limit: float = LIMIT) -> DataFrame:
    """(tile, cid, embedding, copies, shards, shard, part, alone): every class in the tiles of its shards;
    alone: the tile has one part of its shard only."""
    k = max(1, -(-classes.count() // shard))
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(max(SAMPLE, SPREAD * k)).select("embedding").toPandas()
    x = unit(np.stack(sample["embedding"])) if len(sample) else np.zeros((1, 1))
    centres = merged(centroids(x, min(len(x), k)), limit)
    sent = classes.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                y = unit(np.stack(part.column("embedding").to_numpy(zero_copy_only=False)))
                within = shards_of(y, *sent.value, margin, limit)
                shards = [np.flatnonzero(row).astype(np.int32) for row in within]
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), pa.array(shards, pa.list_(pa.int32()))], ["cid", "shards"])

    assigned = materialise(classes.select("cid", "embedding").mapInArrow(assign, "cid long, shards array<int>"))
    members = assigned.select("cid", F.explode("shards").alias("shard"))
    sizes = members.groupBy("shard").count()
    parts = sizes.select("shard", F.ceil(F.col("count") / tile).cast("int").alias("parts"))  # a row a centroid
    dealt = members.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other")).alias("tile")
    dealt = dealt.select(key, "cid", "shard", "part", (F.col("part") == F.col("other")).alias("alone"))
    return dealt.join(classes.select("cid", "embedding", "copies").join(assigned, "cid"), "cid")


def counted_here(shard: int, shards: list[np.ndarray], part: np.ndarray, alone: bool) -> np.ndarray:
    """(n, n) booleans: pairs of a tile's rows that are counted in it. Of the shards that hold both the first
    one counts a pair, and in it two rows of one part are counted where this part is alone."""
    n = len(part)
    here = np.full((n, n), True) if alone else part[:, None] != part[None, :]
    lower = [s[s < shard] for s in shards]
    names = np.unique(np.concatenate(lower))
    for at in range(0, len(names), TILE):
        some = names[at : at + TILE]
        in_shard = np.zeros((n, len(some)), np.float32)
        for i, s in enumerate(lower):
            in_shard[i, np.searchsorted(some, s[(s >= some[0]) & (s <= some[-1])])] = 1
        here &= in_shard @ in_shard.T == 0
    return here


def search_tiles(classes: DataFrame, finish, schema: str, limit: float, shard: int, tile: int, margin: float,
                 slack: float = SLACK, whole: bool = False) -> DataFrame:
    """What ``finish`` makes of each tile's cids, copies, all its links found and those counted in it."""
    tiles = materialise(tiles_of(classes, shard, tile, margin, limit))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cid")
        cid = np.append(rows["cid"].to_numpy(), -1)
        adjacent = cid[build_graph(unit(np.stack(rows["embedding"])))]
        return pd.DataFrame({"cid": cid[:-1], "near": [list(a[a >= 0]) for a in adjacent]})

    lists = tiles.select("tile", "cid", "embedding").groupBy("tile").applyInPandas(build, "cid long, near array<long>")
    united = lists.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cid")
        cid, n = rows["cid"].to_numpy(), len(rows)
        adjacent = np.full((n, max([1, *map(len, rows["near"])])), n)
        for i, near in enumerate(rows["near"]):
            at = np.searchsorted(cid, near)
            at = at[(at < n) & (cid[np.minimum(at, n - 1)] == near)]  # of the list, what is in this tile
            adjacent[i, : len(at)] = at
        adjacent = adjacent[:, : max(1, (adjacent < n).sum(1).max())]
        hits = range_hits(unit(np.stack(rows["embedding"])), adjacent, limit, slack, whole=whole)
        first = rows.iloc[0]
        here = counted_here(first["shard"], list(rows["shards"]), rows["part"].to_numpy(), first["alone"])
        return finish(cid, rows["copies"].to_numpy(), hits, hits & here)

    return materialise(tiles.join(united, "cid").groupBy("tile").applyInPandas(search, schema))


def near_pairs(classes: DataFrame, limit: float = LIMIT, shard: int = SHARD, tile: int = TILE, margin: float = MARGIN) -> DataFrame:
    """(u, v, copies_u, copies_v): linked pairs of classes, u < v, each once."""

    def finish(cid, copies, hits, counted):
        i, j = np.nonzero(np.triu(counted))
        return pd.DataFrame({"u": cid[i], "v": cid[j], "copies_u": copies[i], "copies_v": copies[j]})

    return search_tiles(classes, finish, "u long, v long, copies_u long, copies_v long", limit, shard, tile, margin)


def near_links(classes: DataFrame, limit: float = LIMIT, shard: int = SHARD, tile: int = TILE,
               margin: float = MARGIN, slack: float = SLACK, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cid, near, links): of every class with links, the classes and the rows it links with; and edges
    (u, v) that connect what links. Both grow with the classes, not with the pairs of a large group."""

    def finish(cid, copies, hits, counted):
        near = counted.sum(1)
        some = near > 0
        i, j = forest(*np.nonzero(np.triu(hits)), len(cid))
        return pd.DataFrame({
            "u": np.concatenate([cid[some], cid[i]]),
            "v": pd.array([*[None] * int(some.sum()), *cid[j].tolist()], "Int64"),
            "near": np.concatenate([near[some], 0 * i]),
            "links": np.concatenate([(counted[some] @ copies), 0 * i]),
        })

    found = search_tiles(classes, finish, "u long, v long, near long, links long", limit, shard, tile, margin, slack, whole)
    sums = found.where("v is null").groupBy(F.col("u").alias("cid")).agg(F.sum("near").alias("near"), F.sum("links").alias("links"))
    return sums, found.where("v is not null").select("u", "v")


def true_links(classes: DataFrame, limit: float = LIMIT, sample: int = AUDITED) -> dict[int, int]:
    """How many classes each of ``sample`` classes (by hash) links with; the sample is compared with all
    classes, block by block."""
    chosen = classes.orderBy(F.xxhash64("cid", F.lit(1)), "cid").limit(sample).select("cid", "embedding").toPandas()
    if chosen.empty:
        return {}
    sent = classes.sparkSession.sparkContext.broadcast((chosen["cid"].to_numpy(), unit(np.stack(chosen["embedding"]))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = sent.value
        near = np.zeros(len(ids), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                y = unit(np.stack(part.column("embedding").to_numpy(zero_copy_only=False)))
                same = ids[:, None] == part.column("cid").to_numpy()
                near += ((x @ y.T >= limit) & ~same).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near)], ["cid", "near"])

    counted = classes.select("cid", "embedding").mapInArrow(compare, "cid long, near long")
    return {r.cid: r.near for r in counted.groupBy("cid").agg(F.sum("near").alias("near")).collect()}


def recall(true: dict[int, int], links: DataFrame) -> float:
    """Share of the ``true`` links of its classes that ``links`` (cid, near) holds: the least of that of all
    links and those of the strata of classes, a stratum being all with up to twice as many links as
    its fewest, and its share the mean of its classes'. So a large group, which has most links, does not hide
    what is lost outside it. Strata of under ``STRATUM`` classes say too little by themselves."""
    true = {c: n for c, n in true.items() if n}
    if not true:
        return 1.0
    of_sample = links.where(F.col("cid").isin(list(true))).groupBy("cid").agg(F.sum("near").alias("near"))
    found = {r.cid: r.near for r in of_sample.collect()}  # a row for each class of the sample at most
    strata: dict[int, list[float]] = {}
    for c, n in true.items():
        strata.setdefault(n.bit_length(), []).append(found.get(c, 0) / n)
    shares = [sum(s) / len(s) for s in strata.values() if len(s) >= STRATUM]
    return min([sum(found.values()) / sum(true.values()), *shares])


def audit(classes: DataFrame, pairs: DataFrame, limit: float = LIMIT, sample: int = 200) -> float:
    """Share of the links of ``sample`` classes (by hash) that ``pairs`` holds."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("cid"), F.lit(1).alias("near"))
    return recall(true_links(classes, limit, sample), ends)


def audited_links(classes: DataFrame, limit: float = LIMIT, shard: int = SHARD, tile: int = TILE,
                  steps=STEPS) -> tuple[DataFrame, DataFrame, float]:
    """``near_links`` of the first of the steps that finds ``RECALL`` of the sample's links, and its recall."""
    true = true_links(classes, limit)
    for margin, slack, whole in steps:
        links, edges = near_links(classes, limit, shard, tile, margin, slack, whole)
        found = recall(true, links)
        log.warning("recall %.4f of %d links of %d classes (margin %s, slack %s%s)", found, sum(true.values()),
                    len(true), margin, slack, ", all compared" if whole else "")
        if found >= RECALL:
            return links, edges, found
    raise RuntimeError(f"near vectors: recall {found:.4f} is below {RECALL}")


def near_vectors(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    vectors = vectors.select("vec_id", "embedding")
    classes = classes_of(vectors)
    links, edges, _ = audited_links(classes, limit)
    labels = components(edges).withColumnRenamed("node", "cid")
    known = classes.join(links, "cid", "left").join(labels, "cid", "left")
    known = known.withColumn("label", F.coalesce("label", "cid"))
    named = known.groupBy("label").agg(F.min("rep").alias("component"))
    known = known.join(named, "label").select(
        "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component"
    )
    usable = F.col("vec_id").isNotNull()
    return (
        vectors.join(materialise(known), "embedding", "left")
        .select(
            "vec_id", F.when(usable, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(usable, F.coalesce("component", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def op2_pruned_graph(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
