"""Approximate nearest neighbours: one navigable small-world graph per shard.

Different vectors are dealt to shards of bounded size. A shard's nodes are taken
in a random order and get random levels; on each level a node is linked to a
diverse choice of its nearest predecessors, and links are made mutual and pruned
to a fixed degree, so a level is one flat array of neighbour numbers. Because a
shard is bounded, predecessors are found by blocked matrix products instead of a
search in the half-built graph. Blocks of queries are streamed past a shard, each in lockstep:
greedily down the upper levels, then with a beam on the lowest, and the shards'
results are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, written
from .tokens import tidy
from .warc import store_of

#: Different vectors in a shard, on average, and queries in a block.
SHARD_ROWS = 4096
QUERY_ROWS = 512
#: Links per node above the lowest level, which has twice as many.
DEGREE = 16
#: Predecessors considered for a node, and beam width of a search.
BUILD_BEAM = 64
SEARCH_BEAM = 128

INDEX = "shard int, n int, ids binary, vectors binary, levels array<binary>, members array<binary>"
FOUND = "query_id long, ids array<long>, score double"


class Graph(NamedTuple):
    """``links[l]`` are rows of neighbours within ``members[l]``; -1 is no link."""

    vectors: np.ndarray
    members: list[np.ndarray]
    links: list[np.ndarray]


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def _diverse(v: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int) -> np.ndarray:
    """For each node ``degree`` of its candidates (nearest first, -1 pads).

    A candidate is taken if it is nearer to the node than to all taken before it;
    free places go to the nearest of the rest.
    """
    out = np.full((len(nodes), degree), -1, np.int32)
    width = cand.shape[1]
    step = max(1, (1 << 22) // (width * width))
    for lo in range(0, len(nodes), step):
        c = cand[lo : lo + step]
        real = c >= 0
        own = v[c]
        sims = np.einsum("mcd,md->mc", own, v[nodes[lo : lo + step]])
        gram = own @ own.transpose(0, 2, 1)
        taken = np.zeros(c.shape, bool)
        count = np.zeros(len(c), np.int64)
        for t in range(width):
            near = ((gram[:, t, :] > sims[:, t, None]) & taken).any(axis=1)
            ok = real[:, t] & ~near & (count < degree)
            taken[:, t] = ok
            count += ok
        # taken first, then the nearest others, both in order of nearness
        rank = np.where(taken, 0, np.where(real, 1, 2)) * width + np.arange(width)
        best = np.argsort(rank, axis=1, kind="stable")[:, :degree]
        picked = np.take_along_axis(c, best, axis=1)
        out[lo : lo + step, : picked.shape[1]] = picked
    return out


def _level(v: np.ndarray, degree: int, beam: int) -> np.ndarray:
    """Neighbour rows of one level whose nodes are in order of insertion."""
    n = len(v)
    cand = np.full((n, min(beam, max(n - 1, 1))), -1, np.int64)
    for lo in range(0, n, 512):
        hi = min(n, lo + 512)
        sims = v[lo:hi] @ v[:hi].T
        sims[np.arange(lo, hi)[:, None] <= np.arange(hi)[None, :]] = -np.inf
        k = min(cand.shape[1], hi)
        part = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < hi else np.tile(np.arange(hi), (hi - lo, 1))
        near = np.take_along_axis(sims, part, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        part, near = np.take_along_axis(part, order, axis=1), np.take_along_axis(near, order, axis=1)
        cand[lo:hi, :k] = np.where(np.isfinite(near), part, -1)
    first = _diverse(v, np.arange(n), cand, degree)
    a, j = np.nonzero(first >= 0)
    b = first[a, j].astype(np.int64)
    src, dst = np.concatenate((a, b)), np.concatenate((b, a))
    sims = np.einsum("ed,ed->e", v[src], v[dst])
    order = np.lexsort((dst, -sims, src))
    src, dst = src[order], dst[order]
    sizes = np.bincount(src, minlength=n)
    starts = np.cumsum(sizes) - sizes
    out = np.full((n, degree), -1, np.int32)
    # Lists of similar length are pruned together, so hubs do not widen the others.
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for w in np.unique(width[sizes > 0]):
        nodes = np.flatnonzero((width == w) & (sizes > 0))
        at = starts[nodes][:, None] + np.arange(w)[None, :]
        full = np.arange(w)[None, :] < sizes[nodes][:, None]
        lists = np.where(full, dst[np.minimum(at, len(dst) - 1)], -1)
        out[nodes] = _diverse(v, nodes, lists, degree)
    return out


def build(vectors: np.ndarray, levels: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> Graph:
    """Graph over vectors in their order of insertion; node ``i`` is on levels 0 to ``levels[i]``."""
    v = unit(vectors)
    members, links = [], []
    for level in range(int(levels.max()) + 1):
        own = np.flatnonzero(levels >= level)
        members.append(own)
        links.append(_level(v[own], degree * (2 if level == 0 else 1), beam))
    return Graph(v, members, links)


def _climb_down(g: Graph, q: np.ndarray) -> np.ndarray:
    """Each query's nearest node found greedily on the levels above the lowest."""
    at = np.full(len(q), g.members[-1][0])
    for members, links in zip(g.members[:0:-1], g.links[:0:-1], strict=True):
        place = np.searchsorted(members, at)
        best = np.einsum("qd,qd->q", g.vectors[members[place]], q)
        moving = np.arange(len(q))
        while len(moving):
            near = links[place[moving]]
            sims = np.einsum("qmd,qd->qm", g.vectors[members[near]], q[moving])
            sims[near < 0] = -np.inf
            k = sims.argmax(axis=1)
            top = sims[np.arange(len(k)), k]
            better = top > best[moving]
            moving, k, near, top = moving[better], k[better], near[better], top[better]
            place[moving] = near[np.arange(len(k)), k]
            best[moving] = top
        at = members[place]
    return at


def search(g: Graph, q: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Per query (rows of unit length) up to ``beam`` nodes of the lowest level, -1 pads."""
    n, width = len(g.vectors), min(beam, len(g.vectors))
    at = _climb_down(g, q)
    ids = np.full((len(q), width), -1, np.int64)
    sims = np.full((len(q), width), -np.inf, np.float32)
    done = np.zeros((len(q), width), bool)
    ids[:, 0], sims[:, 0] = at, np.einsum("qd,qd->q", g.vectors[at], q)
    seen = np.zeros((len(q), n), bool)
    seen[np.arange(len(q)), at] = True
    live = np.arange(len(q))
    while len(live):
        open_sims = np.where(done[live] | (ids[live] < 0), -np.inf, sims[live])
        k = open_sims.argmax(axis=1)
        going = open_sims[np.arange(len(k)), k] > -np.inf
        live, k = live[going], k[going]
        if not len(live):
            break
        done[live, k] = True
        near = g.links[0][ids[live, k]].astype(np.int64)
        fresh = (near >= 0) & ~seen[live[:, None], near]
        rows, cols = np.nonzero(fresh)
        seen[live[rows], near[rows, cols]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        s[rows, cols] = np.einsum("ed,ed->e", g.vectors[near[rows, cols]], q[live[rows]])
        all_ids = np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1)
        all_sims = np.concatenate((sims[live], s), axis=1)
        all_done = np.concatenate((done[live], np.zeros(near.shape, bool)), axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[live] = np.take_along_axis(all_ids, top, axis=1)
        sims[live] = np.take_along_axis(all_sims, top, axis=1)
        done[live] = np.take_along_axis(all_done, top, axis=1)
    return ids


def levels_of(ids: np.ndarray) -> np.ndarray:
    """Random levels, the same for the same ids."""
    u = np.random.default_rng(7).random(len(ids))
    return np.floor(-np.log(1 - u) / math.log(DEGREE)).astype(int)


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of the rows that take part.

    Rows are left out whose id or vector is NULL, whose vector is zero or holds NULL
    or non-finite components, or has another length than most of the rest.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )
    sizes = v.groupBy(F.size("embedding").alias("d")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return v.where(F.size("embedding") == (most.d if most else 0))


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``INDEX``: one row per shard over all usable vectors, written to the shared folder.

    Equal vectors are one node with their ``k + 1`` smallest ids, so a vector that a
    third of all rows share is one node; the ids are limited per task before they
    are shuffled.
    """
    order = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = written(
        vectors.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "vectors",
    )
    shards = max(1, math.ceil(nodes.count() / shard_rows))

    def make(table: pa.Table) -> pa.Table:
        rows = table.to_pandas()
        # insertion in the order of a hash of the first id
        rows = rows.sort_values("h", kind="stable")
        v = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        lengths = rows["ids"].map(len).to_numpy()
        ids = np.full((len(rows), k + 1), np.iinfo(np.int64).min, np.int64)
        ids[np.arange(k + 1)[None, :] < lengths[:, None]] = np.concatenate(rows["ids"].to_numpy())
        g = build(v, levels_of(ids))
        return pa.table(
            {
                "shard": pa.array([rows["shard"].iloc[0]], pa.int32()),
                "n": pa.array([len(rows)], pa.int32()),
                "ids": [ids.tobytes()],
                "vectors": [v.tobytes()],
                "levels": pa.array([[x.tobytes() for x in g.links]], pa.list_(pa.binary())),
                "members": pa.array([[x.astype(np.int64).tobytes() for x in g.members]], pa.list_(pa.binary())),
            }
        )

    hashed = F.xxhash64(F.col("ids")[0])
    dealt = nodes.select(
        F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"), hashed.alias("h"), "ids", "embedding"
    )
    return written(dealt.groupBy("shard").applyInArrow(make, INDEX), "graphs")


#: Scores are told apart to so many places, so that parallel vectors tie.
SCORE_DIGITS = 12


def _query_blocks(path: str, rows: int = QUERY_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the queries of a written table, a block at a time."""
    files, where = store_of(path)
    table = ds.dataset(where, filesystem=files, format="parquet")
    for batch in table.to_batches(columns=["vec_id", "embedding"], batch_size=rows, use_threads=False):
        if len(batch):
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False)
            yield batch["vec_id"].to_numpy(), flat.reshape(len(batch), -1)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Graph, np.ndarray, np.ndarray]]:
    """Graph, ids and vectors of each shard row, one at a time."""
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            n = row["n"]
            ids = np.frombuffer(row["ids"], np.int64).reshape(n, -1)
            v = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
            links = [np.frombuffer(x, np.int32) for x in row["levels"]]
            members = [np.frombuffer(x, np.int64) for x in row["members"]]
            yield Graph(unit(v), members, [x.reshape(len(m), -1) for x, m in zip(links, members, strict=True)]), ids, v


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, beam: int = SEARCH_BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest found, by cosine.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; a query's own id is
    no candidate. Scores are cosines of the original vectors in double precision; equal
    ones, to ``SCORE_DIGITS`` places, go to the smaller id. Unusable rows (see :func:`usable`)
    take no part; no usable vectors or queries give no rows; a repeated id counts once per row.

    A shard is opened once, by one task, and all blocks of queries are streamed past it
    from the shared folder; only the ``k + 1`` best nodes of each query and shard are shuffled.
    """
    spark = vectors.sparkSession
    base = written(usable(vectors), "usable")
    wanted = base.select(F.size("embedding").alias("d")).limit(1).collect()
    asked = usable(queries).withColumn("vec_id", F.col("vec_id").cast("long"))
    if not wanted:
        return asked.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    path = scratch_dir(spark, "queries")
    asked.where(F.size("embedding") == wanted[0].d).select("vec_id", "embedding").write.parquet(path)
    index = build_index(base, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, ids, v in _shards(batches):
            norms = np.sqrt((v * v).sum(axis=1))
            for query_ids, q in _query_blocks(path):
                found = search(g, unit(q), beam)
                out: dict[str, list] = {"query_id": [], "ids": [], "score": []}
                for i, own in enumerate(found):
                    own = own[own >= 0]
                    score = (v[own] @ q[i]) / (norms[own] * math.sqrt(q[i] @ q[i]))
                    score = np.clip(score, -1, 1)
                    for j in np.lexsort((ids[own, 0], -score.round(SCORE_DIGITS)))[: k + 1]:
                        real = ids[own[j]]
                        out["query_id"].append(query_ids[i])
                        out["ids"].append(real[real > np.iinfo(np.int64).min].tolist())
                        out["score"].append(float(score[j]))
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema(
                        [("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())]
                    ),
                )

    found = index.mapInArrow(tidy(run), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", SCORE_DIGITS)), "vec_id")
    return (
        found.select("query_id", F.explode("ids").alias("vec_id"), "score")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
