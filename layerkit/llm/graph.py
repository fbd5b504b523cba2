"""Approximate nearest neighbours: one robust-pruned directed graph for each shard.

Vectors are dealt to shards of about ``SHARD`` rows by a hash of their id. In a shard
equal vectors become one node. The graph starts from random edges; greedy searches from
the node nearest the mean propose neighbours for every node, and robust pruning with a
relaxed distance (a candidate is dropped when a kept neighbour is ``ALPHA`` times nearer
to it than the node is) keeps few but diverse edges, reverse edges included. Many
searches advance in lockstep, as numpy matrices.

A query runs a beam search in every shard; the candidates found are measured exactly, in
double precision on the original vectors, and the nearest of all shards are kept. The
shard's graph and the query rows meet in one sorted partition, where queries stream past
the graph in batches; a shard no larger than the beam is searched exhaustively.

Defined results: null vectors, empty and zero ones and those with null or non-finite
components take no part, as rows and as queries; rows with a null id are no queries and
no candidates; vectors are compared with those of equal length; distance ties go to the
smaller id (a node keeps its k + 1 smallest ids, which is all that any query can need);
rows that repeat are candidates each; an empty table gives an empty result; only the
named columns are read, so extra columns cannot clash.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored

SHARD, DEGREE, BUILD_BEAM, BEAM, ALPHA, BATCH = 4096, 24, 48, 80, 1.2, 256


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the best ``beam`` nodes for each row of ``q``
    (-1 and inf where fewer were met), nearest first."""
    n, rows = len(q), np.arange(len(q))
    ids = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    seen = np.zeros((n, len(x)), bool)
    ids[:, 0], done[:, 0], seen[:, start] = start, False, True
    far[:, 0] = ((q - x[start]) ** 2).sum(1)
    while True:
        pick = np.where(done, np.inf, far).argmin(1)
        live = np.flatnonzero(~done[rows, pick])
        if not len(live):
            return ids, far
        done[live, pick[live]] = True
        near = edges[ids[live, pick[live]]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[np.repeat(live, near.shape[1])[fresh.ravel()], near[fresh]] = True
        gap = x[near] - q[live, None, :]
        dist = np.where(fresh, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
        every = np.concatenate((far[live], dist), 1)
        best = np.argpartition(every, beam - 1, 1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(every, best, 1), 1, kind="stable"), 1)
        far[live] = np.take_along_axis(every, best, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], near), 1), best, 1)
        done[live] = np.take_along_axis(np.concatenate((done[live], ~fresh), 1), best, 1)


def robust_prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node among its candidates (-1: none)."""
    cand = np.sort(cand, 1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == nodes[:, None]] = -1
    points = x[cand]
    gap = points - x[nodes][:, None, :]
    own = np.where(cand >= 0, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
    open_, rows = own.copy(), np.arange(len(nodes))
    out = np.full((len(nodes), degree), -1)
    for k in range(degree):
        pick = open_.argmin(1)
        live = np.isfinite(open_[rows, pick])
        if not live.any():
            break
        out[live, k] = cand[live, pick[live]]
        gap = points - points[rows, pick][:, None, :]
        between = np.einsum("ijk,ijk->ij", gap, gap)
        open_[live[:, None] & (alpha * alpha * between <= own)] = np.inf
        open_[rows, pick] = np.inf
    return out


def build(x: np.ndarray, *, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, batch: int = BATCH, seed: int = 9) -> tuple[np.ndarray, int]:
    """Edge lists (-1: none) and the start node of the graph over the rows of ``x``."""
    n, rng = len(x), np.random.default_rng(seed)
    wide = degree + degree // 3
    edges = np.full((n, wide), -1)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin()) if n else 0
    if n <= wide:
        edges[:, :n] = np.arange(n)
        return edges, start
    edges[:, :degree] = rng.integers(0, n, (n, degree))
    order = rng.permutation(n)
    for a in range(0, n, batch):
        nodes = order[a:a + batch]
        met, _ = beam_search(x, edges, start, x[nodes], beam)
        kept = robust_prune(x, nodes, np.concatenate((met, edges[nodes]), 1), degree, alpha)
        edges[nodes] = -1
        edges[nodes, :degree] = kept
        # reverse edges: appended where there is room, pruned again where there is none
        to, of = kept[kept >= 0], np.repeat(nodes, (kept >= 0).sum(1))
        sort = np.argsort(to, kind="stable")
        to, of = to[sort], of[sort]
        heads, first, many = np.unique(to, return_index=True, return_counts=True)
        block = np.full((len(heads), int(many.max()) if len(many) else 0), -1)
        block[np.repeat(np.arange(len(heads)), many), np.arange(len(to)) - np.repeat(first, many)] = of
        both = np.concatenate((edges[heads], block), 1)
        both.sort(1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both = -np.sort(-both, 1)
        crowded = both[:, wide] >= 0 if both.shape[1] > wide else np.zeros(len(heads), bool)
        edges[heads[~crowded]] = both[~crowded, :wide]
        if crowded.any():
            edges[heads[crowded]] = -1
            edges[heads[crowded], :degree] = robust_prune(x, heads[crowded], both[crowded], degree, alpha)
    return edges, start


def pack_shard(ids: np.ndarray, vectors: np.ndarray, k: int) -> bytes:
    """The shard's nodes (equal vectors once, with their k + 1 smallest ids) and graph."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    _, first, node = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    node = node.ravel()
    sort = np.argsort(node, kind="stable")
    begin = np.searchsorted(node[sort], np.arange(len(first)))
    place = np.arange(len(ids)) - begin[node[sort]]
    keep = place <= k
    table = np.full((len(first), k + 1), -1, np.int64)
    held = np.zeros((len(first), k + 1), bool)
    table[node[sort][keep], place[keep]] = ids[sort][keep]
    held[node[sort][keep], place[keep]] = True
    points = vectors[first]
    edges, start = build(points.astype(np.float32))
    return pickle.dumps((points, table, held, edges, start), protocol=5)


def search_shard(shard: tuple, query_ids: np.ndarray, q: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, distance) of the k nearest found for each query."""
    points, table, held, edges, start = shard
    small = len(points) <= beam
    met = np.broadcast_to(np.arange(len(points)), (len(q), len(points))) if small else \
        beam_search(points.astype(np.float32), edges, start, q.astype(np.float32), beam)[0]
    gap = points[met] - q[:, None, :]
    dist = np.sqrt((gap * gap).sum(2))
    near = table[met].reshape(len(q), -1)
    ok = (held[met] & (met >= 0)[:, :, None]).reshape(len(q), -1) & (near != query_ids[:, None])
    dist = np.where(ok, np.repeat(dist, table.shape[1], 1), np.inf)
    best = np.lexsort((near, dist), axis=1)[:, :k]
    out_far = np.take_along_axis(dist, best, 1)
    take = np.isfinite(out_far)
    return np.repeat(query_ids, take.sum(1)), np.take_along_axis(near, best, 1)[take], out_far[take]


def valid(table: DataFrame, key: str, vector: str) -> DataFrame:
    cells = quoted(vector).cast("array<double>")
    inf = F.lit(float("inf"))
    return (table.select(quoted(key).cast("long").alias("id"), cells.alias("v")).where(F.col("id").isNotNull() & (F.size("v") > 0))
            .where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)) & F.exists("v", lambda c: c != 0))
            .withColumn("dim", F.size("v")))


def nearest(table: DataFrame, is_query, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, shard: int = SHARD,
            beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id satisfies ``is_query``."""
    spark = table.sparkSession
    rows = valid(table, key, vector)
    shards = {r["dim"]: -(-r["count"] // shard) for r in rows.groupBy("dim").count().collect()}  # a row for each vector length
    count = F.coalesce(*[F.when(F.col("dim") == d, F.lit(n)) for d, n in shards.items()], F.lit(1))

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        blob = pack_shard(pdf["id"].to_numpy(np.int64), np.array(pdf["v"].to_list(), float), k)
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "graph": [blob]})

    index = stored(rows.withColumn("shard", F.pmod(F.xxhash64("id"), count).cast("int")).groupBy("dim", "shard")
                   .applyInPandas(built, "dim int, shard int, graph binary"), spark, "graph-index")
    queries = rows.where(is_query(F.col("id"))).select("dim", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("shard"), "id", "v")
    both = index.select("dim", "shard", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("v"), "graph") \
        .unionByName(queries.withColumn("graph", F.lit(None).cast("binary")))

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, current = None, None
        for pdf in frames:
            out = []
            for place, part in pdf.groupby(["dim", "shard"], sort=False):
                blob = part["graph"].dropna()
                if len(blob):
                    opened, current = pickle.loads(blob.iloc[0]), place
                asked = part[part["graph"].isna()]
                if current != place or not len(asked):
                    continue
                for a in range(0, len(asked), BATCH):
                    some = asked.iloc[a:a + BATCH]
                    out.append(search_shard(opened, some["id"].to_numpy(np.int64), np.array(some["v"].to_list(), float), k, beam))
            if out:
                q, near, far = (np.concatenate(c) for c in zip(*out))
                yield pd.DataFrame({"query_id": q, "vec_id": near, "score": far})

    found = (both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("graph").isNull())
             .mapInPandas(searched, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, lambda id_: id_ % 100 == 0)
