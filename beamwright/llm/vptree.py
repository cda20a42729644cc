"""Nearest neighbours by vantage-point trees, one per shard.

Every valid vector goes to a shard by the hash of its id; a shard's tree is built in one task and stored. Each block of
queries then searches each shard's tree, and a query's best candidates of all shards are merged. A branch is skipped when
``factor`` times the least distance it can hold, by the triangle inequality, exceeds the query's worst kept distance: at
factor one the search is exact, larger factors skip more. Distances are sums over the components in order, in double precision.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows with a null
id; a query meets vectors of its own length only; rows that repeat a query count once, and a candidate with the query's id is
its own row; other repeated rows are candidates each; ties go to the smaller id. No vector or no query: no rows. Of the input
only the id and the vector are read.
"""

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beamwright.llm.common import written

LEAF = 64


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean, summed over the components in their order."""
    total = np.zeros((len(queries), len(points)))
    for q, p in zip(queries.T, points.T):
        step = q[:, None] - p[None, :]
        total += step * step
    return np.sqrt(total)


def build(ids: np.ndarray, points: np.ndarray) -> dict:
    """Nodes as arrays. A node is a leaf (rows ``lo:hi``) or has a vantage row, two children and their distance ranges.

    A set whose members are all equally far from the vantage point becomes one leaf, however large.
    """
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    nodes, stack = [], [(np.arange(len(ids)), -1, 0)]
    while stack:
        members, parent, side = stack.pop()
        if parent >= 0:
            nodes[parent]["children"][side] = len(nodes)
        far = None
        if len(members) > LEAF:
            vantage = members[len(members) // 2]
            rest = members[members != vantage]
            far = distances(points[vantage][None], points[rest])[0]
        if far is None or far.min() == far.max():
            nodes.append({"rows": members})
            continue
        inside = far <= np.median(far)
        if inside.all():
            inside = far < far.max()
        spans = [(far[side].min(), far[side].max()) for side in (inside, ~inside)]
        stack += [(rest[inside], len(nodes), 0), (rest[~inside], len(nodes), 1)]
        nodes.append({"vantage": vantage, "spans": spans, "children": [-1, -1]})
    return {"ids": ids, "points": points, "nodes": nodes}


class Search:
    """The best ``k`` rows of one tree for a block of queries, searched together."""

    def __init__(self, tree: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.query_ids, self.queries, self.k, self.factor = tree, query_ids, queries, k, factor
        self.best = np.full((len(queries), k), np.inf)
        self.best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    def offer(self, active: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
        """Keep what is better by (distance, id); ``rows`` are in the order of their ids."""
        ids = self.tree["ids"][rows]
        far = np.where(ids[None, :] == self.query_ids[active][:, None], np.inf, far)
        hit = (far <= self.best[active, -1][:, None]).any(axis=1)
        if not hit.any():
            return
        active, far = active[hit], far[hit]
        first = np.argsort(far, axis=1, kind="stable")[:, : self.k]
        all_far = np.concatenate([self.best[active], np.take_along_axis(far, first, 1)], axis=1)
        all_ids = np.concatenate([self.best_ids[active], ids[first]], axis=1)
        keep = np.lexsort((all_ids, all_far), axis=1)[:, : self.k]
        self.best[active] = np.take_along_axis(all_far, keep, 1)
        self.best_ids[active] = np.take_along_axis(all_ids, keep, 1)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Depth first; each query goes to the child on its own side of the border before the other."""
        points, stack = self.tree["points"], [(0, np.arange(len(self.queries)), None)]
        while stack:
            number, active, least = stack.pop()
            if least is not None:
                near = self.factor * least <= self.best[active, -1]
                active = active[near]
            if not len(active):
                continue
            node = self.tree["nodes"][number]
            if "rows" in node:
                self.offer(active, node["rows"], distances(self.queries[active], points[node["rows"]]))
                continue
            far = distances(self.queries[active], points[[node["vantage"]]])
            self.offer(active, np.array([node["vantage"]]), far)
            far = far[:, 0]
            # the least distance to anything in a child, less what rounding may add
            bounds = [np.maximum(0, np.maximum(lo - far, far - hi) - 1e-9 * (far + hi)) for lo, hi in node["spans"]]
            left = far <= node["spans"][0][1]
            for side, first in ((1, False), (0, False), (1, True), (0, True)):
                own = left if (side == 0) == first else ~left
                stack.append((node["children"][side], active[own], bounds[side][own]))
        return self.best, self.best_ids


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors])


def index(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", shard_rows: int = 8192) -> tuple[DataFrame, int]:
    """The stored trees (dim, shard, tree) of all valid vectors, and the number of shards."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & valid(F.col("v")))
    shards = max(1, -(-rows.count() // shard_rows))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build(group["id"].to_numpy(np.int64), _matrix(group["v"]))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree)]})

    keyed = rows.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return written(keyed.groupBy("dim", "shard").applyInPandas(grow, "dim int, shard bigint, tree binary"), "vptree"), shards


def search(trees: DataFrame, shards: int, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 10,
           factor: float = 1.0, block_rows: int = 512) -> DataFrame:
    """For each query its ``k`` nearest: query_id, rank, vec_id, score."""
    rows = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & valid(F.col("v"))).distinct()
    blocks = max(1, -(-rows.count() // block_rows))
    packed = rows.withColumn("dim", F.size("v")).groupBy("dim", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("id", "v")).alias("queries"))
    # every block of the stated query set visits every shard
    sent = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    pairs = sent.join(trees, ["dim", "shard"]).select("tree", "queries")

    def work(batches):
        for batch in batches:
            for packed_tree, block in zip(batch.column(0), batch.column(1)):
                tree = pickle.loads(packed_tree.as_py())
                wanted = block.values
                ids = wanted.flatten()[0].to_numpy(zero_copy_only=False)
                vectors = wanted.flatten()[1].flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                far, found = Search(tree, ids, vectors, k, factor).run()
                real = np.isfinite(far)
                number = np.broadcast_to(np.arange(len(ids))[:, None], far.shape)[real]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[number]), pa.array(found[real]), pa.array(far[real])], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(work, "query_id bigint, vec_id bigint, score double")
    order = W.Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, shard_rows: int = 8192) -> DataFrame:
    trees, shards = index(vectors, shard_rows=shard_rows)
    return search(trees, shards, queries, k=k, factor=factor)
