"""Operator 6: exact top-k inner products by ball trees, branch and bound per shard."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 64
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
HITS = "query_id long, vec_id long, score long"


@dataclass
class Tree:
    rows: np.ndarray
    ids: np.ndarray
    levels: list[list[tuple[int, int]]]
    centres: list[np.ndarray]
    radii: list[np.ndarray]


def build(rows: np.ndarray, ids: np.ndarray) -> Tree:
    """A balanced ball tree: each node is cut at the median of its widest component."""
    order = np.arange(len(rows))
    spans = [(0, len(rows))]
    levels = [spans]
    while max(b - a for a, b in spans) > LEAF:
        halves = []
        for a, b in spans:
            own = rows[order[a:b]]
            axis = int(np.argmax(np.ptp(own, axis=0))) if own.size else 0
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)] if own.size else order[a:b]
            halves += [(a, a + mid), (a + mid, b)]
        spans = halves
        levels.append(spans)
    laid = rows[order].astype(np.float64)
    centres = [np.array([laid[a:b].mean(axis=0) for a, b in level]) for level in levels]
    radii = [
        np.array([np.sqrt(((laid[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(level, centre)])
        for level, centre in zip(levels, centres)
    ]
    return Tree(rows[order], ids[order], levels, centres, radii)


def search(
    tree: Tree, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query index, row id, score)`` of each query's best ``k`` rows of the shard.

    ``floor`` is the k-th score each query already has elsewhere. Going down the
    tree, a node is dropped once its bound ``q . centre + |q| radius`` lies below it;
    the leaves left are read from the highest bound down, raising the floor, until
    the next bound is too low. Ties at the floor are followed, since a smaller id wins.
    """
    asked = queries.astype(np.float64)
    norms = np.sqrt((asked**2).sum(axis=1))
    bound = np.full((len(asked), 1), np.inf)
    for level, (centres, radii) in enumerate(zip(tree.centres, tree.radii)):
        if level:
            bound = np.repeat(bound, 2, axis=1)
        reach = asked @ centres.T + norms[:, None] * radii[None, :]
        reach += 1e-9 * np.abs(reach) + 1e-6
        bound = np.where((bound >= floor[:, None]) & (reach >= floor[:, None]), np.minimum(bound, reach), -np.inf)
    big = max(np.abs(asked).max(initial=0), np.abs(tree.rows).max(initial=0))
    exact = np.float64 if big * big * max(1, asked.shape[1]) < 2**53 else np.int64
    left, right = queries.astype(exact), tree.rows.astype(exact)
    empty = -np.inf if exact is np.float64 else np.iinfo(np.int64).min
    score = np.full((len(asked), k), empty, dtype=exact)
    found = np.full((len(asked), k), -1, dtype=np.int64)
    lowest = floor.astype(np.float64).copy()
    by_bound = np.argsort(-bound, axis=1, kind="stable")
    for turn in range(bound.shape[1]):
        leaf = by_bound[:, turn]
        best = bound[np.arange(len(asked)), leaf]
        live = np.flatnonzero((best >= lowest) & (best > -np.inf))
        if not len(live):
            break
        for node in np.unique(leaf[live]):
            who = live[leaf[live] == node]
            a, b = tree.levels[-1][node]
            got = left[who] @ right[a:b].T
            ids = np.broadcast_to(tree.ids[a:b], got.shape)
            own = ids == query_ids[who][:, None]
            all_ids = np.concatenate([found[who], np.where(own, -1, ids)], axis=1)
            all_scores = np.concatenate([score[who], np.where(own, empty, got)], axis=1)
            by_id = np.argsort(all_ids, axis=1, kind="stable")
            ranked = np.take_along_axis(all_scores, by_id, axis=1)
            falling = -ranked if exact is np.float64 else ~ranked  # ~x falls with x, without overflow
            last = np.argsort(falling, axis=1, kind="stable")[:, :k]
            score[who] = np.take_along_axis(ranked, last, axis=1)
            found[who] = np.take_along_axis(np.take_along_axis(all_ids, by_id, axis=1), last, axis=1)
            kth = score[who, -1]
            lowest[who] = np.where(kth > empty, np.maximum(lowest[who], kth.astype(np.float64)), lowest[who])
    row, column = np.nonzero(score > empty)
    return row, found[row, column], score[row, column].astype(np.int64)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), -1)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query, exactly.

    ``vectors`` has ``vec_id`` and ``vector`` (whole numbers, below 2**31 in size).
    Rows with a NULL id or vector, or a NULL component, take no part. A query's own id
    is no candidate; other ids given twice count twice, and of a query's rows the least asks. Vectors meet only vectors of
    their length. Ties go to the smaller id.

    Rows are dealt over shards of about ``shard_rows``. Each query is first answered
    in its own shard; its k-th score there goes along to all other shards, where it
    cuts off most of the tree from the start. Queries travel in blocks, so a task
    holds one shard and one block, whatever the size of the table.
    """
    clean = vectors.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    ).select("vec_id", "vector", is_query.alias("asks"), F.size("vector").alias("width"))
    rows = clean.count()
    shards = max(1, -(-rows // shard_rows))
    dealt = clean.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def at_home(group: pd.DataFrame) -> pd.DataFrame:
        asks = group[group["asks"]]
        if asks.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        asks = asks.assign(_v=asks["vector"].map(tuple)).sort_values("_v").drop_duplicates("vec_id")
        tree = build(_matrix(group["vector"]), group["vec_id"].to_numpy())
        ids = asks["vec_id"].to_numpy()
        row, found, score = search(tree, _matrix(asks["vector"]), ids, np.full(len(asks), -np.inf), k)
        return pd.DataFrame({"query_id": ids[row], "vec_id": found, "score": score})

    def abroad(key: tuple, group: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or group.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        tree = build(_matrix(group["vector"]), group["vec_id"].to_numpy())
        ids = asks["vec_id"].to_numpy()
        floor = asks["floor"].fillna(-np.inf).to_numpy(dtype=np.float64)
        row, found, score = search(tree, _matrix(asks["vector"]), ids, floor, k)
        return pd.DataFrame({"query_id": ids[row], "vec_id": found, "score": score})

    home = dealt.groupBy("width", "shard").applyInPandas(at_home, HITS)
    if shards == 1:
        hits = home
    else:
        asked = dealt.where("asks").groupBy("vec_id", "width", F.col("shard").alias("home")).agg(
            F.min("vector").alias("vector")
        )
        blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
        kth = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
        floors = kth.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("low")).alias("floor"))
        block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).cast("int").alias("block")
        travelling = (
            asked.join(floors, "vec_id", "left")
            .select("vec_id", "vector", "width", "floor", "home", block)
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .where("shard <> home")
        )
        own = [F.col(c).alias(c) for c in ("vec_id", "vector", "width", "shard")]
        copied = dealt.select(*own, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        away = (
            copied.groupBy("width", "shard", "block")
            .cogroup(travelling.groupBy("width", "shard", "block"))
            .applyInPandas(abroad, HITS)
        )
        hits = home.unionByName(away)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def scaled(embeddings: DataFrame, factor: int = 256) -> DataFrame:
    """``vec_id, vector``: each component times ``factor`` rounded down, as whole numbers.

    Vectors that are NULL or hold a NULL or non-finite component are left out.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return embeddings.where(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        "vec_id", whole.alias("vector")
    )
