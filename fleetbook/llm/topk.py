"""Exact top-k inner-product search with MaxScore pruning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
SHARD_ROWS = 8192      # up to LEAST_SHARDS shards; more rows make them larger first
LEAST_SHARDS = 64
MOST_ROWS = 1 << 16    # rows of a shard
FIRST_ROWS = 256  # scored in full, to get a first threshold
ROWS = 2048       # rows traversed between two threshold updates
QUERIES_AT_ONCE = 256
SLACK = 0.05      # share of the way to the threshold that non-essential terms may bridge
PROBE_TERMS = 8   # non-essential terms probed between two checks


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, vec): components as floor(scale * x). Rows whose id or vector
    is null, or that hold null or non-finite components, are left out."""
    wide = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(finite)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(wide, lambda x: F.floor(x * scale)).alias("vec")))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    if len(column) and all(len(x) == width for x in column):
        return np.stack(column.to_numpy()).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    for i, x in enumerate(column):
        out[i, :len(x)] = x
    return out


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["q", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return found[found.groupby("q").cumcount() < k]


def max_score(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
              k: int) -> pd.DataFrame:
    """Top ``k`` rows of one shard for each query, as (q, vec_id, score).

    A query's terms are its components; the posting of a term is a column of
    the shard, and a term's contribution lies between its least product and
    ``bound`` above that. Terms of small bounds, which together bridge no more
    than ``SLACK`` of the way from the least score to the query's threshold
    (its k-th score so far), are non-essential: a row needs the others to
    compete. Essential columns are traversed for all rows; the rest is probed,
    largest bound first, only for rows that can still beat the threshold. Rows
    come in ascending id, so a later tie never wins.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 1 << 53:  # sums stay exact, so the floating-point product may be used
        queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    lowest = -np.inf if queries.dtype == np.float64 else np.iinfo(np.int64).min
    low, high = vectors.min(0), vectors.max(0)
    least = np.minimum(queries * low, queries * high)
    bound = np.maximum(queries * low, queries * high) - least
    by_bound = np.argsort(bound, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(bound, by_bound, 1), axis=1)
    base = least.sum(1)
    rank = np.argsort(by_bound, axis=1)  # of each term, the least bound first
    best = pd.DataFrame({"q": np.array([], np.int64), "vec_id": np.array([], np.int64),
                         "score": np.array([], np.int64)})
    cuts = [0, *range(FIRST_ROWS, len(ids), ROWS), len(ids)]
    for lo, hi in zip(cuts, cuts[1:]):
        rows, row_ids = vectors[lo:hi], ids[lo:hi]
        counted = best.groupby("q")["score"].agg(["size", "min"])
        full = counted[counted["size"] >= k]
        threshold = np.full(len(queries), lowest, queries.dtype)
        threshold[full.index] = full["min"]
        gap = threshold.astype(np.float64) - base
        idle = (sums <= SLACK * gap[:, None]).sum(1)  # non-essential terms
        essential = np.where(rank >= idle[:, None], queries, 0)
        rest = np.where(idle > 0, np.take_along_axis(sums, np.maximum(idle - 1, 0)[:, None], 1)[:, 0], 0)
        floor = np.where(rank < idle[:, None], least, 0).sum(1)
        found = []
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            some = slice(at, at + QUERIES_AT_ONCE)
            score = rows @ essential[some].T + floor[some]
            r, q = np.nonzero((score + rest[some] > threshold[some]) & (row_ids[:, None] != query_ids[some]))
            score, q = score[r, q], q + at
            left = idle[q]
            while len(r) and left.max() > 0:
                for place in range(1, PROBE_TERMS + 1):  # the largest bounds left
                    term = by_bound[q, left - place]
                    gain = queries[q, term] * rows[r, term] - least[q, term]
                    score += np.where(left >= place, gain, 0)
                left = np.maximum(left - PROBE_TERMS, 0)
                alive = score + np.where(left > 0, sums[q, left - 1], 0) > threshold[q]
                r, q, score, left = r[alive], q[alive], score[alive], left[alive]
            found.append((r, q, score))
        r, q, score = map(np.concatenate, zip(*found))
        new = pd.DataFrame({"q": q, "vec_id": row_ids[r], "score": score.astype(np.int64)})
        best = _best(pd.concat([best, new]), k)
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Each query row's ``k`` highest integer inner products over all other
    rows: query_id, rank (from 1), vec_id, score; ties to the smaller vec_id.

    Rows go into hashed shards of ``SHARD_ROWS`` to ``MOST_ROWS`` and queries into
    hashed blocks of about ``QUERY_BLOCK``; every block meets every shard in a
    task of bounded size, which runs MaxScore, and a window merges the shards'
    lists of at most ``k`` rows.

    A row whose id is the query's own is no candidate. Vectors that are null
    or hold null or non-finite components, and null ids, take no part; a
    shorter vector counts as padded with zeros; repeated rows are candidates
    each, but one query (that with the least vector). Fewer than ``k`` candidates are all returned; no query gives no rows.
    Scores must fit in 64 bits. Other columns are not read.
    """
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    queries = (integer_vectors(vectors.where(is_query), id_col, vec_col, scale)
               .groupBy("vec_id").agg(F.min("vec").alias("vec")))
    n_rows, n_queries = rows.count(), queries.count()
    shards = max(min(-(-max(n_rows, 1) // SHARD_ROWS), LEAST_SHARDS), -(-n_rows // MOST_ROWS))
    blocks = -(-max(n_queries, 1) // QUERY_BLOCK)

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                          each(shards).alias("shard"))
    # rows of one id, and equal rows, are dealt apart
    place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    right = rows.select("vec_id", "vec", place.alias("shard")).select("vec_id", "vec", "shard", each(blocks).alias("block"))

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = max(q["vec"].map(len).max(), c["vec"].map(len).max())
        names = q["vec_id"].to_numpy()
        best = max_score(_matrix(q["vec"], width), names, _matrix(c["vec"], width), c["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": names[best["q"].astype(int)], "vec_id": best["vec_id"], "score": best["score"]})

    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
