"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetbook.llm.common import few_ids, written

TABLES = 2              # hash tables; each holds a copy of every vector
SEED = 7
SAMPLE_VALUES = 1 << 20  # numbers in the sample that the probes are fitted on, at most
SAMPLE_QUERIES = 300    # rows of it that serve as queries
TARGET = 0.97           # recall asked for on the sample
BLOCK_VALUES = 1 << 22  # numbers in a block of rows or of queries, at most
LEAST_BLOCK = 256       # rows
PAIRS_AT_ONCE = 1 << 16
HADAMARD_ROUNDS = 3


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): rows whose id and vector are there, finite and not zero."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull()).where(finite)
            .where(F.exists(x, lambda v: v != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), x.alias("vec")))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    if len(column) and all(len(x) == width for x in column):
        return np.stack(column.to_numpy()).astype(np.float64)
    out = np.zeros((len(column), width))
    for i, x in enumerate(column):
        out[i, :len(x)] = x
    return out


def rotated(x: np.ndarray, table: int, digit: int) -> np.ndarray:
    """Rows turned by a pseudo-rotation: random signs and a fast Hadamard
    transform, three times, over the width padded to a power of two."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([SEED, table, digit]).choice([-1.0, 1.0], (HADAMARD_ROUNDS, width))
    out = np.zeros((len(x), width))
    out[:, :x.shape[1]] = x / np.abs(x).max(axis=1, keepdims=True)  # the direction alone counts
    for s in signs:
        out *= s
        step = 1
        while step < width:
            halves = out.reshape(len(x), -1, 2, step)
            out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], 2).reshape(len(x), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _axes(x: np.ndarray, table: int, digit: int) -> np.ndarray:
    """The nearness of each row to every signed axis, first the positive ones."""
    turned = rotated(x, table, digit)
    return np.concatenate([turned, -turned], axis=1)


def buckets(x: np.ndarray, digits: int) -> np.ndarray:
    """Each row's bucket in every table: its nearest signed axis, one a digit."""
    out = np.zeros((len(x), TABLES), np.int64)
    for t in range(TABLES):
        for d in range(digits):
            axes = _axes(x, t, d)
            out[:, t] = out[:, t] * axes.shape[1] + axes.argmax(axis=1)
    return out


def probe_order(x: np.ndarray, digits: int, probes: int) -> np.ndarray:
    """The first ``probes`` buckets of all tables for each row, nearest first,
    as table * (buckets of a table) + bucket. With two digits a bucket is as
    near as the sum of its axes, and only sums of the ``probes`` nearest axes
    of either digit can be among the first."""
    n, near, names = len(x), [], []
    for t in range(TABLES):
        axes = _axes(x, t, 0)
        size = axes.shape[1]
        code = np.broadcast_to(np.arange(size), axes.shape)
        for d in range(1, digits):
            axes, code = _first(axes, code, probes)
            more, digit = _first(_axes(x, t, d), np.broadcast_to(np.arange(size), (n, size)), probes)
            code = (code[:, :, None] * size + digit[:, None]).reshape(n, -1)
            axes = (axes[:, :, None] + more[:, None]).reshape(n, -1)
        near.append(axes)
        names.append(code + t * size ** digits)
    return _first(np.concatenate(near, 1), np.concatenate(names, 1), probes)[1]


def _first(near: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-near, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(near, order, 1), np.take_along_axis(names, order, 1)


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray,
            k: int) -> pd.DataFrame:
    """The ``k`` rows nearest to each query by exact distance, as (q, vec_id,
    score), ties to the smaller id; equal rows of one id count once and a
    query's own id never. A matrix product finds the rows that can compete;
    their distances are then taken from the differences."""
    order = np.lexsort([*rows.T[::-1], ids])
    rows, ids = rows[order], ids[order]
    again = (ids[1:] == ids[:-1]) & (rows[1:] == rows[:-1]).all(axis=1)
    fresh = np.concatenate([[True], ~again])
    rows, ids = rows[fresh], ids[fresh]
    scale = max(np.abs(rows).max(), np.abs(queries).max())
    a, b = queries / scale, rows / scale
    near_sq = (b * b).sum(1)
    slack = 1e-12 * (rows.shape[1] + 1) * max(1.0, near_sq.max(), (a * a).sum(1).max())
    out, step = [], max(1, BLOCK_VALUES // len(rows))
    for at in range(0, len(a), step):
        some = slice(at, at + step)
        gap = (a[some] ** 2).sum(1)[:, None] + near_sq - 2 * (a[some] @ b.T)
        gap[query_ids[some][:, None] == ids] = np.inf
        most = np.partition(gap, k - 1, axis=1)[:, k - 1] if gap.shape[1] > k else np.full(len(gap), np.inf)
        q, r = np.nonzero((gap <= most[:, None] + slack) & (gap < np.inf))
        far = np.empty(len(q))
        for lo in range(0, len(q), PAIRS_AT_ONCE):
            part = slice(lo, lo + PAIRS_AT_ONCE)
            far[part] = distance(queries[at + q[part]], rows[r[part]])
        found = pd.DataFrame({"q": q + at, "vec_id": ids[r], "score": far})
        out.append(_best(found, k))
    return pd.concat(out)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = np.ascontiguousarray(a - b)
    return np.sqrt((gap * gap).sum(axis=1))


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.drop_duplicates().sort_values(["q", "score", "vec_id"], kind="stable")
    return found[found.groupby("q").cumcount() < k]


def fitted(sample: np.ndarray, k: int) -> tuple[int, int]:
    """(digits, probes) with which the sample's own nearest neighbours are
    found to ``TARGET``, for the fewest rows compared. Neighbours are farther
    in a sample than among all rows, so the recall there is at least as good.
    A query that probes every bucket of the first table finds everything."""
    n, width = sample.shape
    size = 2 << max(0, width - 1).bit_length()
    queries = sample[:SAMPLE_QUERIES]
    own = np.arange(len(queries))
    truth = nearest(queries, own, sample, np.arange(n), k)
    q, r = truth["q"].to_numpy(), truth["vec_id"].to_numpy()
    best = None
    for digits in (1, 2):
        probes = min(TABLES * size ** digits, 2048)
        order = probe_order(queries, digits, probes)
        names = buckets(sample[r], digits) + np.arange(TABLES) * size ** digits
        place = np.full(len(q), probes)
        for t in range(TABLES):
            hit = order[q] == names[:, t, None]
            place = np.where(hit.any(1), np.minimum(place, hit.argmax(1)), place)
        need = int(np.quantile(place, TARGET, method="higher")) + 1 if len(place) else 1
        if need > probes:
            continue
        cost = need / size ** digits
        if best is None or cost < best[0]:
            best = cost, digits, need
    return (1, TABLES * size) if best is None else best[1:]


def _sample(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """About ``SAMPLE_VALUES`` numbers' worth of rows, by a hash of the vector,
    so that equal vectors are drawn once. They come to the driver."""
    most = max(SAMPLE_QUERIES, SAMPLE_VALUES // max(width, 1))
    drawn = rows.where(F.pmod(F.xxhash64("vec"), F.lit(max(1, n // most))) == 0).select("vec")
    found = drawn.dropDuplicates().limit(most).toPandas()
    x = _matrix(found["vec"], width)
    x = x[np.lexsort(x.T)]
    return x[np.random.default_rng(SEED).permutation(len(x))]


def _hashed(df: DataFrame, width: int, make) -> DataFrame:
    """A row for each row of ``df`` and each bucket ``at`` that ``make`` names."""
    kind = df.schema["vec"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            if len(batch):
                names = make(_matrix(batch["vec"], width))
                yield pd.DataFrame({"vec_id": batch["vec_id"], "vec": batch["vec"], "at": list(names)})

    return df.mapInPandas(each, f"vec_id long, vec {kind}, at array<long>").select(
        "vec_id", "vec", F.explode("at").alias("at"))


def _searched(queries: DataFrame, rows: DataFrame, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` nearest per query in each of its
    buckets ``at``. A bucket's rows and queries are dealt to blocks of bounded
    size, and a large bucket to more blocks than others, so that every task
    compares one block of queries with one of rows."""
    per_block = max(LEAST_BLOCK, BLOCK_VALUES // max(width, 1))
    sizes = (rows.groupBy("at").agg(F.count(F.lit(1)).alias("n_rows"))
             .join(queries.groupBy("at").agg(F.count(F.lit(1)).alias("n_queries")), "at"))
    sizes = written(sizes, "buckets")
    usual = sizes.agg(F.avg("n_rows")).first()[0] or 1.0
    row_block = int(min(per_block, max(LEAST_BLOCK, 2 * usual)))
    blocks = few_ids(sizes.select("at", F.ceil(F.col("n_rows") / row_block).alias("row_blocks"),
                                 F.ceil(F.col("n_queries") / per_block).alias("query_blocks")))

    def dealt(df, own, other):
        # equal rows and ids are dealt apart too
        place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col(own))
        return (df.join(blocks, "at")
                .withColumn(own[:-1], place)
                .withColumn(other[:-1], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
                .select("at", "row_block", "query_block", "vec_id", "vec"))

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        names = q["vec_id"].to_numpy()
        found = nearest(_matrix(q["vec"], width), names, _matrix(c["vec"], width), c["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": names[found["q"].to_numpy(np.int64)], "vec_id": found["vec_id"],
                             "score": found["score"]})

    key = ["at", "row_block", "query_block"]
    return (dealt(queries, "query_blocks", "row_blocks").groupBy(*key)
            .cogroup(dealt(rows, "row_blocks", "query_blocks").groupBy(*key))
            .applyInPandas(search, "query_id long, vec_id long, score double"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """Each query row's ``k`` nearest other rows found, by Euclidean distance
    in double precision: query_id, rank (from 1), vec_id, score; ties to the
    smaller vec_id.

    Every row is hashed in each table to the signed axis nearest to its
    direction after a pseudo-rotation (one axis or two, as fitted). A query
    probes the buckets whose axes it is nearest to, over all tables together,
    and meets the rows there in blocks of bounded size, where distances are
    exact. How many buckets to probe is fitted to a recall of ``TARGET`` on a
    sample of ``SAMPLE_VALUES`` numbers; every row is indexed. A query that
    found fewer than ``k`` rows is compared with all rows, in blocks.

    Vectors that are null, zero or hold null or non-finite components, and
    null ids, take no part. A shorter vector counts as padded with zeros. A
    row whose id is the query's own is no candidate; of rows that repeat an
    id the query is the least vector, each is a candidate, and those at equal
    distance count once. With ``k`` candidates or fewer all are returned; no
    query gives no rows. Other columns are not read.
    """
    rows = written(usable(vectors, id_col, vec_col), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    queries = written(usable(vectors.where(is_query), id_col, vec_col)
                      .groupBy("vec_id").agg(F.min("vec").alias("vec")), "queries")
    digits, probes = fitted(_sample(rows, n, width), k) if n else (1, 1)
    width = width or 1
    size = (2 << max(0, width - 1).bit_length()) ** digits
    found = written(_ranked(_searched(
        _hashed(queries, width, lambda x: probe_order(x, digits, probes)),
        _hashed(rows, width, lambda x: buckets(x, digits) + np.arange(TABLES) * size), width, k), k), "found")
    short = queries.join(found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("got"))
                         .where(F.col("got") >= k), "vec_id", "left_anti")
    short = written(short.withColumn("at", F.lit(0).cast("long")), "short")
    if short.isEmpty():
        return found
    rest = _ranked(_searched(short, rows.withColumn("at", F.lit(0).cast("long")), width, k), k)
    return found.join(few_ids(short.select(F.col("vec_id").alias("query_id"))), "query_id", "left_anti").unionByName(rest)

