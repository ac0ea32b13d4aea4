"""Nearest neighbours by inner product: multiprobe hashing with p-stable projections.

Vectors are scaled by the largest norm and given one more coordinate that brings all to length
one; then the largest inner product is the smallest distance. Each table projects a vector on
Gaussian directions, shifted and cut into cells; the cells together are its bucket. A query
visits its own bucket and those beside it in the order of the estimated chance that a neighbour
lies there, which follows from how near the query's projection is to each cell's edges, until
these chances reach a given sum. The candidates of all tables are ranked by exact products.

How far neighbours are and how many buckets a query has to visit depends on the data. A bounded
sample of queries is compared with all vectors first: the width of the cells follows from the
distance of their true neighbours, and the sum of chances is the least that would have found
`TARGET` of these. Where no sum would, because neighbours lie beyond the adjacent cells, every
query is compared with all vectors.

Buckets are dealt out to slabs by hash. A slab of too many rows, as a large bucket makes one,
is cut into parts by a hash of the id, and the queries that visit it into blocks; a task takes
one part of the vectors and one block of the queries. A query that found fewer than it asked for
is compared with all vectors, dealt out in the same way.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerstats.llm.common import ship, written

TABLES = 3
#: Width of a cell, in distances of a neighbour.
CELL = 1.75
#: Share of the sample's neighbours that the buckets visited have to hold.
TARGET = 0.96
#: Queries, by a hash of their id, whose neighbours are looked up among all vectors.
SAMPLE = 128
#: Vectors of a slab and their bytes, about; one of more than twice as many is cut.
SLAB_ROWS, SLAB_BYTES = 1 << 16, 1 << 25
#: Projections of a table: the binary logarithm of the rows by 2.5, within these.
LEAST_CELLS, MOST_CELLS = 4, 9
#: Queries of a block, about.
BLOCK_ROWS = 1 << 12
#: Products of so many queries with a slab are held at a time.
QUERIES_AT_ONCE = 64


class Tables:
    """The directions and shifts of all tables, drawn from a seed, for neighbours at a distance
    of about `near` once all vectors have length one."""

    def __init__(self, dimensions: int, cells: int, norm: float, near: float, seed: int = 7):
        draw = np.random.default_rng([seed, dimensions, cells])
        self.cells, self.norm, self.near, self.width = cells, norm, near, CELL * near
        self.directions = draw.normal(size=(TABLES, dimensions + 1, cells))
        self.shifts = draw.uniform(0, self.width, size=(TABLES, cells))
        steps = np.array(list(product((-1, 0, 1), repeat=cells)), np.int64)
        self.steps = steps
        self.codes = draw.integers(1, 2**62, size=(TABLES, cells)) * 2 + 1
        # Which of the 3 x cells single steps each combination takes.
        self.taken = (steps + 1) + 3 * np.arange(cells)

    def _cells(self, points: np.ndarray, table: int) -> np.ndarray:
        return (points @ self.directions[table] + self.shifts[table]) / self.width

    def _codes(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.codes[table]).sum(axis=-1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        points = np.column_stack([scaled, rest])
        found = [self._codes(np.floor(self._cells(points, t)), t) for t in range(TABLES)]
        return np.stack(found, axis=1)

    def probes(self, query: np.ndarray, mass: float) -> list[np.ndarray]:
        """The buckets that a query visits in each table, the likeliest first."""
        return [
            codes[: int(np.searchsorted(np.cumsum(estimate), mass)) + 1]
            for codes, estimate in self.ordered(query)
        ]

    def mass_to_find(self, query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The sum of chances from which on a query's visits hold each of the vectors in some
        table; infinite for those that no visit holds."""
        buckets = self.buckets(vectors)
        least = np.full(len(vectors), np.inf)
        for t, (codes, estimate) in enumerate(self.ordered(query)):
            reached = np.concatenate([[0.0], np.cumsum(estimate)[:-1]])
            by_code = np.argsort(codes, kind="stable")
            at = np.minimum(np.searchsorted(codes[by_code], buckets[:, t]), len(codes) - 1)
            held = codes[by_code][at] == buckets[:, t]
            least = np.where(held, np.minimum(least, reached[by_code][at]), least)
        return least

    def ordered(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each table: the buckets about the query's own by falling estimated chance."""
        point = np.append(query / np.linalg.norm(query), 0.0)[None]
        visits = []
        for t in range(TABLES):
            at = self._cells(point, t)[0]
            own = np.floor(at)
            # Chance that a neighbour's projection falls a cell below, in the same, or above.
            edges = (own[:, None] + np.arange(-1, 3) - at[:, None]) * CELL
            below = _normal(edges)
            chances = np.log(np.maximum(np.diff(below, axis=1), 1e-30)).ravel()
            estimate = np.exp(chances[self.taken].sum(axis=1))
            order = np.argsort(-estimate, kind="stable")
            visits.append((self._codes(own + self.steps[order], t), estimate[order]))
        return visits


_ERF = np.vectorize(math.erf, otypes=[float])


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _ERF(x / math.sqrt(2)))


def usable(vector: Column) -> Column:
    """Whether a vector has finite components only, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), np.float64).reshape(len(series), -1)


def _best(frame_ids, frame_vectors, buckets, query_ids, queries, visited, k):
    """The k largest products of each query with the vectors in buckets that it visits, exact
    ties by smaller id. Products are first found for some queries at a time, then again one by
    one, each in the same order of terms, so that equal vectors have equal scores."""
    codes, place = np.unique(buckets, return_inverse=True)
    out = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        block = queries[at : at + QUERIES_AT_ONCE]
        wanted = np.zeros((len(block), len(codes)), bool)
        for i, own in enumerate(visited[at : at + QUERIES_AT_ONCE]):
            found = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            wanted[i, found[codes[found] == own]] = True
        rough = np.where(wanted[:, place], block @ frame_vectors.T, -np.inf)
        for i, row in enumerate(rough):
            query_id = query_ids[at + i]
            row[frame_ids == query_id] = -np.inf
            n = int(np.isfinite(row).sum())
            if not n:
                continue
            floor = np.partition(row, -k)[-k] if n > k else row[np.isfinite(row)].min()
            near = np.flatnonzero(row >= floor - 1e-9 * max(1.0, abs(floor)))
            scores = (frame_vectors[near] * block[i]).sum(axis=1)
            order = np.lexsort((frame_ids[near], -scores))[:k]
            out.append((np.full(len(order), query_id), frame_ids[near][order], scores[order]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


FOUND = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _compared(
    held: DataFrame, asked: DataFrame, k: int, slab_rows: int, block_rows: int
) -> DataFrame:
    """The k best of (vec_id, embedding, table, slab, bucket) for each (query_id, embedding,
    table, slab, codes), of the vectors in the buckets that `codes` lists.

    Slabs of many vectors or queries are cut, and each part meets each block. A vector found
    in several tables counts once.
    """
    key = ["table", "slab"]
    # One row a slab, of which there are few.
    sizes = (
        held.select(*key, F.lit(1).alias("own"), F.lit(0).alias("query"))
        .unionByName(asked.select(*key, F.lit(0).alias("own"), F.lit(1).alias("query")))
        .groupBy(*key)
        .agg(
            F.ceil(F.sum("own") / F.lit(2 * slab_rows)).cast("int").alias("parts"),
            F.ceil(F.sum("query") / F.lit(2 * block_rows)).cast("int").alias("blocks"),
        )
    )
    cuts = written(sizes.filter("parts > 1 OR blocks > 1"), "cuts")

    def dealt(rows: DataFrame, row_id: str, own: str, own_n: str, other: str, other_n: str):
        """Each row in a share of its own by hash, once for every share of the other side."""
        n, others = (F.greatest(F.coalesce(x, F.lit(1)), F.lit(1)) for x in (own_n, other_n))
        return (
            rows.join(cuts, key, "left")
            .withColumn(own, F.pmod(F.xxhash64(row_id), n).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))
            .drop("parts", "blocks")
            .groupBy(*key, "part", "block")
        )

    def search(of, own: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(questions):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        own = own.drop_duplicates("vec_id").sort_values("vec_id")
        questions = questions.drop_duplicates("query_id")
        rows = _best(
            own["vec_id"].to_numpy(),
            _matrix(own["embedding"]),
            own["bucket"].to_numpy(),
            questions["query_id"].to_numpy(),
            _matrix(questions["embedding"]),
            questions["codes"].tolist(),
            k,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), rows)))

    found = (
        dealt(held, "vec_id", "part", "parts", "block", "blocks")
        .cogroup(dealt(asked, "query_id", "block", "blocks", "part", "parts"))
        .applyInPandas(search, FOUND)
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SAMPLED = T.StructType(
    [
        T.StructField("query", T.IntegerType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ]
)


def true_neighbours(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int):
    """The k nearest vectors of some queries, by comparison with all: a list of matrices.

    A batch of vectors gives k a query at most, and a query's from all batches are ranked.
    """

    def best(frames):
        for frame in frames:
            if not len(frame):
                continue
            matrix, own = _matrix(frame["embedding"]), frame["vec_id"].to_numpy()
            products = queries @ matrix.T
            products[ids[:, None] == own[None]] = -np.inf
            for i, row in enumerate(products):
                top = np.argpartition(-row, min(k, len(row)) - 1)[:k]
                top = top[np.isfinite(row[top])]
                yield pd.DataFrame(
                    {
                        "query": np.full(len(top), i, np.int32),
                        "vec_id": own[top],
                        "score": row[top],
                        "embedding": list(matrix[top]),
                    }
                )

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = vectors.mapInPandas(best, SAMPLED).withColumn("rank", F.row_number().over(order))
    found = ranked.filter(F.col("rank") <= k).select("query", "embedding").collect()
    return [
        np.array([r["embedding"] for r in found if r["query"] == i]).reshape(-1, queries.shape[1])
        for i in range(len(queries))
    ]


def fitted(
    vectors: DataFrame, queries: DataFrame, k: int, dimensions: int, cells: int, norm: float
) -> tuple[Tables, float]:
    """Tables and the sum of chances for these data, from the true neighbours of `SAMPLE`
    queries; an infinite sum where visits to adjacent cells would find too few."""
    rows = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    asked = np.array([r["embedding"] for r in rows]).reshape(len(rows), -1)
    known = true_neighbours(vectors, ids, asked, k) if len(rows) else []
    # The distance of the furthest of the k, once the query has length one and the vectors
    # at most.
    furthest = [
        math.sqrt(max(0.0, 2 - 2 * (own @ q).min() / (norm * np.linalg.norm(q))))
        for q, own in zip(asked, known)
        if len(own)
    ]
    near = max(1e-3, float(np.median(furthest))) if furthest else 1.0
    tables = Tables(dimensions, cells, norm, near)
    needed = [tables.mass_to_find(q, own) for q, own in zip(asked, known) if len(own)]
    if not needed:
        return tables, 1.0
    mass = float(np.quantile(np.concatenate(needed), TARGET, method="higher"))
    return tables, mass + 1e-9


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    mass: float | None = None,
    slab_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest of (vec_id, embedding) found for each query, itself left out.

    Nearness is the inner product of the original vectors in double precision; ties go to the
    smaller vec_id. A query has k rows, fewer only where the table has fewer other vectors: where
    the buckets that it visits hold too few, it is compared with all. `mass` is the sum of
    chances that a query visits, by default fitted to the data. Null or zero vectors, those with
    a null or non-finite component, and rows without vec_id take no part. All vectors must have
    one length; a table that mixes lengths fails. Of rows that repeat a vec_id the one with the
    least vector, component by component, counts. An empty table gives no rows. Further columns
    are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)

    def prepared(rows: DataFrame) -> DataFrame:
        rows = rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    def unique(rows: DataFrame) -> DataFrame:
        """A row for each vec_id; moved only where some repeat."""
        n, ids = rows.agg(F.count("*"), F.count_distinct("vec_id")).first()
        if n == ids:
            return rows
        return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    vectors, queries = unique(prepared(vectors)), unique(prepared(queries))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x))
    known = vectors.agg(
        F.count("*").alias("n"),
        F.max(norm).alias("norm"),
        F.min(F.size("embedding")).alias("least"),
        F.max(F.size("embedding")).alias("most"),
    ).first()
    if not known["n"]:
        return spark.createDataFrame([], RANKED)
    if known["least"] != known["most"]:
        raise ValueError(f"vectors of {known['least']} and of {known['most']} components")
    cells = min(MOST_CELLS, max(LEAST_CELLS, round(math.log2(known["n"]) / 2.5)))
    tables, found_mass = fitted(vectors, queries, k, known["most"], cells, known["norm"])
    mass = found_mass if mass is None else mass
    slab_rows = slab_rows or max(1, min(SLAB_ROWS, SLAB_BYTES // (8 * known["most"])))
    slabs = max(1, math.ceil(known["n"] / slab_rows))

    def slab_of(buckets: np.ndarray) -> np.ndarray:
        return (buckets.view(np.uint64) >> np.uint64(24)) % np.uint64(slabs)

    def index(frames):
        for frame in frames:
            if len(frame):
                found = tables.buckets(_matrix(frame["embedding"]))
                for t in range(TABLES):
                    bucket = np.ascontiguousarray(found[:, t])
                    slab = slab_of(bucket).astype(np.int64)
                    yield frame.assign(table=t, bucket=bucket, slab=slab)

    def visits(frames):
        for frame in frames:
            rows = []
            for i, vector in enumerate(_matrix(frame["embedding"])):
                for t, codes in enumerate(tables.probes(vector, mass)):
                    slab = slab_of(codes)
                    rows += [(i, t, int(x), codes[slab == x]) for x in np.unique(slab)]
            if rows:
                place, table, slab, codes = zip(*rows)
                found = frame.iloc[list(place)]
                yield found.assign(table=table, slab=slab, codes=codes)

    key = "table int, slab long"
    held = vectors.mapInPandas(
        index, f"vec_id long, embedding array<double>, {key}, bucket long"
    )
    asked = queries.mapInPandas(
        visits, f"vec_id long, embedding array<double>, {key}, codes array<long>"
    ).withColumnRenamed("vec_id", "query_id")
    if math.isfinite(mass):
        found = written(_compared(held, asked, k, slab_rows, block_rows), "nearest")
    else:
        found = spark.createDataFrame([], RANKED)
    most = min(k, known["n"] - 1)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= most)
    short = queries.withColumnRenamed("vec_id", "query_id").join(full, "query_id", "left_anti")
    short = written(short, "short")
    if short.isEmpty():
        return found
    # All vectors in slabs by id, each one bucket, and every query visits all of them.
    table = F.lit(0).alias("table")
    slab = F.pmod(F.xxhash64("vec_id"), F.lit(slabs))
    all_held = vectors.select("*", table, slab.alias("slab"), F.lit(0).cast("long").alias("bucket"))
    all_asked = short.select(
        "*",
        table,
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slabs - 1).cast("long"))).alias("slab"),
        F.array(F.lit(0).cast("long")).alias("codes"),
    )
    rest = _compared(all_held, all_asked, k, slab_rows, block_rows)
    return found.join(short, "query_id", "left_anti").unionByName(rest)


RANKED = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
