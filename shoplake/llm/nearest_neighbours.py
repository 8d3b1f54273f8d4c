"""Approximate nearest neighbours: multiprobe p-stable hashing, exact distances at the end."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import attach
from shoplake.storage import materialize

#: Vectors sampled to set the width of a hash cell; queries that set the number of probes.
FIT_VECTORS, FIT_QUERIES = 2_000, 100

#: Recall that the calibration must reach on its queries, and the most probes of a table: if these are too few, cells are made larger.
TARGET, MOST_PROBES = 0.97, 1 << 14

#: Vectors of an index block and queries of a probe block.
INDEX_BLOCK, PROBE_BLOCK = 1_024, 256

#: Cells are made so fine that a bucket holds about so many vectors.
BUCKET = 512


@dataclass(frozen=True)
class Hashing:
    """Some tables of p-stable functions: cell = floor((a.x + b) / width), a bucket is the tuple of cells."""

    lines: np.ndarray  # table, function, dimension
    shift: np.ndarray  # table, function
    width: np.ndarray  # table, function

    @property
    def exact(self) -> bool:
        """No functions: all vectors are in one bucket."""
        return self.lines.shape[1] == 0

    def fewer(self, functions: int) -> Hashing:
        """The first ``functions`` of each table; none at all need one table only."""
        tables = len(self.lines) if functions else 1
        return Hashing(*(a[:tables, :functions] for a in (self.lines, self.shift, self.width)))

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.lines[table].T + self.shift[table]) / self.width[table]

    @staticmethod
    def key(cells: np.ndarray) -> np.ndarray:
        """One number for each row of cells; a chance collision only adds candidates."""
        h = np.full(len(cells), 0x9E3779B97F4A7C15, dtype=np.uint64)
        for column in cells.astype(np.int64).view(np.uint64).T:
            h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """Keys of the ``count`` buckets most likely to hold a near vector, the own one first.

        For each function the steps to other cells are ordered by their squared
        distance from the query's place; perturbations are tuples of steps, visited
        from the least sum of these on.
        """
        if self.exact:
            return self.key(np.zeros((1, 0)))
        place = self.places(x[None, :], table)[0]
        home = np.floor(place)
        steps, costs = [], []
        for f, h, w in zip(place, home, self.width[table]):
            offset = np.arange(-4, 5)
            gap = np.where(offset < 0, f - (h + offset + 1), np.where(offset > 0, h + offset - f, 0.0)) * w
            order = np.argsort(gap, kind="stable")
            steps.append(offset[order])
            costs.append((gap[order] ** 2).tolist())
        first = (0,) * len(steps)
        heap, seen, found = [(0.0, first)], {first}, []
        while heap and len(found) < count:
            cost, at = heapq.heappop(heap)
            found.append(at)
            for i, c in enumerate(costs):
                if at[i] + 1 < len(c):
                    after = (*at[:i], at[i] + 1, *at[i + 1 :])
                    if after not in seen:
                        seen.add(after)
                        heapq.heappush(heap, (cost - c[at[i]] + c[at[i] + 1], after))
        picked = np.array(found)
        return self.key(home + np.stack([s[picked[:, i]] for i, s in enumerate(steps)], axis=1))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _nearest(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of each query, each id once, at its nearest vector; ties to the smaller id."""
    ordered = found.sort_values(["query_id", "score", "vec_id"], kind="stable").drop_duplicates(["query_id", "vec_id"])
    return ordered.groupby("query_id", sort=False).head(k)


def _pairs(queries: np.ndarray, ids: list, x: np.ndarray, groups: list, k: int) -> pd.DataFrame:
    """Each query's k nearest rows among vectors that each stand for some rows."""
    out = []
    for q, own in zip(queries, ids):
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        least = np.partition(d, k)[k] if len(d) > k + 1 else np.inf
        for i in np.flatnonzero(d <= least):
            out.extend((own, v, d[i]) for v in groups[i] if v != own)
    return _nearest(pd.DataFrame(out, columns=["query_id", "vec_id", "score"]), k)


def fit(vectors: DataFrame, dimension: int, tables: int, seed: int) -> Hashing:
    """Hash functions; a cell is as wide as the middle half of a bounded sample, times 1.5."""
    count = vectors.count()
    functions = int(np.clip(np.ceil(np.log(max(count, 2) / BUCKET) / np.log(2.3)), 2, 16))
    rng = np.random.default_rng(seed)
    lines = rng.standard_normal((tables, functions, dimension))
    sample = vectors.orderBy(F.xxhash64("first")).limit(FIT_VECTORS).select("v").collect()
    x = np.array([r["v"] for r in sample], dtype=np.float64).reshape(-1, dimension)
    width = np.ones((tables, functions))
    for t in range(tables):
        if len(x):
            at = x @ lines[t].T
            spread = np.quantile(at, 0.75, axis=0) - np.quantile(at, 0.25, axis=0)
            width[t] = np.where(spread > 0, 1.5 * spread, np.maximum(np.abs(at).max(axis=0), 1.0))
    return Hashing(lines, rng.uniform(0, 1, (tables, functions)) * width, width)


def calibrate(vectors: DataFrame, queries: DataFrame, hashing: Hashing, k: int) -> tuple[Hashing, int]:
    """Functions, and probes per table with which the sampled queries find enough of their true neighbours.

    The sample is bounded; its true neighbours come from all vectors, in blocks.
    Where `MOST_PROBES` do not reach the target, every table has two functions less
    until they do; without functions each query meets all vectors.
    """
    sample = queries.orderBy(F.xxhash64("query_id")).limit(FIT_QUERIES).collect()
    if not sample:
        return hashing, 1
    ids, x = [r["query_id"] for r in sample], np.array([r["v"] for r in sample], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            if len(batch):
                found = _pairs(x, ids, _matrix(batch.column("v")), batch.column("ids").to_pylist(), k)
                best = found if best is None else _nearest(pd.concat([best, found]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    near = vectors.mapInArrow(run, "query_id long, vec_id long, score double")
    top = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = near.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k).select("query_id", "vec_id")
    held = vectors.select("v", F.explode("ids").alias("vec_id"))
    true = held.join(F.broadcast(near), "vec_id").collect()
    place = {q: i for i, q in enumerate(ids)}
    if not true:
        return hashing, 1
    while not hashing.exact:
        keys = [[hashing.probes(q, t, MOST_PROBES) for t in range(len(hashing.lines))] for q in x]
        ranks = []
        for r in true:
            v = np.array(r["v"], dtype=np.float64)[None, :]
            found = [MOST_PROBES + 1]
            for t, order in enumerate(keys[place[r["query_id"]]]):
                at = np.flatnonzero(order == hashing.key(np.floor(hashing.places(v, t)))[0])
                found.extend(at[:1] + 1)
            ranks.append(min(found))
        probes = int(np.sort(ranks)[int(np.ceil(TARGET * len(ranks))) - 1])
        if probes <= MOST_PROBES:
            return hashing, probes
        hashing = hashing.fewer(max(hashing.lines.shape[1] - 2, 0))
    return hashing, 1


def nearest(rows: DataFrame, is_query: Column, k: int = 10, tables: int = 2, seed: int = 11) -> DataFrame:
    """Each query's k nearest other rows: query_id, rank, vec_id, score.

    ``rows`` has vec_id and embedding; where ``is_query`` holds a row is a query too.
    ``score`` is the Euclidean distance of the stored vectors in double precision,
    nearest first, ties to the smaller vec_id. A vector that is null, all zero, or
    has null or non-finite components, or another length than most, takes no part,
    nor does a row without an id. An id with several vectors counts once, at the one
    nearest to the query; as a query it asks with the least of them. Equal vectors are hashed
    once, with the k + 1 smallest ids that can be answers. A query whose probes find fewer
    than k ids meets all vectors, so it gets k or all others; an empty table gives an empty result.

    A vector is stored once a table; a query visits buckets in the order of their
    estimated success, as many as a bounded calibration found to reach the target
    recall, among larger buckets if the most that a query may visit do not reach it,
    and in the end among all vectors. Buckets of any size are cut into blocks, and the tasks that join blocks
    of probes with blocks of vectors return the nearest only.
    """
    usable = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), is_query.alias("asks"))
    inf = float("inf")
    usable = usable.where("vec_id is not null and v is not null").where(
        ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == inf)) & F.exists("v", lambda c: c != 0)
    )
    lengths = usable.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n"))
    usual = lengths.first()
    dimension = usual["n"] if usual else 1
    usable = usable.where(F.size("v") == dimension)
    least = Window.partitionBy("v").orderBy("vec_id")
    firsts = usable.select("v", "vec_id").withColumn("n", F.dense_rank().over(least)).where(F.col("n") <= k + 1)
    vectors = firsts.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    vectors = materialize(vectors.withColumn("first", F.col("ids")[0]), "vectors")
    queries = usable.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    queries = materialize(queries, "queries")
    hashing, probes = calibrate(vectors, queries, fit(vectors, dimension, tables, seed), k)
    found = _search(vectors, queries, hashing, probes, k)
    if hashing.exact:
        return found
    found = materialize(found, "nearest-of-probes")
    short = queries.join(found.where(F.col("rank") == k), "query_id", "left_anti")
    short = materialize(short, "queries-left")
    if short.isEmpty():
        return found
    rest = _search(vectors, short, hashing.fewer(0), 1, k)
    return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(rest)


def _search(vectors: DataFrame, queries: DataFrame, hashing: Hashing, probes: int, k: int) -> DataFrame:
    """The k nearest of each query among the vectors in the buckets that its probes visit."""
    tables = len(hashing.lines)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            for t in range(tables if len(batch) else 0):
                key = pa.array(hashing.key(np.floor(hashing.places(x, t))))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), t, dtype=np.int32)), key, batch.column("first")], ["table", "key", "first"])

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, x in zip(batch.column("query_id").to_pylist(), _matrix(batch.column("v"))):
                for t in range(tables):
                    key = np.unique(hashing.probes(x, t, probes))
                    columns = [np.full(len(key), t, dtype=np.int32), key, np.full(len(key), query)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["table", "key", "query_id"])

    index = materialize(vectors.select("v", "first").mapInArrow(buckets, "table int, key long, first long"), "index")
    sizes = materialize(index.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    asked = queries.mapInArrow(visited, "table int, key long, query_id long")
    asked = materialize(asked.join(sizes, ["table", "key"], "left_semi"), "probes")
    blocks = _blocks(index, "first", INDEX_BLOCK).join(vectors.select("first", "v", "ids"), "first")
    blocks = blocks.groupBy("table", "key", "block").agg(F.collect_list(F.struct("v", "ids")).alias("held"))
    asking = _blocks(asked, "query_id", PROBE_BLOCK).join(queries, "query_id")
    asking = asking.groupBy("table", "key", "block").agg(F.collect_list(F.struct("query_id", "v")).alias("asking"))
    if hashing.exact:  # every block of queries with every block of vectors, which a join by the one key would do in one task
        met = asking.select("asking").crossJoin(blocks.select("held"))
    else:
        met = asking.drop("block").join(blocks.drop("block"), ["table", "key"]).select("asking", "held")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pd.DataFrame] = []
        waiting = 0
        for batch in batches:
            for i in range(len(batch)):
                asking, held = batch.column("asking")[i].values, batch.column("held")[i].values
                found = _pairs(
                    _matrix(asking.field("v")), asking.field("query_id").to_pylist(),
                    _matrix(held.field("v")), held.field("ids").to_pylist(), k,
                )
                best.append(found)
                waiting += len(found)
                if waiting > 100_000:
                    best = [_nearest(pd.concat(best), k)]
                    waiting = len(best[0])
                    if waiting > 50_000:  # many queries: hand on what there is
                        yield pa.RecordBatch.from_pandas(best.pop(), preserve_index=False)
                        waiting = 0
        if best:
            yield pa.RecordBatch.from_pandas(_nearest(pd.concat(best), k), preserve_index=False)

    found = met.mapInArrow(measure, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """``rows`` with ``block``: the bucket's rows, by hash, in blocks of about ``size``."""
    keyed = rows.withColumn("bucket", F.xxhash64("table", "key"))
    counts = materialize(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-blocks")
    parts = F.ceil(F.col("n") / size).cast("int")
    return attach(keyed, counts, "bucket", "n").withColumn("block", F.pmod(F.xxhash64(name), parts)).drop("bucket", "n")
