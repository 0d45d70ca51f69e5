"""Exact top-k by inner product, term at a time.

Vectors become integers and are packed in blocks. A block of candidates is inverted: each
dimension has a posting list of the rows where it is not zero and their weights. A block of
queries meets every block of candidates; the terms of the queries, one after the other,
scatter their weighted postings into a dense array of scores, one row per query. A task
keeps the best k of each query over the blocks that it has seen, and the tasks' are merged.
Nothing is skipped, so the result is exact. Blocks meet as pairs of partitions that each
task reads for itself: no copy of a query is shuffled, and none of them goes by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from farelight.llm.common import bound_batches
from farelight.session import PARTITIONS, written

#: Rows of a block of candidates and of a block of queries.
CANDIDATES = 4096
QUERIES = 256
#: Most blocks of queries that a task holds, with the best rows of each query so far, and their bytes.
HELD = 512
HELD_BYTES = 32 << 20
#: Queries whose scores are summed up together.
TOGETHER = 16
#: A list with more than one in so many of the rows is added as a whole, zeros included.
DENSE = 16
_SAFE = float(2**62)


def integers(vector: Column, factor: int) -> Column:
    """``floor(factor * x)`` of each component, ``x`` as double; null unless all are finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(doubles, lambda x: F.floor(x * F.lit(float(factor))).cast("long")))


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Rows ``vec_id, v`` as blocks ``block, ids, lengths, values``, written once.

    ``block`` tells blocks apart. Values are as wide as the largest of a block needs.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= size:
                some, whole = pa.Table.from_batches(held), count - count % size
                for at in range(0, whole, size):
                    yield packed(some.slice(at, size))
                held, count = some.slice(whole).to_batches(), count - whole
        if count:
            yield packed(pa.Table.from_batches(held))

    def packed(some: pa.Table) -> pa.RecordBatch:
        ids, vectors = (c.combine_chunks() for c in some.columns)
        lengths = pc.list_value_length(vectors).to_numpy().astype(np.int32)
        parts = ids.to_numpy().astype(np.int64), lengths, narrow(pc.list_flatten(vectors).to_numpy())
        columns = [pa.array([x.tobytes()], pa.binary()) for x in parts]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "lengths", "values"])

    bound_batches(rows.sparkSession)
    found = rows.mapInArrow(blocks, "ids binary, lengths binary, values binary")
    return written(found.withColumn("block", F.monotonically_increasing_id()), "packed")


def narrow(values: np.ndarray) -> np.ndarray:
    """The values in the fewest bytes that hold all of them."""
    low, high = values.min(initial=0), values.max(initial=0)
    kinds = (np.int8, np.int16, np.int32, np.int64)
    return values.astype(next(x for x in kinds if np.iinfo(x).min <= low and high <= np.iinfo(x).max))


def _unpack(ids: bytes, lengths: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a matrix that is as wide as the longest vector, padded with zeros."""
    ids, lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int32)
    width, count = int(lengths.max(initial=0)), int(lengths.sum(dtype=np.int64))
    kind = f"i{len(values) // max(1, count) or 1}"
    matrix = np.zeros((len(ids), width), kind)
    matrix[np.arange(width) < lengths[:, None]] = np.frombuffer(values, kind)
    return ids, matrix


class Postings:
    """Candidates inverted: for each term the rows where it is not zero, and their weights.

    A list with a good part of the rows has no row numbers and a weight for each row.
    """

    def __init__(self, candidates: np.ndarray):
        self.rows, self.width = candidates.shape
        self.largest = _largest(candidates)
        self._by_term = np.ascontiguousarray(candidates.T)
        self._lists: dict[type, list[tuple[np.ndarray | None, np.ndarray]]] = {}

    def lists(self, kind: type) -> list[tuple[np.ndarray | None, np.ndarray]]:
        if kind not in self._lists:
            self._lists[kind] = found = []
            for weights in self._by_term:
                rows = np.flatnonzero(weights)
                whole = len(rows) * DENSE > self.rows
                found.append((None, weights.astype(kind)) if whole else (rows, weights[rows].astype(kind)))
        return self._lists[kind]


def _largest(matrix: np.ndarray) -> float:
    return np.abs(matrix.astype(float)).max(initial=0)


def accumulate(queries: np.ndarray, candidates: Postings) -> np.ndarray:
    """Scores of all queries against all candidates, one term after the other."""
    width = min(queries.shape[1], candidates.width)
    bound = _largest(queries) * candidates.largest * max(1, width)
    if bound >= _SAFE:
        raise OverflowError("inner products do not fit a long")
    kind = np.int32 if bound < 2**31 else np.int64
    lists, queries = candidates.lists(kind), queries[:, :width].astype(kind)
    scores = np.zeros((len(queries), candidates.rows), kind)
    part = np.empty((TOGETHER, candidates.rows), kind)
    for at in range(0, len(queries), TOGETHER):
        asking, sums = queries[at : at + TOGETHER], scores[at : at + TOGETHER]
        for term in np.flatnonzero(asking.any(axis=0)):
            rows, weights = lists[term]
            if rows is None:
                sums += np.multiply(asking[:, term, None], weights, out=part[: len(asking)])
            elif len(rows):
                for q in np.flatnonzero(asking[:, term]):
                    sums[q, rows] += asking[q, term] * weights
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores and their ids, smaller id first on a tie, without the query's own row."""
    others = np.flatnonzero(ids != own)
    scores, ids = scores[others], ids[others]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)
        level = level[np.argsort(ids[level], kind="stable")[: k - len(above)]]
        chosen = np.concatenate([above, level])
        scores, ids = scores[chosen], ids[chosen]
    order = np.lexsort((ids, -scores))
    return scores[order], ids[order]


class Found:
    """The best rows so far of each query of a block."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.count = np.zeros(len(queries), np.int64)
        self.scores, self.ids = np.zeros((2, len(queries), k), np.int64)
        #: A row has to reach this score; any does until there are k.
        self.least = np.full(len(queries), np.iinfo(np.int64).min)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i in np.flatnonzero(scores.max(axis=1, initial=np.iinfo(scores.dtype).min) >= self.least):
            near, n = np.flatnonzero(scores[i] >= self.least[i]), self.count[i]
            all_scores = np.concatenate([self.scores[i, :n], scores[i, near]])
            top = best(all_scores, np.concatenate([self.ids[i, :n], ids[near]]), self.k, self.queries[i])
            self.count[i] = n = len(top[0])
            self.scores[i, :n], self.ids[i, :n] = top
            if n == self.k:
                self.least[i] = self.scores[i, -1]

    def rows(self, block: int) -> pa.RecordBatch:
        at, place = np.nonzero(np.arange(self.k) < self.count[:, None])
        columns = [np.full(len(at), block), at, self.queries[at], self.scores[at, place], self.ids[at, place]]
        names = ["q_block", "q_row", "query_id", "score", "vec_id"]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)


def dealt(spark: SparkSession, candidates: int, queries: int, size: int) -> tuple[int, int]:
    """Partitions of so many blocks of queries, of ``size`` bytes, and of candidates.

    Each partition of candidates gives k rows for each query, so they are no more than give
    all cores work; with more queries, the partitions of queries grow in number instead.
    """
    tasks = max(int(spark.conf.get(PARTITIONS)), 4 * spark.sparkContext.defaultParallelism)
    q_parts = max(1, -(-queries // HELD), min(queries, max(-(-size // HELD_BYTES), -(-tasks // candidates))))
    return q_parts, max(1, min(candidates, -(-tasks // q_parts)))


def _none(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def search(
    vectors: DataFrame,
    asked: Column,
    k: int = 5,
    factor: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each row that meets ``asked``.

    ``asked`` is a condition on ``vec_id``. Vectors that are null or hold a null or
    non-finite component take no part, nor do rows without an id. Vectors may differ in
    length; missing components count as zero, and an empty vector scores zero. All rows
    with the query's own id are left out of its result. A repeated query row gives its
    rows once for each copy. Scores beyond a long fail the query. No rows give none.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), integers(F.col(vector), factor).alias("v")
    ).filter("vec_id is not null and v is not null")
    candidates = pack(rows, CANDIDATES)
    queries = pack(rows.filter(asked), QUERIES).select(
        F.col("ids").alias("q_ids"), F.col("lengths").alias("q_lengths"), F.col("values").alias("q_values"), F.col("block").alias("q_block")
    )
    count = candidates.count()
    if not count:
        return _none(vectors)
    size = F.sum(F.octet_length("q_ids") + F.octet_length("q_lengths") + F.octet_length("q_values"))
    asking, held = queries.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    # Every partition of candidates meets every partition of queries, each pair in a task of its own.
    # By the hint neither is broadcast, whatever its size, and none is copied to be joined by a key.
    q_parts, parts = dealt(vectors.sparkSession, count, asking, held)
    met = candidates.repartition(parts).hint("shuffle_replicate_nl").crossJoin(queries.repartition(q_parts))
    columns = ("block", "ids", "lengths", "values", "q_block", "q_ids", "q_lengths", "q_values")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Found] = {}
        last = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, *answering, q_block = (batch.column(n) for n in range(5))
                if last != block[i].as_py():
                    last = block[i].as_py()
                    ids, matrix = _unpack(*(c[i].as_py() for c in answering))
                    postings = Postings(matrix)
                q_ids, terms = _unpack(*(batch.column(n)[i].as_py() for n in range(5, 8)))
                number = q_block[i].as_py()
                if number not in found:
                    found[number] = Found(q_ids, k)
                found[number].add(accumulate(terms, postings), ids)
        for number, top in found.items():
            yield top.rows(number)

    scored = met.select(*columns).mapInArrow(score, "q_block long, q_row long, query_id long, score long, vec_id long")
    order = Window.partitionBy("q_block", "q_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
