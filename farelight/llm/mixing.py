"""Mixing sources to target weights.

The words of a source, in the order of its documents, are packed into blocks of one length.
The output is a row of shards of slots; each shard draws how many of its slots a source
fills from a multinomial distribution over what the sources still owe, so that the totals
come out as planned. The slots of a source, numbered over all shards, are mapped to block
numbers by a pseudorandom permutation that is another one each time the source has been
gone through. Slots and documents then meet by a join on source and block number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farelight.llm.common import map_rows
from farelight.operators.ranking import running_total
from farelight.session import written

WEIGHTS = (5, 2, 1)
PERCENT = 150
#: A document is taken at most so many times.
MOST = 2
#: Words of a block; less for a source that would have fewer than ``BLOCKS`` blocks.
BLOCK = 128
BLOCKS = 256
#: Slots of a shard at least, and shards at most; beyond, shards grow.
SHARD = 1024
SHARDS = 5000
#: Slots laid out in memory at a time.
SLOTS_AT_ONCE = 1 << 18
SEED = 2024


def targets(sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, percent: int = PERCENT) -> list[float]:
    """Words wanted of each source, in order; what a cap cuts off is shared by weight again."""
    total = sum(sizes) * percent / 100
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    wanted, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        rest = total - sum(wanted[i] for i in range(len(sizes)) if i not in open_)
        unit = rest / sum(weight[i] for i in open_)
        above = {i for i in open_ if unit * weight[i] > MOST * sizes[i]}
        for i in above or open_:
            wanted[i] = float(MOST * sizes[i]) if above else unit * weight[i]
        open_ = open_ - above if above else set()
    return wanted


@dataclass(frozen=True)
class Source:
    """A source in code point order: words, words wanted, place of its first word, blocks."""

    number: int
    name: str | None
    size: int
    target: float
    start: int

    @property
    def block(self) -> int:
        return max(1, min(BLOCK, self.size // BLOCKS))

    @property
    def blocks(self) -> int:
        return math.ceil(self.size / self.block)

    @property
    def slots(self) -> int:
        """Blocks to take: the whole rounds, and of the last round what comes nearest."""
        rounds, rest = divmod(self.target, max(1, self.size))
        return min(MOST * self.blocks, int(rounds) * self.blocks + round(rest / self.block))


def plan(sized: DataFrame) -> list[Source]:
    """One entry per source; only their totals meet on the driver."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, [ord(c) for c in r["source"] or ""]))
    wanted = targets([r["size"] for r in rows])
    found, start = [], 0
    for i, row in enumerate(rows):
        found.append(Source(i, row["source"], row["size"], wanted[i], start))
        start += row["size"]
    return found


def draw(sources: Sequence[Source], seed: int = SEED) -> Iterator[tuple[int, int, int, int]]:
    """``shard, source, first slot, slots`` of every shard and source that it draws."""
    owed = np.array([s.slots for s in sources], np.int64)
    size = max(SHARD, -(-int(owed.sum()) // SHARDS))
    given = np.zeros_like(owed)
    rng = np.random.default_rng(seed)
    shard = 0
    while owed.sum():
        free = min(size, int(owed.sum()))
        while free:
            # What a draw gives beyond a source's debt is drawn again.
            count = np.minimum(rng.multinomial(free, owed / owed.sum()), owed)
            for i in np.flatnonzero(count):
                yield shard, int(i), int(given[i]), int(count[i])
            given += count
            owed -= count
            free -= int(count.sum())
        shard += 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Image of ``index`` under a keyed permutation of ``0 .. size - 1``.

    Four Feistel rounds on the next even number of bits, repeated while outside the range.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % 2**63))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[todo] = x = left << np.uint64(half) | right
        todo = todo[x >= np.uint64(size)]
    return out.astype(np.int64)


def slots(spark: SparkSession, sources: Sequence[Source], seed: int = SEED) -> DataFrame:
    """Every slot: ``shard, number, slot, round, block``; ``number`` is the source's."""
    blocks = {s.number: s.blocks for s in sources}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, begin, upto in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                slot = np.arange(begin, upto)
                turn, at = np.divmod(slot, blocks[number])
                block = np.empty_like(at)
                for t in np.unique(turn):
                    same = turn == t
                    block[same] = permuted(at[same], blocks[number], (seed * 1_000_003 + number) * 16 + int(t))
                columns = [np.full(len(slot), shard), np.full(len(slot), number), slot, turn, block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], names=["shard", "number", "slot", "round", "block"]
                )

    # As Arrow; rows of Python objects would pass through workers of their own on each executor.
    # Spark knows the size of this table and not how far the ranges expand, so what is made of
    # them has a hint where it is joined, or it would be broadcast.
    rows = np.array(list(draw(sources, seed)), np.int64).reshape(-1, 4)
    names = ["shard", "number", "first", "count"]
    drawn = spark.createDataFrame(pa.Table.from_arrays([pa.array(c) for c in rows.T.copy()], names))
    # At most so many slots of one shard and source are laid out at a time.
    end = F.col("first") + F.col("count")
    begin = F.explode(F.sequence("first", end - 1, F.lit(SLOTS_AT_ONCE)))
    ranges = drawn.select("shard", "number", begin.alias("begin"), end.alias("end"))
    ranges = ranges.select("shard", "number", "begin", F.least("end", F.col("begin") + SLOTS_AT_ONCE))
    return ranges.mapInArrow(work, "shard long, number long, slot long, round long, block long")


def place(sized: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Rows with ``number`` of their source and ``at``, the place of their first word in it."""
    spark = sized.sparkSession
    rows = [(s.name, s.number, s.size, s.target, s.start, s.block) for s in sources]
    names = ("name", "number", "source_size", "target", "start", "block_words")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    facts = spark.createDataFrame(pa.Table.from_arrays(columns, names))
    # One row per source; Spark broadcasts it if it is small.
    joined = sized.join(facts, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    order = [F.col("number"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("row")]
    summed = running_total(joined, order, F.col("size"), "upto")
    return summed.withColumn("at", F.col("upto") - F.col("size") - F.col("start")).drop("upto", "start")


def fragments(placed: DataFrame) -> DataFrame:
    """Each document's part of each block: ``number, block, row, doc_id, first, words``."""
    last = F.floor((F.col("at") + F.col("size") - 1) / F.col("block_words")).cast("long")
    begun = F.floor(F.col("at") / F.col("block_words")).cast("long")
    cut = placed.filter("size > 0").select(
        "number", "row", "doc_id", "at", "size", "block_words", F.explode(F.sequence(begun, last)).alias("block")
    )
    first = F.greatest(F.lit(0), F.col("block") * F.col("block_words") - F.col("at"))
    upto = F.least(F.col("size"), (F.col("block") + 1) * F.col("block_words") - F.col("at"))
    return cut.select("number", "block", "row", "doc_id", first.alias("first"), (upto - first).alias("words"))


def sizes(docs: DataFrame, text: str, source: str, doc_id: str, row: Column | None = None) -> DataFrame:
    """``row, doc_id, source, size`` of every row; ``row`` tells rows with equal ids apart."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [0 if t is None else len(t.encode().split()) for t in batch.column(3).to_pylist()]
        columns = [*batch.columns[:3], pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "source", "size"])

    rows = docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.col(text).alias("text"),
    )
    return written(map_rows(rows, "row long, doc_id long, source string, size long", work), "sizes")


def mixture(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, row, size, source_size, target, taken`` of every row.

    A null text has no words and nothing is taken of it; a null source is the last source.
    No document is taken more than twice, because each round of a source takes a block once.
    Rows with equal ids are told apart by their place in the table. The draws depend on the
    seed and the sizes alone, so reruns agree. No rows give none.
    """
    sized = sizes(docs, text, source, doc_id)
    sources = plan(sized)
    placed = written(place(sized, sources), "placed")
    times = slots(docs.sparkSession, sources).groupBy("number", "block").agg(F.count("*").alias("times")).hint("merge")
    taken = (
        fragments(placed)
        .join(times, ["number", "block"])
        .groupBy("row")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    return placed.join(taken.hint("merge"), "row", "left").select(
        "doc_id", "row", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def taken_parts(docs: DataFrame, text: str, source: str, doc_id: str, row: str) -> DataFrame:
    """``row, copy, parts``: word ranges ``first, words`` of each copy of a document, in order."""
    sized = sizes(docs, text, source, doc_id, F.col(row))
    sources = plan(sized)
    placed = written(place(sized, sources), "placed")
    times = slots(docs.sparkSession, sources).groupBy("number", "block").agg(F.count("*").alias("times")).hint("merge")
    copies = fragments(placed).join(times, ["number", "block"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    parts = F.sort_array(F.collect_list(F.struct("first", "words")))
    return copies.groupBy("row", "copy").agg(parts.alias("parts"))


def _cut(text: str, parts: list[dict]) -> str:
    """The words of the given ranges with what stands between them; gaps become line ends."""
    data = text.encode()
    space = np.isin(np.frombuffer(data, np.uint8), np.frombuffer(b" \t\n\v\f\r", np.uint8))
    edges = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if len(parts) == 1 and parts[0]["words"] == len(starts):
        return text
    runs: list[list[int]] = []
    for part in parts:
        if runs and runs[-1][1] == part["first"]:
            runs[-1][1] += part["words"]
        else:
            runs.append([part["first"], part["first"] + part["words"]])
    if runs == [[0, len(starts)]]:
        return text
    return b"\n".join(data[starts[a] : ends[b - 1]] for a, b in runs).decode()


def mix_documents(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", length: str = "n_chars"
) -> DataFrame:
    """The mixture as documents: a row for each copy taken, its text cut to what was drawn.

    Other columns stay as they are; ``length``, if there is such a column, is counted anew.
    """
    # By number, so that no name of the table can clash with those of the parts. Rows are
    # written with their number: a second scan would number them otherwise if executors had
    # come or gone in between, for files are cut by the cores there are.
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    numbered = written(docs.toDF(*names.values()).withColumn("row", F.monotonically_increasing_id()), "numbered")
    marked = numbered.join(taken_parts(numbered, names[text], names[source], names[doc_id], "row").hint("merge"), "row")
    at, what = marked.columns.index(names[text]), marked.columns.index("parts")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [_cut(t, p) for t, p in zip(batch.column(at).to_pylist(), batch.column(what).to_pylist(), strict=True)]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    cut = map_rows(marked, marked.schema, work).select(*names.values()).toDF(*docs.columns)
    return cut.withColumn(length, F.length(text).cast("long")) if length in docs.columns else cut
