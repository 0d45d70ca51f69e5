"""Documents in blocks that numpy works on, and questions that blocks ask each other.

A block holds the texts of some hundred documents, compressed. Blocks are written once as a
table bucketed by block number, so that answers can be joined to them again and again
without shuffling text. A question goes from each block, as packed arrays, to the cells of
a hash; all blocks' rows for a cell meet in one task, whose size is set by the number of
cells; the answers go back to the blocks. What a block asks twice it asks once, so that a
passage that very many documents share counts once per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from farelight.llm.common import bound_batches
from farelight.session import scratch_path, written

#: Bytes of text in a block, unless one document has more.
BLOCK_BYTES = 2 << 20
#: Bytes of text per bucket of the table, about.
BUCKET_BYTES = 12 << 20
#: Ids of documents without one: they come last.
NO_ID = np.iinfo(np.int64).max

_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))


class Block:
    """Texts of a block: ids, lengths in bytes, and the bytes, a line end after each text."""

    def __init__(self, number: int, ids: bytes, lengths: bytes, data: bytes):
        self.number = number
        self.ids = np.frombuffer(ids, np.int64)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(data)
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]]


def write_blocks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The table of blocks ``block, ids, lengths, data, size``, bucketed by ``block``.

    Joins by block do not move it. A null text counts as empty.
    """
    spark = docs.sparkSession
    bound_batches(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            part = np.cumsum(sizes) // BLOCK_BYTES
            for k in np.unique(part):
                at = np.flatnonzero(part == k)
                data = b"".join(texts[i] + b"\n" for i in at)
                packed = [x.tobytes() for x in (ids[at], sizes[at])] + [zstandard.ZstdCompressor(3).compress(data)]
                columns = [pa.array([x], pa.binary()) for x in packed] + [pa.array([len(data)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "lengths", "data", "size"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = rows.mapInArrow(pack, "ids binary, lengths binary, data binary, size long")
    # The size of the texts sets the number of buckets; reading the column alone is cheap.
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = int(min(8192, max(8, size // BUCKET_BYTES + 1)))
    name, path = f"farelight_{uuid.uuid4().hex}", scratch_path(spark, "blocks")
    numbered = packed.withColumn("block", F.monotonically_increasing_id())
    numbered.write.format("parquet").bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def text_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("size")).first()[0] or 0


def number_of_cells(entries: float, each: int) -> int:
    """Cells that hold about ``each`` entries; some at least, so that tasks share the work."""
    return int(max(16, entries // each + 1))


def each_block(df: DataFrame, schema: str, work: Callable[..., Iterator[pa.RecordBatch] | pa.RecordBatch]) -> DataFrame:
    """``mapInArrow`` over blocks; columns after the first four are answers, handed over as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in batch.columns]
                out = work(Block(row[0], *row[1:4]), *row[4:])
                if out is not None and out.num_rows:
                    yield out

    first = ["block", "ids", "lengths", "data"]
    return df.select(*first, *[c for c in df.columns if c not in first and c != "size"]).mapInArrow(run, schema)


def cells_of(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts hashes in cells, and where each cell begins in that order."""
    cell = (hashes % np.uint64(cells)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    return order, np.searchsorted(cell[order], np.arange(cells + 1))


def question(number: int, order: np.ndarray, cuts: np.ndarray, pack: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    """Rows ``cell, block, packed`` for the cells that have something."""
    some = np.flatnonzero(np.diff(cuts))
    packed = [pack(order[cuts[c] : cuts[c + 1]]) for c in some]
    columns = [pa.array(some, pa.int64()), pa.array([number] * len(some), pa.int64()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["cell", "block", "packed"])


QUESTION = "cell long, block long, packed binary"


def answers(asked: DataFrame, meet: Callable[[list[int], list[bytes]], list[bytes]], name: str) -> DataFrame:
    """One row per block, ``block, <name>``: the answers of its cells, written.

    ``meet`` gets the blocks and packed rows of one cell and gives one answer to each.
    """

    def run(cell: pa.Table) -> pa.Table:
        blocks = cell.column("block").to_pylist()
        found = meet(blocks, cell.column("packed").to_pylist())
        columns = {"block": pa.array(blocks, pa.int64()), "cell": cell.column("cell"), "answer": pa.array(found, pa.binary())}
        return pa.table(columns)

    given = asked.groupBy("cell").applyInArrow(run, "block long, cell long, answer binary")
    return written(given.groupBy("block").agg(F.collect_list(F.struct("cell", "answer")).alias(name)), name)


def bits_of(found: list[dict] | None, order: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Answers that are bits, put back in the order of the hashes that were asked."""
    out = np.zeros(len(order), bool)
    for row in found or []:
        at = order[cuts[row["cell"]] : cuts[row["cell"] + 1]]
        out[at] = np.unpackbits(np.frombuffer(row["answer"], np.uint8), count=len(at)).astype(bool)
    return out


def ask_hashes(number: int, unique: np.ndarray, which: np.ndarray, cells: int) -> pa.RecordBatch:
    """Question whether the distinct hashes of a block occur anywhere else, or twice in it.

    ``which`` has the index into ``unique`` of every place.
    """
    many = np.bincount(which, minlength=len(unique)) > 1
    order, cuts = cells_of(unique, cells)
    return question(number, order, cuts, lambda at: unique[at].tobytes() + np.packbits(many[at]).tobytes())


def meet_hashes(_: list[int], packed: list[bytes]) -> list[bytes]:
    """Which hashes occur more than once, over all blocks."""
    counts = [len(p) * 8 // 65 for p in packed]
    rows = list(zip(packed, counts, strict=True))
    hashes = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in rows])
    out = np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8, offset=8 * n), count=n) for p, n in rows]).astype(bool)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return split_bits(out, counts)


def split_bits(bits: np.ndarray, counts: list[int]) -> list[bytes]:
    ends = np.cumsum(counts)
    return [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, counts, strict=True)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(stream: int, size: int, inverse: bool) -> np.ndarray:
    """Powers of a stream's base or of its inverse modulo 2^64; the longest so far is kept."""
    known = _POWERS.get((stream, inverse))
    if known is None or len(known) < size:
        base = pow(_BASES[stream], -1, 2**64) if inverse else _BASES[stream]
        known = np.full(1 << max(16, int(size).bit_length()), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _POWERS[stream, inverse] = known
    return known


class Rolling:
    """Hashes of any substrings of a sequence of 64-bit values, from running sums."""

    def __init__(self, values: np.ndarray, stream: int = 0):
        self.stream = stream
        self.back = _powers(stream, len(values) + 1, True)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(stream, len(values) + 1, False)[: len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


@lru_cache(maxsize=2)
def byte_values(stream: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[1 - stream]))


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in some bytes."""
    edges = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, stream: int = 0) -> np.ndarray:
    """A hash of each word, a megabyte of text at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20))))
        low = int(starts[at])
        roll = Rolling(byte_values(stream)[data[low : int(ends[upto - 1])]], stream)
        out[at:upto] = roll(starts[at:upto] - low, ends[at:upto] - low)
        at = upto
    return out
