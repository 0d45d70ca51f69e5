"""SimHash near-duplicates, found with the pigeonring principle.

A fingerprint has 64 bits. Cut into five segments on a ring, two fingerprints that differ
in at most four bits have a segment from which every chain of ``l`` consecutive segments
differs in at most ``l * 4 / 5`` bits: the first is equal, two differ in at most one bit,
three in two, and so on. So fingerprints are grouped by the value of one segment (five rows
each), probed by the next one with at most one bit changed, and the growing chain budgets
prune the pairs before the full check. No link within the distance is missed.

Documents with the same fingerprint are one node. Links found in a task are reduced there
to a spanning forest, so a cloud of near copies sends about as many links as it has
members, never all its pairs. Components are then found by joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from farelight.llm.common import map_rows
from farelight.llm.components import components
from farelight.llm.rows import BLOCK, PLACE, keep_rows, write_rows
from farelight.session import written

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Bits of the segments of the ring; one more than DISTANCE.
WIDTHS = (13, 13, 13, 13, 12)
#: Distinct fingerprints that a group of one segment has about, and pairs checked at a time.
GROUP = 50_000
PAIRS_AT_ONCE = 2_000_000
_CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    """64-bit SimHash; no words give zero. A bit is set if it is in over half the hashes."""
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    last = max(1, len(words) - SHINGLE + 1)
    begin, end = starts[:last].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, last, _CHUNK):
        pairs = zip(begin[at : at + _CHUNK], end[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carried: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, fp`` (a signed long) of each row and columns carried along; a null text counts as empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        columns = [batch.column(0), pa.array(found), *batch.columns[2:]]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *carried])

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *carried)
    more = "".join(f", {c} {kind}" for c, kind in docs.select(*carried).dtypes) if carried else ""
    return map_rows(ids, f"doc_id long, fp long{more}", work)


def _rotated(fps: np.ndarray, first: int) -> np.ndarray:
    """The ring turned so that segment ``first`` has the highest bits."""
    shift = sum(WIDTHS[:first])
    if not shift:
        return fps
    return (fps << np.uint64(shift)) | (fps >> np.uint64(64 - shift))


def ring_links(fps: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of distinct fingerprints with all chains from segment ``first`` within budget.

    The last chain is the whole ring, so the pairs are exactly checked. Each pair once per
    ``first``; at most about ``PAIRS_AT_ONCE`` candidates are held.
    """
    order = WIDTHS[first:] + WIDTHS[:first]
    bits = np.cumsum(order)
    turned = _rotated(fps, first)
    by = np.argsort(turned)
    turned, fps = turned[by], fps[by]
    keys = turned >> np.uint64(64 - int(bits[1]))
    for flip in [0, *(1 << b for b in range(order[1]))]:
        if flip:
            lower = np.flatnonzero(keys & np.uint64(flip) == 0)
            wanted = keys[lower] | np.uint64(flip)
            low = np.searchsorted(keys, wanted)
        else:
            lower = np.arange(len(keys))
            wanted = keys
            low = lower + 1
        count = np.searchsorted(keys, wanted, side="right") - low
        some = count > 0
        lower, low, count = lower[some], low[some], count[some]
        at = 0
        while at < len(lower):
            upto = at + max(1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS_AT_ONCE, side="right")))
            n = count[at:upto]
            a = np.repeat(lower[at:upto], n)
            b = np.repeat(low[at:upto] - np.cumsum(n) + n, n) + np.arange(len(a))
            for length in range(3, len(order) + 1):
                differ = np.bitwise_count((turned[a] ^ turned[b]) >> np.uint64(64 - int(bits[length - 1])))
                within = differ <= length * DISTANCE // len(order)
                a, b = a[within], b[within]
            if len(a):
                yield fps[a], fps[b]
            at = upto


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star from the smallest node of each component of the given links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
        if np.array_equal(before, root):
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def links(fps: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect whatever is connected by at most ``DISTANCE`` bits.

    ``fps`` has distinct values ``fp``. Packed in arrays, a fingerprint goes to the groups
    of its five segments; a group holds the arrays of one or more values of one segment,
    8 bytes a fingerprint: at ten billion distinct fingerprints, some ten megabytes.
    """
    groups = min(1 << min(WIDTHS), max(8, fps.count() // GROUP))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for first in range(len(WIDTHS)):
                place = ((_rotated(values, first) >> np.uint64(64 - WIDTHS[first])) % np.uint64(groups)).astype(np.int64)
                by = np.argsort(place, kind="stable")
                cuts = np.searchsorted(place[by], np.arange(groups + 1))
                some = np.flatnonzero(np.diff(cuts))
                packed = [values[by[cuts[g] : cuts[g + 1]]].tobytes() for g in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some + first * groups, pa.int64()), pa.array(packed, pa.binary())], names=["cell", "packed"]
                )

    def meet(cell: pa.Table) -> pa.Table:
        first = cell.column("cell")[0].as_py() // groups
        fps = np.concatenate([np.frombuffer(x, np.uint64) for x in cell.column("packed").to_pylist()])
        a = b = np.empty(0, np.uint64)
        for more_a, more_b in ring_links(fps, first):
            a, b = np.concatenate([a, more_a]), np.concatenate([b, more_b])
            if len(a) > 2 * len(fps):
                a, b = spanning(a, b)
        if len(a):
            a, b = spanning(a, b)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    packed = fps.select("fp").mapInArrow(cells, "cell long, packed binary")
    return packed.groupBy("cell").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, fp, component, component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links of at most
    four bits, itself included; ``component`` is a fingerprint that names the component.
    A null or empty text has fingerprint zero and is linked like any other. A null
    ``doc_id`` keeps its row and takes part, but never names a component unless nothing
    else can: then ``component_id`` is null. Repeated rows stay. Other columns are not
    looked at, whatever their names.
    """
    marked = written(fingerprints(docs, text, doc_id), "fingerprints")
    return marked.join(_components_of(marked), "fp").select("doc_id", "fp", "component", "component_id")


def _components_of(marked: DataFrame) -> DataFrame:
    """``fp, component, component_id`` of each distinct fingerprint, written."""
    per_fp = written(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    found = written(components(links(per_fp)), "components")
    named = per_fp.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    return written(named.select("fp", "component").join(least, "component"), "named")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does.

    It is one with the smallest ``doc_id`` of the component. Rows of the same id are judged
    by their texts: unrelated ones stay, each in its own component. Rows without an id
    cannot be named, so all of them stay. No rows give no rows.

    The rows are written once with their place, and the choice comes back by place, so that
    texts are never shuffled.
    """
    rows = write_rows(docs, text)
    marked = written(fingerprints(rows, text, doc_id, (BLOCK, PLACE)), "fingerprints")
    named = marked.filter("doc_id is not null").join(_components_of(marked).select("fp", "component"), "fp")
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", BLOCK, PLACE)).alias("first"))
    unnamed = marked.filter("doc_id is null").select(BLOCK, PLACE)
    return keep_rows(rows, first.select(f"first.{BLOCK}", f"first.{PLACE}").union(unnamed))
