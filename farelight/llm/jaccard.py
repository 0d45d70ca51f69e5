"""N-gram Jaccard join by grouped prefixes.

The distinct shingles of a document are put in a global order, the rarer first: counts are
kept in a table of fixed size over all documents, and what shares a place in it goes by
its hash. Two sets that are similar enough share one of their first shingles, few in number
(the prefix). Documents with the same prefix and size form one group, whose prefix is
posted once; equal sets are one class. A posting list is the groups that share a prefix
shingle; groups alone on all of their lists are done.

The other lists, and the groups with several classes, are expanded to classes. Pairs on a
list are filtered by size, by position, and by a bit string of each set whose distance can
not be more than that of the sets; what is left is verified on whole sets. As links are wanted up
to what they connect, pairs of classes that are known to be connected are not looked at:
first each list pairs its members with one pivot, in ``ROUNDS`` rounds, and only then all
pairs that are still apart on some list. So a cloud of near copies costs about as many
pairs as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from farelight.llm.blocks import (
    NO_ID,
    QUESTION,
    Block,
    Rolling,
    answers,
    ask_hashes,
    bits_of,
    cells_of,
    each_block,
    meet_hashes,
    number_of_cells,
    text_bytes,
    word_hashes,
    word_places,
    write_blocks,
)
from farelight.llm.components import components
from farelight.session import written

SHINGLE = 5
#: Percent of the union that the intersection has at least.
PERCENT = 80
#: Binary logarithm of the number of counters of shingles: 8 MB of them.
COUNTERS = 20
_SLICE = 1 << 10
#: Prefix shingles in a cell, about.
CELL = 500_000
#: Rounds in which a list pairs its members with a pivot.
ROUNDS = 2


def shingles(text: bytes, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of the documents that begin at the given bytes, and the
    document of each. A line end stands between documents."""
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = word_places(data)
    cuts = np.searchsorted(starts, np.append(begins, len(data)))
    count = np.diff(cuts)
    # A document with fewer words has its whole sequence as one shingle.
    windows = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), windows)
    first = np.repeat(cuts[:-1] - np.cumsum(windows) + windows, windows) + np.arange(int(windows.sum()))
    last = np.minimum(first + SHINGLE, cuts[1:][doc])
    hashes = Rolling(word_hashes(data, starts, ends))(first, last)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], doc[new]


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTERS)).astype(np.int64)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many first shingles of ``n`` one shared with any similar set is among."""
    return n - (PERCENT * n + 99) // 100 + np.minimum(n, 1)


def parities(hashes: np.ndarray, doc: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit string for each set, in 64-bit words, and where each begins among the words.

    A set of ``n`` has the least power of two of bits that is ``n`` or more, 64 at least; a
    shingle turns over the bit at its hash. So two strings of the same length differ in no
    more bits than the sets differ in shingles, and xor of the two halves of a string is the
    string of half the length. Sets that are similar in size differ by one such step at most.
    """
    size = 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
    begin = np.cumsum(size) - size
    at = begin[doc] + (hashes & (size - 1).astype(np.uint64)[doc]).astype(np.int64)
    odd = (np.bincount(at, minlength=int(size.sum())) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8"), np.append(begin, size.sum()) // 64


def _rarest_first(hashes: np.ndarray, doc: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each document in the global order, and the place of each in its document."""
    order = np.lexsort((hashes, counts[_counter(hashes)], doc))
    first = np.searchsorted(doc, np.arange(int(doc[-1]) + 1 if len(doc) else 0))
    return hashes[order], np.arange(len(doc)) - first[doc]


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts, all in as many bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    """The counts of a slice, whose number tells their width."""
    return np.frombuffer(packed, f"u{len(packed) // _SLICE}").astype(np.int64)


def _count_shingles(blocks: DataFrame) -> np.ndarray:
    """In how many documents the shingles of each counter occur; 1,024 rows of 8 KB or less to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["block"], row["ids"], row["lengths"], row["data"])
                hashes, _ = shingles(block.data, block.starts)
                total += np.bincount(_counter(hashes), minlength=len(total))
        if total.any():
            rows = [pack_counts(part) for part in total.reshape(-1, _SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows)], names=["slice", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(_SLICE, np.int64)
        for part in rows.column("counts").to_pylist():
            total += unpack_counts(part)
        return pa.table({"slice": rows.column("slice")[:1], "counts": pa.array([pack_counts(total)])})

    kind = "slice long, counts binary"
    parts = blocks.select("block", "ids", "lengths", "data").mapInArrow(count, kind)
    out = np.zeros(1 << COUNTERS, np.int64)
    for row in parts.groupBy("slice").applyInArrow(add, kind).toLocalIterator():
        out[row["slice"] * _SLICE : (row["slice"] + 1) * _SLICE] = unpack_counts(row["counts"])
    return out


_MARKED = (
    "block long, at int, doc_id long, n long, g long, c1 long, c2 long, "
    "bits array<long>, posted array<struct<token: long, pos: int>>"
)


def _mark(blocks: DataFrame) -> DataFrame:
    """Each document's set as two hashes, its group, and the prefix shingles that occur elsewhere too."""
    counts = blocks.sparkSession.sparkContext.broadcast(_count_shingles(blocks).astype(np.uint64).tobytes())
    cells = number_of_cells(text_bytes(blocks) / 30, CELL)

    def prefixes(block: Block):
        hashes, doc = shingles(block.data, block.starts)
        hashes, pos = _rarest_first(hashes, doc, np.frombuffer(counts.value, np.uint64))
        n = np.bincount(doc, minlength=len(block.ids))
        inside = pos < prefix_length(n)[doc]
        unique, which = np.unique(hashes[inside], return_inverse=True)
        return hashes, doc, pos, n, inside, unique, which

    def ask(block: Block) -> pa.RecordBatch:
        *_, unique, which = prefixes(block)
        return ask_hashes(block.number, unique, which, cells)

    def mark(block: Block, found) -> pa.RecordBatch:
        hashes, doc, pos, n, inside, unique, which = prefixes(block)
        shared = np.zeros(len(hashes), bool)
        shared[inside] = bits_of(found, *cells_of(unique, cells))[which]
        ends = np.cumsum(n)
        group, one, two, posted = [], [], [], []
        signed = hashes.view(np.int64)
        for i, (e, k) in enumerate(zip(ends.tolist(), n.tolist(), strict=True)):
            s = e - k
            prefix = hashes[s : s + int(prefix_length(n[i : i + 1])[0])]
            group.append(xxhash.xxh3_64_intdigest(prefix.tobytes(), k) - (1 << 63))
            both = xxhash.xxh3_128_digest(np.sort(hashes[s:e]).tobytes())
            one.append(int.from_bytes(both[:8], "big", signed=True))
            two.append(int.from_bytes(both[8:], "big", signed=True))
        words, begins = parities(hashes, doc, n)
        bits = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(words))
        at = np.flatnonzero(shared)
        offsets = np.searchsorted(doc[at], np.arange(len(n) + 1))
        pairs = pa.StructArray.from_arrays([pa.array(signed[at]), pa.array(pos[at].astype(np.int32))], names=["token", "pos"])
        posted = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        columns = [pa.array(np.full(len(n), block.number)), pa.array(np.arange(len(n), dtype=np.int32)), ids]
        columns += [pa.array(n.astype(np.int64)), *[pa.array(x, pa.int64()) for x in (group, one, two)], bits, posted]
        return pa.RecordBatch.from_arrays(columns, names=["block", "at", "doc_id", "n", "g", "c1", "c2", "bits", "posted"])

    asked = each_block(blocks, QUESTION, ask)
    found = answers(asked, lambda _, packed: meet_hashes(_, packed), "shared")
    return written(each_block(blocks.join(found, "block", "left"), _MARKED, mark), "marked")


def _sets(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, tokens``: whole sets of the classes asked for, made again from one document of each."""
    asked = nodes.groupBy("block").agg(F.collect_list(F.struct("at", "node")).alias("asked"))

    def read(block: Block, wanted: list[dict]) -> pa.RecordBatch:
        texts = [block.text(w["at"]) for w in wanted]
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        hashes, doc = shingles(b"\n".join([*texts, b""]), begins[:-1])
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        tokens = [hashes[s:e].view(np.int64) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [pa.array([w["node"] for w in wanted], pa.int64()), pa.array(tokens, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["node", "tokens"])

    return written(each_block(blocks.join(asked, "block"), "node long, tokens array<long>", read), "sets")


def _may_link(n: Column, pos: Column, m: Column, other_pos: Column) -> Column:
    """Size filter, and that enough can follow a shingle if it is the first one shared."""
    left = F.least(n - pos, m - other_pos)
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & ((100 + PERCENT) * left >= PERCENT * (n + m))


def _halved(bits: Column, like: Column) -> Column:
    """A bit string brought to the length of another that is as long or half as long."""
    half = F.size(like)
    halves = F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > half, halves).otherwise(bits)


def _near_in_bits(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs ``a, b`` those whose bit strings do not differ in more bits than similar sets can."""
    sides = [classes.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("home.bits").alias(f"{s}_bits")) for s in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a")
    a, b, total = F.col("a_bits"), F.col("b_bits"), F.col("a_n") + F.col("b_n")
    unlike = F.zip_with(_halved(a, b), _halved(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    bits = F.aggregate(unlike, F.lit(0), lambda x, y: x + y)
    return both.filter((100 + PERCENT) * (total - bits) >= 2 * PERCENT * total).select("a", "b")


def _verified(pairs: DataFrame, classes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Of pairs ``a, b`` those whose whole sets are similar enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets(blocks, nodes.join(classes.select("node", "home.block", "home.at"), "node"))
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("a_tokens"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - both
    return pairs.join(b, "b").join(a, "a").filter(100 * both >= PERCENT * union).select("a", "b")


def _ordered_pair(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


_LIST = ["own", "token"]


def _apart(lists: DataFrame, links: DataFrame | None, name: str) -> DataFrame:
    """Members ``own, token, node, n, pos, label`` of the lists whose members are not all connected."""
    if links is None:
        return lists.withColumn("label", F.col("node"))
    found = components(links).withColumnRenamed("component", "label")
    members = lists.drop("label").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    members = written(members, name)
    several = members.groupBy(*_LIST).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    return written(members.join(several.select(*_LIST), _LIST, "left_semi"), name)


def _with_pivot(members: DataFrame, turn: int) -> DataFrame:
    """Pairs of each member and one of its list: first the one with least before the shared
    shingle, which is the one most like the others; then one by chance."""
    key = F.col("pos") if turn == 0 else F.xxhash64("node", F.lit(turn))
    pivot = F.min(F.struct(key.cast("long").alias("key"), "node", "n", "pos", "label"))
    chosen = members.groupBy(*_LIST).agg(pivot.alias("p"))
    joined = members.join(chosen, _LIST).filter("label <> p.label")
    joined = joined.filter(_may_link(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos")))
    return joined.select(*_ordered_pair(F.col("node"), F.col("p.node"))).distinct()


def _still_apart(members: DataFrame) -> DataFrame:
    """All pairs on a list that are not known to be connected."""
    per_label = members.groupBy(*_LIST, "label").agg(F.count("*").alias("members"))
    main = per_label.groupBy(*_LIST).agg(F.max(F.struct("members", "label")).alias("most"))
    main = main.select(*_LIST, F.col("most.label").alias("main"))
    others = members.join(main, _LIST).filter("label <> main")
    others = others.select(*_LIST, "main", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "pos", "label")])
    # A pair of two that are outside the largest part comes up twice; one of them is enough.
    pairs = members.join(others, _LIST).filter("label <> o_label and (label = main or node < o_node)")
    pairs = pairs.filter(_may_link(F.col("n"), F.col("pos"), F.col("o_n"), F.col("o_pos")))
    return pairs.select(*_ordered_pair(F.col("node"), F.col("o_node"))).distinct()


def _lists(marked: DataFrame, classes: DataFrame) -> DataFrame:
    """``own, token, node, n, pos``: the lists with more than one group, and the groups with
    more than one class (``own``), in classes.

    Near copies share many shingles, which gives many lists of the same groups. Of these the
    one whose shingle is first in the global order stays: it has the least before it in
    each group, so its filter lets through whatever the others let through.
    """
    posted = marked.filter(F.size("posted") > 0).select("g", "n", F.explode("posted").alias("p"))
    posted = written(posted.select("g", "n", "p.token", "p.pos").distinct(), "posted")
    members = [F.bit_xor(F.xxhash64("g", "n")).alias("f1"), F.bit_xor(F.xxhash64("n", "g", F.lit(1))).alias("f2")]
    several = posted.groupBy("token").agg(F.count("*").alias("groups"), F.sum("pos").alias("before"), *members)
    several = several.filter("groups > 1").groupBy("groups", "f1", "f2").agg(F.min(F.struct("before", "token")).alias("first"))
    by_token = posted.join(several.select("first.token"), "token", "left_semi").join(classes.select("g", "n", "node"), ["g", "n"])
    crowded = classes.groupBy("g", "n").agg(F.count("*").alias("members")).filter("members > 1")
    within = classes.join(crowded, ["g", "n"]).select(
        F.lit(True).alias("own"), F.col("g").alias("token"), "node", "n", F.lit(0).alias("pos")
    )
    return written(by_token.select(F.lit(False).alias("own"), "token", "node", "n", "pos").union(within), "lists")


def similar_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    A document's set is that of its distinct 5-word shingles, A-Z in lower case; with fewer
    words, its whole sequence. Two are linked when the intersection has at least 80 percent
    of the union. ``component_id`` is the smallest ``doc_id`` that can be reached over links,
    itself included.

    A null or empty text has no shingles, is linked with nothing, and has its own id as
    ``component_id``. Repeated rows stay and are linked like other copies. A null ``doc_id``
    keeps its row and takes part, but names a component only if nothing else can: then
    ``component_id`` is null. No rows give no rows. Other columns are not looked at,
    whatever their names. Equal 64-bit hashes stand for equal shingles, equal 128-bit hashes
    of all shingles for equal sets.
    """
    blocks = write_blocks(docs, text, doc_id)
    marked = _mark(blocks)
    classes = marked.filter("n > 0").groupBy("c1", "c2", "n", "g").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("block", "at", "bits")).alias("home")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    lists = _lists(marked, classes)

    links = None
    for turn in range(ROUNDS + 1):
        lists = _apart(lists, links, f"apart{turn}")
        pairs = _with_pivot(lists, turn) if turn < ROUNDS else _still_apart(lists)
        pairs = written(_near_in_bits(pairs, classes), "pairs")
        found = written(_verified(pairs, classes, blocks), "links")
        links = found if links is None else links.union(found)

    found = written(components(links), "components")
    named = classes.join(found, "node", "left").select("c1", "c2", "low", F.coalesce("component", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = written(named.join(least, "label").select("c1", "c2", "component_id"), "named")
    return (
        marked.select("doc_id", "n", *[F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("c1", "c2")])
        .join(named, ["c1", "c2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
