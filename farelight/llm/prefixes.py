"""Prefix trie of conversations by vertical bitmaps, shard by shard.

Conversations are dealt to shards. In a shard each conversation is a bit, and an index has
for each position and turn the bitset of the conversations that have the turn there. A
depth-first walk intersects the bitset of a node with the postings of the next position:
what is left over gives the children, popcounts the members, and the bitset of the
conversations that are as long as the node is deep its end list. A turn is a 128-bit
digest, a node the digest of its path, so that the nodes of all shards meet by key.

Shards add up, except where several have the same node. Such shared nodes have shared
ancestors only. What they were counted too often is summed over their subtrees by pointer
doubling, in as many rounds as the depth of the shared part has binary digits, and taken
off. Other nodes are final as their shard has them.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from farelight.llm.common import bound_batches, sha256_hex
from farelight.session import written

#: Turns that a shard holds, about.
SHARD_TURNS = 50_000
#: Conversations that share what they are rebuilt from.
FAMILY = 100

NO_ENDS = sha256_hex(b"")
_ROOT = bytes(16)
_NODES = (
    "k1 long, k2 long, p1 long, p2 long, depth long, n long, low long, parent_low long, children long, "
    "leaves long, weighted long, plain long, size long, ends binary, ends_sha256 string"
)
_NAMES = [c.split()[0] for c in _NODES.split(", ")]


def _turns(conversations: DataFrame, names: dict[str, str]) -> DataFrame:
    """``conv_id, turn``, the turn's digest ``a, b`` and its code points; text goes no further."""
    role, text = (F.coalesce(F.col(names[c]).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))

    def half(start: int) -> Column:
        # Two parts: 16 hex digits do not fit in a positive long.
        high, low = (F.conv(F.substring(digest, start + i, 8), 16, 10).cast("long") for i in (0, 8))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return conversations.select(
        F.col(names["conv_id"]).cast("long").alias("conv_id"),
        F.col(names["turn"]).cast("long").alias("turn"),
        half(1).alias("a"),
        half(17).alias("b"),
        F.length(text).cast("long").alias("size"),
    ).filter("conv_id is not null")


def _ordered(shard: pa.Table) -> dict[int, list[tuple[bytes, int]]]:
    """Conversation to its turns (digest, code points), by turn (null first), then digest."""
    conv, a, b, size = (shard.column(c).to_numpy() for c in ("conv_id", "a", "b", "size"))
    known = shard.column("turn").is_valid().to_numpy()
    turn = shard.column("turn").fill_null(0).to_numpy()
    order = np.lexsort((b.view(np.uint64), a.view(np.uint64), turn, known, conv))
    digests = np.ascontiguousarray(np.stack([a, b], 1)[order].astype(">i8")).tobytes()
    sizes = size[order].tolist()
    ids, starts = np.unique(conv[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    return {
        c: [(digests[16 * i : 16 * i + 16], sizes[i]) for i in range(s, e)]
        for c, s, e in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True)
    }


def rebuilt(own: dict[int, list], family: int = FAMILY) -> dict[int, list]:
    """Each conversation with its first turns taken from the first one of its family.

    How many is told by the id; see :func:`prefix_trie`.
    """
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, family))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _bits(bitset: int, width: int) -> np.ndarray:
    """Numbers of the bits that are set."""
    packed = np.frombuffer(bitset.to_bytes((width + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(packed, bitorder="little"))


def walk(conversations: dict[int, list[tuple[bytes, int]]]) -> Iterator[dict]:
    """The nodes of a shard's trie, each after its parent; sums over subtrees are in it."""
    ids = np.array(sorted(conversations), np.int64)
    sequences = [conversations[c] for c in ids.tolist()]
    # Bits are set in bytearrays, as postings grow; then they become integers.
    postings: dict[tuple[int, bytes], list[int]] = {}
    by_length: dict[int, list[int]] = {}
    for bit, turns in enumerate(sequences):
        by_length.setdefault(len(turns), []).append(bit)
        for at, (turn, _) in enumerate(turns):
            postings.setdefault((at, turn), []).append(bit)
    width = len(ids)
    index = {k: _bitset(bits, width) for k, bits in postings.items()}
    ends_at = {n: _bitset(bits, width) for n, bits in by_length.items()}

    nodes: list[dict] = []
    stack = [(_ROOT, None, -1, 0, 0, (1 << width) - 1)]
    while stack:
        key, parent_key, parent, depth, size, members = stack.pop()
        me, n = len(nodes), members.bit_count()
        done = members & ends_at.get(depth, 0)
        low = int(ids[(members & -members).bit_length() - 1])
        nodes.append(
            {
                "key": key, "parent_key": parent_key, "parent": parent, "depth": depth, "n": n, "low": low,
                "children": 0, "leaves": 0, "weighted": n * size, "plain": size, "size": size,
                "ends": ids[_bits(done, width)] if done else ids[:0],
            }
        )
        rest = members & ~done
        while rest:
            turn, length = sequences[(rest & -rest).bit_length() - 1][depth]
            child = members & index[depth, turn]
            rest &= ~child
            nodes[me]["children"] += 1
            stack.append((xxhash.xxh3_128_digest(key + turn), key, me, depth + 1, length, child))
    for node in reversed(nodes):
        node["leaves"] += node["children"] == 0
        if node["parent"] >= 0:
            above = nodes[node["parent"]]
            for name in ("leaves", "weighted", "plain"):
                above[name] += node[name]
    for node in nodes:
        node["parent_low"] = nodes[node["parent"]]["low"] if node["parent"] >= 0 else None
        yield node


def _bitset(bits: list[int], width: int) -> int:
    if len(bits) == 1:
        return 1 << bits[0]
    flags = np.zeros(width, np.uint8)
    flags[bits] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _ends_digest(ids: np.ndarray) -> str:
    return sha256_hex(",".join(map(str, ids.tolist())).encode())


def _shard_rows(shard: pa.Table, family: int) -> pa.Table:
    columns: dict[str, list] = {name: [] for name in _NAMES}
    own = _ordered(shard)
    for node in walk(rebuilt(own, family) if family else own):
        k1, k2 = struct.unpack(">qq", node["key"])
        p1, p2 = struct.unpack(">qq", node["parent_key"]) if node["parent_key"] else (None, None)
        ends = node["ends"]
        row = {**node, "k1": k1, "k2": k2, "p1": p1, "p2": p2}
        row["ends"] = ends.tobytes() if len(ends) else None
        row["ends_sha256"] = _ends_digest(ends) if len(ends) else NO_ENDS
        for name in _NAMES:
            columns[name].append(row[name])
    kinds = {"ends": pa.binary(), "ends_sha256": pa.string()}
    return pa.table({name: pa.array(columns[name], kinds.get(name, pa.int64())) for name in _NAMES})


def _too_often(shared: DataFrame) -> DataFrame:
    """``k1, k2, extra_plain, extra_leaves`` of shared nodes: what their subtrees count too often."""
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    state = shared.select(
        "k1",
        "k2",
        F.col("p1").alias("a1"),
        F.col("p2").alias("a2"),
        ((F.col("shards") - 1) * F.col("size")).alias("extra_plain"),
        F.when(F.col("children") == 0, F.col("shards") - 1).otherwise(F.col("childless")).alias("extra_leaves"),
    )
    reach = 1
    while reach <= deepest:
        # So far a node has what lies less than `reach` below it, and the node `reach` above it.
        state = written(state, "subtrees")
        below = state.filter("a1 is not null").groupBy("a1", "a2").agg(
            F.sum("extra_plain").alias("more_plain"), F.sum("extra_leaves").alias("more_leaves")
        )
        up = state.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("a1").alias("n1"), F.col("a2").alias("n2"))
        below = below.withColumnsRenamed({"a1": "b1", "a2": "b2"})
        state = (
            state.join(below, (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")), "left")
            .join(up, (F.col("a1") == F.col("u1")) & (F.col("a2") == F.col("u2")), "left")
            .select(
                "k1",
                "k2",
                F.col("n1").alias("a1"),
                F.col("n2").alias("a2"),
                (F.col("extra_plain") + F.coalesce("more_plain", F.lit(0))).alias("extra_plain"),
                (F.col("extra_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("extra_leaves"),
            )
        )
        reach *= 2
    return state.select("k1", "k2", "extra_plain", "extra_leaves")


def _shared_ends(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of shared nodes with ends, hashed in order as the ids stream by.

    A digest is a serial matter, so the ids of one node go through one task; it holds a
    batch of them at a time.
    """
    packed = nodes.filter("ends is not null").join(shared.select("k1", "k2"), ["k1", "k2"], "left_semi")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[i].as_py(), np.int64)
                keys = [pa.array(np.full(len(ids), batch.column(c)[i].as_py())) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(ids)], names=["k1", "k2", "conv_id"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            columns = [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "ends_sha256"])

        for batch in batches:
            k1, k2, ids = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if s == e:
                    continue
                now = (int(k1[s]), int(k2[s]))
                text = ",".join(map(str, ids[s:e].tolist())).encode()
                if now == key:
                    digest.update(b"," + text)
                    continue
                if key is not None:
                    yield row()
                key, digest = now, hashlib.sha256(text)
        if key is not None:
            yield row()

    rows = packed.select("k1", "k2", "ends").mapInArrow(unpack, "k1 long, k2 long, conv_id long")
    ordered = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    return ordered.mapInArrow(stream, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    family: int = 0,
) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included.

    Turns are ordered by ``turn`` (null first); turns of the same number by the MD5 digest
    of role and text. Two turns are equal if role and text are; null ones count as empty.
    With ``family`` each conversation ``c`` first takes its first ``crc32(c) % 6`` turns from
    conversation ``c - c % family``: all of them if that one has fewer, none if there is no
    such conversation.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree),
    ``saved_tokens`` (over the subtree, code points of a node's last text for each member
    but one), ``ends_sha256`` (of the ids of the members that are as long as the node is
    deep, in order, joined by commas).

    Rows without a conversation id are left out. Repeated rows are turns of their own. No
    rows give no nodes, not even a root. Other columns are not looked at. A family is worked
    on in one task, which holds some 200 bytes a turn.
    """
    spark = conversations.sparkSession
    bound_batches(spark)
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    turns = written(_turns(conversations, names), "turns")
    shards = max(8, turns.count() // SHARD_TURNS)
    together = F.col("conv_id") - F.col("conv_id") % (family or FAMILY)
    dealt = turns.withColumn("shard", F.pmod(F.xxhash64(together), F.lit(shards)))
    nodes = written(dealt.groupBy("shard").applyInArrow(lambda t: _shard_rows(t, family), _NODES), "nodes")

    sums = {name: F.sum(name).alias(name) for name in ("n", "children", "leaves", "weighted", "plain")}
    found = nodes.groupBy("k1", "k2").agg(
        F.count("*").alias("shards"),
        F.count_if(F.col("children") == 0).alias("childless"),
        *[F.max(name).alias(name) for name in ("p1", "p2", "depth", "size", "ends_sha256")],
        *[F.min(name).alias(name) for name in ("low", "parent_low")],
        *sums.values(),
    )
    found = written(found, "trie")
    shared = written(found.filter("shards > 1"), "shared")
    above = shared.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.col("low").alias("shared_low"))
    with_parent = found.join(above, (F.col("p1") == F.col("s1")) & (F.col("p2") == F.col("s2")), "left").withColumn(
        "parent_low", F.coalesce("shared_low", "parent_low")
    )
    private = with_parent.filter("shards = 1").select(
        *_result(F.col("children"), F.col("leaves"), F.col("plain"), F.col("ends_sha256"))
    )
    if shared.isEmpty():
        return private
    again = shared.filter("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    extra = (
        _too_often(shared)
        .join(again.agg(F.sum(F.col("shards") - 1).alias("extra_children")), ["k1", "k2"], "left")
        .join(_shared_ends(nodes, shared).withColumnRenamed("ends_sha256", "all_ends"), ["k1", "k2"], "left")
    )
    common = with_parent.filter("shards > 1").join(extra, ["k1", "k2"]).select(
        *_result(
            F.col("children") - F.coalesce("extra_children", F.lit(0)),
            F.col("leaves") - F.col("extra_leaves"),
            F.col("plain") - F.col("extra_plain"),
            F.coalesce("all_ends", F.lit(NO_ENDS)),
        )
    )
    return private.unionByName(common)


def _result(children: Column, leaves: Column, plain: Column, ends: Column) -> list[Column]:
    return [
        F.col("low").alias("conv_id"),
        F.col("depth"),
        F.col("parent_low").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        children.alias("n_children"),
        leaves.alias("n_leaves"),
        (F.col("weighted") - plain).alias("saved_tokens"),
        ends.alias("ends_sha256"),
    ]
