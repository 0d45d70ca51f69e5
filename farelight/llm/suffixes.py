"""Suffix-array deduplication of long byte strings.

Every string of 200 bytes has an anchor that its bytes alone determine: among the places
where the hash of the last eight bytes calls for a cut, the one of least hash (a string
without such a place is its own anchor). Strings can be equal only if the bytes around their
anchors are; anchors that occur once are done with. For the others, the stretch of text that
holds all strings of an anchor goes, by the anchor's hash, to a task where all stretches of
that anchor meet.

An anchor with very many occurrences is hot: around the ends of a passage its stretches would
hold the neighbouring text of every document that has it. Its strings go out one by one, by
the hash of the whole string, each once per block; equal 128-bit hashes stand for equal
strings, and nothing meets by the anchor.

For all other anchors, stretches that are equal as a whole are repeats of each other. Those that differ but
share an anchor are cut into phrases at the places mentioned, and a suffix array is built
over the phrases in linear time by grouping: suffixes are grouped by their Lyndon prefix,
groups being processed in descending order and split with pointers to the previous smaller
suffix; then each group is put in order by one pass over the suffixes, without renaming. Two
strings are equal if they begin and end alike and their whole phrases lie in the same
interval of the suffix array.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from farelight.llm.blocks import (
    NO_ID,
    QUESTION,
    Block,
    Rolling,
    answers,
    bits_of,
    byte_values,
    cells_of,
    each_block,
    mix,
    number_of_cells,
    question,
    split_bits,
    text_bytes,
    write_blocks,
)

LENGTH = 200
#: Bytes whose hash asks for a cut behind them, one place in so many; and the distance
#: behind such a place within which another one is not listened to.
TRIGGER = 8
RATE = 16
APART = 8
#: An anchor is at least so far behind the start of its string and before the end: what
#: decides on it, and what its key is made of, lies inside.
BEHIND = TRIGGER + APART
AHEAD = 60
#: Anchors, and stretches, that meet in one task at most, about.
ANCHORS = 1_000_000
STRETCHES = 40_000
#: Occurrences beyond which an anchor is hot: stretches do not meet by it. At most 255.
HOT = 255
#: Bytes of text for each string of hot anchors that the number of their cells allows for.
HOT_APART = 4


def sort_suffixes(symbols: list[int]) -> list[int]:
    """Suffix array of non-negative integers by linear grouping.

    The end of the sequence counts as smaller than every symbol.
    """
    n = len(symbols)
    text = [-1, *symbols]  # place 0 stands in front of all
    order = sorted(range(1, n + 1), key=text.__getitem__)
    place = [0] * (n + 2)
    group = [0] * (n + 2)  # first place of the group of a suffix; 0 in front and at the end
    size = [0] * (n + 2)
    order.insert(0, 0)
    start = 0
    for at in range(1, n + 1):
        i = order[at]
        if at == 1 or text[i] != text[order[at - 1]]:
            start = at
        group[i] = start
        size[start] += 1
        place[i] = at
    group[0] = -1
    before = [0] * (n + 2)
    # Groups by their Lyndon prefix, from the largest down.
    at = n
    while at > 0:
        first = group[order[at]]
        members = order[first : at + 1]
        if len(members) > 1:
            members.sort()
        runs: dict[int, int] = {}
        for i in members:
            j = i - 1
            g = group[j]
            while g > first:
                j = before[j]
                g = group[j]
            if g == first:  # the same prefix once more
                j = before[j]
            before[i] = j
            runs[j] = runs.get(j, 0) + 1
        runs.pop(0, None)
        if runs:
            most = max(runs.values())
            if most == 1:
                levels = [list(runs)]
            else:
                by_count: dict[int, list[int]] = {}
                for j, count in runs.items():
                    by_count.setdefault(count, []).append(j)
                levels = [by_count[c] for c in sorted(by_count, reverse=True)]
            for moved in levels:
                # To the end of their groups, which they leave for new ones behind.
                for j in moved:
                    g = group[j]
                    last = g + size[g] - 1
                    size[g] -= 1
                    other, here = order[last], place[j]
                    order[last], order[here] = j, other
                    place[j], place[other] = last, here
                fresh = [group[j] + size[group[j]] for j in moved]
                for j, g in zip(moved, fresh, strict=True):
                    group[j] = g
                    size[g] += 1
        at = first - 1
    # Each group in order: what ends where the next smallest suffix begins comes next.
    result = [n + 1] + [0] * n
    free = list(range(n + 2))  # next free place of a group
    for k in range(n + 1):
        j = result[k] - 1
        while j > 0 and group[j] > 0:
            g = group[j]
            result[free[g]] = j
            free[g] += 1
            group[j] = 0
            j = before[j]
    return [i - 1 for i in result[1:]]


def cuts(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to cut within the given texts of ``data``, and the hash that asked for each."""
    n = len(data) - TRIGGER + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    every = np.ndarray((n,), "<u8", data, 0, (1,))
    found = [at + np.flatnonzero(mix(every[at : at + (1 << 19)]) % RATE == 0) for at in range(0, n, 1 << 19)]
    at = np.concatenate(found) + TRIGGER
    text = np.searchsorted(starts, at - 1, side="right") - 1
    at = at[(at - TRIGGER >= starts[text]) & (at <= starts[text] + lengths[text])]
    at = at[np.diff(at, prepend=-APART) >= APART]
    return at, mix(every[at - TRIGGER] ^ np.uint64(0x5851F42D4C957F2D))


class Anchors:
    """The anchors of a block: keys, and the first and last start of the strings of each."""

    def __init__(self, block: Block):
        ends = block.starts + block.lengths
        self.roll = Rolling(byte_values(0)[block.bytes])
        at, asks = cuts(block.data, block.starts, block.lengths)
        doc = np.searchsorted(block.starts, at, side="right") - 1
        low = np.maximum(at - (LENGTH - AHEAD), block.starts[doc])
        high = np.minimum(at - BEHIND, ends[doc] - LENGTH)
        # A string belongs to the least of its places, the leftmost on a tie.
        for step in range(1, (LENGTH - AHEAD - BEHIND) // APART + 2):
            if step >= len(at):
                break
            left, right = asks[:-step], asks[step:]
            low[step:] = np.where(left <= right, np.maximum(low[step:], at[:-step] - BEHIND + 1), low[step:])
            high[:-step] = np.where(right < left, np.minimum(high[:-step], at[step:] - (LENGTH - AHEAD) - 1), high[:-step])
        # Strings with no place to cut, between two places or a place and an end.
        alone = self._alone(block, at, ends)
        some = low <= high
        at, low, high = at[some], low[some], high[some]
        self.low, self.high = np.concatenate([low, alone]), np.concatenate([high, alone])
        self.key = np.concatenate([self.roll(at - BEHIND, at + AHEAD), self.roll(alone, alone + LENGTH)])
        self.unique, self.which = np.unique(self.key, return_inverse=True)

    @staticmethod
    def _alone(block: Block, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = [np.empty(0, np.int64)]
        first = np.searchsorted(places, block.starts)
        last = np.searchsorted(places, ends, side="right")
        for i in np.flatnonzero(block.lengths >= LENGTH):
            begin, end = int(block.starts[i]), int(ends[i])
            own = places[first[i] : last[i]]
            low = np.maximum(np.concatenate(([begin], own - BEHIND + 1)), begin)
            high = np.minimum(np.concatenate((own - (LENGTH - AHEAD) - 1, [end])), end - LENGTH)
            for j in np.flatnonzero(low <= high):
                found.append(np.arange(low[j], high[j] + 1))
        return np.concatenate(found)


class Stretches:
    """Distinct stretches of a block around repeated anchors."""

    def __init__(self, block: Block, found: list[dict] | None, cells: int):
        anchors = Anchors(block)
        order, cut = cells_of(anchors.unique, cells)
        hot = bits_of(_hot_part(found, cut), order, cut)[anchors.which]
        repeated = bits_of(found, order, cut)[anchors.which] & ~hot
        self._strings(block, anchors, hot)
        self.low, self.high = anchors.low[repeated], anchors.high[repeated]
        known: dict[bytes, int] = {}
        data = block.data
        which = [
            known.setdefault(data[a:b], len(known))
            for a, b in zip(self.low.tolist(), (self.high + LENGTH).tolist(), strict=True)
        ]
        self.which = np.array(which, np.int64)
        self.texts = list(known)
        self.key = np.zeros(len(known), np.uint64)
        self.key[self.which] = anchors.key[repeated]
        self.many = np.bincount(self.which, minlength=len(known)) > 1


    def _strings(self, block: Block, anchors: Anchors, hot: np.ndarray) -> None:
        """Strings of hot anchors: starts, distinct hashes (two of each), which of them, and which twice."""
        amount = (anchors.high - anchors.low + 1)[hot]
        self.hot = np.arange(amount.sum()) + np.repeat(anchors.low[hot] - np.cumsum(amount) + amount, amount)
        self.hashes, self.hot_which = np.empty((0, 2), np.uint64), np.empty(0, np.int64)
        if len(self.hot):
            other = Rolling(byte_values(1)[block.bytes], 1)
            both = np.column_stack([roll(self.hot, self.hot + LENGTH) for roll in (anchors.roll, other)])
            by = np.lexsort((both[:, 1], both[:, 0]))
            new = np.append(True, (both[by][1:] != both[by][:-1]).any(1))
            self.hashes, self.hot_which = both[by][new], np.empty(len(by), np.int64)
            self.hot_which[by] = np.cumsum(new) - 1
        self.hot_many = np.bincount(self.hot_which, minlength=len(self.hashes)) > 1


def _hot_part(found: list[dict] | None, cut: np.ndarray) -> list[dict]:
    """The second half of the answers about anchors."""
    return [{"cell": r["cell"], "answer": r["answer"][(cut[r["cell"] + 1] - cut[r["cell"]] + 7) // 8 :]} for r in found or []]


def _ask_anchors(block: Block, cells: int) -> pa.RecordBatch:
    anchors = Anchors(block)
    count = np.minimum(np.bincount(anchors.which, minlength=len(anchors.unique)), 255).astype(np.uint8)
    order, cut = cells_of(anchors.unique, cells)
    return question(block.number, order, cut, lambda at: anchors.unique[at].tobytes() + count[at].tobytes())


def _meet_anchors(packed: list[bytes], hot: int) -> list[bytes]:
    """For each anchor, a bit: it occurs more than once; then for each, a bit: it is hot."""
    sizes = [len(p) // 9 for p in packed]
    rows = list(zip(packed, sizes, strict=True))
    keys = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in rows])
    count = np.concatenate([np.frombuffer(p, np.uint8, n, 8 * n) for p, n in rows]).astype(np.int64)
    order = np.argsort(keys)
    first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else np.empty(0, np.int64)
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(np.add.reduceat(count[order], first), np.diff(first, append=len(keys)))
    return [a + b for a, b in zip(split_bits(total > 1, sizes), split_bits(total > hot, sizes), strict=True)]


def _ask_stretches(
    block: Block, found: list[dict] | None, cells: int, stretch_cells: int, hot_cells: int
) -> pa.RecordBatch | None:
    """Stretches go to the first cells, strings of hot anchors to those behind."""
    if not found:
        return None
    asked = Stretches(block, found, cells)
    order, cut = cells_of(asked.key, stretch_cells)
    strings, string_cut = cells_of(asked.hashes[:, 0], hot_cells)

    def pack(at: np.ndarray) -> bytes:
        if at[0] >= len(order):
            at = at - len(order)
            return b"".join([_STRINGS, asked.hashes[at].tobytes(), asked.hot_many[at].tobytes()])
        texts = [asked.texts[i] for i in at]
        sizes = np.array([len(t) for t in texts], np.uint32)
        head = np.array([len(at)], np.int64)
        data = b"".join([head.tobytes(), asked.key[at].tobytes(), sizes.tobytes(), asked.many[at].tobytes(), *texts])
        return _TEXTS + zstandard.ZstdCompressor(3).compress(data)

    both = np.concatenate([order, strings + len(order)])
    return question(block.number, both, np.concatenate([cut, string_cut[1:] + len(order)]), pack)


#: What a question to a cell is made of.
_TEXTS, _STRINGS = b"t", b"s"


def _meet(_: list[int], packed: list[bytes]) -> list[bytes]:
    """For each stretch, a bit for each of its strings, or for each string of a hot anchor, a bit: it occurs elsewhere too."""
    rest = [memoryview(p)[1:] for p in packed]
    return _meet_strings(rest) if packed[0][:1] == _STRINGS else _meet_stretches(rest)


def _meet_strings(packed: list[memoryview]) -> list[bytes]:
    sizes = [len(p) // 17 for p in packed]
    rows = list(zip(packed, sizes, strict=True))
    hashes = np.concatenate([np.frombuffer(p, np.uint64, 2 * n) for p, n in rows]).reshape(-1, 2)
    out = np.concatenate([np.frombuffer(p, bool, n, 16 * n) for p, n in rows])
    by = np.lexsort((hashes[:, 1], hashes[:, 0]))
    same = (hashes[by][1:] == hashes[by][:-1]).all(1)
    out[by[1:][same]] = True
    out[by[:-1][same]] = True
    return split_bits(out, sizes)


def _meet_stretches(packed: list[memoryview]) -> list[bytes]:
    """For each stretch, a bit for each of its strings: it occurs elsewhere too."""
    known: dict[bytes, int] = {}
    keys: list[int] = []
    count: list[int] = []
    rows = []
    for p in packed:
        data = zstandard.ZstdDecompressor().decompress(p)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        key = np.frombuffer(data, np.uint64, n, 8).tolist()
        size = np.frombuffer(data, np.uint32, n, 8 + 8 * n)
        many = np.frombuffer(data, bool, n, 8 + 12 * n).tolist()
        ends = (8 + 13 * n + np.cumsum(size, dtype=np.int64)).tolist()
        row, begin = [], 8 + 13 * n
        for k, m, end in zip(key, many, ends, strict=True):
            i = known.setdefault(data[begin:end], len(keys))
            if i == len(keys):
                keys.append(k)
                count.append(0)
            count[i] += 1 + m
            row.append(i)
            begin = end
        rows.append(row)
    texts = list(known)
    strings = [np.full(len(t) - LENGTH + 1, c > 1) for t, c in zip(texts, count, strict=True)]
    _, key, members = np.unique(np.array(keys, np.uint64), return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(members[key] > 1).tolist()
    if mixed:
        for i, bits in zip(mixed, repeated_strings([texts[i] for i in mixed]), strict=True):
            strings[i] |= bits
    return [np.packbits(np.concatenate([strings[i] for i in row])).tobytes() for row in rows]


def repeated_strings(texts: list[bytes]) -> list[np.ndarray]:
    """Of different texts, which strings of ``LENGTH`` bytes occur in at least two of them.

    Every string has a place to cut between ``BEHIND`` and ``LENGTH - AHEAD`` bytes after
    its start, and equal strings of one text do not occur.
    """
    data = b"".join(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    roll = Rolling(byte_values(0)[np.frombuffer(data, np.uint8)])
    at, _ = cuts(data, starts, lengths)
    text = np.searchsorted(starts, at - 1, side="right") - 1
    # A phrase from each place to the next of the same text; behind the last place, none.
    whole = np.append(text[1:] == text[:-1], False)
    symbols = np.zeros(len(at), np.int64)
    begin = np.flatnonzero(whole)
    _, names = np.unique(roll(at[begin], at[begin + 1]), return_inverse=True)
    symbols[begin] = names + 1
    order = np.array(sort_suffixes(symbols.tolist()), np.int64)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))

    amount = lengths - LENGTH + 1
    owner = np.repeat(np.arange(len(texts)), amount)
    string = np.arange(amount.sum()) - np.repeat(np.cumsum(amount) - amount, amount) + starts[owner]
    first = np.searchsorted(at, string + BEHIND)
    last = np.searchsorted(at, string + LENGTH, side="right") - 1
    phrases = last - first
    # Suffixes lie in the same interval for so many phrases if all between them agree.
    group = np.zeros(len(string), np.int64)
    apart = np.zeros(len(order), bool)
    for k in range(int(phrases.max(initial=0)) + 1):
        own = phrases == k
        interval = np.cumsum(apart)
        group[own] = interval[rank[first[own]]]
        ahead = order + k
        symbol = np.where(ahead < len(symbols), symbols[np.minimum(ahead, len(symbols) - 1)], -1)
        apart[1:] |= symbol[1:] != symbol[:-1]
    left = roll(string, at[first])
    right = roll(at[last], string + LENGTH)
    inner = mix(group.astype(np.uint64) * np.uint64(64) + phrases.astype(np.uint64)) ^ (at[first] - string).astype(np.uint64)
    by = np.lexsort((right, left, inner))
    same = (inner[by][1:] == inner[by][:-1]) & (left[by][1:] == left[by][:-1]) & (right[by][1:] == right[by][:-1])
    repeated = np.zeros(len(string), bool)
    repeated[by[1:][same]] = True
    repeated[by[:-1][same]] = True
    return np.split(repeated, np.cumsum(amount)[:-1])


def _keep(
    block: Block,
    found: list[dict] | None,
    repeats: list[dict] | None,
    cells: int,
    stretch_cells: int,
    hot_cells: int,
    digest: bool,
) -> pa.RecordBatch:
    """Texts of a block without the bytes that repeated strings cover."""
    removed = np.zeros(len(block.bytes), bool)
    if found:
        asked = Stretches(block, found, cells)
        order, cut = cells_of(asked.key, stretch_cells)
        strings: list[np.ndarray | None] = [None] * len(asked.texts)
        hot = [{"cell": r["cell"] - stretch_cells, "answer": r["answer"]} for r in repeats or [] if r["cell"] >= stretch_cells]
        for row in repeats or []:
            if row["cell"] >= stretch_cells:
                continue
            own = order[cut[row["cell"]] : cut[row["cell"] + 1]]
            bits = np.unpackbits(np.frombuffer(row["answer"], np.uint8)).astype(bool)
            begin = 0
            for i in own.tolist():
                end = begin + len(asked.texts[i]) - LENGTH + 1
                strings[i] = bits[begin:end]
                begin = end
        change = np.zeros(len(block.bytes) + 1, np.int64)
        at = [low + np.flatnonzero(strings[i]) for low, i in zip(asked.low.tolist(), asked.which.tolist(), strict=True)]
        at.append(asked.hot[bits_of(hot, *cells_of(asked.hashes[:, 0], hot_cells))[asked.hot_which]])
        if at:
            begin = np.concatenate(at)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + LENGTH, -1)
        removed = np.cumsum(change)[:-1] > 0
    n_removed, n_spans, kept = [], [], []
    for i in range(len(block.ids)):
        text = block.text(i)
        gone = removed[block.starts[i] : block.starts[i] + block.lengths[i]]
        some = int(gone.sum())
        n_removed.append(some)
        n_spans.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)) if some else 0)
        left = np.frombuffer(text, np.uint8)[~gone].tobytes() if some else text
        kept.append(hashlib.sha256(left).hexdigest() if digest else left)
    columns = [
        pa.array(block.ids, mask=block.ids == NO_ID),
        pa.array(block.lengths),
        pa.array(n_removed, pa.int64()),
        pa.array(n_spans, pa.int64()),
        pa.array(kept, pa.string() if digest else pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: bool = False, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` is binary.

    A byte goes if a string of 200 bytes that covers it occurs at another place too, in the
    same text or any other, overlapping or not; texts are UTF-8 and strings never cross from
    one to the next. ``n_spans`` counts the runs of bytes that go. A null text counts as
    empty; shorter texts lose nothing; repeated rows repeat each other. ``kept`` need not be
    valid UTF-8, for bytes may be cut inside a character. With ``digest``, ``kept_sha256``
    takes its place. Other columns are not looked at. ``hot`` decides only on the path that
    strings take, never on the result.
    """
    blocks = write_blocks(docs, text, doc_id)
    size = text_bytes(blocks)
    # Bytes from one anchor to the next, at random.
    apart = (LENGTH - AHEAD - BEHIND + RATE) / 2
    cells, stretch_cells = number_of_cells(size / apart, ANCHORS), number_of_cells(size / apart, STRETCHES)
    hot_cells = number_of_cells(size / HOT_APART, ANCHORS)
    found = answers(
        each_block(blocks, QUESTION, lambda b: _ask_anchors(b, cells)), lambda _, packed: _meet_anchors(packed, hot), "found"
    )
    asked = each_block(
        blocks.join(found, "block", "left"), QUESTION, lambda b, f: _ask_stretches(b, f, cells, stretch_cells, hot_cells)
    )
    repeats = answers(asked, _meet, "repeats")
    both = blocks.join(found, "block", "left").join(repeats, "block", "left")
    kept = "kept_sha256 string" if digest else "kept binary"
    return each_block(
        both,
        f"doc_id long, n_bytes long, n_removed long, n_spans long, {kept}",
        lambda b, f, r: _keep(b, f, r, cells, stretch_cells, hot_cells, digest),
    )
