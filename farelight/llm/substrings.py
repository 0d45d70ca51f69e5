"""Substring deduplication with difference-cover anchors.

A repeated window of twenty words need not start at the same place modulo anything in its
two documents, so all windows would have to be compared. A difference cover modulo 13 with
four positions has, for any two places, a shift by less than 13 that brings both of them to
cover positions. So it is enough to hash shorter windows of eight words, at cover positions
only, a third of all: two equal windows of twenty words share such an anchor, whole and at
the same offset. Anchors that occur once anywhere are done with. Around those that repeat,
the match is extended: the windows of twenty words that contain one are hashed to 128 bits,
and each hash finds its earliest place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

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
    mix,
    number_of_cells,
    question,
    split_bits,
    text_bytes,
    word_hashes,
    word_places,
    write_blocks,
)

WINDOW = 20
#: A perfect difference cover: every difference modulo 13 occurs once.
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Anchors and windows that meet in one task, about.
CELL = 1_000_000


class Words:
    """Words of a block, where each document's words begin, and its places in the cover."""

    def __init__(self, block: Block):
        self.block = block
        self.starts, self.ends = word_places(block.bytes)
        self.hashes = word_hashes(block.bytes, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, block.starts)
        self.doc = np.searchsorted(block.starts, self.starts, side="right") - 1
        self.place = np.arange(len(self.starts)) - self.first[self.doc] if len(self.starts) else self.starts

    def windows(self, length: int) -> np.ndarray:
        """Starts of the windows of a length that lie within one document."""
        n = len(self.starts) - length + 1
        return np.flatnonzero(self.doc[:n] == self.doc[length - 1 :]) if n > 0 else np.empty(0, np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, places, and the hash of each place."""
        at = self.windows(ANCHOR)
        at = at[np.isin(self.place[at] % PERIOD, COVER)]
        unique, which = np.unique(Rolling(mix(self.hashes))(at, at + ANCHOR), return_inverse=True)
        return unique, at, which

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that contain an anchor at one of the given places."""
        change = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(change, np.maximum(repeated - (WINDOW - ANCHOR), 0), 1)
        np.add.at(change, repeated + 1, -1)
        whole = self.windows(WINDOW)
        return whole[np.cumsum(change)[whole] > 0]

    def fingerprints(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        second = word_hashes(self.block.bytes, self.starts, self.ends, 1)
        return Rolling(mix(self.hashes))(at, at + WINDOW), Rolling(mix(second), 1)(at, at + WINDOW)


def _ask_anchors(block: Block, cells: int) -> pa.RecordBatch:
    unique, _, which = Words(block).anchors()
    return ask_hashes(block.number, unique, which, cells)


class Candidates:
    """Windows to compare in a block: distinct fingerprints, each with its earliest place."""

    def __init__(self, block: Block, found: list[dict] | None, cells: int):
        self.words = words = Words(block)
        unique, at, which = words.anchors()
        repeated = bits_of(found, *cells_of(unique, cells))
        self.at = words.candidates(at[repeated[which]])
        high, low = words.fingerprints(self.at) if len(self.at) else (np.empty(0, np.uint64),) * 2
        ids = block.ids[words.doc[self.at]] if len(self.at) else np.empty(0, np.int64)
        # In order of fingerprint, and then of place; equal ids in order of the table.
        order = np.lexsort((self.at, ids, low, high))
        new = np.ones(len(order), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        # Of equal windows in a block, all but the earliest are repeats.
        self.later = self.at[order[~new]]
        first = np.sort(order[new])
        self.first, self.high, self.low, self.ids = self.at[first], high[first], low[first], ids[first]


def _ask_windows(block: Block, found: list[dict] | None, cells: int, window_cells: int) -> pa.RecordBatch | None:
    if not found:
        return None
    asked = Candidates(block, found, cells)
    order, cuts = cells_of(asked.high, window_cells)

    def pack(at: np.ndarray) -> bytes:
        # Ids and places rise slowly and compress well; the fingerprints do not.
        ids, runs = _runs(asked.ids[at])
        places = np.diff(asked.first[at], prepend=0).astype(np.uint32)
        head = np.array([len(at), len(ids)], np.int64)
        return b"".join(x.tobytes() for x in (head, ids, runs, asked.high[at], asked.low[at], places))

    return question(block.number, order, cuts, pack)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[begin], np.diff(np.append(begin, len(values)))


def _meet_windows(blocks: list[int], packed: list[bytes]) -> list[bytes]:
    """Which windows have an equal one that starts earlier."""
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    counts = []
    for number, p in zip(blocks, packed, strict=True):
        n, m = np.frombuffer(p, np.int64, 2)
        at = 16
        ids = np.frombuffer(p, np.int64, m, at)
        runs = np.frombuffer(p, np.int64, m, at + 8 * m)
        at += 16 * m
        columns[0].append(np.frombuffer(p, np.uint64, n, at))
        columns[1].append(np.frombuffer(p, np.uint64, n, at + 8 * n))
        columns[2].append(np.repeat(ids, runs))
        columns[3].append(np.full(n, number, np.int64))
        columns[4].append(np.cumsum(np.frombuffer(p, np.uint32, n, at + 16 * n), dtype=np.int64))
        counts.append(int(n))
    high, low, ids, number, place = (np.concatenate(c) for c in columns)
    order = np.lexsort((place, number, ids, low, high))
    repeat = np.zeros(len(order), bool)
    repeat[order[1:]] = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    return split_bits(repeat, counts)


def _keep(block: Block, found: list[dict] | None, repeats: list[dict] | None, cells: int, window_cells: int, digest: bool) -> pa.RecordBatch:
    """Texts of a block without the words that repeats cover."""
    removed = None
    if found:
        asked = Candidates(block, found, cells)
        words = asked.words
        repeat = bits_of(repeats, *cells_of(asked.high, window_cells))
        change = np.zeros(len(words.starts) + 1, np.int64)
        for at in (asked.later, asked.first[repeat]):
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
        removed = np.cumsum(change)[:-1] > 0
    n_words, n_removed, kept = [], [], []
    for i in range(len(block.ids)):
        own = block.text(i).split()
        gone = 0
        if removed is not None and len(own):
            part = removed[words.first[i] : words.first[i] + len(own)]
            gone = int(part.sum())
            if gone:
                left = np.flatnonzero(~part).tolist()
                joined = b" ".join([own[j] for j in left])
        if not gone:
            joined = b" ".join(own)
        n_words.append(len(own))
        n_removed.append(gone)
        kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
    ids = pa.array(block.ids, mask=block.ids == NO_ID)
    columns = [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row; ``kept`` is the text that is left.

    A word goes if a window of twenty consecutive words that covers it also starts earlier:
    in a document of smaller id, or earlier in the same one. Rows that share an id come in
    the order of the table, rows without one after all others. A null text counts as empty;
    texts of fewer than twenty words lose nothing. Kept words are joined by one space. With
    ``digest``, ``kept_sha256`` takes the place of ``kept``. Other columns are not looked at.
    """
    blocks = write_blocks(docs, text, doc_id)
    size = text_bytes(blocks)
    # A byte of prose has 0.05 anchors; all its windows may be candidates, 0.15 a byte.
    cells, window_cells = number_of_cells(size / 20, CELL), number_of_cells(size / 7, CELL)
    asked = each_block(blocks, QUESTION, lambda b: _ask_anchors(b, cells))
    found = answers(asked, meet_hashes, "found")
    asked = each_block(
        blocks.join(found, "block", "left"), QUESTION, lambda b, f: _ask_windows(b, f, cells, window_cells)
    )
    repeats = answers(asked, _meet_windows, "repeats")
    both = blocks.join(found, "block", "left").join(repeats, "block", "left")
    kept = "kept_sha256" if digest else "kept"
    return each_block(
        both,
        f"doc_id long, n_words long, n_removed long, {kept} string",
        lambda b, f, r: _keep(b, f, r, cells, window_cells, digest),
    )
