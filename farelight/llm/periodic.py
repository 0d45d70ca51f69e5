"""Periodic runs of words, found on a grammar that Re-Pair builds of each document.

Re-Pair replaces pairs of neighbouring symbols that occur at least twice by new symbols
until no pair does. All documents of a piece are worked on at once in arrays, each with
symbols of its own; in a round the pairs of at least half the highest count are replaced,
the more frequent first where two overlap. A pair that occurs once never occurs twice
again, so its boundary is settled and leaves the work.

A run lies in the expansion of a smallest symbol (or in none but the document) and crosses
the boundary between the two halves of that symbol, or one between two symbols that are
left at the top. So the runs across the boundary of each symbol are computed once, on one
of its places in the text, whatever the number of its uses; they are then moved to all
places where the symbol is derived, and of the intervals found for a period those that
are contained in another one go. What remains is maximal.

A run of length ``len`` and period ``q`` is a stretch of ``len - q >= max(q, 12 - q) >= 6``
consecutive words that are equal to the word ``q`` further on. Next to the boundary it
holds one of four word triples, so the candidates of a boundary are the places of equal
triples in the symbol's text; running hashes tell how far each stretch reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farelight.llm.blocks import Rolling, mix
from farelight.llm.common import map_rows, sha256_hex

#: Shortest run, in words.
SHORTEST = 12
#: Bytes of text worked on at a time, unless one document has more.
PIECE_BYTES = 4 << 20
#: Candidate distances looked at a time.
AT_ONCE = 1 << 20

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Grammar:
    """Rules by number, and the symbols and boundaries left at the top.

    Symbols below ``base`` are words; ``base + k`` is rule ``k`` with halves ``left[k]`` and
    ``right[k]``, ``size[symbol]`` words long, derived among others at ``place[k]``.
    ``rounds`` has the first rule of each round.
    """

    def __init__(self, symbols: np.ndarray, joined: np.ndarray):
        """``joined[i]`` tells whether words ``i`` and ``i + 1`` are of one document."""
        self.base = int(symbols.max()) + 1 if len(symbols) else 0
        left, right, place, rounds, tops, cuts = [], [], [], [], [], []
        size = np.ones(self.base, np.int64)
        at = np.arange(len(symbols))
        joined = np.append(joined, False)
        while True:
            inner = np.flatnonzero(joined)
            if not len(inner):
                rule = symbols >= self.base
                tops.append((symbols[rule], at[rule]))
                break
            keys = (symbols[inner] << 32) | symbols[inner + 1]
            even = _even(inner, keys)
            group, counts, first = _groups(keys, even)
            settled = counts[group] < 2
            cuts.append(at[inner[settled] + 1])
            joined[inner[settled]] = False
            alone = ~joined
            alone[1:] &= ~joined[:-1]
            rule = alone & (symbols >= self.base)
            tops.append((symbols[rule], at[rule]))
            inner, group, even = inner[~settled], group[~settled], even[~settled]
            if not len(inner):
                break
            used, taken = _choose(inner, group, even, counts)
            number = np.full(len(counts), -1)
            number[used] = np.arange(len(used)) + len(size)
            rounds.append(len(size) - self.base)
            left.append(keys[first[used]] >> 32)
            right.append(keys[first[used]] & 0xFFFFFFFF)
            size = np.concatenate([size, size[left[-1]] + size[right[-1]]])
            where = inner[taken]
            symbols = symbols.copy()
            symbols[where] = number[group[taken]]
            spot = np.empty(len(used), np.int64)
            spot[symbols[where] - number[used[0]]] = at[where]
            place.append(spot)
            joined[where] = joined[where + 1]
            gone = alone
            gone[where + 1] = True
            symbols, at, joined = symbols[~gone], at[~gone], joined[~gone]
        none = np.empty(0, np.int64)
        self.left, self.right, self.place = (np.concatenate([none, *x]) for x in (left, right, place))
        self.size, self.rounds = size, rounds
        #: Where a top symbol begins that is not the first one of its document.
        self.cuts = np.concatenate([none, *cuts])
        self.top_symbols = np.concatenate([none, *[s for s, _ in tops]])
        self.top_places = np.concatenate([none, *[p for _, p in tops]])

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places in the text where the ``wanted`` rules are derived: rule, place."""
        need = np.concatenate([np.zeros(self.base, bool), wanted])
        ends = [*self.rounds[1:], len(self.left)]
        for low, high in zip(self.rounds, ends, strict=True):
            need[self.base + low : self.base + high] |= need[self.left[low:high]] | need[self.right[low:high]]
        keep = need[self.top_symbols]
        symbols, at = self.top_symbols[keep], self.top_places[keep]
        rules, spots = [symbols[:0]], [at[:0]]
        for low in reversed(self.rounds):
            now = symbols >= self.base + low
            rule, spot = symbols[now] - self.base, at[now]
            asked = wanted[rule]
            rules.append(rule[asked])
            spots.append(spot[asked])
            below = np.concatenate([self.left[rule], self.right[rule]])
            where = np.concatenate([spot, spot + self.size[self.left[rule]]])
            some = need[below]
            symbols, at = np.concatenate([symbols[~now], below[some]]), np.concatenate([at[~now], where[some]])
        return np.concatenate(rules), np.concatenate(spots)


def _even(inner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a pair may be replaced next to equal ones: in ``aaaa`` every other one."""
    again = np.zeros(len(inner), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (inner[1:] == inner[:-1] + 1)
    n = np.arange(len(inner))
    return (n - np.maximum.accumulate(np.where(again, 0, n))) % 2 == 0


def _groups(keys: np.ndarray, even: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the distinct pair at each place, how often each can be replaced, and a place of it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, np.bincount(group[even], minlength=int(new.sum())), order[new]


def _choose(
    inner: np.ndarray, group: np.ndarray, even: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a round, and which places take theirs: no two overlap, each pair twice at least."""
    best = int(counts.max())
    ranked = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[ranked] = np.arange(len(counts))
    taken = even & (counts[group] >= max(2, (best + 1) // 2))
    mine = np.where(taken, rank[group], len(counts))
    near = inner[1:] == inner[:-1] + 1
    beaten = np.zeros(len(inner), bool)
    beaten[1:] |= near & (mine[:-1] < mine[1:])
    beaten[:-1] |= near & (mine[1:] < mine[:-1])
    taken &= ~beaten
    uses = np.bincount(group[taken], minlength=len(counts))
    taken &= uses[group] >= 2
    return np.flatnonzero(uses >= 2), taken


class Text:
    """Word numbers of a piece, with hashes of any stretch and the places of equal triples."""

    def __init__(self, words: np.ndarray):
        values = mix(words.astype(np.uint64) + np.uint64(1))
        self.n = len(words)
        self.hash = Rolling(values)
        starts = np.arange(max(0, self.n - 2))
        triples = self.hash(starts, starts + 3)
        self.order = np.argsort(triples, kind="stable")
        ordered = triples[self.order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, bool)
        # Sorted: the group of a triple, then its places.
        self.sorted = (np.cumsum(new) - 1) * (self.n + 1) + self.order
        self.group = np.empty(len(starts), np.int64)
        self.group[self.order] = np.cumsum(new) - 1

    def equal(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``order`` the places from ``low`` to ``high`` (exclusive) of the triples at ``at`` are."""
        key = self.group[at] * (self.n + 1)
        return np.searchsorted(self.sorted, key + low), np.searchsorted(self.sorted, key + high)

    def reaches(self, a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the stretch around equal triples may be long enough for a run.

        Then it has half of what is missing on one side at least: two hashes tell.
        """
        half = (np.maximum(b - a, SHORTEST - b + a) + 4) // 2
        good = np.zeros(len(a), bool)
        for begin in (np.zeros(len(a), np.int64), 3 - half):
            i = np.flatnonzero(~good & (a + begin >= low) & (b + begin + half <= high))
            x, y, n = a[i] + begin[i], b[i] + begin[i], half[i]
            good[i] = self.hash(x, x + n) == self.hash(y, y + n)
        return good

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are equal, ``most`` at most."""
        return self._reach(most, lambda n: self.hash(a, a + n) == self.hash(b, b + n))

    def behind(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b`` are equal, ``most`` at most."""
        return self._reach(most, lambda n: self.hash(a - n, a) == self.hash(b - n, b))

    def _reach(self, most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = same(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _crossing(text: Text, m: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Runs across boundary ``m`` within the words from ``l`` to ``r``.

    Rows ``boundary number, start, end, period``; at most about ``AT_ONCE`` candidates are held.
    """
    found = [np.empty((0, 4), np.int64)]
    # Of a run with a whole period after m, the stretch holds the word before m; of one with a
    # whole period before m, the word one period before m. Three words around it are equal too.
    for shift, after in ((-3, True), (-1, True), (0, False), (-2, False)):
        node = np.flatnonzero((m + shift >= l) & (m + shift + 3 <= r))
        x = m[node] + shift
        low, high = (x + 1, x + 1 + r[node] - m[node]) if after else (x - (m[node] - l[node]), x)
        first, last = text.equal(x, np.maximum(low, l[node]), np.minimum(high, r[node] - 2))
        count = np.maximum(last - first, 0)
        some = np.flatnonzero(count)
        at, total = 0, np.cumsum(count[some])
        while at < len(some):
            done = total[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(total, done + AT_ONCE, side="right")))
            part = some[at:upto]
            each = count[part]
            inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            y = text.order[np.repeat(first[part], each) + inside]
            who = np.repeat(node[part], each)
            anchor = np.repeat(x[part], each)
            a, b = np.minimum(anchor, y), np.maximum(anchor, y)
            near = text.reaches(a, b, l[who], r[who])
            who, a, b = who[near], a[near], b[near]
            q = b - a
            forward = text.ahead(a + 3, b + 3, r[who] - b - 3) + 3
            backward = text.behind(a, b, a - l[who])
            start, end = a - backward, b + forward
            good = (end - start >= np.maximum(SHORTEST, 2 * q)) & (start < m[who]) & (m[who] < end)
            found.append(np.stack([who, start, end, q], 1)[good])
            at = upto
    return _smallest(np.concatenate(found))


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of rows with the same owner, start and end, the one with the smallest period."""
    runs = runs[np.lexsort(runs.T[::-1])]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    return runs[new]


def _maximal(runs: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` without those contained in one of the same period, then by start and period."""
    runs = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))]
    if len(runs):
        # Ends only grow from one period to the next, so one running maximum serves all.
        step = int(runs[:, 1].max()) + 1
        ends = runs[:, 1] + np.unique(runs[:, 2], return_inverse=True)[1] * step
        keep = np.ones(len(runs), bool)
        keep[1:] = ends[1:] > np.maximum.accumulate(ends)[:-1]
        runs = runs[keep]
    owned = np.concatenate([np.zeros((len(runs), 1), np.int64), runs], 1)
    return _smallest(owned)[:, 1:]


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start and period.

    ``words`` numbers the words of consecutive documents of the given ``lengths``; no two
    documents share a number.
    """
    ends = np.cumsum(lengths)
    joined = np.ones(max(0, len(words) - 1), bool)
    joined[ends[(ends > 0) & (ends < len(words))] - 1] = False
    grammar = Grammar(words, joined)
    text = Text(words)
    owner = np.searchsorted(ends, grammar.cuts, side="right")
    at_top = _crossing(text, grammar.cuts, ends[owner] - lengths[owner], ends[owner])[:, 1:]
    size = grammar.size[grammar.base :]
    low = grammar.place
    in_rules = _crossing(text, low + grammar.size[grammar.left], low, low + size)
    in_rules[:, 1:3] -= low[in_rules[:, 0]][:, None]
    wanted = np.zeros(len(size), bool)
    wanted[in_rules[:, 0]] = True
    rules, spots = grammar.places(wanted) if len(in_rules) else (low[:0], low[:0])
    # The rows of a rule stand together, so each place of it takes a range of them.
    begin, end = (np.searchsorted(in_rules[:, 0], rules, side=s) for s in ("left", "right"))
    each = end - begin
    row = np.repeat(begin - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
    moved = in_rules[row][:, 1:].copy()
    moved[:, :2] += np.repeat(spots, each)[:, None]
    return _maximal(np.concatenate([at_top, moved]))


def spread_periods(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, of one in ten ids repeated periodically from some word on."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _piece(ids: list[int | None], texts: list[list[bytes]]) -> dict[str, list]:
    """The columns of some documents."""
    numbers, lengths, base = [], np.array([len(w) for w in texts], np.int64), 0
    for words in texts:
        known: dict[bytes, int] = {}
        number = known.setdefault
        numbers.append(np.fromiter((number(w, len(known)) for w in words), np.int64, len(words)) + base)
        base += len(known)
    words = np.concatenate([np.empty(0, np.int64), *numbers])
    runs = find_runs(words, lengths)
    starts = np.cumsum(lengths) - lengths
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    cuts = np.searchsorted(runs[:, 0], np.append(starts, len(words)))
    out: dict[str, list] = {name: [] for name in ("n_runs", "start", "length", "period", "exponent_milli", "runs", "kept")}
    for i, (first, words_here) in enumerate(zip(starts.tolist(), texts, strict=True)):
        mine = runs[cuts[i] : cuts[i + 1]].copy() if len(words_here) else runs[:0]
        mine[:, :2] -= first
        out["n_runs"].append(len(mine))
        if len(mine):
            lengths_here = mine[:, 1] - mine[:, 0]
            best = int(np.argmax(lengths_here))  # the first of the longest: smallest start, then period
            start, length, period = int(mine[best, 0]), int(lengths_here[best]), int(mine[best, 2])
            values = (start, length, period, 1000 * length // period)
            keep = np.flatnonzero(kept[first : first + len(words_here)]).tolist()
            words_here = [words_here[k] for k in keep]
        else:
            values = (None,) * 4
        for name, value in zip(("start", "length", "period", "exponent_milli"), values, strict=True):
            out[name].append(value)
        out["runs"].append([(s, e - s, q) for s, e, q in mine.tolist()])
        out["kept"].append(b" ".join(words_here))
    return out


def _pieces(ids: list[int | None], texts: list[str | None], plant: bool) -> Iterator[dict[str, list]]:
    """Results of a batch, in pieces of bounded size."""
    at = 0
    while at < len(ids):
        held, size, upto = [], 0, at
        while upto < len(ids) and (upto == at or size + len(texts[upto] or "") <= PIECE_BYTES):
            words = (texts[upto] or "").encode().split()
            held.append(spread_periods(words, ids[upto]) if plant else words)
            size += len(texts[upto] or "")
            upto += 1
        yield _piece(ids[at:upto], held)
        at = upto


def collapse_runs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: bool = False, plant: bool = False
) -> DataFrame:
    """Periodic runs of each row, and its text with one period of each run left.

    A run is a stretch of words with smallest period ``q`` of at least 12 words and two
    periods that cannot be made longer; overlapping runs with different periods are runs of
    their own. Of each run all words after the first ``q`` go.

    Columns: ``doc_id, n_runs``; ``start, length, period, exponent_milli`` of the longest run
    (on a tie that of the smallest start, then period; null without a run); ``runs`` (an
    array of ``start, length, period``) and ``collapsed`` (the words left, joined by a
    space), or with ``digest`` their SHA-256 as ``runs_sha256`` and ``collapsed_sha256``.
    ``plant`` repeats words periodically in one of ten documents, chosen by their id, first.

    A null or empty text has no words and no run. Every row gives a row, repeated ones too;
    a null id is kept and plants nothing. No rows give no rows. Other columns are not
    looked at, whatever their names. Words are compared as they are; how far two stretches
    agree is told by 64-bit hashes. A document is worked on whole: memory is some 150 bytes
    a word.
    """
    schema = SCHEMA if digest else SCHEMA.split(", runs_sha256")[0] + (
        ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = list(_pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), plant))
        all_of = {name: [v for p in pieces for v in p[name]] for name in pieces[0]}
        columns = [batch.column(0)]
        columns += [pa.array(all_of[c], pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
        if digest:
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in r).encode() for r in all_of["runs"]]
            columns += [pa.array([sha256_hex(x) for x in some], pa.string()) for some in (lines, all_of["kept"])]
            names = ["runs_sha256", "collapsed_sha256"]
        else:
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            rows = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in all_of["runs"]]
            columns += [pa.array(rows, kind), pa.array([k.decode() for k in all_of["kept"]], pa.string())]
            names = ["runs", "collapsed"]
        return pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", *names]
        )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_rows(rows, schema, work)
