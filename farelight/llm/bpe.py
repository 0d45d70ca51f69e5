"""Byte-level BPE: recursive DuckDB queries merge tokens, an ordered aggregation decodes.

Each task splits its texts into pieces by the tokenizer's pattern. Pieces it has not met are
given to a small in-process DuckDB as rows of (piece, position, token). A recursive query
joins neighbouring tokens with the merge table and contracts the leftmost pair of minimum
rank of each piece, until no pair is left. The ids of a piece, and its bytes decoded from
these ids, are ordered aggregations over its last rows. Documents never leave their task,
so nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from farelight.llm.common import map_rows, sha256_hex

#: Documents whose pieces are held at a time, pieces in one recursive query, pieces remembered
#: by a worker (twice that at most), and the length in bytes from which a piece is contracted
#: at all places of a pair at once.
DOCS_AT_ONCE = 256
PIECES_AT_ONCE = 8_000
REMEMBERED = 150_000
LONG_PIECE = 64
_DUCKDB = {"threads": 1, "memory_limit": "250MB"}

# One leftmost contraction per piece and round; pieces without a pair end there. A piece is
# kept as a list between rounds and laid out as token-position rows for the join.
_SHORT = """
with recursive state(w, round, toks) as (
    select w, 0, list(tok order by pos) from start group by w
    union all
    select s.w, s.round + 1, s.toks[:b.best & 65535] || [(b.best >> 16)::int] || s.toks[(b.best & 65535) + 3:]
    from state s join (
        select p.w, min((m.t::bigint << 16) | p.pos) as best
        from (
            select w, unnest(toks[:-2]) as l, unnest(toks[2:]) as r, unnest(range(len(toks) - 1)) as pos from state
        ) p join merges m on m.l = p.l and m.r = p.r
        group by p.w
    ) b on b.w = s.w
),
"""

# All places of the pair of minimum rank, from left to right without overlap; or only the
# leftmost where the new token could form a pair of still lower rank.
_LONG = """
with recursive state(w, round, pos, tok) as (
    select w, 0, pos, tok from start
    union all
    select w, round + 1, row_number() over (partition by w order by pos) - 1, case when chosen then best else tok end
    from (
        select *, coalesce(lag(chosen) over (partition by w order by pos), false) as swallowed
        from (
            select *, coalesce(t = best and case
                when solo then pos = first_at
                else (row_number() over (partition by w, island, t = best order by pos)) % 2 = 1 end, false) as chosen
            from (
                select *, pos - row_number() over (partition by w, t = best order by pos) as island,
                    min(case when t = best then pos end) over (partition by w) as first_at
                from (
                    select *, min(t) over (partition by w) as best
                    from (
                        select s.*, m.t, m.solo
                        from (
                            select *, lead(tok) over (partition by w order by pos) as nxt from state
                        ) s left join merges m on m.l = s.tok and m.r = s.nxt
                    )
                )
            )
            where best is not null
        )
    )
    where not swallowed
),
"""

_LAST_OF_SHORT = """
last as (select w, arg_max(toks, round) as toks from state group by w),
ends as (select w, unnest(toks) as tok, unnest(range(len(toks))) as pos from last)
"""

_LAST_OF_LONG = """
last as (select *, max(round) over (partition by w) as final from state),
ends as (select w, pos, tok from last where round = final)
"""

_DECODE = """
select w, string_agg(tok::varchar, ',' order by pos) as ids, count(*) as n,
    unhex(string_agg(v.hex, '' order by pos)) as decoded
from ends join vocabulary v on v.id = ends.tok group by w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_rows(ranks: dict[bytes, int]) -> list[tuple[int, int, int, bool]]:
    """All ``(left, right, merged, solo)``; solo: the merged token has a lower-ranked pair."""
    rows = [
        (ranks[token[:i]], ranks[token[i:]], rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    lower = {part for left, right, rank in rows for part in (left, right) if rank <= part}
    return [(left, right, rank, rank in lower) for left, right, rank in rows]


class Encoder:
    """Encodes pieces; remembers a bounded number of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        rows = merge_rows(ranks)
        kinds = {"l": pa.int32(), "r": pa.int32(), "t": pa.int32(), "solo": pa.bool_()}
        self.merges = pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))
        self.vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.young: dict[str, tuple[str, int, bytes]] = {}
        self.old: dict[str, tuple[str, int, bytes]] = {}
        self._db: duckdb.DuckDBPyConnection | None = None

    @property
    def db(self) -> duckdb.DuckDBPyConnection:
        """DuckDB with the tables of the tokenizer, opened when a task first needs it."""
        if self._db is None:
            self._db = duckdb.connect(":memory:", config=_DUCKDB)
            for name, rows in (("merges", self.merges), ("vocabulary", self.vocabulary)):
                self._db.register("given", rows)
                self._db.execute(f"create table {name} as select * from given")
                self._db.unregister("given")
        return self._db

    def rest(self) -> None:
        """Close DuckDB until the next task; the pieces stay.

        Spark keeps workers between tasks and stages, and an open DuckDB keeps what its queries
        have freed, which the executor would lack in the stages that follow.
        """
        if self._db is not None:
            self._db.close()
            self._db = None

    def _merge(self, query: str, pieces: list[bytes]) -> dict[int, tuple[str, int, bytes]]:
        sizes = np.fromiter(map(len, pieces), np.int32, len(pieces))
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = np.arange(len(w), dtype=np.int32) - np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, sizes)
        columns = [pa.array(x) for x in (w, pos, self.single[np.frombuffer(b"".join(pieces), np.uint8)])]
        self.db.register("start", pa.Table.from_arrays(columns, names=["w", "pos", "tok"]))
        rows = self.db.execute(query + _DECODE).fetchall()
        self.db.unregister("start")
        return {i: (ids, n, data) for i, ids, n, data in rows}

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[str, int, bytes]]:
        """Ids as text, their number and the decoded bytes of each piece."""
        found, new = {}, []
        for piece in pieces:
            known = self.young.get(piece) or self.old.get(piece)
            if known:
                found[piece] = known
            else:
                new.append(piece)
        for at in range(0, len(new), PIECES_AT_ONCE):
            part = new[at : at + PIECES_AT_ONCE]
            data = [p.encode() for p in part]
            whole = {p: d for p, d in zip(part, data, strict=True) if d in self.ranks}
            # One token, which is its own fixpoint; it is decoded from its id like the others.
            tokens = {p: self.ranks[d] for p, d in whole.items()}
            found.update({p: (str(token), 1, self.token_bytes[token]) for p, token in tokens.items()})
            for query, long in ((_SHORT + _LAST_OF_SHORT, False), (_LONG + _LAST_OF_LONG, True)):
                rest = [
                    (p, d) for p, d in zip(part, data, strict=True) if p not in whole and (len(d) >= LONG_PIECE) == long
                ]
                if rest:
                    merged = self._merge(query, [d for _, d in rest])
                    found.update({p: merged[i] for i, (p, _) in enumerate(rest)})
        for piece in new:
            if len(piece) < LONG_PIECE:
                self.young[piece] = found[piece]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(read_ranks(path))
    return _ENCODERS[path]


def rest() -> None:
    """Let the worker's encoders rest."""
    for model in _ENCODERS.values():
        model.rest()


#: Letters, decimal digits and white space of these texts mean the same to ``re`` and to the
#: Unicode properties of the pattern: Latin-1 without its superscripts, fractions and ordinals.
_PLAIN = re.compile("[\x20-\x7e\\n\\t\\r\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\xff]*")
_AS_RE = ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"[^\s\p{L}\p{N}]", r"(?:[^\w\s]|_)"))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Splits a text by the pattern; plain texts go to the faster of two equal matchers."""
    full = regex.compile(pattern)
    quick = pattern
    for unicode_form, plain_form in reversed(_AS_RE):
        quick = quick.replace(unicode_form, plain_form)
    quick = re.compile(quick)
    return lambda text: (quick if _PLAIN.fullmatch(text) else full).findall(text)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids, n_tokens, decoded`` of every row: ids joined by commas, decoded bytes.

    A null text counts as empty and has no ids. Repeated rows stay. Whole texts are encoded,
    however long; a table without rows gives none. Other columns are not looked at.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _encoded(batch, path, pattern, lambda ids, decoded: (ids, decoded), pa.string(), pa.binary())

    return _run(docs, text, doc_id, "doc_id long, n_tokens long, ids string, decoded binary", work)


def digest(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """As :func:`encode`, with SHA-256 of the ids and of the decoded bytes in their place."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        def both(ids: str, decoded: bytes) -> tuple[str, str]:
            return sha256_hex(ids.encode()), sha256_hex(decoded)

        return _encoded(batch, path, pattern, both, pa.string(), pa.string())

    return _run(docs, text, doc_id, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)


def _run(docs: DataFrame, text: str, doc_id: str, schema: str, work: Callable) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_rows(rows, schema, work, rest)


def _encoded(batch: pa.RecordBatch, path: str, pattern: str, output: Callable, *kinds: pa.DataType) -> pa.RecordBatch:
    split, model = splitter(pattern), encoder(path)
    texts = batch.column(1)
    counts, first, second = [], [], []
    for at in range(0, len(texts), DOCS_AT_ONCE):
        # A piece is held once, however often the texts have it.
        met: dict[str, str] = {}
        pieces = [[met.setdefault(p, p) for p in split(t or "")] for t in texts.slice(at, DOCS_AT_ONCE).to_pylist()]
        known = model.learn(met)
        for doc in pieces:
            parts = [known[p] for p in doc]
            a, b = output(",".join([p[0] for p in parts]), b"".join([p[2] for p in parts]))
            counts.append(sum([p[1] for p in parts]))
            first.append(a)
            second.append(b)
    columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "first", "second"])
