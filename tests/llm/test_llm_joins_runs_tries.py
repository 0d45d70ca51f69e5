"""N-gram Jaccard join, periodic runs and prefix tries against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.llm import jaccard, periodic, prefixes
from farelight.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- N-gram Jaccard join ---------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def plain_components(rows):
    """Row number to the smallest id that links reach; all pairs that share a shingle are compared."""
    sets = [shingle_set(text) for _, text in rows]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in having[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = [None] * len(rows)
    for members in groups.values():
        low = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        for i in members:
            out[i] = (rows[i][0], len(sets[i]), low)
    return out


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def joined(spark, rows, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = jaccard.similar_documents(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return by_text([tuple(r) for r in found.collect()])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_jaccard_join_on_clouds_and_shared_passages(spark):
    """Chains of edits, a cloud of near copies, sets of the same prefix, a passage in a third of all."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    texts = []
    for _ in range(6):
        words = rng.choices(vocabulary, k=rng.randrange(20, 120))
        texts.append(words)
        for _ in range(8):
            words = edited(rng, words, rng.randrange(0, 3))  # each from the one before
            texts.append(words)
    base = rng.choices(vocabulary, k=80)
    texts += [edited(rng, base, rng.randrange(0, 5)) for _ in range(60)]
    texts += [rng.choices(vocabulary, k=rng.randrange(10, 60)) + passage for _ in range(40)]
    texts += [base[:k] for k in range(60, 81)]
    texts += [rng.choices(vocabulary[:3], k=rng.randrange(0, 7)) for _ in range(30)]
    rows = [(i, " ".join(w).upper() if rng.random() < 0.2 else "\t".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert joined(spark, rows) == by_text(plain_components(rows))


def test_jaccard_join_at_the_threshold(spark):
    """Sets of 10 shingles that share 8 of 10 (8 of 12: apart), and 80 of exactly 100."""
    words = [f"a{i}" for i in range(200)]
    rows = [
        (1, " ".join(words[:14])),
        (2, " ".join(words[2:16])),
        (10, " ".join(words[:94])),  # 90 shingles
        (11, " ".join(words[10:104])),  # 90 more, of which 80 are the same: 80 of 100
        (12, " ".join(words[21:115])),  # 79 of 101 with the one before
    ]
    assert joined(spark, rows) == [(1, 10, 1), (2, 10, 2), (10, 90, 10), (11, 90, 10), (12, 90, 12)]


def test_jaccard_join_edges(spark):
    long_text = " ".join(f"v{i % 5000}x{i % 7}" for i in range(40_000))
    rows = [
        (5, None), (6, ""), (7, " \n"), (None, None), (8, "One two"), (3, "one\vTWO"), (9, "one two three"),
        (None, "only here and nowhere else at all"), (4, long_text), (2, long_text), (None, long_text), (2, "one two"),
    ]
    assert joined(spark, rows) == by_text(plain_components(rows))
    assert joined(spark, rows[:1]) == [(5, 0, 5)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_documents(empty).count() == 0
    odd = spark.createDataFrame(
        [(1, "a b c d e f", 5, "x", 2), (2, "A b c d e f", None, None, 1)],
        "doc_id long, text string, block long, component string, n int",
    )
    assert sorted(tuple(r) for r in jaccard.similar_documents(odd).collect()) == [(1, 2, 1), (2, 2, 1)]


def test_jaccard_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_ngram_jaccard"](spark, SMALL).collect()
    expected = plain_components([tuple(r) for r in docs])
    assert by_text(tuple(r) for r in found) == by_text(expected)
    assert any(i != c for i, _, c in expected)


def similar_pair(rng, n, percent):
    """Two random sets of about ``n`` hashes, as similar as the percent says or just not."""
    common = [rng.getrandbits(64) for _ in range(n * percent // 100)]
    rest = [rng.getrandbits(64) for _ in range(n - len(common))]
    cut = rng.randrange(len(rest) + 1)
    return sorted(common + rest[:cut]), sorted(common + rest[cut:])


def test_bit_strings_lose_no_link_and_drop_most_others(spark):
    rng = random.Random(5)
    sizes = [1, 2, 5, 63, 64, 65, 120, 129, 256, 257, 300, 700, 1025]
    wanted = [(n, percent) for n in sizes for percent in (80, 82, 90, 100, 40) for _ in range(4)]
    sets = [x for n, percent in wanted for x in similar_pair(rng, n, percent)]
    n = np.array([len(x) for x in sets])
    hashes = np.array([h for x in sets for h in x], np.uint64)
    words, begins = jaccard.parities(hashes, np.repeat(np.arange(len(sets)), n), n)
    rows = [(i, int(n[i]), (0, words[begins[i] : begins[i + 1]].tolist())) for i in range(len(sets))]
    classes = spark.createDataFrame(rows, "node long, n long, home struct<block: long, bits: array<long>>")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, len(sets), 2)], "a long, b long")
    kept = {r.a for r in jaccard._near_in_bits(pairs, classes).collect()}
    linked = set()
    for i in range(0, len(sets), 2):
        a, b = set(sets[i]), set(sets[i + 1])
        if 100 * len(a & b) >= 80 * len(a | b):
            linked.add(i)
    assert len(linked) > 150 and linked <= kept
    unlike = {2 * k for k, (size, percent) in enumerate(wanted) if percent == 40 and size > 100}
    assert len(unlike & kept) < len(unlike) / 10


def test_counts_keep_their_values_in_any_width():
    for most in (0, 1, 255, 256, 65_535, 65_536, 1 << 32, 1 << 40):
        counts = np.zeros(1 << 10, np.int64)
        counts[7] = most
        assert (jaccard.unpack_counts(jaccard.pack_counts(counts)) == counts).all()


def test_prefix_length():
    n = np.arange(0, 2000)
    needed = np.array([-(-80 * k // 100) for k in n.tolist()])
    assert (jaccard.prefix_length(n)[1:] == (n - needed + 1)[1:]).all() and jaccard.prefix_length(n)[0] == 0


# --- periodic runs ---------------------------------------------------------------------


def plain_runs(words):
    """Every period at every place; of the same stretch the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n = len(words)
    if plant and n and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def random_words(rng, size, letters):
    words = []
    while len(words) < size:
        if rng.random() < 0.4:
            root = [rng.randrange(letters) for _ in range(rng.randint(1, 15))]
            words += (root * 20)[: rng.randint(1, 5 * len(root))]
        else:
            words += [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
    return words[:size]


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = [random_words(rng, rng.choice([0, 1, 11, 40, 150]), rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(1, 6))]
        lengths = np.array([len(d) for d in docs])
        words = np.array([x + 31 * i for i, d in enumerate(docs) for x in d], np.int64)
        starts = np.cumsum(lengths) - lengths
        expected = [(s + o, s + n + o, q) for d, o in zip(docs, starts.tolist()) for s, n, q in plain_runs(d)]
        assert [tuple(r) for r in periodic.find_runs(words, lengths).tolist()] == expected


def test_grammar_spells_the_text():
    rng = random.Random(4)
    words = np.array(random_words(rng, 3000, 4), np.int64)
    grammar = periodic.Grammar(words, np.ones(len(words) - 1, bool))

    def spell(symbol):
        if symbol < grammar.base:
            return [symbol]
        k = symbol - grammar.base
        return spell(int(grammar.left[k])) + spell(int(grammar.right[k]))

    for k, place in enumerate(grammar.place.tolist()):
        assert spell(grammar.base + k) == words[place : place + grammar.size[grammar.base + k]].tolist()
    cuts = [0, *sorted(grammar.cuts.tolist())]
    top = dict(zip(grammar.top_places.tolist(), grammar.top_symbols.tolist(), strict=True))
    assert [x for c in cuts for x in spell(top.get(c, int(words[c])))] == words.tolist()
    # No pair of neighbours at the top is there twice, as far as they do not overlap.
    symbols = [top.get(c, int(words[c])) for c in cuts]
    seen = defaultdict(list)
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        seen[pair].append(i)
    assert all(max(at) - min(at) <= 1 for at in seen.values())
    rules, spots = grammar.places(np.ones(len(grammar.left), bool))
    uses = Counter(rules.tolist())
    assert min(uses.values()) >= 2 and len(uses) == len(grammar.left)
    assert len(set(zip(rules.tolist(), spots.tolist()))) == len(rules)


def test_long_periods_take_time_in_proportion():
    """One word, or a line, very many times: candidates stay few, as the grammar is small."""
    for words in ([0] * 16, [0] * 100_000, list(range(10)) * 20_000):
        runs = periodic.find_runs(np.array(words, np.int64), np.array([len(words)]))
        assert runs.tolist() == [[0, len(words), len(set(words))]]


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len((r.text or "").split()) < 3000]
    found = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert len(found) == len(docs) and len(short) > 150
    for r in short:
        assert found[r.doc_id] == plain_row(r.doc_id, r.text)
    assert sum(r[1] > 0 for r in found.values()) > 10


def test_runs_edges(spark):
    line = "la la li " * 30
    rows = [(1, None), (2, ""), (3, " \t"), (None, line), (4, line), (4, line), (5, "x " * 11), (6, "x " * 12), (7, "日 本 " * 9)]
    docs = spark.createDataFrame([(*r, 9, "y") for r in rows], "doc_id long, text string, n_runs int, start string")
    found = periodic.collapse_runs(docs, digest=True, plant=True)
    assert by_text(tuple(r) for r in found.collect()) == by_text(plain_row(i, t) for i, t in rows)
    plain = periodic.collapse_runs(docs).filter("doc_id = 4").collect()
    assert [(r.n_runs, r.collapsed, [tuple(x) for x in r.runs]) for r in plain] == [(1, "la la li", [(0, 90, 3)])] * 2
    assert periodic.collapse_runs(docs.filter("false"), digest=True).count() == 0


# --- prefix trie -----------------------------------------------------------------------


def plain_trie(turns, family=100):
    """Nodes of all distinct prefixes, by brute force."""

    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if family else 0
        base = c - int(np.fmod(c, family)) if family else c
        built[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    rows = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        inner = {x[:-1] for x in below if x}
        rows.append(
            (
                convs[0], len(node), members[node[:-1]][0] if node else None, len(convs),
                sum(len(x) == len(node) + 1 for x in below), sum(x not in inner for x in below),
                sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
                sha(",".join(str(c) for c in convs if len(built[c]) == len(node))),
            )
        )
    return by_text(rows)


TURNS = "conv_id long, turn long, role string, text string"


def trie(spark, rows, monkeypatch, shard_turns, family=100):
    monkeypatch.setattr(prefixes, "SHARD_TURNS", shard_turns)
    found = prefixes.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(4), family=family)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return by_text(tuple(r) for r in found.collect())


@pytest.mark.parametrize("shard_turns, family", [(7, 100), (10**6, 100), (7, 0)])
def test_trie_of_random_conversations(spark, monkeypatch, shard_turns, family):
    """Shared openings and whole copies over many shards; ties, nulls, gaps and negative ids."""
    rng = random.Random(shard_turns)
    opening = [("user", f"opening {i} ü") for i in range(12)]
    rows = []
    for c in [*range(-120, 130), 1000, 2050, 2051, 10**12]:
        kind = rng.random()
        turns = opening[: rng.randint(0, 12)] if kind < 0.5 else []
        turns = turns + [(rng.choice("ab"), rng.choice(["x", "yy", ""])) for _ in range(rng.randint(kind >= 0.5, 4))]
        rows += [(c, rng.choice([i, i, i, None]), r, t) for i, (r, t) in enumerate(turns)]
    rows += [(None, 1, "user", "nobody"), (7, 3, None, None), (7, 3, None, None)]
    rng.shuffle(rows)
    assert trie(spark, rows, monkeypatch, shard_turns, family) == plain_trie(rows, family)


def test_trie_edges(spark, monkeypatch):
    empty = spark.createDataFrame([], TURNS)
    assert prefixes.prefix_trie(empty, family=100).count() == 0
    # Of conversation 101 all turns may be replaced by those of 100, which is not there.
    lonely = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(lonely, 0, "user", "gone")]
    assert trie(spark, rows, monkeypatch, 7) == plain_trie(rows) == [(lonely, 0, None, 1, 0, 1, 0, sha(str(lonely)))]
    clash = spark.createDataFrame([(1, 0, "a", "b", 5, "z")], TURNS + ", shard int, size string")
    assert prefixes.prefix_trie(clash).count() == 2


def test_trie_query(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = by_text(tuple(r) for r in QUERIES["op13_prefix_trie"](spark, SMALL).collect())
    assert found == plain_trie([tuple(r) for r in turns.collect()])


def test_queries_take_the_whole_table(spark):
    """No id subset: a row for each document, and members of the root for each conversation."""
    for name in ("op11_ngram_jaccard", "op12_periodic_runs"):
        assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    root = QUERIES["op13_prefix_trie"](spark, SMALL).filter("depth = 0").select(F.sum("n_convs")).first()[0]
    assert root == spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
