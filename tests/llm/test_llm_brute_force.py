"""Operators against plain Python on small tables, and learned models on rows held out."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from farelight.llm import bpe, components, langid, mixing, privacy, quality, simhash, substrings, suffixes, topk, toxicity
from farelight.llm.queries import ORACLE, QUERIES
from tests.llm.test_llm_edges import BPE

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").repartition(4).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_substrings(docs, texts):
    seen, want = set(), {}
    for i, text in sorted(texts.items()):
        words = text.encode().split()
        gone = bytearray(len(words))
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone[at : at + 20] = b"\1" * 20
            seen.add(window)
        want[i] = (len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    got = substrings.remove_repeats(docs, digest=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def repeated_bytes(texts):
    count = Counter()
    for text in texts.values():
        data = text.encode()
        count.update(hashlib.blake2b(data[i : i + 200], digest_size=10).digest() for i in range(len(data) - 199))
    want = {}
    for k, text in texts.items():
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 199):
            if count[hashlib.blake2b(data[i : i + 200], digest_size=10).digest()] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[k] = (len(data), int(gone.sum()), spans, sha(np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return want


def test_suffixes(spark, docs, texts):
    got = suffixes.remove_repeats(docs, digest=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == repeated_bytes(texts)
    rng = random.Random(5)
    base = "".join(rng.choice("abc ") for _ in range(3000))
    odd = {1: base, 2: "a" * 1000, 3: "ab" * 300, 4: "ba" * 100, 5: base[:199], 6: "日本" * 90 + base[40:250]}
    for k in range(40):
        a, pad = rng.randint(0, 2500), "".join(rng.choice("de") for _ in range(rng.randint(0, 60)))
        odd[10 + k] = pad + base[a : a + rng.randint(190, 420)] + pad[::-1]
    got = suffixes.remove_repeats(spark.createDataFrame(list(odd.items()), "doc_id long, text string"), digest=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == repeated_bytes(odd)


def test_hot_anchors(spark):
    """A passage with other neighbours in each text: nothing meets by its anchors beyond the bound."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abc ") for _ in range(700))
    own = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(300)]
    odd = {k: own[k] + passage + own[(k + 1) % 300 if k % 10 == 0 else k][::-1] for k in range(300)}
    docs = spark.createDataFrame(list(odd.items()), "doc_id long, text string").repartition(6)
    want, blocks = repeated_bytes(odd), suffixes.write_blocks(docs, "text", "doc_id").collect()
    blocks = [suffixes.Block(r.block, r.ids, r.lengths, r.data) for r in blocks]
    asked = [(b.number, suffixes._ask_anchors(b, 1).column("packed")[0].as_py()) for b in blocks]
    met = suffixes._meet_anchors([p for _, p in asked], 255)
    keys = Counter()
    for b, answer in zip(blocks, met, strict=True):
        keys.update(suffixes.Stretches(b, [{"cell": 0, "answer": answer}], 1).key.tolist())
    assert max(keys.values(), default=0) <= 255
    for hot in (1, 4, 255):
        got = suffixes.remove_repeats(docs, digest=True, hot=hot).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(3000):
        symbols = [rng.randint(0, rng.choice([0, 1, 2, 9])) for _ in range(rng.randint(0, 30))]
        assert suffixes.sort_suffixes(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_topk_with_ties(spark):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-2, 3, (400, 6)) / 256.0
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    whole = np.floor(vectors * 256).astype(int)
    want = {}
    for q in range(0, 400, 50):
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-int(whole[i] @ whole[q]), i))[:5]
        want |= {(q, n): (i, int(whole[i] @ whole[q])) for n, i in enumerate(order, 1)}
    assert got == want


@pytest.mark.parametrize(("size", "asking", "held"), [(5, 3, 2), (64, 16, 512)])
def test_topk_over_many_blocks(spark, monkeypatch, size, asking, held):
    """Common and rare terms, small and large weights, repeated ids, blocks with fewer rows than k."""
    for name, value in (("CANDIDATES", size), ("QUERIES", asking), ("HELD", held)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    whole = np.hstack([rng.integers(-2, 3, (300, 6)), rng.integers(-300, 300, (300, 40)) * (rng.random((300, 40)) < 0.02)])
    whole[rng.random(300) < 0.02, 1] = 70_000_000
    lengths = rng.integers(0, 47, 300)
    whole[np.arange(46) >= lengths[:, None]] = 0
    ids = rng.integers(0, 150, 300)
    rows = [(int(i), (v[:n] / 256.0).tolist()) for i, v, n in zip(ids, whole, lengths, strict=True)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.search(vectors, F.col("vec_id") % 10 == 0, k=7)
    want = []
    for i in np.flatnonzero(ids % 10 == 0):
        scores = whole @ whole[i]
        order = sorted((j for j in range(300) if ids[j] != ids[i]), key=lambda j: (-int(scores[j]), ids[j]))[:7]
        want += [(int(ids[i]), n, int(ids[j]), int(scores[j])) for n, j in enumerate(order, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_topk_sends_no_copies_of_queries(spark):
    """A block of queries meets all blocks of candidates, but no copy of it for each of them is made or broadcast."""
    rows = [(i, [i / 256.0, 1.0]) for i in range(200)]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "SortMergeJoin" not in plan
    assert found.count() == 20


def test_bpe_against_the_library(docs, texts):
    import tiktoken

    ranks = bpe.read_ranks(BPE[0])
    library = tiktoken.Encoding("own", pat_str=BPE[1], mergeable_ranks=ranks, special_tokens={})
    for r in bpe.digest(docs, *BPE).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())
    model = bpe.Encoder(ranks)
    rng = random.Random(2)
    odd = ["a" * 700, "ab" * 300, "!?" * 200, " " * 300, "".join(rng.choice("etaoinshr") for _ in range(400)), "日本語" * 60]
    for piece, (ids, n, data) in model.learn(odd).items():
        assert list(map(int, ids.split(","))) == library._encode_single_piece(piece) or len(piece) == 0
        assert (n, data) == (len(ids.split(",")), piece.encode())
    split = bpe.splitter(BPE[1])
    signs = [chr(c) for c in range(0x180)]
    import regex

    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 20)))
        assert split(text) == regex.findall(BPE[1], text)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_spans(text):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits)) % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", m))
    return privacy.in_order([(k, m.start(), m.end()) for k, m in found])


def test_base_spans():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-+ 2(5") for _ in range(rng.randint(0, 40)))
        assert privacy.base_spans(text) == plain_spans(text)


def test_tagger_gradient_and_reconciling():
    model, rng = privacy.Tagger.fresh(), np.random.default_rng(0)
    windows = rng.integers(0, privacy._N_CLASSES, (2, privacy.WINDOW)).astype(np.int8)
    tags = rng.integers(0, 9, (2, privacy.WINDOW)).astype(np.int8)

    def likelihood():
        scores, _ = model.emissions(windows)
        wanted = tags.T.astype(int)
        path = np.take_along_axis(scores, wanted[:, :, None], 2)[:, :, 0].sum(0)
        return (path + model.weights["move"][wanted[:-1], wanted[1:]].sum(0) - model.marginals(scores)[3]).mean()

    slopes = model.slopes(windows, tags)
    for name, values in model.weights.items():
        at, step = tuple(rng.integers(0, n) for n in values.shape), 1e-5
        values[at] += step
        above = likelihood()
        values[at] -= 2 * step
        below = likelihood()
        values[at] += step
        assert math.isclose((above - below) / (2 * step), slopes[name][at], abs_tol=1e-5)
    found = [(0.95, ("ip", 0, 10)), (0.99, ("card", 8, 30)), (0.99, ("phone", 40, 50)), (0.5, ("ip", 60, 70))]
    assert privacy.reconcile(found, [("email", 45, 60)]) == [("card", 8, 30)]


def test_pii_query(docs, texts):
    for r in privacy.find(docs).collect():
        want = plain_spans(texts[r.doc_id])
        written_out = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == sha(",".join(written_out).encode())
        assert set(written_out) <= set(r.spans.split(",") if r.spans else [])
        assert r.n_card == sum(k == "card" for k, _, _ in want)


def test_mixture(docs):
    rows = mixing.mixture(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    assert all(r["size"] == len(r.text.encode().split()) and 0 <= r.taken <= 2 * r["size"] for r in rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    # Half a block by rounding, and less than one because the last block of a source is short.
    assert all(abs(taken[s] - target[s]) <= max(2, 1.5 * size[s] / mixing.BLOCKS) for s in size)
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()))
    again = {r.doc_id: r.taken for r in mixing.mixture(docs).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    mixed = mixing.mix_documents(docs).collect()
    words = Counter()
    for r in mixed:
        words[r.doc_id] += len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in again.items() if v})


def test_targets_and_permutation():
    # 450 words by 5, 2, 1: the first may have 200, and 250 are shared by 2 and 1.
    assert np.allclose(mixing.targets([100, 100, 100]), [200, 500 / 3, 250 / 3])
    # 1545 words; the caps of 20 and 40 bind, and the rest goes to the source in the middle.
    assert mixing.targets([10, 1000, 20]) == [20.0, 1485.0, 40.0]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    for n in (1, 2, 3, 10, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, 7)) == list(range(n))


def test_quality(docs, texts):
    for r in quality.judge(docs).select("_doc.doc_id", "*").collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if x.split()]
        where = defaultdict(list)
        for i in range(len(words) - 7):
            where[tuple(words[i : i + 8])].append(i)
        repeat = len({p for v in where.values() if len(v) > 1 for i in v for p in range(i, i + 8)})
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(words) < 20 or 100 * repeat > 30 * len(words)
        assert r.base_failed == failed and not (failed and r.kept) and r.kept == (r.first_reason is None)


def test_cascade_order_does_not_matter(docs):
    there = {r.doc_id: r.kept for r in quality.judge(docs).select("_doc.doc_id", "kept").collect()}
    back = quality.judge(docs, rules=quality.RULES[::-1]).select("_doc.doc_id", "kept").collect()
    assert there == {r.doc_id: r.kept for r in back}
    for rules in (quality.RULES, quality.RULES[::-1]):
        kept = quality.keep_good(docs, rules=rules).collect()
        assert {r.doc_id for r in kept} == {i for i, good in there.items() if good}
        assert len(kept) == sum(there.values())
    measured = quality.keep_good(docs)
    assert not re.search("Python|Arrow|Pandas", measured._jdf.queryExecution().executedPlan().toString())


def test_cascade_prefers_cheap_rules_that_reject(docs):
    never = quality.Rule("never", "n_words < 0", ("n_words",))
    found = quality.estimate(docs, "text", (never, *quality.RULES), rows=10**6)
    assert [e.worth for e in found] == sorted((e.worth for e in found), reverse=True)
    rejection = {e.rule.name: e.rejection for e in found}
    assert rejection["never"] == 0 < rejection["few_words"] < 1
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_fingerprint(text):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, texts):
    rows = simhash.near_duplicates(docs).collect()
    marks = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fp % 2**64 for r in rows} == marks
    low = dict.fromkeys(marks)
    for i in sorted(marks):
        if low[i] is None:
            todo = [i]
            while todo:
                at = todo.pop()
                if low[at] is None:
                    low[at] = i
                    todo += [j for j in marks if low[j] is None and (marks[at] ^ marks[j]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in rows} == low
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == set(low.values())


def test_ring_loses_no_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = [base]
    for bits in range(1, 7):
        copy = base.copy()
        for _ in range(bits):
            copy ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
        near.append(copy)
    marks = np.unique(np.concatenate(near))
    found = set()
    for first in range(5):
        for a, b in simhash.ring_links(marks, first):
            found |= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    close = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 4
    assert found == {(int(marks[i]), int(marks[j])) for i, j in zip(*np.nonzero(close), strict=True) if i < j}


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)] + [(5, 5)]
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert {r.node: r.component for r in got.collect()} == {v: root[v] for v in linked}


def test_maximal_segments():
    def plain(scores, start=0):
        best = max(((sum(scores[a:b]), -a, -b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a, b = -best[1], -best[2]
        return plain(scores[:a], start) + [(start + a, start + b, best[0])] + plain(scores[b:], start + b)

    rng = random.Random(6)
    for _ in range(400):
        # Sums of distinct powers do not tie, so the maximal segments are unique.
        scores = [rng.choice([-1, 1]) * 2.0 ** rng.choice(range(-12, 3)) + rng.random() / 64 for _ in range(rng.randint(0, 12))]
        got = [(a, b) for a, b, _ in toxicity.maximal_segments(scores)]
        assert got == [(a, b) for a, b, _ in plain(scores)]


def test_extreme_value_law():
    """Best segments drawn from the law give back its parameter, those below zero as zeros."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(50, 5000, 20_000)
    best = (np.log(0.002 * sizes) - np.log(-np.log(rng.random(len(sizes))))) / 1.5
    assert abs(toxicity.chance(np.maximum(best, 0), sizes, 1.5) / 0.002 - 1) < 0.05
    assert toxicity.chance(np.empty(0), np.empty(0), 1.5) == toxicity.DEFAULT_CHANCE


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    rows = rows.join(labels, "doc_id").filter("held_out").collect()
    hit = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(hit) >= 0.85 * len(hit) and sum(clean) <= 0.02 * len(clean)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = db.execute(ORACLE[name]).fetch_df()
    got = QUERIES[name](spark, SMALL).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.astype(str).values)) == sorted(map(tuple, want.astype(str).values))


def test_pipeline(spark, texts):
    """Every stage against plain Python on what the one before has left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL).cache()
        counts[name] = docs.count()
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "pii":
            assert not any(plain_spans(r.text) for r in docs.collect())
            assert docs.count() == before.count()
        if name == "source_mixing":
            want = {r.doc_id: r.taken for r in mixing.mixture(before).collect() if r.taken}
    assert len(texts) > counts["quality_rules"] > counts["simhash_near_dedup"] == counts["pii"]
    assert {r.doc_id for r in docs.collect()} == set(want)
    assert corpus_pipeline.run(spark, SMALL).count() == counts["byte_bpe"]
