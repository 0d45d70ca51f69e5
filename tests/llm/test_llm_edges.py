"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for every operator."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from farelight.llm import bpe, langid, mixing, privacy, quality, simhash, substrings, suffixes, topk, toxicity

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, block long, component string, label string, _doc string, _text string, _keep long, parts string, n_words int"
)
EXTRA = (None, 1, "x", "y", None, "t", 3, "p", 4)
LONG = " ".join(f"word{i % 900}x{i % 7}" for i in range(30_000))
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 3
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, SAME, "en", "a", len(SAME)),
    (4, SAME, "en", "a", len(SAME)),
    (5, SAME, None, "b", None),
    (None, SAME + "more", "de", "b", 7),
    (None, None, "de", "b", 7),
    (6, LONG, "en", "c", len(LONG)),
    (7, "x" * 5000, "xx", "c", 5000),
    (8, "日本語のテキスト" * 40, "ja", "c", 320),
]
BPE = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, 1, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda d: substrings.remove_repeats(d),
    "op2": lambda d: suffixes.remove_repeats(d),
    "op4": lambda d: bpe.encode(d, *BPE),
    "op5": lambda d: langid.identify(d),
    "op6": lambda d: privacy.find(d),
    "op7": lambda d: mixing.mixture(d),
    "op8": lambda d: quality.judge(d),
    "op9": lambda d: simhash.near_duplicates(d),
    "op10": lambda d: toxicity.score_toxicity(d, labels(d.sparkSession)),
}
STAGES = {
    "quality": quality.keep_good,
    "simhash": simhash.drop_near_duplicates,
    "pii": privacy.redact,
    "mixing": mixing.mix_documents,
}


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each(edge, name):
    assert OPERATORS[name](edge).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(edge, name):
    assert OPERATORS[name](edge.filter("false")).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(edge, name):
    out = STAGES[name](edge)
    assert out.columns == edge.columns
    assert out.dtypes == edge.dtypes
    assert STAGES[name](edge.filter("false")).count() == 0
    assert out.filter("component is null or _doc is null").count() in (0, out.filter("_doc is null").count())


def test_stage_decisions(edge):
    kept = {(r.doc_id, r.text) for r in quality.keep_good(edge).collect()}
    assert not any(t is None or not t.strip() for _, t in kept)
    rest = simhash.drop_near_duplicates(edge).groupBy("doc_id").count().collect()
    counts = {r["doc_id"]: r["count"] for r in rest}
    # 1, 2 and 3 have no words and the same fingerprint; 5 is a copy of 4; rows without id stay.
    assert counts == {1: 1, 4: 1, 6: 1, 7: 1, 8: 1, None: 2}


def test_values(edge):
    scores = {r.doc_id: r for r in langid.identify(edge).collect()}
    assert (scores[1].lang_pred, scores[2].lang_pred, scores[3].lang_pred) == ("und",) * 3
    tokens = {r.doc_id: r for r in bpe.encode(edge, *BPE).collect()}
    assert (tokens[1].n_tokens, tokens[1].ids, bytes(tokens[1].decoded)) == (0, "", b"")
    assert bytes(tokens[8].decoded).decode() == ROWS[-1][1]
    mixed = {r.doc_id: r for r in mixing.mixture(edge).collect()}
    assert mixed[1]["size"] == 0 and mixed[1].taken == 0


def test_search_edges(spark):
    rows = [
        (0, [0.5, 0.25], "a"),
        (50, None, "a"),
        (1, [0.5, None], "a"),
        (2, [float("nan"), 1.0], "a"),
        (3, [0.5, float("inf")], "a"),
        (4, [0.5, 0.25], "a"),
        (5, [0.5, 0.25], "a"),
        (6, [], "a"),
        (None, [1.0, 1.0], "a"),
        (7, [-0.001], "a"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string")
    asked = F.col("vec_id") % 50 == 0
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(vectors, asked, 3).collect()]
    assert sorted(found) == [(0, 1, 4, 20480), (0, 2, 5, 20480), (0, 3, 6, 0)]
    assert topk.search(vectors.filter("false"), asked).count() == 0
    large = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        topk.search(large, asked).collect()


def test_batches_of_one_label(spark):
    """Batches without a toxic text, or with blank texts alone, have the schema of all others."""
    docs = spark.createDataFrame(
        [(i, "you utter scum and trash" if i % 7 == 0 and i > 60 else f"a fine day {i}", "en") for i in range(90)]
        + [(i, "", "de") for i in range(90, 99)],
        "doc_id long, text string, lang string",
    ).coalesce(1)
    labels = docs.selectExpr("doc_id", "int(text like '%scum%') as toxic")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = toxicity.score_toxicity(docs, labels).collect()
        assert len(rows) == 99 and len(langid.identify(docs).collect()) == 99
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    scores = {r.doc_id: r.score for r in rows}
    assert min(scores[i] for i in (63, 70, 77, 84)) > max(scores[i] for i in (61, 62, 64, 90))


def test_passages_of_low_scores(spark, monkeypatch):
    """All significant passages are returned, also of a text that the curve scores low."""
    model = toxicity.Model({"scum": 5.0, "trash": 4.0}, weights=(-20.0, 0.5, 0.5, 0.0))
    monkeypatch.setattr(toxicity, "learn", lambda *_: model)
    text = "scum trash " + "a fine day " * 40 + "trash scum"
    docs = spark.createDataFrame([(1, text), (2, "a fine day"), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels(spark)).collect()}
    assert rows[1].score < 0.1 and rows[1].predicted == 0
    assert [(p.start, p.end) for p in rows[1].passages] == [(0, 2), (122, 124)]
    assert rows[2].passages == rows[3].passages == []


class Marks(privacy.Tagger):
    """A tagger that takes each run of ``日`` and ``@`` for an address, whatever its window."""

    def emissions(self, windows):
        inside = np.isin(windows.T, (5, 6 + privacy._SIGNS.index("@")))[:, :, None]
        return np.where(inside, [0.0, 12, 10, 0, 0, 0, 0, 0, 0], [10.0, 0, 0, 0, 0, 0, 0, 0, 0]), ()


def test_length_and_place_of_a_span_do_not_decide():
    model = Marks(privacy.Tagger.fresh().weights)
    model.weights["move"][:] = -50.0
    for before, after in ((0, 0), (0, 1), (1, 2), (2, 2), (2, 0)):
        model.weights["move"][before, after] = 0.0
    texts, want = [], []
    for size in (8, 31, 32, 43, 62, 63, 64, 100, 400):
        for start in range(66):
            for at in (0, size // 2, size - 1):
                span = "日" * at + "@" + "日" * (size - at - 1)
                texts.append("a" * max(0, start - 1) + " " * (start > 0) + span + " plain words" * (start % 3 * 20))
                want.append(([], [("email", start, start + size)]))
    texts.append("")
    want.append(([], []))
    assert privacy.find_spans(texts, model) == want
    assert privacy.find_spans(texts[::7], model, 3) == want[::7]  # windows of a run in several batches


def test_pipeline_writes_token_ids(spark):
    """The last stage's ids are those of the text, and the digests are of the same."""
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        words = {int(n): base64.b64decode(w) for w, n in (line.split() for line in f if line.strip())}
    texts = {1: "Two words, 12 numbers", 2: "日本 é", 3: "", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = corpus_pipeline.tokens(spark, docs, "").collect()
    assert len(rows) == 4
    for r in rows:
        ids = [int(i) for i in r.ids.split(",")] if r.ids else []
        data = b"".join(words[i] for i in ids)
        assert data == (texts[r.doc_id] or "").encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(r.ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(data).hexdigest()


def test_unrelated_rows_of_one_id_stay(spark):
    """Of near copies one row stays; rows that share only their id are not taken for copies."""
    texts = [" ".join(f"{w}{i * k % 97}" for i in range(60)) for k, w in ((1, "a"), (2, "b"), (3, "c"))]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2]), (3, texts[0]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()]
    expected = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[0])]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("partitions", [3, 40])
def test_near_duplicates_leave_texts_where_they_are(spark, monkeypatch, partitions):
    """Rows in blocks of several partitions come back as chosen, and no text is shuffled."""
    from farelight.llm import rows

    monkeypatch.setattr(rows, "BLOCK_BITS", 9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    docs = spark.range(0, 100_000, 1, 3).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 20).alias("text"))
    written = rows.write_rows(docs, "text")
    chosen = written.filter("doc_id % 7 = 3").select(rows.BLOCK, rows.PLACE)
    kept = rows.keep_rows(written, chosen)
    assert kept.columns == ["doc_id", "text"]
    assert [r.doc_id for r in kept.orderBy("doc_id").select("doc_id").collect()] == [i for i in range(100_000) if i % 7 == 3]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("text#") and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    spark.conf.set("spark.sql.shuffle.partitions", before)
    text = next(line for line in plan.splitlines() if "FileScan" in line and "text#" in line)
    assert "Bucketed: true" in text
    assert "BucketedScan" not in text and "disabled" not in text
