"""What Python workers hold between tasks, and small tables that need no workers of their own."""

import time

import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from farelight.llm import bpe, mixing

BPE = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_no_duckdb_is_left_open_between_tasks(spark):
    def probe(batches):
        for _ in batches:
            time.sleep(0.3)
            models = list(bpe._ENCODERS.values())
            still = [m for m in models if m.__dict__.get("db") or m.__dict__.get("_db")]
            yield pa.RecordBatch.from_pydict({"models": [len(models)], "still": [len(still)]})

    docs = spark.range(0, 64, 1, 8).select(
        F.col("id").alias("doc_id"), F.expr("concat('unheard', id, 'zyxwv jjkkzz', id * 977)").alias("text")
    )
    texts = {r.doc_id: r.text for r in docs.collect()}
    for _ in range(2):  # the second time, workers open it again
        for r in bpe.encode(docs, *BPE).collect():
            assert bytes(r.decoded).decode() == texts[r.doc_id]
        seen = spark.range(0, 16, 1, 16).mapInArrow(probe, "models long, still long").collect()
        assert sum(r.models for r in seen) > 0
        assert sum(r.still for r in seen) == 0


def test_an_encoder_goes_on_after_a_rest():
    ranks = bpe.read_ranks(BPE[0])
    model, fresh = bpe.Encoder(ranks), bpe.Encoder(ranks)
    model.learn(["unheardzyxwv"])
    model.rest()
    model.rest()
    both = ["unheardzyxwv", "qqvvxxjjkk", "ab" * 300]
    assert model.learn(both) == fresh.learn(both)


def test_slots_and_sources_come_without_python_rows(spark):
    sources = [mixing.Source(0, "a", 5000, 4000.0, 0), mixing.Source(1, None, 300, 500.0, 5000)]
    slots = mixing.slots(spark, sources)
    assert "ExistingRDD" not in slots._jdf.queryExecution().toString()
    assert slots.count() == sum(s.slots for s in sources)
    sized = spark.createDataFrame([(0, 1, "a", 5000), (1, 2, None, 300)], "row long, doc_id long, source string, size long")
    rows = mixing.place(sized, sources).select("row", "number", "source_size", "target", "at", "block_words").collect()
    assert sorted(map(tuple, rows)) == [(0, 0, 5000, 4000.0, 0, 19), (1, 1, 300, 500.0, 0, 1)]
    assert mixing.slots(spark, []).count() == 0
