from collections import Counter

import pytest

from farelight.operators import text

LINES = ["", "!!!", "--a b!", "Café au lait", "The the THE", "x_1 2", "trailing, ", " lead"]


def frame(spark, lines=LINES, column="value"):
    return spark.createDataFrame([(line,) for line in lines], f"{column} string")


def counts(df):
    return {r[0]: r[1] for r in df.collect()}


def test_word_count_drops_empty_tokens(spark):
    found = counts(text.word_counts(frame(spark)))
    assert "" not in found
    assert found["the"] == 3
    assert found["caf"] == 1 and "café" not in found
    assert found["x_1"] == found["2"] == found["a"] == found["b"] == 1


def test_reference_mode_keeps_the_empty_tokens_a_split_gives(spark):
    found = counts(text.word_counts(frame(spark), mode="reference"))
    # the empty line, "--a b!" and " lead"; not "!!!", whose tokens are all trailing
    assert found.pop("") == 3
    assert found == counts(text.word_counts(frame(spark)))


def test_char_counts_and_top(spark):
    df = frame(spark, ["aAé", "\U0001f600a b", ""])
    found = text.char_counts(df)
    assert counts(found) == Counter("aAé\U0001f600a b")
    assert [tuple(r) for r in text.top_n(found, 2).collect()] == [("a", 2), (" ", 1)]


def test_text_stats(spark):
    rows = [("s", ""), ("s", "one"), ("s", "one\n"), ("s", "a\r\nb\rc"), ("s", "\n\n"), ("t", "é\U0001f600")]
    df = spark.createDataFrame(rows, "source string, value string")
    found = {r.source: (r.n_texts, r.n_chars, r.n_lines) for r in text.text_stats(df, "source").collect()}
    assert found == {"s": (5, 0 + 3 + 4 + 6 + 2, 0 + 1 + 1 + 3 + 2), "t": (1, 2, 1)}


def test_char_counts_of_nulls_long_texts_and_nothing(spark):
    long = "é\U0001f600ab" * 50_000
    df = spark.createDataFrame([(None,), ("",), (long,), ("b\n\x00",)], "value string").repartition(3)
    assert counts(text.char_counts(df)) == Counter(long + "b\n\x00")
    assert counts(text.char_counts(df.filter("value = 'none'"))) == {}


def test_a_task_sends_a_row_per_distinct_character(spark):
    df = frame(spark, ["abc" * 1000] * 100).repartition(2)
    plan = text.char_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.index("hashpartitioning(char") < plan.index("MapInArrow")


def even(spark):
    """300 words of which each has 20 rows, but ten that have up to 29."""
    many = [f"w{i:03}" for i in range(300) for _ in range(20)] + [f"w{i:03}" for i in range(10) for _ in range(i)]
    return frame(spark, many, "word"), Counter(many)


def largest(counter, n):
    return sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:n]


def test_most_frequent_is_exact_whether_or_not_the_sketch_can_tell(spark):
    df, all_counts = even(spark)
    for tracked in (16, 64, 1024):
        found = text.most_frequent(df.repartition(8), 5, tracked=tracked)
        assert [tuple(r) for r in found.collect()] == largest(all_counts, 5)


def test_most_frequent_counts_candidates_only_if_they_suffice(spark):
    rare = [f"r{i}" for i in range(5000)]
    many = ["a"] * 9000 + ["b"] * 8000 + ["c"] * 8000 + rare
    df = frame(spark, many, "word").repartition(8)
    found = text.most_frequent(df, 3, tracked=64)
    assert [tuple(r) for r in found.collect()] == [("a", 9000), ("b", 8000), ("c", 8000)]
    # The result comes from the stored counts of candidates, not from the words.
    assert "Scan parquet" in found._jdf.queryExecution().executedPlan().toString()


def test_most_frequent_of_little(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",), ("x",)], "word string")
    assert [tuple(r) for r in text.most_frequent(df, 5).collect()] == [("x", 2), ("y", 1)]
    assert text.most_frequent(df.filter("word is null"), 5).collect() == []


def test_file_stats(spark, tmp_path):
    contents = {
        "closed.txt": b"one\ntwo\n",
        "open.txt": "é\U0001f600\n\nlast".encode(),
        "dos.txt": b"a\r\nb\r\n",
        "mark.txt": b"\xef\xbb\xbfab\nc",
        "feed.txt": b"\n",
        "empty.txt": b"",
        "sub/inner.txt": b"x" * 100_000 + b"\n" + b"y\n" * 50_000,
    }
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        found = {r.path.split("/")[-1]: (r.n_bytes, r.n_chars, r.n_lines) for r in text.file_stats(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {}
    for name, data in contents.items():
        if not data:  # no task reads it
            continue
        chars = data.decode("utf-8-sig")
        expected[name.split("/")[-1]] = (len(data), len(chars), chars.count("\n") + (chars != "" and chars[-1] != "\n"))
    assert found == expected


def test_file_stats_refuses_compressed_files(spark, tmp_path):
    frame(spark, ["a" * 500, "b"]).write.option("compression", "gzip").text(str(tmp_path / "packed"))
    with pytest.raises(Exception, match="Not a plain text file"):
        text.file_stats(spark, str(tmp_path / "packed")).collect()
