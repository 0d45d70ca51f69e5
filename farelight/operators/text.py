"""Word and character counts and text statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farelight.functions.rules import check_mode
from farelight.session import written

_GAP = r"\W+"
_LINE_END = r"\r\n|\r|\n"


def words(text: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """One row per lower-case word, in column ``word``.

    Text is split at runs of non-word characters (ASCII, so accented letters separate)
    and lower-cased after. ``strict`` drops empty tokens. ``reference`` expects one line
    per row and keeps the empty token of an empty line, and the one in front of a line
    that starts with a gap and has a word.
    """
    check_mode(mode)
    line = F.col(column)
    if mode == "strict":
        tokens = text.select(F.explode(F.split(line, _GAP)).alias("word")).filter(F.col("word") != "")
    else:
        leading = (line == "") | line.rlike(r"^\W+\w")
        tokens = (
            text.select(leading.alias("leading"), F.posexplode(F.split(line, _GAP)).alias("pos", "word"))
            .filter((F.col("word") != "") | ((F.col("pos") == 0) & F.col("leading")))
        )
    return tokens.select(F.lower("word").alias("word"))


def word_counts(text: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    return words(text, column, mode).groupBy("word").agg(F.count("*").alias("count"))


def _histogram() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of code points over all texts of a partition: 9 MB, and one text at a time."""
        totals = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch.column(0).drop_null().cast(pa.binary()):
                points = np.frombuffer(text.as_py().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                counts = np.bincount(points)
                totals[: len(counts)] += counts
        seen = np.flatnonzero(totals)
        chars = pa.array([chr(point) for point in seen], pa.string())
        yield pa.RecordBatch.from_arrays([chars, pa.array(totals[seen])], ["char", "count"])

    # A local function travels by value, so executors need no copy of this package.
    return count


def char_counts(text: DataFrame, column: str = "value") -> DataFrame:
    """Frequency of every character, case kept; nulls count as empty.

    Each task counts into a table of code points, so what leaves it is a row per distinct
    character and never a row per character. No built-in function counts characters of a
    text in one go: replacing each distinct one in turn took seven times as long as a row
    per character, and this half of it.
    """
    per_task = text.select(F.col(column).cast("string")).mapInArrow(_histogram(), "char string, count long")
    return per_task.groupBy("char").agg(F.sum("count").alias("count"))


#: An item that is not among the tracked ones of the sketch has at most this many times
#: ``rows / tracked`` rows: twice the error bound of the sketch, which is 3.5 (fixed value).
MISSED = 7


def most_frequent(rows: DataFrame, n: int, key: str = "word", tracked: int = 65_536) -> DataFrame:
    """The ``n`` most frequent keys with their exact ``count``; the smaller key first on a tie.

    A sketch in one pass names at most ``tracked`` candidates, a second pass counts those
    exactly, and only they are shuffled. They hold all of the result if they make up all
    rows, or if the last of the result is more frequent than any key that the sketch can have
    lost. Where neither holds, as with keys that are all about as frequent, every key is
    counted. Null keys are left out.
    """
    keys = rows.select(F.col(key).alias(key)).filter(F.col(key).isNotNull())
    sketch = keys.agg(F.expr(f"approx_top_k({key}, {tracked}, {tracked})").alias("top"), F.count("*").alias("total"))
    candidates = written(sketch, "candidates")
    names = candidates.select(F.inline("top").alias(key, "estimate")).select(key)
    # At most ``tracked`` rows are broadcast.
    matched = keys.join(F.broadcast(names), key, "left_semi")
    exact = written(matched.groupBy(key).agg(F.count("*").alias("count")), "counts")
    top = top_n(exact, n, key)
    total = candidates.first()["total"]
    counted = exact.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    last, found = top.agg(F.min("count"), F.count("*")).first()
    if counted == total or (found == n and last * tracked > MISSED * total):
        return top
    return top_n(keys.groupBy(key).agg(F.count("*").alias("count")), n, key)


def top_words(text: DataFrame, n: int, column: str = "value", mode: str = "strict") -> DataFrame:
    """The ``n`` most frequent words, as :func:`words` gives them."""
    return most_frequent(words(text, column, mode), n)


def top_n(frequencies: DataFrame, n: int, key: str = "char", count: str = "count") -> DataFrame:
    """The ``n`` largest frequencies; the smaller key first on a tie."""
    return frequencies.orderBy(F.col(count).desc(), F.col(key).asc()).limit(n)


def line_count(text: Column) -> Column:
    """Lines as a line reader sees them: a line end at the very end opens no new line."""
    # Carriage returns are rare, and splitting at one plain character needs no regex.
    ends = F.when(text.contains("\r"), F.regexp_count(text, F.lit(_LINE_END))).otherwise(
        F.size(F.split(text, "\n")) - 1
    )
    open_end = (text != "") & ~text.endswith("\n") & ~text.endswith("\r")
    return ends + open_end.cast("int")


def text_stats(text: DataFrame, source: str, column: str = "value") -> DataFrame:
    """Characters and lines per source."""
    body = F.col(column)
    return text.groupBy(source).agg(
        F.count("*").alias("n_texts"),
        F.sum(F.length(body)).alias("n_chars"),
        F.sum(line_count(body)).alias("n_lines"),
    )


_BOM_BYTES = 3


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Characters and lines of each text file below ``path``: ``path, n_bytes, n_chars, n_lines``.

    Lines end in a line feed, which counts as a character; one at the very end of a file
    opens no new line. The files are read line by line, so a large one is split over tasks,
    and whether it ends in a line feed follows from its size. A byte order mark is no
    character. A file without a byte has no row, as no task is planned for it. A file whose
    size fits neither form, such as a compressed one, fails the query.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    per_file = lines.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("n_bytes")
    ).agg(
        F.sum(F.length("value")).alias("chars"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.count("*").alias("n_lines"),
    )
    # Bytes of the file that no line and no line feed between two of them accounts for.
    rest = F.col("n_bytes") - F.col("bytes") - F.col("n_lines") + 1
    mark = F.lit(_BOM_BYTES)
    unfit = F.raise_error(F.concat(F.lit("Not a plain text file: "), F.col("path"))).cast("long")
    ends = F.when(rest.isin(0, _BOM_BYTES), 0).when((rest == 1) | (rest == mark + 1), 1).otherwise(unfit)
    return per_file.select(
        "path", "n_bytes", (F.col("chars") + F.col("n_lines") - 1 + ends).alias("n_chars"), "n_lines"
    )
