"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a condition on measures of a text that rejects a document. On a sample, a
rule's rejection rate and its cost (the time that its measures and the rule take on the
texts) are measured; the cascade asks the rules in the order of rejection per cost. Where
only the verdict is wanted (``keep_good``), a document that is rejected is not measured
further. Where the measures are wanted too (``judge``), all of them are taken and the
cascade is one conditional expression over them. The order changes the cost and the
reported first reason, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from farelight.session import written

#: Fixed values of the contract: characters that part words, symbols, window and limits.
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rows on which cost and selectivity are estimated, about. Only the order of the rules
#: depends on them.
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def with_words(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_text`` and ``_words``; the columns of ``docs`` are kept in ``_doc``."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"))
    named = packed.withColumn("_text", F.coalesce(F.col("_doc").getField(text), F.lit("")))
    return named.withColumn("_words", words(F.col("_text")))


def count_symbols(text: Column) -> Column:
    """Characters of ``SYMBOLS``, one byte each. Replacing bytes is faster than translating."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(x))) for x in SYMBOLS), F.lit(0))


def count_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\\n"), lambda x: ~x.rlike("^[\\x20\\x09-\\x0D]*$"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _doubled(hashes: Column, step: int) -> Column:
    """Each hash combined with the one ``step`` places on; the last ones have no partner."""
    size = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), size), F.slice(hashes, F.lit(step + 1), size), lambda a, b: F.xxhash64(a, b))


def repeated_windows(hashes: Column) -> Column:
    """Windows as ``(h, i)`` in order of their hash; empty if all hashes differ.

    Only a text with an equal pair sorts its windows. In one text of a million words the
    chance that two different windows share a hash is 3 in 100 million.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")
    )


def repeat_starts(pairs: Column) -> Column:
    """Starts, in order, of the windows whose hash a neighbour in ``pairs`` shares.

    ``pairs`` has to be a column, not an expression that each element would compute anew.
    """

    def shared(p: Column, at: Column) -> Column:
        before = (at > 0) & F.coalesce(F.get(pairs, at - 1).getField("h") == p.getField("h"), F.lit(False))
        return before | F.coalesce(F.get(pairs, at + 1).getField("h") == p.getField("h"), F.lit(False))

    return F.array_sort(F.transform(F.filter(pairs, shared), lambda p: p.getField("i")))


def count_covered(starts: Column) -> Column:
    """Words in the union of windows that begin at ``starts``."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts,
        zero,
        lambda seen, i: F.struct(
            (seen.getField("n") + F.least(F.lit(WINDOW), i - seen.getField("last"))).cast("long").alias("n"),
            i.alias("last"),
        ),
        lambda seen: seen.getField("n"),
    )


def measure(df: DataFrame, name: str, open_: Column | None = None) -> DataFrame:
    """Adds a measure of ``_text`` and ``_words``; where ``open_`` is false, that of no text."""

    def asked(value: Column, nothing: Column) -> Column:
        return value if open_ is None else F.when(open_, value).otherwise(nothing)

    text, found = asked(F.col("_text"), F.lit("")), asked(F.col("_words"), F.array().cast("array<string>"))
    if name == "n_words":
        return df.withColumn(name, F.size(found).cast("long"))
    if name == "word_chars":
        return df.withColumn(name, F.length(F.array_join(found, "")).cast("long"))
    if name == "n_symbols":
        return df.withColumn("_asked", text).withColumn(name, count_symbols(F.col("_asked")).cast("long")).drop("_asked")
    if name == "n_dup_lines":
        return df.withColumn(name, count_dup_lines(text))
    # Hashes of one word, of two, of four and of eight: all windows, in order.
    df = df.withColumn("_hashes", F.transform(found, lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        df = df.withColumn("_hashes", _doubled(F.col("_hashes"), step))
    df = df.withColumn("_pairs", repeated_windows(F.col("_hashes")))
    return df.withColumn("n_repeat_words", count_covered(repeat_starts(F.col("_pairs")))).drop("_hashes", "_pairs")


def settled(df: DataFrame, *names: str) -> DataFrame:
    """``_doc``, ``_text`` and the named columns.

    They are generated, one row from each, so that no filter on them moves below and has the
    lambdas compute their arrays for every element.
    """
    return df.select("_doc", "_text", F.inline(F.array(F.struct(*names))))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_doc, _text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    split = with_words(docs, text)
    for name in MEASURES:
        split = measure(split, name)
    return settled(split, *MEASURES)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the measures it ``needs``; a null outcome rejects nothing."""

    name: str
    rejects: str
    needs: tuple[str, ...] = MEASURES


#: The base rules come from the contract. The others are set far from ordinary prose.
BASE_RULES = (
    Rule("few_words", f"n_words < {MIN_WORDS}", ("n_words",)),
    Rule("repeated_words", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words", ("n_words", "n_repeat_words")),
)
OTHER_RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words", ("n_words", "n_symbols")),
    Rule("repeated_lines", "2 * n_dup_lines > length(_text) - length(replace(_text, '\\n', '')) + 1", ("n_dup_lines",)),
    Rule("word_length", "word_chars > 20 * n_words or word_chars < 2 * n_words", ("n_words", "word_chars")),
)
RULES = BASE_RULES + OTHER_RULES


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejection: float
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejection / self.seconds


def estimate(docs: DataFrame, text: str, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Rejection rate and time of each rule on the texts of about ``rows`` rows, best worth first.

    The rows are chosen by a hash of their columns (but maps, which have none), so nothing is
    moved to choose them, and a text with very many copies counts as often as its share.
    """
    share = 1_000_000 * rows // max(1, docs.count()) + 1
    hashed = F.xxhash64(*[docs[f"`{name}`"] for name, kind in docs.dtypes if "map<" not in kind])
    chosen = docs.filter(F.pmod(hashed, F.lit(1_000_000)) < share).select(F.col(text).alias("text"))
    sample = written(chosen, "quality-sample")

    def timed(aggregate: DataFrame) -> tuple[float | None, float]:
        started = time.perf_counter()
        return aggregate.first()[0], time.perf_counter() - started

    # What any job over the texts takes is no rule's own cost.
    _, common = timed(sample.agg(F.sum(F.octet_length("text"))))
    found = []
    for rule in rules:
        measured = with_words(sample, "text")
        for name in rule.needs:
            measured = measure(measured, name)
        rejected, seconds = timed(settled(measured, *rule.needs).agg(F.avg(F.expr(f"if({rule.rejects}, 1.0D, 0.0D)"))))
        found.append(Estimate(rule, rejected or 0.0, max(seconds - common, 1e-3)))
    return sorted(found, key=lambda e: (-e.worth, rules.index(e.rule)))


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    branches = " ".join(f"when {r.rejects} then '{r.name}'" for r in rules)
    return F.expr(f"case {branches} end") if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measures with ``base_failed``, ``kept`` and ``first_reason``; ``_doc`` is the row.

    A null text counts as empty: it has no words, fails the base rule and is not kept.
    Repeated rows are judged alike; an empty table gives none. ``rules`` have to contain
    the base rules for ``kept`` to be false wherever ``base_failed`` is true.
    """
    measured = measures(docs, text)
    ordered = [e.rule for e in estimate(docs, text, rules)]
    base = F.expr(" or ".join(f"({r.rejects})" for r in BASE_RULES))
    judged = measured.withColumn("base_failed", base).withColumn("first_reason", cascade(ordered))
    return judged.withColumn("kept", F.col("first_reason").isNull())


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they were.

    Each rule takes its measures only of what the rules before it have left.
    """
    left, known = with_words(docs, text).withColumn("_open", F.lit(True)), set()
    for rule in (e.rule for e in estimate(docs, text, rules)):
        for name in rule.needs:
            if name not in known:
                left, known = measure(left, name, F.col("_open")), known | {name}
        left = left.withColumn("_open", F.col("_open") & ~F.coalesce(F.expr(rule.rejects), F.lit(False)))
    return settled(left, "_open").filter("_open").select("_doc.*")
