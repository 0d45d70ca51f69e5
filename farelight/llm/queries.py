"""One query per operator of this package over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelight.llm import (
    bpe,
    jaccard,
    langid,
    mixing,
    periodic,
    prefixes,
    privacy,
    quality,
    simhash,
    substrings,
    suffixes,
    topk,
    toxicity,
)
from farelight.llm.common import ship_package, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).drop("row")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("_doc.doc_id", *counts, "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse_runs(table(spark, sf_dir, "documents"), digest=True, plant=True)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"), family=prefixes.FAMILY)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES = {
    q.__name__: _shipped(q)
    for q in (
        op1_substring_dedup,
        op2_suffix_array_dedup,
        op3_exact_topk,
        op4_byte_bpe,
        op5_language_id,
        op6_pii,
        op7_source_mixing,
        op8_quality_rules,
        op9_simhash,
        op10_toxicity,
        op11_ngram_jaccard,
        op12_periodic_runs,
        op13_prefix_trie,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op1_substring_dedup": f"""
with docs as (select doc_id, {_WORDS} as words from documents),
windows as (
    select doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) as h
    from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from docs)
),
later as (
    select doc_id, i from (
        select doc_id, i, row_number() over (partition by h order by doc_id, i) as n from windows
    ) where n > 1
),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
placed as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from docs),
left_over as (
    select doc_id, count(g.p) as n_removed, string_agg(word, ' ' order by p) filter (where g.p is null) as kept
    from placed left join gone g using (doc_id, p) group by doc_id
)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from docs left join left_over using (doc_id)
""",
    "op3_exact_topk": """
with whole as (
    select vec_id, [floor(256 * x::double)::bigint for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
terms as (select vec_id, unnest(v) as x, unnest(range(len(v))) as d from whole),
scores as (
    select q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
    from terms q join terms c on q.d = c.d and q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
    group by q.vec_id, c.vec_id
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 5
""",
    "op8_quality_rules": f"""
with docs as (select doc_id, coalesce(text, '') as t, {_WORDS} as words from documents),
windows as (
    select doc_id, i, md5(array_to_string(words[i:i + 7], ' ')) as h
    from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from docs)
),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, h) as n from windows) where n > 1),
covered as (
    select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id
),
measured as (
    select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines,
        len(string_split(t, chr(10))) as n_lines, coalesce(n, 0)::bigint as n_repeat_words
    from docs left join covered using (doc_id)
),
counted as (
    select *, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not (base_failed or 10 * n_symbols > 3 * n_words or 2 * n_dup_lines > n_lines
        or word_chars > 20 * n_words or word_chars < 2 * n_words) as kept
from counted
""",
}
