"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three letters, with word edges) of
a language by rank. A text is ranked in the same way; its distance to a language is the sum
of how far each of its n-grams is out of place, an n-gram that the profile lacks counting
as the worst. The nearest language is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from farelight.llm.common import crc32_of, map_rows

#: Ranks in a profile.
RANKS = 300
#: About so many labelled documents of a language are learned from, chosen by a hash of the
#: id; all of them if there are fewer. Prediction looks at whole texts of all documents.
LEARN_DOCS = 4000
_EDGE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.concatenate(([_EDGE], np.where(_letters()[codes], codes, _EDGE), [_EDGE]))
    codes = codes[np.concatenate(([True], (codes[1:] != _EDGE) | (codes[:-1] != _EDGE)))]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    one = codes[codes != _EDGE]
    two = codes[:-1] << 21 | codes[1:]
    three = (a << 42 | b << 21 | c)[b != _EDGE]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ``RANKS`` most frequent codes, most frequent first, smaller code first on a tie."""
    return codes[np.lexsort((codes, -counts))[:RANKS]]


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold of the contract; a row without an id is not held out."""
    return F.coalesce(F.pmod(crc32_of(doc_id), F.lit(4)) == 2, F.lit(False))


def learn_profiles(docs: DataFrame, text: str, lang: str, doc_id: str, limit: int = LEARN_DOCS) -> dict[str, np.ndarray]:
    """Ranked codes per language, from labelled rows outside the held-out fold."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    # The hash is of the id alone, so the choice is the same whenever it is made.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1_000_000, 1_000_000 * limit // n + 1))])
    chosen = rows.filter(place < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(name, []).append(value)
            for name, values in texts.items():
                codes, counts = grams(" ".join(values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"]
                )

    counted = chosen.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    best = counted.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= RANKS)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in best.collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["code"]))
    return {name: np.array([code for _, code in sorted(found)]) for name, found in sorted(profiles.items())}


def predict(text: str | None, profiles: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[str, float]:
    """Nearest language and 1 minus its distance as a share of the largest possible."""
    if not text or not profiles:
        return "und", 0.0
    found = ranked(*grams(text))
    if len(found) < 2:  # edges alone
        return "und", 0.0
    own = np.arange(len(found))
    best = ("und", 2.0)
    for name, (codes, ranks) in profiles.items():
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        out = np.where(codes[at] == found, np.abs(ranks[at] - own), RANKS)
        distance = float(out.sum()) / (RANKS * len(found))
        if distance < best[1]:
            best = (name, distance)
    return best[0], 1.0 - best[1]


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    Languages are the non-null values of ``lang`` outside the held-out fold; the first in
    order wins a tie. A text that is null, empty or without a letter is ``und`` with score
    0, as is everything if there is nothing to learn from. Repeated rows stay; other columns
    are not looked at.
    """
    learned = learn_profiles(docs, text, lang, doc_id)
    profiles = {name: (np.sort(codes), np.argsort(codes)) for name, codes in learned.items()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [predict(t, profiles) for t in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array([f[0] for f in found]), pa.array([f[1] for f in found])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return map_rows(rows, "doc_id long, held_out boolean, lang_pred string, score double", work)
