"""Toxicity by maximum-scoring segments.

Tokens are scored by the log-odds of occurring in a toxic and in a clean text, with a
Dirichlet prior in proportion to their frequency in both. Tokens whose log-odds stand out
get their value; all others share one penalty. A linear scan finds every maximal segment
of a text; the largest possible scores of a text of chance follow an extreme-value law,
whose two parameters turn a segment's score into a significance for that text's length. A
logistic curve over the significance of the best segment and of all significant ones
together, fitted on the same labelled rows, gives the score of the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from farelight.llm.common import crc32_of, map_rows
from farelight.session import written

#: About so many labelled rows are learned from, chosen by a hash of the id; all of them if
#: there are fewer. Scoring looks at whole texts of all documents.
LEARN_DOCS = 20_000
#: Weight of the prior in documents, standard errors from which log-odds stand out, tokens
#: kept at most, and the penalty of a token that does not stand out.
PRIOR = 50.0
STANDS_OUT = 3.0
TOKENS = 20_000
PENALTY = 0.15
#: Significance (natural log of 1 / E) from which a segment counts: one in a hundred clean
#: texts of that length has such a segment.
SIGNIFICANT = math.log(100)
#: Parameter of the law where there is no clean text to fit it on.
DEFAULT_CHANCE = 0.1
_TOKEN = re.compile(r"\w+")


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold of the contract; a row without an id is not held out."""
    return F.coalesce(F.pmod(crc32_of(doc_id), F.lit(5)) == 0, F.lit(False))


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, end exclusive, in linear time.

    Each candidate keeps the sum before it and up to its end, and the place of the nearest
    earlier candidate that starts lower, so that those between the two are never looked at
    again. A new positive score is merged with the nearest earlier candidate that starts
    lower, as long as that pays.
    """
    found: list[list[float]] = []  # start, end, sum before, sum up to the end, place of the lower one
    total = 0.0
    for at, score in enumerate(scores):
        if score <= 0:
            total += score
            continue
        new = [at, at + 1, total, total + score]
        total += score
        j = len(found) - 1
        while j >= 0 and found[j][2] >= new[2]:
            j = found[j][4]
        while j >= 0 and found[j][3] < new[3]:
            new = [found[j][0], new[1], found[j][2], new[3]]
            lower = found[j][4]
            del found[j:]
            j = lower
        found.append([*new, j])
    return [(int(a), int(b), upto - before) for a, b, before, upto, _ in found]


@dataclass(frozen=True)
class Model:
    """Token scores, parameters of the extreme-value law, weights of the logistic curve."""

    scores: dict[str, float]
    scale: float = 1.0
    chance: float = DEFAULT_CHANCE
    weights: tuple[float, ...] = (-2.0, 0.5, 0.0, 0.0)

    def segments(self, found: list[str]) -> list[tuple[int, int, float]]:
        """Maximal scoring segments of a token list.

        Runs of tokens that share the penalty are one step of the scan.
        """
        get = self.scores.get
        hits = [(i, s) for i, s in enumerate(map(get, found)) if s is not None]
        if not hits:
            return []
        steps, places, last = [], [], hits[0][0]
        for at, score in hits:
            if at > last:
                steps.append(-PENALTY * (at - last))
                places.append((last, at))
            steps.append(score)
            places.append((at, at + 1))
            last = at + 1
        return [(places[a][0], places[b - 1][1], s) for a, b, s in maximal_segments(steps)]

    def passages(self, found: list[str]) -> list[tuple[int, int, float]]:
        """The segments with their significance, ``ln(1 / E)`` by the extreme-value law."""
        size = math.log(self.chance * max(1, len(found)))
        return [(a, b, self.scale * s - size) for a, b, s in self.segments(found)]

    def significant(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """All passages beyond the least significance, and the number of tokens."""
        found = tokens(text)
        return [x for x in self.passages(found) if x[2] > SIGNIFICANT], len(found)

    def features(self, spans: list[tuple[int, int, float]], size: int) -> tuple[float, float, float]:
        """By how much the best of the spans, and all together, are beyond the least significance; length."""
        worth = [w - SIGNIFICANT for _, _, w in spans]
        if not worth:
            return 0.0, 0.0, math.log1p(size)
        return math.log1p(max(worth)), math.log1p(sum(worth)), math.log1p(size)

    def score(self, spans: list[tuple[int, int, float]], size: int) -> float:
        features = self.features(spans, size)
        return _logistic(self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features, strict=True)))


def _logistic(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, x))))


def labelled(docs: DataFrame, labels: DataFrame, label: str, text: str, doc_id: str, limit: int) -> DataFrame:
    """``text, label`` of about ``limit`` labelled rows outside the held-out fold."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
    marks = marks.filter(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out("_id"))
    marks = marks.groupBy("_id").agg(F.max("label").alias("label"))
    size = marks.count()
    share = min(1_000_000, 1_000_000 * limit // max(1, size) + 1)
    place = F.pmod(F.xxhash64(F.col("_id").cast("long")), F.lit(1_000_000))
    texts = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
    return texts.filter(place < share).join(marks.filter(place < share), "_id").select("text", "label")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have a token; the null token counts all of them."""
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[int(label == 1)].update({None, *tokens(text)})
        for label, counter in counts.items():
            columns = [
                pa.array(list(counter), pa.string()),
                pa.array([label] * len(counter), pa.int64()),
                pa.array(list(counter.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "label", "n"])


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds with a Dirichlet prior, and how many standard errors they are from zero."""
    prior = np.maximum(PRIOR * (toxic + clean) / (n_toxic + n_clean), 0.01)
    odds = np.log((toxic + prior) / (n_toxic + PRIOR - toxic - prior + 1)) - np.log(
        (clean + prior) / (n_clean + PRIOR - clean - prior + 1)
    )
    return odds, odds / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))


def law(scores: np.ndarray, rates: np.ndarray) -> float:
    """Scale of the extreme-value law: the positive root of E[exp(scale * score)] = 1."""
    rest = max(0.0, 1.0 - float(rates.sum()))

    def excess(x: float) -> float:
        return float((rates * np.exp(np.minimum(x * scores, 700))).sum()) + rest * math.exp(-x * PENALTY) - 1.0

    low, high = 1e-6, 1.0
    if excess(low) >= 0:
        return low
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def chance(best: np.ndarray, sizes: np.ndarray, scale: float) -> float:
    """Other parameter of the law, by maximum likelihood, from clean texts.

    The best segment of a text of ``n`` tokens scores above ``x`` with probability
    ``1 - exp(-chance * n * exp(-scale * x))``. A text without a segment, which scores 0
    here, is known to score no more.
    """
    weight = float((sizes * np.exp(-scale * best)).sum())
    return max(1, np.count_nonzero(best)) / weight if weight else DEFAULT_CHANCE


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights, the constant first, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, label: str, text: str, doc_id: str, limit: int = LEARN_DOCS) -> Model:
    """Without toxic or without clean rows to learn from, the model scores nothing."""
    rows = written(labelled(docs, labels, label, text, doc_id, limit), "labelled")
    counted = rows.mapInArrow(_count, "token string, label long, n long").groupBy("token").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    counted = written(counted, "tokens")
    size = counted.filter("token is null").first()
    if size is None or not size["toxic"] or not size["clean"]:
        return Model({})
    n_toxic, n_clean = size["toxic"], size["clean"]
    # Tokens of which toxic texts have more than their share, at most as many as are kept.
    more = (counted["toxic"] + 0.0) * n_clean > 2.0 * (counted["clean"] + 0.0) * n_toxic
    kept = counted.filter(F.col("token").isNotNull() & (F.col("toxic") > 1) & more)
    kept = kept.orderBy(F.col("toxic").desc(), "token").limit(TOKENS).toPandas()
    toxic, clean = kept["toxic"].to_numpy(float), kept["clean"].to_numpy(float)
    odds, z = log_odds(toxic, clean, n_toxic, n_clean)
    out = z >= STANDS_OUT
    scores = dict(zip(kept["token"][out], odds[out].tolist(), strict=True))
    length = rows.filter("label <> 1").agg(F.avg(F.size(F.split("text", "\\s+")))).first()[0] or 1.0
    rates = (clean[out] + 0.5) / (n_clean * length)
    model = Model(scores, law(odds[out], rates))

    def best_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [tokens(t) for t in batch.column(0).to_pylist()]
        best = [max((s for _, _, s in model.segments(f)), default=0.0) for f in found]
        columns = [pa.array(best, pa.float64()), pa.array([len(f) for f in found], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["best", "size"])

    plain = map_rows(rows.filter("label <> 1"), "best double, size long", best_of).toPandas().sort_values(["best", "size"])
    model = replace(model, chance=chance(plain["best"].to_numpy(), plain["size"].to_numpy(), model.scale))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([model.features(*model.significant(t)) for t in batch.column(0).to_pylist()]).reshape(-1, 3)
        columns = [pa.array(found[:, i]) for i in range(3)] + [batch.column(1)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "c", "label"])

    seen = map_rows(rows, "a double, b double, c double, label int", work).toPandas().sort_values(["a", "b", "c", "label"])
    weights = fit_logistic(seen[["a", "b", "c"]].to_numpy(), (seen["label"] == 1).to_numpy(float))
    return replace(model, weights=weights)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` of every row.

    ``passages`` are all significant segments, whatever the score, as ``start, end``
    (tokens) and significance.
    A null text counts as empty; it has a score too. Repeated rows of ``docs`` stay; a
    document with several labels is toxic if one of them is 1. Rows without an id are
    scored but not learned from. Other columns are not looked at.
    """
    model = learn(docs, labels, label, text, doc_id)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.significant(t) for t in batch.column(2).to_pylist()]
        scores = [model.score(spans, size) for spans, size in found]
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("significance", pa.float64())])
        rows = [[{"start": a, "end": b, "significance": w} for a, b, w in spans] for spans, _ in found]
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array(scores, pa.float64()),
            pa.array([int(s >= 0.5) for s in scores], pa.int32()),
            pa.array(rows, pa.list_(kind)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "passages"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    schema = (
        "doc_id long, held_out boolean, score double, predicted int, "
        "passages array<struct<start:bigint,end:bigint,significance:double>>"
    )
    return map_rows(rows, schema, work)
