"""Personal data: base patterns, and a character BiLSTM-CRF that adds to them.

The model reads characters by class in both directions and scores tags (outside, or begin
and inside of a kind); transitions between tags are learned too, as in a linear-chain CRF.
It is trained here, in numpy, from spans labelled by the base patterns on a bounded sample.
It then reads overlapping windows. Each character has its scores from the window in which
it is most central, and the tags of adjoining windows are decided together, as one run that
grows as long as a span touches its edge: neither the length of a span nor its place in the
text decides. What the runs of a text find is reconciled over the text as a whole, by the
best set of spans that do not overlap.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farelight.llm.common import map_rows, sha256_hex
from farelight.session import written

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: Windows, in characters. Only windows with a digit or ``@`` are read: no kind has neither.
WINDOW = 64
STRIDE = 32
#: Documents that windows are labelled in, and windows learned from with and without spans,
#: at most. They are chosen by a hash of their text.
LEARN_DOCS = 4000
LEARN_WINDOWS = 400
#: Mean probability from which a span of the model counts.
SURE = 0.9
HIDDEN = 12
EMBEDDED = 8
STEPS = 120
_SIGNS = ".@-_+% \n\t():/,;\"'=#"
_TAGS = 1 + 2 * len(KINDS)

# What the contract takes for an address, a number of a card, and so on.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def emails(text: str) -> list[Span]:
    """Leftmost addresses: for each ``@``, all that can stand before it, and the domain."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return found


def ips(text: str) -> list[Span]:
    """Leftmost four numbers with dots between, wherever more follow each other."""
    found = []
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, at = run.group().split("."), run.start()
        places = []
        for part in parts:
            places.append((at, at + len(part)))
            at += len(part) + 1
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                found.append(("ip", places[i][0], places[i + 3][1]))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    return found


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    """All spans of the base patterns, by start and then kind."""
    found = emails(text) if "@" in text else []
    if _TRIGGER.search(text):
        found += ips(text) + cards(text) + phones(text)
    return in_order(found)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point below 256; all others are letters or signs alike."""
    table = np.full(256, 1, np.int8)
    for c in range(256):
        x = chr(c)
        if x in _SIGNS:
            table[c] = 6 + _SIGNS.index(x)
        elif "0" <= x <= "9":
            table[c] = 2
        elif x.isalpha():
            table[c] = 3 if x.islower() else 4
    return table


_N_CLASSES = 6 + len(_SIGNS)


def class_codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 256, _classes()[np.minimum(codes, 255)], 5).astype(np.int8)


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    last, found = -1, []
    for m in _TRIGGER.finditer(text):
        high = m.start() // STRIDE
        for k in range(max(last + 1, high - WINDOW // STRIDE + 1, 0), high + 1):
            found.append(k * STRIDE)
            last = k
    return found


def tags_of(spans: list[Span], start: int) -> np.ndarray:
    """Tags of the characters of a window."""
    tags = np.zeros(WINDOW, np.int8)
    for kind, a, b in spans:
        low, high = max(a - start, 0), min(b - start, WINDOW)
        if low < high:
            tags[low:high] = 2 + 2 * KINDS.index(kind)
            if a >= start:
                tags[low] -= 1
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; windows are rows of class codes, 0 standing for the end of a text."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.5, (_N_CLASSES, EMBEDDED))}
        for side in ("ahead", "back"):
            w[side] = rng.normal(0, 0.3, (EMBEDDED + HIDDEN, 4 * HIDDEN))
            w[side + "_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        w["out"] = rng.normal(0, 0.3, (2 * HIDDEN, _TAGS))
        w["out_bias"] = np.zeros(_TAGS)
        w["move"] = np.zeros((_TAGS, _TAGS))
        return Tagger(w)

    def _run(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction over ``(time, window, feature)``."""
        w, bias = self.weights[side], self.weights[side + "_bias"]
        h = c = np.zeros((x.shape[1], HIDDEN))
        states, tape = np.empty((*x.shape[:2], HIDDEN)), []
        for t in range(len(x)):
            joined = np.concatenate([x[t], h], 1)
            gates = joined @ w + bias
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            tape.append((joined, i, f, o, g, before, squashed))
        return states, tape

    def _run_back(self, side: str, tape: list, slope: np.ndarray, grads: dict) -> np.ndarray:
        """Gradients of one direction; returns those of its input."""
        w = self.weights[side]
        dh = dc = np.zeros(slope.shape[1:])
        dx = np.empty((*slope.shape[:2], EMBEDDED))
        for t in range(len(slope) - 1, -1, -1):
            joined, i, f, o, g, before, squashed = tape[t]
            dh = dh + slope[t]
            dc = dc + dh * o * (1 - squashed**2)
            d = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1
            )
            grads[side] += joined.T @ d
            grads[side + "_bias"] += d.sum(0)
            back = d @ w.T
            dx[t], dh = back[:, :EMBEDDED], back[:, EMBEDDED:]
            dc = dc * f
        return dx

    def emissions(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores ``(time, window, tag)``."""
        x = self.weights["embed"][windows.T]
        ahead, tape_a = self._run(x, "ahead")
        back, tape_b = self._run(x[::-1], "back")
        both = np.concatenate([ahead, back[::-1]], 2)
        return both @ self.weights["out"] + self.weights["out_bias"], (both, tape_a, tape_b)

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tag probabilities, the forward and backward scores and the normaliser of each window."""
        move = self.weights["move"]
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        forward[0] = scores[0]
        for t in range(1, len(scores)):
            forward[t] = scores[t] + _logsumexp(forward[t - 1][:, :, None] + move, 1)
        for t in range(len(scores) - 2, -1, -1):
            backward[t] = _logsumexp((scores[t + 1] + backward[t + 1])[:, None, :] + move, 2)
        norm = _logsumexp(forward[-1], 1)
        return np.exp(forward + backward - norm[:, None]), forward, backward, norm

    def slopes(self, windows: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log-likelihood of the tags."""
        scores, (both, tape_a, tape_b) = self.emissions(windows)
        probability, forward, backward, norm = self.marginals(scores)
        move, tags = self.weights["move"], tags.T.astype(int)
        slope = -probability
        np.put_along_axis(slope, tags[:, :, None], np.take_along_axis(slope, tags[:, :, None], 2) + 1, 2)
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for t in range(1, len(scores)):
            pair = forward[t - 1][:, :, None] + move + (scores[t] + backward[t])[:, None, :] - norm[:, None, None]
            grads["move"] -= np.exp(pair).sum(0)
            np.add.at(grads["move"], (tags[t - 1], tags[t]), 1)
        grads["out"] = np.einsum("tnh,tnk->hk", both, slope)
        grads["out_bias"] = slope.sum((0, 1))
        d = slope @ self.weights["out"].T
        dx = self._run_back("ahead", tape_a, d[:, :, :HIDDEN], grads)
        dx = dx + self._run_back("back", tape_b, d[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["embed"], windows.T.astype(int), dx)
        return {k: v / len(windows) for k, v in grads.items()}

    def train(self, windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, size: int = 64, seed: int = 7) -> None:
        """Adam on random batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            at = rng.integers(0, len(windows), size)
            for k, g in self.slopes(windows[at], tags[at]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                self.weights[k] += 0.02 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)

    def decode(self, runs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Best tags of each run of ``(time, tag)`` scores, and the probability of each of them.

        Runs come from the longest to the shortest; each step looks at those that reach it.
        """
        sizes = np.array([len(r) for r in runs])
        scores = np.zeros((sizes[0], len(runs), _TAGS))
        for i, r in enumerate(runs):
            scores[: len(r), i] = r
        reach = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="left")
        move = self.weights["move"]
        best, steps = scores[0].copy(), np.zeros(scores.shape, np.int8)
        for t in range(1, len(scores)):
            n = reach[t]
            ways = best[:n, :, None] + move
            steps[t, :n] = ways.argmax(1)
            best[:n] = ways.max(1) + scores[t, :n]
        tags = np.zeros(scores.shape[:2], int)
        tags[sizes - 1, np.arange(len(runs))] = best.argmax(1)
        for t in range(len(scores) - 2, -1, -1):
            n = reach[t + 1]
            tags[t, :n] = np.take_along_axis(steps[t + 1, :n], tags[t + 1, :n, None], 1)[:, 0]
        chance = np.ones(tags.shape)
        some = np.flatnonzero(tags.any(0))  # the others have no span
        if len(some):
            chance[:, some] = self._chances(scores[:, some], sizes[some], tags[:, some])
        return [(tags[:k, i], chance[:k, i]) for i, k in enumerate(sizes.tolist())]

    def _chances(self, scores: np.ndarray, sizes: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """Probabilities of the given tags; only the forward scores are held whole."""
        move = self.weights["move"]
        reach = np.searchsorted(-sizes, -np.arange(len(scores) + 1), side="left")
        forward, out = np.zeros_like(scores), np.ones(tags.shape)
        forward[0] = scores[0]
        for t in range(1, len(scores)):
            n = reach[t]
            forward[t, :n] = scores[t, :n] + _logsumexp(forward[t - 1, :n, :, None] + move, 1)
        norm = _logsumexp(forward[sizes - 1, np.arange(len(sizes))], 1)
        backward = np.zeros(scores.shape[1:])
        for t in range(len(scores) - 1, -1, -1):
            n = reach[t + 1]
            if n:
                backward[:n] = _logsumexp((scores[t + 1, :n] + backward[:n])[:, None, :] + move, 2)
            n = reach[t]
            both = np.take_along_axis(forward[t, :n] + backward[:n], tags[t, :n, None], 1)[:, 0]
            out[t, :n] = np.exp(both - norm[:n])
        return out


def window_codes(codes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int8)])
    return padded[np.array(starts, int)[:, None] + np.arange(WINDOW)]


#: Text, first and last window of a run.
Run = tuple[int, int, int]


def joined(found: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last window of each run; runs that follow each other or overlap are one."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted(found):
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last))
        else:
            runs.append((first, last))
    return runs


def run_scores(model: Tagger, runs: list[Run], codes: list[np.ndarray], at_once: int) -> list[np.ndarray]:
    """Tag scores of each character of the runs, from the window where it is most central."""
    starts, window, place, sizes, before = [], [], [], [], 0
    for i, first, last in runs:
        amount = last - first + 1
        size = min((amount - 1) * STRIDE + WINDOW, len(codes[i]) - first * STRIDE)
        at = np.arange(size)
        own = np.clip((at - (WINDOW - STRIDE) // 2) // STRIDE, 0, amount - 1)
        window.append(own + before)
        place.append(at - own * STRIDE)
        starts.extend((i, k * STRIDE) for k in range(first, last + 1))
        sizes.append(size)
        before += amount
    windows, places = np.concatenate(window), np.concatenate(place)
    out = np.empty((len(windows), _TAGS))
    for a in range(0, before, at_once):
        part = starts[a : a + at_once]
        rows, k = [], 0
        while k < len(part):
            upto = k
            while upto < len(part) and part[upto][0] == part[k][0]:
                upto += 1
            rows.append(window_codes(codes[part[k][0]], [s for _, s in part[k:upto]]))
            k = upto
        scores, _ = model.emissions(np.concatenate(rows))
        low, high = np.searchsorted(windows, [a, a + at_once])
        out[low:high] = scores[places[low:high], windows[low:high] - a]
    return np.split(out, np.cumsum(sizes)[:-1])


def decode_runs(
    model: Tagger, runs: list[Run], codes: list[np.ndarray], at_once: int
) -> Iterator[tuple[Run, np.ndarray, np.ndarray]]:
    """Tags of each run and their probabilities; runs of like length go together."""
    scores = run_scores(model, runs, codes, at_once)
    order = sorted(range(len(runs)), key=lambda r: -len(scores[r]))
    at = 0
    while at < len(order):
        upto = at
        while upto < len(order) and 2 * len(scores[order[upto]]) >= len(scores[order[at]]):
            upto += 1
        part = order[at:upto]
        for r, (tags, chance) in zip(part, model.decode([scores[r] for r in part]), strict=True):
            yield runs[r], tags, chance
        at = upto


def spans_in(tags: np.ndarray, chance: np.ndarray, start: int) -> Iterator[tuple[float, Span]]:
    """Spans of one run, with their mean probability."""
    at = 0
    while at < len(tags):
        tag = tags[at]
        if tag == 0:
            at += 1
            continue
        kind, end = (tag - 1) // 2, at + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        if tag == 1 + 2 * kind:
            yield float(chance[at:end].mean()), (KINDS[kind], start + at, start + end)
        at = end


def reconcile(found: list[tuple[float, Span]], base: list[Span]) -> list[Span]:
    """The set of spans with the largest total of length times probability.

    No two of them overlap each other, and none a base span, which all stay.
    """
    best: dict[Span, float] = {}
    for chance, span in found:
        if chance >= SURE and not any(a < span[2] and span[1] < b for _, a, b in base):
            best[span] = max(chance, best.get(span, 0.0))
    spans = sorted(best, key=lambda s: (s[2], s[1], KINDS.index(s[0])))
    ends = [s[2] for s in spans]
    total, take = [0.0], []
    for i, span in enumerate(spans):
        before = bisect_right(ends, span[1], 0, i)
        gain = total[before] + best[span] * (span[2] - span[1])
        take.append((gain > total[-1], before))
        total.append(max(gain, total[-1]))
    chosen, i = [], len(spans)
    while i:
        taken, before = take[i - 1]
        if taken:
            chosen.append(spans[i - 1])
        i = before if taken else i - 1
    return chosen


def model_spans(texts: list[str], model: Tagger, at_once: int = 512) -> list[list[tuple[float, Span]]]:
    """What the model finds in each text, with mean probabilities.

    A run with a tag at an edge that is not an end of the text is read again with as many
    windows more on that side, together with the runs that it then touches.
    """
    codes, runs = [], []
    for text in texts:
        starts = windows_of(text)
        codes.append(class_codes(text) if starts else np.empty(0, np.int8))
        runs.append(joined((s // STRIDE, s // STRIDE) for s in starts))
    # Of each run, what was found in it and the windows that it should have had.
    known: dict[Run, tuple[list[tuple[float, Span]], tuple[int, int]]] = {}
    left = [i for i, r in enumerate(runs) if r]
    while left:
        pending: list[Run] = []
        windows = 0

        def read() -> None:
            for run, tags, chance in decode_runs(model, pending, codes, at_once):
                i, first, last = run
                more, end = last - first + 1, first * STRIDE + len(tags)
                wanted = (
                    max(0, first - more) if tags[0] else first,
                    min((len(texts[i]) - 1) // STRIDE, last + more) if tags[-1] and end < len(texts[i]) else last,
                )
                known[run] = list(spans_in(tags, chance, first * STRIDE)) if tags.any() else [], wanted
            pending.clear()

        for i in left:
            for run in runs[i]:
                if (i, *run) not in known:
                    pending.append((i, *run))
                    windows += run[1] - run[0] + 1
                    if windows >= 4 * at_once:
                        read()
                        windows = 0
        if pending:
            read()
        grown = {i: joined(known[i, *run][1] for run in runs[i]) for i in left}
        left = [i for i in left if grown[i] != runs[i]]
        for i in left:
            runs[i] = grown[i]
    return [[x for run in r for x in known[i, *run][0]] for i, r in enumerate(runs)]


def find_spans(texts: list[str], model: Tagger | None, at_once: int = 512) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    found = [[] for _ in texts] if model is None else model_spans(texts, model, at_once)
    return [(b, in_order(b + reconcile(f, b))) for b, f in zip(base, found, strict=True)]


def learn(docs: DataFrame, text: str, limit: int = LEARN_DOCS) -> Tagger | None:
    """A tagger trained on labelled windows; none if no window with a span was found."""
    rows = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    size = rows.count()
    rows = rows.filter(place < min(1_000_000, 1_000_000 * limit // max(1, size) + 1))

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, tags = [], []
        for value in batch.column(0).to_pylist():
            spans, starts = base_spans(value), windows_of(value)
            near = starts[:: max(1, len(starts) // 8)]  # of one text, a few windows
            for start, window in zip(near, window_codes(class_codes(value), near), strict=True):
                codes.append(window.tobytes())
                tags.append(tags_of(spans, start).tobytes())
        columns = [pa.array(codes, pa.binary()), pa.array(tags, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["codes", "tags"])

    labelled = written(map_rows(rows, "codes binary, tags binary", label), "windows")
    plain = F.col("tags") == F.lit(bytes(WINDOW))
    seen = []
    for wanted in (~plain, plain):
        chosen = labelled.filter(wanted).distinct().orderBy(F.xxhash64("codes", "tags")).limit(LEARN_WINDOWS)
        seen.append(sorted((bytes(r["codes"]), bytes(r["tags"])) for r in chosen.collect()))
    if not seen[0]:
        return None
    both = seen[0] + seen[1]
    windows, tags = (np.frombuffer(b"".join(x), np.int8).reshape(-1, WINDOW) for x in zip(*both, strict=True))
    model = Tagger.fresh()
    model.train(windows, tags)
    return model


def _written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row.

    Counts and ``base_sha256`` are of the base spans, ``spans`` has all of them, as
    ``kind:start:end`` in code points. A null text counts as empty and has none. Repeated
    rows stay; without a labelled window there is no model, and the base spans are all.
    Other columns are not looked at.
    """
    model = learn(docs, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find_spans([t or "" for t in batch.column(1).to_pylist()], model)
        counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts)]
        columns += [pa.array([sha256_hex(_written_out(b).encode()) for b, _ in found], pa.string())]
        columns += [pa.array([_written_out(a) for _, a in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_rows(rows, f"doc_id long, {counts}, base_sha256 string, spans string", work)


def mask(text: str, spans: list[Span]) -> str:
    """The text with spans replaced by their kind; overlapping ones count as the first."""
    parts, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with all spans masked; ``length``, if there is one, counted anew."""
    model = learn(docs, text)
    at = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        found = find_spans([t or "" for t in texts], model)
        masked = [t if t is None or not s else mask(t, s) for t, (_, s) in zip(texts, found, strict=True)]
        columns = list(batch.columns)
        columns[at] = pa.array(masked, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    masked = map_rows(docs, docs.schema, work)
    return masked.withColumn(length, F.length(text).cast("long")) if length in docs.columns else masked
