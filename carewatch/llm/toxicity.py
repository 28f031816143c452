"""Operator 10: toxic passages as maximum-scoring segments.

A word scores the log-odds that it stands in a toxic text, with Dirichlet priors in a chain:
the prior of a word is the estimate of its six-character beginning, whose prior is that of the
five-character beginning, down to three characters and the base rate. So unseen compounds of
toxic stems score too, rare words stay near the base rate, and words of clean texts score below
zero. A constant is taken off, which makes the expected score negative.

One linear scan over the scores of all occurrences finds all maximal scoring segments of a text
(no segment can be extended or shortened with gain). Inside a segment a word scores above zero
once: the segment's score is that of its best part, with repeats in the part taken as words
without evidence. So a text that repeats one word a hundred times is no hundred times as toxic,
and what stands elsewhere in the text takes nothing from a passage. These scores follow an extreme-value law in clean text: a segment of
score S in n words is expected K n exp(-lambda S) times by chance. lambda solves
sum p(s) exp(lambda s) = 1 over the word scores of clean training texts, K is fitted to their
best segments. Segments expected less than `SIGNIFICANT` times are passages; the text's
evidence is the sum of their -ln(expectation), and a logistic fit turns it into a score.

Word statistics and the fit use a bounded sample of labelled rows: about `SAMPLE` of them
(all, if there are fewer), chosen by a hash of doc_id; 70 % give the word scores, the others
the fit. Every text is scored whole.

Defined cases: a null or empty text has no passage and gets the score of no evidence; a label
that is null, or whose doc_id is null, is not learned from; several labels of one document
count as toxic if any is; without labelled rows of both classes every score is 0; equal texts
get equal scores; an empty table gives an empty result; an input column named like a result
is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

SAMPLE = 20_000
HOLD_OUT = (3, 1)
PREFIXES = (3, 4, 5, 6)
PRIOR = 8.0
MARGIN = 0.7
CLEAN_TEXTS = 3
SIGNIFICANT = 1.0
THRESHOLD = 0.7
MEMO = 200_000
STRIP = ".,;:!?\"'()-#*$%&|<>[]{}=_+/\\~`@^"
OUTPUTS = ("passages", "score", "predicted")
PASSAGE = "array<struct<first_word:int,last_word:int,score:double,expected:double>>"


def held_out(id_col, mod=HOLD_OUT):
    """Whether a row is kept from learning: crc32 of doc_id as text; a null doc_id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod[0] == mod[1], F.lit(True))


def units(word: str) -> list[str]:
    """The chain of a word: its beginnings, and itself with an end mark."""
    word = word.strip(STRIP)
    return [word[:k] for k in PREFIXES if len(word) > k] + [word + "$"] if word else []


def words_of(text: str) -> list[str]:
    return text.lower().split()


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in one linear pass with a stack: each
    candidate holds the running sum before and after it and a link to the nearest candidate below
    it whose start sum is lower; a new one joins back to the nearest such candidate, if the
    joined score gains. Links skip what an earlier search has skipped, so no candidate is
    passed over twice."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    first: list[int] = []
    last: list[int] = []
    low: list[float] = []  # sum before
    high: list[float] = []  # sum after
    link: list[int] = []
    for i, before, after in zip(up.tolist(), total[up].tolist(), total[up + 1].tolist(), strict=True):
        begin, j = i, len(first) - 1
        while True:
            while j >= 0 and low[j] >= before:
                j = link[j]
            if j < 0 or high[j] >= after:
                break
            begin, before, below = first[j], low[j], link[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
            j = below
        first.append(begin)
        last.append(i)
        low.append(before)
        high.append(after)
        link.append(j)
    return [(a, b, y - x) for a, b, x, y in zip(first, last, low, high, strict=True)]


def distinct_score(words: list[str], scores: np.ndarray) -> float:
    """The greatest score of a part of a segment if repeats of a word in the part score -MARGIN.

    Ends go from left to right. A start that is worth no more than a later one never is again
    (a word adds to the later one alone, or the same to both), so the starts kept fall in worth and
    the first is the best. Only differences of neighbours are held: a word takes from the one
    difference between the starts before and after its last occurrence, which a union-find
    over dropped starts finds, so a pass is linear but for that."""
    up = np.flatnonzero(scores > 0).tolist()
    names = [words[i].strip(STRIP) for i in up]
    if len(set(names)) == len(names):
        return float(scores.sum())
    total = np.concatenate(([0.0], np.cumsum(scores))).tolist()
    kept: list[int] = []  # start -> itself, or a start before it (-1: none) if it was dropped
    before: list[int] = []  # neighbours of a kept start
    after: list[int] = []
    less: list[float] = []  # its worth less that of the next kept start

    def held(k: int) -> int:
        """The last kept start up to the k-th."""
        root = k
        while root >= 0 and kept[root] != root:
            root = kept[root]
        while k >= 0 and kept[k] != root and kept[k] != k:
            kept[k], k = root, kept[k]
        return root

    latest: dict[str, int] = {}
    best = top = bottom = 0.0  # worth of the first and of the last kept start
    last, end = -1, 0
    for k, (i, name) in enumerate(zip(up, names, strict=True)):
        gain, between = float(scores[i]), total[i] - total[end]  # words between, none above zero
        changed = -1
        kept.append(k)
        before.append(last)
        after.append(-1)
        less.append(0.0)
        if last < 0:
            top = gain
        else:
            at = held(latest[name]) if name in latest else -1
            top += between + (gain if at < 0 else -MARGIN)
            bottom += between + (-MARGIN if at == last else gain)
            if 0 <= at != last:
                less[at] -= MARGIN + gain
                changed = at
            after[last], less[last] = k, bottom - gain
        for start in (changed, last):
            while start >= 0 and kept[start] == start and less[start] <= 0:
                ahead, behind = before[start], after[start]
                kept[start], before[behind] = ahead, ahead
                if ahead < 0:
                    top -= less[start]
                else:
                    after[ahead] = behind
                    less[ahead] += less[start]
                start = ahead
        last, bottom, end = k, gain, i + 1
        latest[name] = k
        best = max(best, top)
    return best


@dataclass
class Model:
    """Scores of the known units, and the constants of the calibration."""
    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    bias: float = -50.0
    memo: dict[str, float] = field(default_factory=dict)

    def word(self, raw: str) -> float:
        score = self.memo.get(raw)
        if score is None:
            for unit in reversed(units(raw)):
                score = self.scores.get(unit)
                if score is not None:
                    break
            else:
                score = 0.0
            score -= MARGIN
            if len(self.memo) >= MEMO:
                self.memo.clear()
            if len(raw) <= 64:
                self.memo[raw] = score
        return score

    def scan(self, text: str | None) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """Scores of all words of a text, and its maximal segments (first, last, score) with
        repeats inside a segment counted once."""
        words = words_of(text or "")
        scores = np.array([self.word(w) for w in words], float)
        return scores, [(a, b, distinct_score(words[a:b + 1], scores[a:b + 1])) for a, b, _ in segments(scores)]

    def passages(self, text: str | None) -> list[tuple[int, int, float, float]]:
        scores, parts = self.scan(text)
        found = []
        for first, last, score in parts:
            expected = math.exp(min(700.0, self.log_k + math.log(len(scores)) - self.lam * score))
            if expected < SIGNIFICANT:
                found.append((first, last, score, expected))
        return found

    def probability(self, passages) -> float:
        z = self.bias + self.slope * evidence(passages)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def evidence(passages) -> float:
    return sum(-math.log(max(p[3], 1e-300)) for p in passages)


def unit_scores(counts: dict[str, tuple[int, int]], n1: int, n0: int) -> dict[str, float]:
    """Log-odds of each unit against the base rate, smoothed along its chain."""
    base = n1 / (n1 + n0)
    rate: dict[str, float] = {}

    def parent(u: str) -> float:
        word = u.removesuffix("$")
        for k in reversed(PREFIXES):
            if k < len(word) and word[:k] in rate:
                return rate[word[:k]]
        return base

    for u in sorted(counts, key=lambda u: (u.endswith("$"), len(u), u)):
        y1, y0 = counts[u]
        rate[u] = (y1 + PRIOR * parent(u)) / (y1 + y0 + PRIOR)
    logit = lambda p: math.log(p / (1 - p))
    return {u: logit(r) - logit(base) for u, r in rate.items()}


def solve_lambda(values: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1 (1 if no score is positive)."""
    if not (values > 0).any() or (p * values).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    f = lambda lam: (p * np.exp(np.minimum(700, lam * values))).sum() - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton's method with a slight ridge."""
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p) + 1e-6)[:, None]) + np.diag([0.05, 1e-3])
        step = np.linalg.solve(h, a.T @ (y - p) - np.array([0.05, 1e-3]) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def training_sample(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text",
                    label_col="toxic", sample=SAMPLE) -> DataFrame:
    """(text, toxic, fit) of about `sample` labelled rows outside the held-out third."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(id_col))
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("toxic")))
    n = known.count()
    share = min(1.0, sample / max(1, n))
    draw = F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1 << 20))
    chosen = known.filter(draw < int(share * (1 << 20))).withColumn(
        "fit", F.pmod(F.xxhash64("__id", F.lit("fold")), F.lit(10)) >= 7)
    # at most about `sample` rows of 13 bytes
    return (docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"))
            .select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), "toxic", "fit"))


def train(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text",
          label_col="toxic", sample=SAMPLE) -> Model:
    """The model from the labelled sample. The driver receives the units of the sample, and one row
    for each text of the fit: both bounded by `sample`. A unit that stands in no toxic text and in
    fewer than `CLEAN_TEXTS` clean ones says nothing that its beginning does not say (its log-odds
    would be within 0.3 of it) and is left to it."""
    rows = training_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample=sample)

    def count(batches):
        for rb in batches:
            pos: Counter[str] = Counter()
            neg: Counter[str] = Counter()
            for text, toxic in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                seen = {u for w in set(words_of(text)) for u in units(w)}
                seen.add("")  # counts the texts
                (pos if toxic else neg).update(seen)
            names = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_pydict({
                "unit": pa.array(names, pa.string()), "y1": pa.array([pos[u] for u in names], pa.int64()),
                "y0": pa.array([neg[u] for u in names], pa.int64())})

    counts = (rows.filter("not fit").select("text", "toxic").mapInArrow(count, "unit string, y1 long, y0 long")
              .groupBy("unit").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
              .filter(f"y1 >= 1 or y0 >= {CLEAN_TEXTS} or unit = ''").toArrow())
    table = {u: (y1, y0) for u, y1, y0 in zip(*[counts.column(k).to_pylist() for k in range(3)], strict=True)}
    n1, n0 = table.pop("", (0, 0))
    model = Model()
    if not n1 or not n0:
        return model
    model.scores = unit_scores(table, n1, n0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        m = shared.value
        for rb in batches:
            out: list[tuple] = []
            hist: Counter[float] = Counter()
            for text, toxic in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                s, parts = m.scan(text)
                if not toxic:
                    hist.update(np.round(s, 1).tolist())
                out.append((toxic, len(s), [x[2] for x in parts], None, None))
            out += [(None, None, None, float(v), k) for v, k in hist.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True) if out else [[]] * 5,
                (pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.int64()), strict=True)],
                names=["toxic", "n", "segments", "value", "times"])

    hist: Counter[float] = Counter()
    fit = []
    for r in rows.filter("fit").select("text", "toxic").mapInArrow(
            scan, "toxic int, n int, segments array<double>, value double, times long").collect():
        if r["toxic"] is None:
            hist[r["value"]] += r["times"]
        else:
            fit.append((r["toxic"], r["n"], r["segments"]))
    if not hist or not fit:
        return model
    values = np.array(sorted(hist))
    p = np.array([hist[v] for v in values.tolist()], float)
    model.lam = solve_lambda(values, p / p.sum())
    # Gumbel law of the best segment: the mean of lambda * S - ln n is ln K + 0.5772
    best = [model.lam * max(s) - math.log(n) for toxic, n, s in fit if not toxic and s]
    model.log_k = float(np.mean(best)) - 0.5772 if best else 0.0
    x = np.array([sum(max(0.0, model.lam * v - model.log_k - math.log(n)) for v in s) if n else 0.0
                  for _, n, s in fit])
    model.slope, model.bias = logistic_fit(x, np.array([float(t) for t, _, _ in fit]))
    model.slope = max(0.0, model.slope)
    return model


def toxicity(docs: DataFrame, model: Model, *, text_col="text", threshold=THRESHOLD) -> DataFrame:
    """`docs` with passages (significant segments, words counted from 0), score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, OUTPUTS, keep=(text_col,))

    @F.pandas_udf(f"passages {PASSAGE}, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            found = [m.passages(t) for t in texts]
            yield pd.DataFrame({
                "passages": [[dict(zip(("first_word", "last_word", "score", "expected"), p, strict=True)) for p in f]
                             for f in found],
                "score": [m.probability(f) for f in found]})

    return (docs.withColumn("__t", run(F.col(text_col)))
            .select(*[f"`{c}`" for c in docs.columns], F.col("__t.passages").alias("passages"),
                    F.col("__t.score").alias("score"),
                    F.when(F.col("__t.score") >= threshold, 1).otherwise(0).alias("predicted")))
