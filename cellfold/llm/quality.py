"""Quality scores by naive-Bayes support vectors.

A text's features are indicators of its byte n-grams (one to three bytes of
the UTF-8 text; those of three hashed into a fixed table) and of word n-grams
that are one word n times over, whichever word it is. Each indicator is
scaled by the log ratio of its smoothed frequencies among good and bad
training texts, and a linear hinge-loss model is fitted on the scaled
indicators by dual coordinate descent. The model is blended with its own mean
weight, as usual for this method, and a logistic curve fitted on training
texts left out of the descent turns margins into scores from 0 to 1.

The fit uses a bounded sample of labelled documents (``sample`` of them, by a
hash of their ids; only the numbers of a text's features, at most one per
table entry, reach the driver). Scoring reads every whole text once, where it
lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.blobs import pack_sorted, unpack_sorted
from cellfold.llm.common import doc_fold, utf8

TABLE = 1 << 16  # entries for each order of two bytes and up
REPEATS = 256 + 2 * TABLE  # one word n times in a row: n = 2, 3, 4-7, 8-15, ...
SIZE = REPEATS + 8
CHUNK = 1 << 20


class Indicators:
    """Finds the distinct features of a text; keeps one scratch table."""

    def __init__(self) -> None:
        self.flags = np.zeros(SIZE, dtype=bool)

    def of(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer(utf8(text), dtype=np.uint8)
        for i in range(0, len(raw), CHUNK):
            b = raw[i:i + CHUNK + 2].astype(np.uint32)
            self.flags[b] = True
            if len(b) > 1:
                two = b[:-1] << 8 | b[1:]
                self.flags[256 + two] = True
            if len(b) > 2:
                three = ((two[:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16)
                self.flags[256 + TABLE + three] = True
        words = utf8(text).split()
        longest, run = 1, 1
        for a, b in zip(words, words[1:]):
            run = run + 1 if a == b else 1
            if run > longest:
                longest = run
        steps = min(8, 0 if longest < 2 else 1 if longest < 3 else longest.bit_length())
        self.flags[REPEATS:REPEATS + steps] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


class NBSVM:
    """Fitted on rows of feature numbers and labels 0 or 1."""

    def __init__(self, rows: list[np.ndarray], labels: list[int], c: float = 0.1,
                 epochs: int = 12, alpha: float = 1.0, blend: float = 0.25, seed: int = 3):
        y = np.array(labels, dtype=np.int64)
        self.weights, self.scale, self.shift = np.zeros(SIZE), 0.0, 0.0
        good = float(y.mean()) if len(y) else 0.5
        self.prior = float(np.log((good * len(y) + 1) / ((1 - good) * len(y) + 1)))
        if len(set(labels)) < 2:
            self.shift = self.prior
            return
        held = np.random.default_rng(seed).random(len(y)) < 0.2
        if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
            held[:] = False
        fit = np.flatnonzero(~held)
        p, q = np.full(SIZE, alpha), np.full(SIZE, alpha)
        for i in fit:
            (p if y[i] else q)[rows[i]] += 1
        ratio = np.log(p / (y[fit].sum() + 2 * alpha)) - np.log(q / ((1 - y[fit]).sum() + 2 * alpha))
        w = self._descend([rows[i] for i in fit], y[fit] * 2 - 1, ratio, c, epochs, seed)
        mean = np.abs(w).mean()
        self.weights = ((1 - blend) * mean + blend * w) * ratio
        check = np.flatnonzero(held) if held.any() else fit
        self._calibrate(np.array([self.margin(rows[i]) for i in check]), y[check])

    @staticmethod
    def _descend(rows, y, ratio, c, epochs, seed) -> np.ndarray:
        """Dual coordinate descent for min |w|^2/2 + C sum hinge(1 - y w.x), rows of unit length."""
        square = ratio * ratio
        size = np.array([max(float(np.sqrt(square[r].sum())), 1e-12) for r in rows])
        diag = np.array([float(square[r].sum()) / s ** 2 for r, s in zip(rows, size)])
        upper = c * len(y) / 2 / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
        upper = upper * 10
        a, w = np.zeros(len(y)), np.zeros(SIZE)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            worst = 0.0
            for i in rng.permutation(len(y)):
                if diag[i] == 0:
                    continue
                r = rows[i]
                v = ratio[r] / size[i]
                g = y[i] * float(w[r] @ v) - 1
                new = min(max(a[i] - g / diag[i], 0.0), upper[i])
                if new != a[i]:
                    w[r] += (new - a[i]) * y[i] * v
                    worst = max(worst, abs(new - a[i]))
                    a[i] = new
            if worst < 1e-4:
                break
        return w

    def margin(self, row: np.ndarray) -> float:
        """Per feature, so that long and short texts are on one scale."""
        return float(self.weights[row].sum() / np.sqrt(len(row))) if len(row) else 0.0

    def _calibrate(self, m: np.ndarray, y: np.ndarray) -> None:
        spread = float(m.std()) or 1.0
        a, b, x = 1.0, 0.0, m / spread
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(100):  # Newton steps on the logistic loss
            p = 1 / (1 + np.exp(-(a * x + b)))
            h = np.maximum(p * (1 - p), 1e-9)
            g = np.array([((p - target) * x).sum(), (p - target).sum()])
            hess = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]])
            step = np.linalg.solve(hess + 1e-6 * np.eye(2), g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
            if np.abs(step).max() < 1e-8:
                break
        self.scale, self.shift = a / spread, b

    def score(self, row: np.ndarray) -> float:
        """A text without features gets the share of good texts."""
        z = self.scale * self.margin(row) + self.shift if len(row) else self.prior
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2,
                sample: int = 6000) -> NBSVM:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    Null ids, labels other than 0 and 1, ids labelled both ways and ids that
    ``docs`` does not have are left out. An id counts once, however many rows
    it has: with the text of the smallest hash.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = (labels.filter("doc_id is not null and quality in (0, 1)")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").cast("int").alias("y"), F.max("quality").cast("int").alias("top"))
             .filter((F.col("y") == F.col("top")) & (doc_fold(F.col("doc_id"), folds) != held_fold)))
    known = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "y")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Indicators()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "hash": b["hash"], "found": [
                pack_sorted(find.of(t).astype(np.uint64)) for t in b["text"]]})

    # the sample has a fixed bound, so it may go to every task
    rows = (texts.join(F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("text"))
            .mapInPandas(features, "doc_id long, y int, hash long, found binary")
            .groupBy("doc_id", "y").agg(F.min(F.struct("hash", "found"))["found"].alias("found"))
            .orderBy("doc_id").collect())
    return NBSVM([unpack_sorted(r["found"]).astype(np.uint32) for r in rows], [r["y"] for r in rows])


def scorer(model: NBSVM):
    """A column function: the score of a text column."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = Indicators()
        for t in texts:
            yield pd.Series([model.score(find.of(x)) for x in t], dtype="float64")

    return score


def quality_scores(docs: DataFrame, model: NBSVM, threshold: float = 0.7, folds: int = 4,
                   held_fold: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score depends on the text alone. Null texts count as empty; repeated
    documents each get a row; a null id keeps its row and hashes as ''. Other
    columns are not read.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        scorer(model)("text").alias("score"))
            .select("doc_id", (doc_fold(F.col("doc_id"), folds) == held_fold).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: NBSVM, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at or above the threshold."""
    return docs.filter(scorer(model)("text") >= threshold)
