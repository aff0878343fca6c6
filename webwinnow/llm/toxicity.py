"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

``P(grade <= k) = sigmoid(t_k - w.x)``: all thresholds share the weights *w* and stay in order, so the grades are
levels of one scale. The labels only tell toxic from clean; the grade of a toxic labelled row is one, two or three by how
often it holds words that toxic rows use far more than clean ones. A feature is the hash of a word or of a word's first
four bytes (word forms share their stem), its value the logarithm of one plus its count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from webwinnow.llm.common import mix, text_bytes, word_hashes, word_spans
from webwinnow.llm.decontamination import normalised

GRADES = 4


@dataclass(frozen=True)
class Fit:
    """Bounds of the fit: labelled rows per kind (lowest hashes), word features, rounds; lift of a toxic word."""

    toxic_rows: int = 3000
    clean_rows: int = 6000
    features: int = 512
    rounds: int = 600
    lift: float = 8.0
    share: float = 0.01


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted int64 hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, x: np.ndarray) -> np.ndarray:
        """Probability of each grade from ``w.x``."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - x[:, None], -40, 40)))
        return np.diff(np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], axis=1), axis=1)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes, two per word (the word, and its first four characters), and the first of each row."""
    data, offsets = normalised(*text_bytes(column))
    # characters, of which those beyond the table of bytes are no white space
    starts, ends, first = word_spans(np.minimum(data, 255).astype(np.uint8), offsets)
    features = np.empty(2 * len(starts), np.uint64)
    features[0::2] = word_hashes(data, starts, ends, lower=False)
    head = np.zeros(len(starts), np.uint64)
    for k in range(4):
        at = np.minimum(starts + k, max(0, len(data) - 1))
        head = (head << np.uint64(8)) | np.where(starts + k < ends, data[at] if len(data) else 0, 0).astype(np.uint64)
    features[1::2] = mix(head + np.uint64(1 << 40))
    return features.view(np.int64), 2 * first


def _counted(docs: DataFrame, keep: np.ndarray | None = None) -> DataFrame:
    """``id, text`` (first two columns) -> ``id, words, counts`` of distinct words, or of those in the sorted *keep*."""
    name, kind = docs.columns[0], docs.dtypes[0][1]

    def run(batches):
        for batch in batches:
            words, first = _words(batch.column(1))
            flat, counts = [], []
            for a, b in zip(first[:-1], first[1:]):
                mine = words[a:b]
                if keep is not None:
                    mine = mine[_found(mine, keep)]
                w, c = np.unique(mine, return_counts=True)
                flat.append(w)
                counts.append(c)
            ends = pa.array(np.cumsum([0] + [len(w) for w in flat]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (flat, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [name, "words", "counts"])

    return docs.mapInArrow(run, f"`{name}` {kind}, words array<bigint>, counts array<bigint>")


def _found(words: np.ndarray, keep: np.ndarray) -> np.ndarray:
    if not len(keep):
        return np.zeros(len(words), bool)
    return keep[np.minimum(np.searchsorted(keep, words), len(keep) - 1)] == words


def _regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the likelihood, with a light penalty on the weights.

    Thresholds are a first value and positive steps (exponentials), so they cannot cross.
    """
    n, v = x.shape
    p = np.zeros(v + GRADES - 1)
    m, s = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, rounds + 1):
        w, free = p[:v], p[v:]
        steps = np.exp(np.clip(free[1:], -10, 10))
        t = free[0] + np.concatenate([[0], np.cumsum(steps)])
        below = 1 / (1 + np.exp(-np.clip(t[None, :] - (x @ w)[:, None], -40, 40)))
        full = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        likely = np.maximum(full[np.arange(n), y + 1] - full[np.arange(n), y], 1e-12)
        slope = full * (1 - full)
        up, down = slope[np.arange(n), y + 1], slope[np.arange(n), y]
        per = weight / likely
        gt = np.zeros(GRADES + 1)
        np.add.at(gt, y + 1, per * up)
        np.add.at(gt, y, -per * down)
        gt = gt[1:-1]
        gw = -(x.T @ (per * (up - down))) - 1e-4 * w * n
        gf = np.concatenate([[gt.sum()], [gt[j:].sum() * steps[j - 1] for j in range(1, GRADES - 1)]])
        g = np.concatenate([gw, gf]) / n
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        p += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
    free = p[v:]
    return p[:v], free[0] + np.concatenate([[0], np.cumsum(np.exp(np.clip(free[1:], -10, 10)))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled rows within the bounds of *fit*; null labels are left out, repeated labels count once."""
    ids = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("i")).agg(F.max(label_col).alias("y"))
    order = (F.xxhash64("i"), F.col("i"))
    chosen = ids.where("y = 1").orderBy(*order).limit(fit.toxic_rows).unionByName(ids.where("y = 0").orderBy(*order).limit(fit.clean_rows))
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "i")
    texts = texts.groupBy("i", "y").agg(F.min("t").alias("t"))  # of a repeated id the least text
    counted = _counted(texts.select(F.struct("i", "y").alias("row"), "t"))
    sizes = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([4.0, 5.0, 6.0]))
    found = counted.select("row.y", F.explode("words").alias("w")).groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    pa1, pb0 = (F.col("a") + 0.5) / (n1 + 1), (F.col("b") + 0.5) / (n0 + 1)
    found = found.withColumn("lift", pa1 / pb0).withColumn("gap", F.abs(pa1 - pb0) / F.sqrt((F.col("a") + F.col("b") + 1) / (n1 + n0 + 1)))
    top = found.orderBy(F.desc("gap"), "w").limit(fit.features).collect()  # at most ``features`` rows
    words = np.array(sorted(r["w"] for r in top), np.int64)
    strong = {r["w"] for r in top if r["lift"] >= fit.lift and r["a"] >= fit.share * n1}
    rows = _counted(texts.select(F.struct("i", "y").alias("row"), "t"), words).collect()  # rows and features are bounded
    x, y = np.zeros((len(rows), len(words))), np.zeros(len(rows), np.int64)
    for at, r in enumerate(sorted(rows, key=lambda r: r["row"]["i"])):
        x[at, np.searchsorted(words, np.array(r["words"], np.int64))] = np.log1p(np.array(r["counts"], float))
        hits = sum(c for w, c in zip(r["words"], r["counts"]) if w in strong)
        y[at] = r["row"]["y"] * (1 + (hits >= 6) + (hits >= 10))
    weights, thresholds = _regress(x, y, np.ones(len(rows)), fit.rounds)
    return Model(words, weights, thresholds)


def toxic_grades(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row of *docs*: the id, ``expected_severity`` (0 to 3), ``toxic_probability`` and ``predicted`` (0 or 1).

    Whole texts are scored. Null and empty texts have no feature. Repeated rows get equal grades; null ids stay null;
    other columns are ignored; an empty table gives an empty result; without labels of both kinds all is clean.
    """
    model = fit_toxicity(docs, labels, fit, id_col, text_col, label_col)

    def run(batches):
        for batch in batches:
            words, first = _words(batch.column(1))
            hit = np.flatnonzero(_found(words, model.words))
            row = np.searchsorted(first, hit, side="right") - 1
            pair, count = np.unique(row * max(1, len(model.words)) + np.searchsorted(model.words, words[hit]), return_counts=True)
            x = np.zeros(batch.num_rows)
            np.add.at(x, pair // max(1, len(model.words)), np.log1p(count) * model.weights[pair % max(1, len(model.words))] if len(pair) else 0.0)
            p = model.grades(x)
            columns = [pa.array(p @ np.arange(GRADES), pa.float64()), pa.array(1 - p[:, 0], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "expected_severity", "toxic_probability"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, expected_severity double, toxic_probability double")
    return scored.withColumn("predicted", (F.col("toxic_probability") >= 0.5).cast("int"))
