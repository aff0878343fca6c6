"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is cut into chunks and each chunk is compressed with either dictionary; the difference of the two sizes, as a
share of their sum, says which kind of text it resembles. A logistic curve, fitted on labelled rows that the
dictionaries did not see, turns the difference into a score between 0 and 1.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from webwinnow.llm.common import text_bytes


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample: rows per label, bytes of a row that may be learnt from, dictionary and chunk size,
    chunks per row that the dictionary is trained on.

    The rows are those of lowest hash; longer texts are left out of the sample (all texts are scored whole).
    """

    rows: int = 1500
    row_bytes: int = 20_000
    dictionary: int = 112 << 10
    chunk: int = 1024
    pieces: int = 4
    level: int = 3
    cut: float = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    fit: Fit

    def differences(self, texts: list[bytes]) -> np.ndarray:
        """(size with bad - size with good) / (sum of both); an empty text has 0."""
        packers = [self._packer(d) for d in (self.bad, self.good)]
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            view = memoryview(text)
            sizes = [sum(len(p.compress(view[a : a + self.fit.chunk])) for a in range(0, len(text), self.fit.chunk)) for p in packers]
            if sum(sizes):
                out[i] = (sizes[0] - sizes[1]) / sum(sizes)
        return out

    def _packer(self, body: bytes) -> zstandard.ZstdCompressor:
        words = zstandard.ZstdCompressionDict(body)
        words.precompute_compress(level=self.fit.level)
        return zstandard.ZstdCompressor(level=self.fit.level, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.differences(texts) + self.offset)))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text leaves 2 modulo 4; null ids are held out as well."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps with a light penalty."""
    scale = max(float(np.abs(x).std()), 1e-6)
    z = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ w)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), z.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _dictionary(texts: list[bytes], fit: Fit) -> bytes:
    """A dictionary trained on chunks spread over the sample texts of one kind; too few of them are used as they are."""
    chunks = []
    for text in texts:
        step = max(fit.chunk, len(text) // fit.pieces)
        chunks += [text[a : a + fit.chunk] for a in range(0, len(text), step)][: fit.pieces]
    try:
        return zstandard.train_dictionary(fit.dictionary, chunks).as_bytes()
    except zstandard.ZstdError:  # the trainer asks for more text than a tiny sample holds
        return b"\n".join(chunks)[-fit.dictionary :] or b" "


def fit_classifier(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from at most ``fit.rows`` rows of each label; null labels and texts are left out, repeated labels count once."""
    ids = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    chosen = None
    for y in (0, 1):
        few = ids.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(fit.rows).select(F.col(id_col).alias("i"), "y")
        chosen = few if chosen is None else chosen.unionByName(few)
    # at most 2 * rows ids, so the broadcast is bounded; so are the texts that come back
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.octet_length("t").between(1, fit.row_bytes))
    met = texts.join(F.broadcast(chosen), "i").groupBy("i", "y").agg(F.min("t").alias("t"))  # of a repeated id the least text
    rows = met.select("i", "y", F.col("t").cast("binary").alias("t")).collect()
    rows.sort(key=lambda r: zlib.crc32(str(r["i"]).encode()))
    parts: dict[int, list[bytes]] = {y: [bytes(r["t"]) for r in rows if r["y"] == y] for y in (0, 1)}
    learn = {y: t[: len(t) // 2] for y, t in parts.items()}
    model = Model(_dictionary(learn[1], fit), _dictionary(learn[0], fit), 0.0, 0.0, fit)
    rest = [(t, y) for y in (0, 1) for t in parts[y][len(parts[y]) // 2 :]]
    if len({y for _, y in rest}) < 2:
        return Model(model.good, model.bad, 100.0, 0.0, fit)
    slope, offset = _curve(model.differences([t for t, _ in rest]), np.array([y for _, y in rest], float))
    return Model(model.good, model.bad, max(slope, 0.0), offset, fit)


def score_quality(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row of *docs*: the id, ``held_out``, ``score`` of the whole text and ``predicted`` (score of at least the cut).

    Null and empty texts get the score of no difference. Repeated rows get equal scores; null ids are held out; other
    columns are ignored; an empty table gives an empty result; without labels of both kinds the curve is fixed.
    """
    model = fit_classifier(docs, labels, fit, id_col, text_col, label_col)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(texts), pa.float64())], [id_col, "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= fit.cut).cast("int").alias("predicted"))
