"""Quality scores from compression: how much better does good text help to compress a document than bad text?

One zstandard dictionary is built from text labelled good, one from text labelled bad. A document is
compressed in pieces with each; the difference of the two sizes, over its length, goes through a
logistic curve that is fitted on labelled documents which the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import share, shared_value, text_slices


@dataclass(frozen=True)
class CompressionParams:
    """``documents``: most labelled documents of each class that are collected for the fit, whole, of which every
    other one goes into the dictionary. A document beyond ``document_bytes`` is not sampled, and neither are those
    that follow once a class has ``class_bytes``. ``piece``: bytes compressed at a time, so that a long text cannot explain itself. ``cutoff``: least
    score of a document predicted to be good.
    """

    documents: int = 2000
    document_bytes: int = 256 << 10
    class_bytes: int = 32 << 20
    dictionary_bytes: int = 96 << 10
    piece: int = 512
    level: int = 3
    cutoff: float = 0.3


def pieces(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


class CompressionModel:
    """Two dictionaries and the curve. Without text of both classes every score is the share of good labels.

    ``counts``: labelled documents of both classes where ``good`` and ``bad`` are samples of them. The curve and
    the share follow these counts, so the scores do not depend on how much of a class was sampled.
    """

    def __init__(
        self,
        good: list[str],
        bad: list[str],
        params: CompressionParams = CompressionParams(),
        counts: tuple[int, int] | None = None,
    ):
        self.params, self.compressors = params, None
        counts = counts or (len(good), len(bad))
        self.slope, self.base = 0.0, float(np.log((counts[0] + 1) / (counts[1] + 1)))
        cut = [[pieces(t.encode(), params.piece) for t in texts] for texts in (good, bad)]
        self.dictionaries = [self._dictionary([p for text in texts[::2] for p in text]) for texts in cut]
        held = [[self.difference_of(b"".join(x)) for x in texts[1::2]] for texts in cut]
        if all(held) and all(self.dictionaries):
            weights = [[count / len(x)] * len(x) for count, x in zip(counts, held)]
            y = np.array([1.0] * len(held[0]) + [0.0] * len(held[1]))
            self._fit(np.array(held[0] + held[1]), y, np.array(weights[0] + weights[1]))
        self.compressors = None

    def _dictionary(self, samples: list[bytes]) -> bytes:
        try:
            return zstandard.train_dictionary(self.params.dictionary_bytes, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too little text to train on: its end serves as it is
            return b"".join(samples)[-self.params.dictionary_bytes :]

    def difference_of(self, data: bytes) -> float:
        """(size with bad text - size with good text) / bytes; 0 for no text or without dictionaries."""
        if not data or not all(self.dictionaries):
            return 0.0
        if self.compressors is None:
            self.compressors = []
            for content in self.dictionaries:
                known = zstandard.ZstdCompressionDict(content)
                known.precompute_compress(level=self.params.level)
                options = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
                self.compressors.append(zstandard.ZstdCompressor(dict_data=known, **options).compress)
        parts = pieces(data, self.params.piece)
        good, bad = (sum(len(compress(p)) for p in parts) for compress in self.compressors)
        return (bad - good) / len(data)

    def _fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> None:
        """Weighted logistic regression on one number, by Newton steps; the ridge keeps a clean split finite."""
        scale = float(np.abs(x).max()) or 1.0
        design = np.stack([x / scale, np.ones_like(x)], axis=1)
        w = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (weight * (p - y)) + ridge * w
            hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            w -= step
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.base = float(w[0] / scale), float(w[1])

    def score(self, text: str) -> float:
        at = self.slope * self.difference_of(text.encode()) + self.base
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def held_out(doc_id):
    """Whether a document is kept from all fitting: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, params: CompressionParams = CompressionParams()) -> CompressionModel:
    """Fit on labelled rows that are not held out.

    The documents of each class with the smallest digests of their ids are taken, so the choice does
    not depend on the order of rows; ids are chosen first, and only the chosen texts are collected, each of them
    whole, as long as they are within the bounds of the parameters. Null labels say
    nothing; a document labelled more than once counts as good if any label says so, and of rows that share a
    ``doc_id`` the text with the smallest digest stands for all. All labelled documents of
    each class are counted, and the samples weigh as much as their class.
    """
    known = labels.where("doc_id is not null and quality is not null and quality in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("quality") == k).orderBy(*order).limit(params.documents) for k in (1, 0)]
    ids = chosen[0].union(chosen[1])
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64("text").alias("digest")).join(F.broadcast(ids), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min_by("text", F.struct("digest", "text")).alias("text"))
    size = F.octet_length("text").cast("bigint")
    before = F.sum(size).over(Window.partitionBy("quality").orderBy(*order))  # of the documents chosen only
    texts = texts.where(size <= params.document_bytes).withColumn("total", before).where(F.col("total") <= params.class_bytes)
    rows = sorted(texts.collect(), key=lambda r: r["doc_id"])
    good, bad = ([r["text"] for r in rows if r["quality"] == k] for k in (1, 0))
    return CompressionModel(good, bad, params, (total.get(1, 0), total.get(0, 0)))


def quality_scores(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row.

    Whole texts are scored; a null or empty text gets the score of no difference. The model's size is
    bounded by its parameters; it is broadcast, and no row is shuffled.
    """
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            scores = pa.array([shared_value(shared).score(t) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    predicted = (F.col("score") >= model.params.cutoff).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
