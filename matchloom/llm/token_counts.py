"""Token counts with a public tokenizer, lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import Pieces, share, shared_value, text_slices

PIECES = 20_000
MODEL = public_tokenizers.path("byte_bpe_50k.json")


class Lengths:
    """Numbers of tokens by the library that the model file is for; the library loads in the worker."""

    def __init__(self, model: str):
        self.model, self.loaded, self.pieces = model, None, Pieces(self.of_pieces)
        self.cuts = not model.endswith(".model")

    def _tokenizer(self):
        if self.loaded is None:
            if self.cuts:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
                from tokenizers import Tokenizer

                self.loaded = Tokenizer.from_file(self.model)
                self.loaded.no_truncation()
                self.loaded.no_padding()
            else:
                import sentencepiece

                self.loaded = sentencepiece.SentencePieceProcessor(model_file=self.model)
        return self.loaded

    def of_texts(self, texts: list[str]) -> list[int]:
        if not texts:
            return []
        if self.cuts:
            return [len(e) for e in self._tokenizer().encode_batch_fast(texts, add_special_tokens=False)]
        return [len(ids) for ids in self._tokenizer().encode(texts, num_threads=1)]

    def of_pieces(self, texts: list[str]) -> list[int]:
        """Pieces go through the library together, as words that are already split."""
        counts: list[int] = []
        for start in range(0, len(texts), PIECES):
            part = texts[start : start + PIECES]
            words = self._tokenizer().encode(part, is_pretokenized=True, add_special_tokens=False).word_ids
            counts += np.bincount(np.array(words, np.int64), minlength=len(part)).tolist()
        return counts


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = 1024, cut: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row; null texts count as empty.

    Arrow batches are cut into slices balanced by bytes, and texts into pieces at places where the
    pre-tokenisation of a byte-level model cuts in any case; a piece that comes again in a worker is
    looked up. Only lengths leave the task. ``cut=False`` gives the library whole texts, as models
    without that pre-tokenisation need; sentencepiece models always get them. No row is shuffled.
    """
    shared = share(docs.sparkSession, Lengths(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared_value(shared)
        for part, texts in text_slices(batches):
            if cut and lengths.cuts:
                counts = [sum(found) for found in lengths.pieces.texts(texts)]
            else:
                counts = lengths.of_texts(texts)
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), sizes, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
