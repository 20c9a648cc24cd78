"""Token ids in compact binary files: patched frame-of-reference blocks.

A segment is a byte string that can be read by itself: whole documents with about
``SEGMENT`` ids, little-endian throughout:

    "PFR1", documents u32, ids u64                           head
    first id of each document u64, one more for the end      document index
    byte where each block starts u32, one more for the end   block index, counted from the first block
    blocks of 128 ids, the last one filled up with its minimum:
        minimum u32, width u8, exceptions u8,
        128 differences from the minimum at ``width`` bits,
        place u8 and whole difference u32 of each exception

The width of a block is what 90 % of its differences need; greater ones are exceptions. Segments are
rows of a Parquet table, beside the ids of their documents, so that Spark's committer writes them to
any file system and a lost task leaves nothing behind.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm.common import ODD, Pieces, share, shared_value, text_slices

MODEL = public_tokenizers.path("word_bpe_49k.json")
END = 1
BLOCK = 128
COVER = 0.9
SEGMENT = 1 << 16
SEGMENT_SCHEMA = "part int, segment int, first bigint, doc_ids array<{kind}>, n_tokens bigint, payload binary"
_LINE = 0xFFFFFFFF  # stands for a line end between words; no token has this id
_END = _LINE.to_bytes(4, "little")
_HEAD = "<4sIQ"
# words of Latin letters up to U+024F but for U+0130, whose lower case is two characters
PLAIN = r"^[\x21-\x{12F}\x{131}-\x{24F}]+$"
_BLOCK = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "u1")])


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of the ids as bytes, and where each starts, with the end."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return b"", np.zeros(1, np.uint32)
    filled = np.empty(count * BLOCK, np.uint32)
    filled[: len(ids)] = ids
    tail = ids[(count - 1) * BLOCK :]
    filled[len(ids) :] = tail.min()
    blocks = filled.reshape(count, BLOCK)
    least = blocks.min(axis=1)
    over = blocks - least[:, None]
    common = np.sort(over, axis=1)[:, int(np.ceil(COVER * BLOCK)) - 1]
    width = np.zeros(count, np.uint8)
    for bit in range(32):
        width[common >> np.uint32(bit) > 0] = bit + 1
    outlier = over.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    exceptions = outlier.sum(axis=1).astype(np.uint8)
    sizes = _BLOCK.itemsize + width.astype(np.int64) * (BLOCK // 8) + exceptions.astype(np.int64) * 5
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    heads = np.zeros(count, _BLOCK)
    heads["least"], heads["width"], heads["exceptions"] = least, width, exceptions
    out[starts[:-1, None] + np.arange(_BLOCK.itemsize)] = heads.view(np.uint8).reshape(count, -1)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = (over[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        out[starts[rows, None] + _BLOCK.itemsize + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(outlier)
    if len(row):
        first = starts[:-1] + _BLOCK.itemsize + width.astype(np.int64) * (BLOCK // 8)
        rank = np.arange(len(row)) - np.concatenate([[0], np.cumsum(exceptions.astype(np.int64))])[row]
        out[first[row] + rank] = place
        at = first[row] + exceptions[row] + 4 * rank
        out[at[:, None] + np.arange(4)] = over[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), starts.astype(np.uint32)


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that start at ``starts[:-1]`` in the bytes; 128 for each block."""
    starts = starts.astype(np.int64)
    count = len(starts) - 1
    if count < 1:
        return np.zeros(0, np.uint32)
    heads = data[starts[:-1, None] + np.arange(_BLOCK.itemsize)].reshape(-1).view(_BLOCK)
    width = heads["width"].astype(np.int64)
    over = np.zeros((count, BLOCK), np.uint32)
    body = starts[:-1] + _BLOCK.itemsize
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = data[body[rows, None] + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        values = np.zeros((len(rows), BLOCK), np.uint32)
        for bit in range(w):
            values |= bits[:, :, bit].astype(np.uint32) << np.uint32(bit)
        over[rows] = values
    exceptions = heads["exceptions"].astype(np.int64)
    row = np.repeat(np.arange(count), exceptions)
    if len(row):
        first = body + width * (BLOCK // 8)
        rank = np.arange(len(row)) - np.concatenate([[0], np.cumsum(exceptions)])[row]
        place = data[first[row] + rank]
        at = first[row] + exceptions[row] + 4 * rank
        over[row, place] = data[at[:, None] + np.arange(4)].reshape(-1).view("<u4")
    return (over + heads["least"][:, None]).reshape(-1)


def write_segment(documents: list[np.ndarray]) -> bytes:
    """One segment from the ids of its documents, each an unsigned 32-bit array."""
    edges = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<u8")
    body, starts = pack(np.concatenate([*documents, np.zeros(0, np.uint32)]))
    return b"".join([struct.pack(_HEAD, b"PFR1", len(documents), int(edges[-1])), edges.tobytes(), starts.astype("<u4").tobytes(), body])


def _indexes(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    magic, documents, ids = struct.unpack_from(_HEAD, payload)
    if magic != b"PFR1":
        raise ValueError("not a segment")
    at = struct.calcsize(_HEAD)
    edges = np.frombuffer(payload, "<u8", documents + 1, at).astype(np.int64)
    at += 8 * (documents + 1)
    count = -(-ids // BLOCK) + 1
    starts = np.frombuffer(payload, "<u4", count, at)
    return edges, starts, np.frombuffer(payload, np.uint8, offset=at + 4 * count)


def read_segment(payload: bytes) -> list[np.ndarray]:
    """The ids of each document of a segment."""
    edges, starts, body = _indexes(payload)
    return np.split(unpack(body, starts)[: edges[-1]], edges[1:-1]) if len(edges) > 1 else []


def read_document(payload: bytes, number: int) -> np.ndarray:
    """The ids of one document; only the blocks that hold it are unpacked."""
    edges, starts, body = _indexes(payload)
    first, last = int(edges[number]), int(edges[number + 1])
    if first == last:
        return np.zeros(0, np.uint32)
    blocks = slice(first // BLOCK, (last - 1) // BLOCK + 2)
    at = first - first // BLOCK * BLOCK
    return unpack(body, starts[blocks])[at : at + last - first]


def _byte_alphabet() -> dict[int, str]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(rest)}


_BYTES = _byte_alphabet()


def _strings(words: pa.Array) -> list[str]:
    """Words without white space as strings; one string that is cut is far cheaper than one conversion for each."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().split(" ")


class WordTokenizer:
    """Ids by the library, worked out once for each different word of a worker.

    The tokenizer drops white space and splits the rest by a pattern that it names itself, so words
    and the matches within them are encoded apart. Words are put into lower case and split here only
    where that is the same in any Unicode version (Latin letters up to U+024F, no special strings);
    a text with control characters that libraries class in different ways goes through whole, and so
    does every text if the file describes another kind of tokenizer.
    """

    def __init__(self, model: str):
        self.model, self.loaded = model, None
        with open(model, encoding="utf-8") as file:
            config = json.load(file)
        steps = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers", [])]
        first = next(iter((config.get("pre_tokenizer") or {}).get("pretokenizers", [])), {})
        self.pattern = first.get("pattern", {}).get("Regex")
        rest = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])[1:]
        spelled = [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in rest] == [("ByteLevel", False, False)]
        self.cuts = steps == ["NFC", "Replace", "Lowercase"] and first.get("behavior") == "Removed" and bool(self.pattern) and spelled
        self.words, self.tokens = Pieces(self._of_words), Pieces(self._of_tokens)

    def _tokenizer(self):
        if self.loaded is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.model)
            self.loaded.no_truncation()
            self.loaded.no_padding()
            self.split = regex.compile(f"{self.pattern}|\n").findall
        return self.loaded

    def _by_library(self, words: list[str]) -> list[bytes]:
        result: list[bytes] = []
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000]
            found = self._tokenizer().encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            edges = 4 * np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(part) + 1))
            data = ids.tobytes()
            result += [data[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]
        return result

    def _of_tokens(self, tokens: list[str]) -> list[bytes]:
        """Ids of matches of the pattern, which the model of the library gets one by one, spelled in its byte alphabet."""
        split = self._tokenizer().model.tokenize
        pack = struct.Struct
        forms = [pack(f"<{n}I").pack for n in range(64)]
        result: list[bytes] = []
        for token in tokens:
            if token == "\n":
                result.append(_END)
                continue
            if not token.isascii():
                token = token.encode().decode("latin-1").translate(_BYTES)
            ids = [t.id for t in split(token)]
            result.append(forms[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes())
        return result

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; the plain ones are split together, with line ends between them."""
        self._tokenizer()
        given = pa.array(words, pa.string())
        plain = pc.and_not(pc.match_substring_regex(given, PLAIN), pc.match_substring(given, "<|"))
        number = self.tokens.start()
        lines = "".join(f"{w}\n" for w in _strings(given.filter(plain)))
        places = [*map(number, self.split(lines.lower()))]
        value = self.tokens.settle()
        ids = np.frombuffer(b"".join(map(value, places)), "<u4")
        ends = 4 * np.flatnonzero(ids == _LINE)
        data = ids.tobytes()
        found = (data[a:b] for a, b in zip([0, *(ends[:-1] + 4).tolist()], ends.tolist()))
        others = iter(self._by_library(given.filter(pc.invert(plain)).to_pylist()))
        return [next(found if p else others) for p in plain.to_pylist()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text: words are split and numbered by Arrow, looked up once each, and their ids gathered."""
        odd = [not self.cuts or ODD.search(t) is not None for t in texts]
        split = pc.utf8_split_whitespace(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.string()))
        coded = split.flatten().dictionary_encode()
        number = self.words.start()
        numbers = [number(w) if w else -1 for w in _strings(coded.dictionary)]
        value = self.words.settle()
        values = [value(n) if n >= 0 else b"" for n in numbers]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        starts = (np.cumsum(sizes) - sizes)[codes] - ends + lengths
        places = np.repeat(starts, lengths)
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(values), "<u4")[places]
        edges = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        whole = iter(self._by_library([t for t, o in zip(texts, odd) if o]))
        return [np.frombuffer(next(whole), "<u4") if o else ids[a:b] for o, a, b in zip(odd, edges, edges[1:])]


def write_token_files(docs: DataFrame, path: str, model: str = MODEL, end: int = END) -> None:
    """Encode every text, end each with ``end``, and write the segments in ascending ``doc_id`` order.

    Documents are dealt to parts by ranges of ``doc_id`` (nulls first; rows that share one are ordered by
    their text), so the order holds across parts and no key has to be in one task with another. A null
    or empty text is a document of one id. A segment closes once it holds ``SEGMENT`` ids.
    """
    shared = share(docs.sparkSession, WordTokenizer(model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = np.array([end], "<u4")
        number = first = held = 0
        ids: list[np.ndarray] = []
        names: list = []

        def close() -> pa.RecordBatch:
            columns = [[part], [number], [first], [names], [held], [write_segment(ids)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(columns, ["part", "segment", "first", "doc_ids", "n_tokens", "payload"])

        for batch, texts in text_slices(batches):
            id_type = batch.column("doc_id").type
            for name, found in zip(batch.column("doc_id").to_pylist(), shared_value(shared).encode(texts)):
                names.append(name)
                ids.append(np.concatenate([found, last]))
                held += len(found) + 1
                if held >= SEGMENT:
                    yield close()
                    number, first, held, ids, names = number + 1, first + held, 0, [], []
        if ids:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENT_SCHEMA.format(kind=kind)).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian).

    Segments are read where they lie; only the number of ids of each part is summed up, and those sums,
    one per part of the write, are broadcast.
    """
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    sums = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("part", F.coalesce(before, F.lit(0).cast("bigint")).alias("offset"))
    placed = segments.join(F.broadcast(offsets), "part")
    placed = placed.select((F.col("first") + F.col("offset")).alias("first"), "doc_ids", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                documents = read_segment(batch.column("payload")[row].as_py())
                sizes = np.array([len(d) for d in documents], np.int64)
                starts = batch.column("first")[row].as_py() + np.cumsum(sizes) - sizes
                ids = pa.array([d.astype("<u4").tobytes() for d in documents], pa.binary())
                names = batch.column("doc_ids")[row].values
                columns = [names, pa.array(starts, pa.int64()), pa.array(sizes), ids]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
