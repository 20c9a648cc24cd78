"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

Two tiers: a minimal perfect hash finds whole pre-tokens that are in the vocabulary; any other
pre-token is merged over its linked bytes, with a heap of the pairs by rank.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame

from matchloom.llm.common import SPACES, share, shared_value, text_slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SLICE_BYTES = 2 << 20

_MASK = (1 << 64) - 1


def load_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in order of their rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: n keys in n slots.

    Keys are dealt to buckets; the largest bucket first, each takes the first displacement that
    sends its keys to free slots. The last, single keys take free slots outright (stored as negative
    numbers). A lookup reads one displacement, one slot and compares the key there.
    """

    def __init__(self, keys: list[bytes], load: int = 2):
        self.keys, n = keys, len(keys)
        self.buckets = max(1, n // load)
        halves = [xxhash.xxh128_intdigest(k) for k in keys]
        self.slots = np.full(n, -1, np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        dealt: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(halves):
            dealt[(h >> 96) % self.buckets].append(i)
        taken, free = bytearray(n), 0
        for bucket in sorted(range(self.buckets), key=lambda b: -len(dealt[b])):
            members = dealt[bucket]
            if len(members) == 1:
                free = taken.index(0, free)
                self.shift[bucket] = -free - 1
                taken[free], self.slots[free] = 1, members[0]
            elif members:
                move = 0
                while True:
                    spots = {self._slot(halves[i], move) for i in members}
                    if len(spots) == len(members) and not any(map(taken.__getitem__, spots)):
                        break
                    move += 1
                self.shift[bucket] = move
                for i in members:
                    spot = self._slot(halves[i], move)
                    taken[spot], self.slots[spot] = 1, i

    def _slot(self, h: int, move: int) -> int:
        mixed = ((h ^ move * 0x9E3779B97F4A7C15) & _MASK) * 0xFF51AFD7ED558CCD & _MASK
        return (mixed >> 32) % len(self.keys)

    def get(self, key: bytes) -> int:
        """Number of the key, or -1."""
        if not self.keys:
            return -1
        h = xxhash.xxh128_intdigest(key)
        move = int(self.shift[(h >> 96) % self.buckets])
        spot = -move - 1 if move < 0 else self._slot(h, move)
        found = int(self.slots[spot])
        return found if found >= 0 and self.keys[found] == key else -1


class ByteBpe:
    """Encoder and decoder over a list of tokens in order of rank."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN, most: int = 500_000):
        self.tokens, self.whole = tokens, PerfectHash(tokens)
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.pattern = pattern.replace(r"[^\s", rf"[^{SPACES}").replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")
        self.most, self.known = most, {}
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(lengths)])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_token(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.whole.get(token)
        return [whole] if whole >= 0 else self.merge(token)

    def merge(self, token: bytes) -> list[int]:
        """Merge the lowest-ranked, leftmost pair again and again; a pair in the heap whose ends have changed is passed over."""
        n, rank = len(token), self.ranks.get
        after = list(range(1, n + 1))  # where the part that starts here ends, which is the start of the next
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(token[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i, end = heappop(heap)
            middle = after[i]
            if middle < 0 or middle >= n or after[middle] != end:
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                following = after[end]
                if (r := rank(token[i:following])) is not None:
                    heappush(heap, (r, i, following))
            if (p := before[i]) >= 0 and (r := rank(token[p:end])) is not None:
                heappush(heap, (r, p, end))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[token[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Pre-tokens met before are looked up; beyond ``most`` of them the store starts anew."""
        cut = [regex.findall(self.pattern, t) for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for token in set(chain.from_iterable(cut)) - known.keys():
            known[token] = np.array(self.encode_token(token.encode()), np.int32).tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, tokens)), np.int32) for tokens in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, gathered from the tokens."""
        starts = self.token_start[ids]
        lengths = self.token_start[ids + 1] - starts
        total = int(lengths.sum())
        offsets = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        return self.token_bytes[offsets + np.arange(total)].tobytes()


def _shared(docs: DataFrame, ranks: str):
    """The codec, sent to each executor once; its size is that of the vocabulary file, which does not grow with the data."""
    return share(docs.sparkSession, ByteBpe(load_ranks(ranks)))


def encode(docs: DataFrame, ranks: str = RANKS, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The ``keep`` columns with ``ids`` (array of int) of every text, and with ``decoded`` what the ids decode to (binary).

    A null or empty text has no ids. Special tokens do not exist: their strings are ordinary text.
    Ranks have to hold all 256 single bytes, so every text can be encoded. No row is shuffled; texts are
    taken in slices of bounded bytes, and pre-tokens that come again in a worker are looked up.
    """
    codec = _shared(docs, ranks)
    kept = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, SLICE_BYTES):
            found = shared_value(codec).encode(texts)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32()))
            columns = [*[part.column(c) for c in keep], ids]
            if decoded:  # in the same worker, which has the codec
                texts = [shared_value(codec).decode(x.astype(np.int64)) for x in found]
                columns.append(pa.array(texts, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*keep, "ids", *(["decoded"] if decoded else [])]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return kept.mapInArrow(run, ", ".join([*fields, "ids array<int>", *(["decoded binary"] if decoded else [])]))


def decode(encoded: DataFrame, ranks: str = RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``ids`` with ``decoded`` (binary); null ids decode to no bytes, an unknown id fails."""
    codec = _shared(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            lists = part.column("ids")
            texts = [shared_value(codec).decode(x.values.to_numpy().astype(np.int64)) if x.is_valid else b"" for x in lists]
            columns = [part.column(c) for c in [*keep, "ids"]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], [*keep, "ids", "decoded"])

    fields = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep]
    return encoded.select(*keep, "ids").mapInArrow(run, ", ".join([*fields, "ids array<int>", "decoded binary"]))
