"""Benchmark items in training passages: BM25 over an inverted index of the items, by block-max WAND.

The index holds the items (long ones in segments); every passage of every document is a query.
A weight is a BM25 weight divided by the segment's score against itself, so one threshold holds for
all segments. Upper bounds of blocks of segments leave out nearly all passages at once; the others
go through the index, and every segment above the threshold counts, however many they are. A hit
stands when the words around it hold enough of both the item's question and its answer.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import free_names, share, shared_value, stored, text_slices

_NOT_WORD = re.compile(r"\W+")
_MARGIN = 1e-9  # sums in another order differ by less
_CELLS = 1 << 21  # numbers in one matrix of bounds
OUT = "score double, question_overlap double, answer_overlap double, passages bigint"


@dataclass(frozen=True)
class BenchmarkParams:
    """Parameters of the search; all lengths in words.

    ``segment``: most words of a segment, and the step between passages of twice that length, so any
    segment that occurs lies whole within one. ``threshold``: share of a segment's own score.
    ``overlap``: share of the question's and of the answer's word ``gram``-grams that must be there.
    ``shard_bytes``: most text of the items in one broadcast index; more items make more shards.
    """

    segment: int = 64
    threshold: float = 0.7
    overlap: float = 0.6
    gram: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 4
    shard_bytes: int = 32 << 20


def item_words(text: str) -> list[str]:
    """Lower-case words without their punctuation."""
    return [w for w in (_NOT_WORD.sub("", x) for x in text.lower().split()) if w]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before the item's last sentence, and those of the last sentence; one sentence is all question."""
    sentences = [s for s in (item_words(x) for x in re.split(r"(?<=[.?!:])\s+|\n", text)) if s]
    if len(sentences) < 2:
        return item_words(text), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def _parts(words: list, most: int) -> list[list]:
    """The segments of an item: as few as have at most ``most`` words, of like length."""
    parts = -(-len(words) // most)
    cuts = [len(words) * i // parts for i in range(parts + 1)] if parts else [0]
    return [words[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Statistics:
    """Of all items: number of segments, their words in total, and the segments that hold a word."""

    segments: int
    words: int
    found: dict[str, int]


class Index:
    """Postings, term bounds and block bounds of the items' segments.

    The items may be a part of all: ``statistics`` then has the numbers of all of them.
    """

    def __init__(self, items: list[tuple[int, str]], params: BenchmarkParams, statistics: Statistics | None = None):
        self.params, self.vocabulary, self.items = params, {}, []
        segments = []
        for item, text in items:
            words = item_words(text or "")
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            parts = question_and_answer(text)
            self.items.append((item, *[self._grams([self.vocabulary[w] for w in p]) for p in parts]))
            segments += [(Counter(part), len(self.items) - 1) for part in _parts(ids, params.segment)]
        # segments of like length have weights of like size: their blocks get tight bounds
        segments.sort(key=lambda s: (len(s[0]), s[1]))
        self.owner = [owner for _, owner in segments]
        segments = [words for words, _ in segments]
        n, size = len(segments), len(self.vocabulary)
        lengths = [sum(s.values()) for s in segments]
        if statistics is None:
            total, words, found = n, sum(lengths), Counter(t for s in segments for t in s)
        else:
            total, words = statistics.segments, statistics.words
            found = {t: statistics.found[w] for w, t in self.vocabulary.items()}
        mean = words / max(1, total)
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in range(size)]
        self.block_max: list[dict[int, float]] = [{} for _ in range(size)]
        for i, (segment, length) in enumerate(zip(segments, lengths)):
            weights = {}
            for t, tf in segment.items():
                idf = np.log1p((total - found[t] + 0.5) / (found[t] + 0.5))
                weights[t] = float(idf * tf * (params.k1 + 1) / (tf + params.k1 * (1 - params.b + params.b * length / mean)))
            whole = sum(weights.values())
            for t, w in weights.items():
                self.postings[t][0].append(i)
                self.postings[t][1].append(w / whole)
                best = self.block_max[t]
                best[i // params.block] = max(best.get(i // params.block, 0.0), w / whole)
        self.term_max = np.array([max(p[1]) for p in self.postings] or [0.0])
        self._bound(max(1, -(-n // params.block)))

    def _bound(self, blocks: int) -> None:
        """Block bounds for whole batches: a dense row for a term of many blocks, a list for any other."""
        self.blocks = blocks
        common = [len(b) > max(1, blocks // 8) for b in self.block_max]
        self.common = np.cumsum(common) * common - 1
        self.dense = np.zeros((sum(common) + 1, blocks), np.float32)  # the last row stands for no term
        for place, bounds in zip(self.common, self.block_max):
            if place >= 0:
                self.dense[place, list(bounds)] = list(bounds.values())
        rows = [[] if c else sorted(b.items()) for c, b in zip(common, self.block_max)]
        self.row_start = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.row_block = np.array([b for r in rows for b, _ in r], np.int64)
        self.row_max = np.array([m for r in rows for _, m in r], np.float64)

    def _passing(self, slot: np.ndarray, term: np.ndarray, passages: int) -> np.ndarray:
        """Which passages have a block whose bound reaches the threshold."""
        counts = self.row_start[term + 1] - self.row_start[term]
        rows = np.repeat(self.row_start[term] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        cells = np.repeat(slot, counts) * self.blocks + self.row_block[rows]
        bound = np.bincount(cells, self.row_max[rows], passages * self.blocks).reshape(passages, self.blocks)
        there = np.zeros((passages, len(self.dense)), np.float32)
        there[slot, self.common[term]] = 1
        bound = bound + there @ self.dense  # counts of no rows at all are whole numbers
        return bound.max(axis=1) >= self.params.threshold - 1e-4  # single precision in the dense part

    def _grams(self, ids: list[int]) -> set[tuple[int, ...]]:
        n = min(self.params.gram, len(ids))
        return {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)} if n else set()

    def search(self, terms: list[int]) -> dict[int, float]:
        """Every segment whose score against the different ``terms`` reaches the threshold: block-max WAND."""
        enough, block = self.params.threshold - _MARGIN, self.params.block
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        found = {}

        def move(cursor: list[int], to: int) -> bool:
            places = self.postings[cursor[2]][0]
            cursor[1] = bisect_left(places, to, cursor[1])
            if cursor[1] < len(places):
                cursor[0] = places[cursor[1]]
                return True
            return False

        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for at, _, t in cursors:
                total += self.term_max[t]
                if total >= enough:
                    pivot = at
                    break
            if pivot < 0:
                break
            upto = 0
            while upto < len(cursors) and cursors[upto][0] <= pivot:
                upto += 1
            bound = sum(self.block_max[c[2]].get(pivot // block, 0.0) for c in cursors[:upto])
            if bound < enough:
                target = (pivot // block + 1) * block
                if upto < len(cursors):
                    target = min(target, cursors[upto][0])
            elif cursors[0][0] == pivot:
                score = sum(self.postings[t][1][i] for _, i, t in cursors[:upto])
                if score >= enough:
                    found[pivot] = score
                target = pivot + 1
            else:
                target = pivot
            cursors = [c for i, c in enumerate(cursors) if i >= upto or c[0] >= target or move(c, target)]
        return found

    def candidates(self, doc: np.ndarray, place: np.ndarray, term: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Passages that some block's bound lets through: (document, step) to the different terms.

        The arrays hold, for each word that the items have, its document (ascending), its place and its term.
        A passage is two steps of a document, so its terms are those new in the first step and those of the
        second that are not in the first.
        """
        step = place // self.params.segment
        order = np.argsort(doc * (len(self.vocabulary) + 1) + term, kind="stable")
        same = (doc[order][1:] == doc[order][:-1]) & (term[order][1:] == term[order][:-1])
        before = np.full(len(doc), -2, np.int64)
        before[order[1:]] = np.where(same, step[order[:-1]], -2)
        width = int(step.max()) + 2 if len(step) else 1
        first, second = before < step, before < step - 1
        second &= step > 0
        key = np.concatenate([(doc * width + step)[first], (doc * width + step - 1)[second]])
        terms = np.concatenate([term[first], term[second]])
        order = np.argsort(key, kind="stable")
        key, terms = key[order], terms[order]
        passages, edges = np.unique(key, return_index=True)
        edges = np.append(edges, len(key))
        slot = np.repeat(np.arange(len(passages)), np.diff(edges))
        found, size = {}, max(1, _CELLS // max(self.blocks, len(self.dense)))
        for a in range(0, len(passages), size):
            b = min(len(passages), a + size)
            at = slice(edges[a], edges[b])
            for p in a + np.flatnonzero(self._passing(slot[at] - a, terms[at], b - a)):
                found[divmod(int(passages[p]), width)] = terms[edges[p] : edges[p + 1]]
        return found

    def hits(self, texts: list[str], words: Terms) -> Iterator[tuple[int, int, float, float, float, int]]:
        """Document number, item, best score, overlaps and number of passages of every hit that stands."""
        ids = [np.fromiter(map(words.__getitem__, t.split()), np.int64) for t in texts]
        ids = [x[x > -2] for x in ids]
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        place = np.concatenate([np.arange(len(x)) for x in ids] or [np.array([], np.int64)])
        term = np.concatenate(ids or [np.array([], np.int64)])
        known = term >= 0
        scores: dict[tuple[int, int], dict[int, float]] = {}
        for (d, step), terms in self.candidates(doc[known], place[known], term[known]).items():
            for segment, score in self.search(terms.tolist()).items():
                at = scores.setdefault((d, self.owner[segment]), {})
                at[step] = max(at.get(step, 0.0), score)
        for (d, number), at in scores.items():
            item, question, answer = self.items[number]
            there = [self._overlap(ids[d], at, part) for part in (question, answer)]
            if min(there) >= self.params.overlap - _MARGIN:
                yield d, item, min(1.0, max(at.values())), *there, len(at)

    def _overlap(self, ids: np.ndarray, steps: dict[int, float], grams: set[tuple[int, ...]]) -> float:
        """Share of the n-grams that the passages hold; nothing to look for is all there."""
        if not grams:
            return 1.0
        n, size = len(next(iter(grams))), self.params.segment
        found = set()
        for step in steps:
            part = ids[step * size : (step + 2) * size].tolist()
            found.update(grams.intersection(zip(*(part[i:] for i in range(n)))))
        return len(found) / len(grams)


class Terms(dict):
    """Term of each raw word: -1 for words that no item has, -2 for punctuation alone. Starts anew when large."""

    def __init__(self, vocabulary: dict[str, int], most: int = 300_000):
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, raw: str) -> int:
        if len(self) >= self.most:
            self.clear()
        word = _NOT_WORD.sub("", raw.lower())
        self[raw] = found = self.vocabulary.get(word, -1) if word else -2
        return found


def _shards(items: DataFrame, limit: int) -> list[DataFrame]:
    """The items in parts of about ``limit`` bytes of text; one part as long as they are proven small."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 if size <= limit else -(-2 * size // limit)
    if parts == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == i) for i in range(parts)]


def _frequencies(items: DataFrame, most: int) -> DataFrame:
    """``word``, ``n`` (segments that hold it); the row without a word has the segments and ``words`` of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            parts = [p for t in texts for p in _parts(item_words(t), most)]
            found = Counter(w for p in parts for w in set(p))
            arrays = [[None, *found], [len(parts), *found.values()], [sum(map(len, parts)), *[0] * len(found)]]
            yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], ["word", "n", "words"])

    kinds = [pa.string(), pa.int64(), pa.int64()]
    counted = items.select("text").mapInArrow(run, "word string, n bigint, words bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))


def _statistics(items: DataFrame, shards: list[DataFrame], most: int) -> Iterator[Statistics | None]:
    """For each shard the statistics of all items, of words only those that it has; None where it is all items."""
    if len(shards) == 1:
        yield None
        return
    every = stored(_frequencies(items, most), "benchmark-words")
    all_items = every.where("word is null").first()
    for shard in shards:
        words = _frequencies(shard, most).select("word")
        rows = every.select("word", "n").join(words, "word").collect()  # no more words than the shard's text has
        yield Statistics(all_items["n"], all_items["words"], {r["word"]: r["n"] for r in rows})


def contaminated(docs: DataFrame, items: DataFrame, params: BenchmarkParams = BenchmarkParams()) -> DataFrame:
    """Every (``doc_id``, ``item_id``) whose item stands in the document, with score and overlaps.

    Items are collected and broadcast in shards of a checked size; frequencies and lengths are those of all
    items, so shards change no score. Documents are read whole, one pass per shard, without a shuffle. Null texts, empty texts and
    items without words hit nothing; equal items and repeated document rows each make rows of their own,
    equal rows of the result count once. A null ``doc_id`` is kept as null.
    """
    kinds = [f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", f"item_id {items.schema['item_id'].dataType.simpleString()}"]
    found = []
    items = items.select("item_id", "text")
    shards = _shards(items, params.shard_bytes)
    for shard, statistics in zip(shards, _statistics(items, shards, params.segment)):
        rows = sorted((tuple(r) for r in shard.where("text is not null").collect()), key=lambda r: (r[0] is None, r))
        index = share(docs.sparkSession, Index(rows, params, statistics))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passages"]
            words = Terms(shared_value(index).vocabulary)
            for part, texts in text_slices(batches):
                hits = list(shared_value(index).hits(texts, words))
                if hits:
                    number, item, *others = zip(*hits)
                    arrays = [part.column("doc_id").take(pa.array(number)), pa.array(item), *map(pa.array, others)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

        found.append(docs.select("doc_id", "text").mapInArrow(run, f"{', '.join(kinds)}, {OUT}"))
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"),
        F.max("question_overlap").alias("question_overlap"),
        F.max("answer_overlap").alias("answer_overlap"),
        F.max("passages").alias("passages"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, params: BenchmarkParams = BenchmarkParams()) -> DataFrame:
    """The documents without those that hold an item. Rows without ``doc_id`` go when any such row holds one."""
    name = free_names(docs.columns, "bad")[0]
    bad = contaminated(docs, items, params).select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
