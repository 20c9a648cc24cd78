"""Personal data: fixed patterns, and a skip-chain random field that carries their labels to like tokens.

The patterns find the base spans. The random field has a node for each token with a digit or ``@``: one
factor for its shape, one for each pair of neighbours, and one for each pair of next occurrences of
the same token, however distant. Loopy message passing gives each node its belief; a token that the
patterns missed is added where its belief is strong, e.g. a number that is found once and is run into
other digits elsewhere in the document. Base spans are evidence and stay as they are.

Factors are trained piecewise on the base spans of the whole corpus: counts by shape, by neighbours and
by repeated tokens, summed up by Spark. Tokens in a match that was dropped say nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import share, shared_value, text_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "email", "ip", "card", "card+", "phone", "phone+")
# The patterns of the task, with guards that skip starts which cannot match, so that work stays linear.
_EMAIL = regex.compile(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = regex.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_HAS = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_CORE = re.compile(r"[+(]?[A-Za-z0-9](?:.*[A-Za-z0-9)])?", re.DOTALL)
_KEY = re.compile(r"[^a-z0-9@]+")


@dataclass(frozen=True)
class FieldParams:
    """``rounds`` of message passing, ``damping`` of each, ``belief`` that a label needs, ``prior`` weight of the
    label shares of all tokens for a shape, ``strength``: bound on the logarithm of a pair factor.
    """

    rounds: int = 10
    damping: float = 0.3
    belief: float = 0.8
    prior: float = 5.0
    strength: float = 4.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans as (start, kind, end) in order, and the matches that were dropped as (start, end)."""
    found, dropped = [], []
    if not _HAS.search(text):
        return found, dropped
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in _EMAIL.finditer(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        for m in pattern.finditer(text):
            if kind == 1:
                good = all(map(_small, m[0].split(".")))
            else:
                digits = "".join(_DIGITS.findall(m[0]))
                good = 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15
            if good:
                found.append((m.start(), kind, m.end()))
            elif kind != 2 or len(digits) > 9:
                dropped.append((m.start(), m.end()))
    return sorted(found), sorted(dropped)


def shape(core: str) -> str:
    """Kind of token, from its characters alone."""
    if "@" in core:
        return "email" if _EMAIL.fullmatch(core) else "at"
    if core[:1] == "+":
        return "plus" if core[1:].isdigit() and len(core) < 5 else "plus long"
    if core[:1] == "(":
        return "paren" if core[1:-1].isdigit() and core[-1:] == ")" else "paren other"
    if _DIGITS.fullmatch(core):
        n = len(core)
        if 14 <= n <= 19:
            return "luhn" if luhn(core) else "long"
        return f"{n} digits" if n < 10 else "10 to 13 digits" if n < 14 else "over 19 digits"
    if _IP.fullmatch(core):
        return "quad" if all(map(_small, core.split("."))) else "quad over"
    if re.fullmatch(r"[0-9-]+", core):
        return f"{min(len(core), 12)} with hyphens"
    return "letters" if re.search(r"[A-Za-z]", core) else "other"


class Graph:
    """Nodes and edges of the documents of a slice: tokens with a digit or ``@``."""

    def __init__(self, texts: list[str]):
        self.doc: list[int] = []
        self.spans: list[tuple[int, int]] = []
        self.shapes: list[str] = []
        self.labels: list[int] = []  # -1: not known, for tokens in a dropped match
        self.base_nodes: list[bool] = []
        self.base: list[list[tuple[int, int, int]]] = []
        self.edges: list[list[tuple[int, int]]] = [[], []]
        for number, text in enumerate(texts):
            spans, dropped = base_spans(text)
            self.base.append(spans)
            if _HAS.search(text):
                self._add(number, text, spans, dropped)

    def _add(self, number: int, text: str, spans: list[tuple[int, int, int]], dropped: list[tuple[int, int]]) -> None:
        last, at, gone, seen = -2, 0, 0, {}
        for place, m in enumerate(_TOKEN.finditer(text)):
            token = m[0]
            if not _HAS.search(token):
                continue
            start, end = m.span()
            while at < len(spans) and spans[at][2] <= start:
                at += 1
            while gone < len(dropped) and dropped[gone][1] <= start:
                gone += 1
            # spans of different kinds may overlap: the first that reaches into the token labels it
            hit = next((s for s in spans[at : at + 8] if s[0] < end and s[2] > start), None)
            if hit:
                kind = LABELS.index(KINDS[hit[1]])
                label = kind + 1 if hit[0] < start and hit[1] > 1 else kind
            else:
                label = -1 if gone < len(dropped) and dropped[gone][0] < end else 0
            core = _CORE.search(token)
            low, high = (start + core.start(), start + core.end()) if core else (start, end)
            node = len(self.doc)
            self.doc.append(number)
            self.spans.append((low, high))
            self.shapes.append(shape(text[low:high]))
            self.labels.append(label)
            self.base_nodes.append(hit is not None)
            if place == last + 1:
                self.edges[0].append((node - 1, node))
            key = _KEY.sub("", token.lower())
            if key in seen:
                self.edges[1].append((seen[key], node))
            seen[key], last = node, place

    def counts(self) -> Counter:
        """How often each shape has each label, and each pair of labels stands at each kind of edge."""
        found = Counter((0, s, y, 0) for s, y in zip(self.shapes, self.labels) if y >= 0)
        for kind, edges in enumerate(self.edges, 1):
            found.update((kind, "", self.labels[a], self.labels[b]) for a, b in edges if min(self.labels[a], self.labels[b]) >= 0)
        return found


class Field:
    """Trained factors, as logarithms."""

    def __init__(self, rows: list[tuple[int, str, int, int, int]], params: FieldParams = FieldParams()):
        size, self.params = len(LABELS), params
        shapes: dict[str, np.ndarray] = {}
        pairs = np.full((2, size, size), 0.5)
        for kind, name, a, b, n in rows:
            if kind == 0:
                shapes.setdefault(name, np.zeros(size))[a] += n
            else:
                pairs[kind - 1, a, b] += n
        every = sum(shapes.values(), np.zeros(size)) + 0.1
        self.every = np.log(every / every.sum())
        share = every / every.sum()
        self.shapes = {s: np.log((c + params.prior * share) / (c.sum() + params.prior)) for s, c in shapes.items()}
        joint = pairs / pairs.sum(axis=(1, 2), keepdims=True)
        ratio = np.log(joint / (joint.sum(axis=2, keepdims=True) * joint.sum(axis=1, keepdims=True)))
        self.pairs = np.clip(ratio, -params.strength, params.strength)

    def beliefs(self, shapes: list[str], known: np.ndarray, edges: list[list[tuple[int, int]]]) -> np.ndarray:
        """Loopy sum-product: a row of probabilities per node. ``known`` holds fixed labels, or -1."""
        size = len(LABELS)
        node = np.array([self.shapes.get(s, self.every) for s in shapes]).reshape(-1, size)
        fixed = np.flatnonzero(known >= 0)
        node[fixed] = -60.0
        node[fixed, known[fixed]] = 0.0
        parts = [(np.array(e, np.int64).reshape(-1, 2), np.exp(f)) for e, f in zip(edges, self.pairs)]
        ends = np.concatenate([x for e, _ in parts for x in (e[:, 0], e[:, 1])] or [np.zeros(0, np.int64)])
        others = np.concatenate([x for e, _ in parts for x in (e[:, 1], e[:, 0])] or [np.zeros(0, np.int64)])
        sizes = [len(e) for e, _ in parts]
        back = np.concatenate([[], *[base + np.r_[n : 2 * n, 0:n] for base, n in zip(np.cumsum([0, *[2 * s for s in sizes[:-1]]]), sizes)]])
        back = back.astype(np.int64)
        messages = np.full((len(ends), size), 1.0 / size)  # from ends to others
        total = node
        for _ in range(self.params.rounds if len(ends) else 0):
            out = total[ends] - np.log(messages[back])
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new, start = np.empty_like(messages), 0
            for (edge, factor), n in zip(parts, sizes):
                new[start : start + n] = out[start : start + n] @ factor
                new[start + n : start + 2 * n] = out[start + n : start + 2 * n] @ factor.T
                start += 2 * n
            new /= new.sum(axis=1, keepdims=True)
            messages = self.params.damping * messages + (1 - self.params.damping) * new
            total = node.copy()
            np.add.at(total, others, np.log(messages))
        result = np.exp(total - total.max(axis=1, keepdims=True)) if len(total) else total
        return result / result.sum(axis=1, keepdims=True) if len(total) else result

    def added(self, graph: Graph) -> list[list[tuple[int, int, int]]]:
        """Spans to add, by document: runs of nodes whose beliefs are strong, where no base span lies."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in graph.base]
        known = np.where(graph.base_nodes, graph.labels, -1) if graph.doc else np.zeros(0, np.int64)
        belief = self.beliefs(graph.shapes, known, graph.edges)
        best = belief.argmax(axis=1) if len(belief) else []
        joined = {b for _, b in graph.edges[0]}
        open_kind, run = -1, -1
        for i, y in enumerate(best):
            strong = y > 0 and known[i] < 0 and belief[i, 0] <= 1 - self.params.belief and belief[i, y] >= self.params.belief
            if not strong:
                open_kind = -1
                continue
            kind = KINDS.index(LABELS[y].rstrip("+"))
            low, high = graph.spans[i]
            spans = found[graph.doc[i]]
            if LABELS[y][-1] == "+" and i in joined and open_kind == kind and run == i - 1:
                spans[-1] = (spans[-1][0], kind, high)
            else:
                spans.append((low, kind, high))
            open_kind, run = kind, i
        for number, spans in enumerate(found):
            base = graph.base[number]
            found[number] = [s for s in spans if not any(b[0] < s[2] and b[2] > s[0] for b in base)] if base else spans
        return found


def fit_field(docs: DataFrame, params: FieldParams = FieldParams()) -> Field:
    """Train on every document: only counts leave the tasks, and their number is bounded by shapes and labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, texts in text_slices(batches):
            total.update(Graph(texts).counts())
        if total:
            columns = [list(c) for c in zip(*[(*key, n) for key, n in total.items()])]
            types = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "shape", "a", "b", "n"])

    texts = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    counts = texts.mapInArrow(run, "kind int, shape string, a int, b int, n bigint")
    rows = counts.groupBy("kind", "shape", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Field(sorted(tuple(r) for r in rows), params)


def _spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_pii(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: numbers of base spans by kind, their digest, and all spans with those of the field.

    Places are code points, ends exclusive; spans are in order of start, then kind. A null or empty text
    has none: its digest is that of the empty string. Repeated rows each come out. Nothing is shuffled.
    """
    shared = share(docs.sparkSession, field)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            graph = Graph(texts)
            added = shared_value(shared).added(graph)
            kinds = [Counter(s[1] for s in spans) for spans in graph.base]
            counts = [pa.array([k[i] for k in kinds], pa.int64()) for i in range(len(KINDS))]
            digests = [hashlib.sha256(_spelled(spans).encode()).hexdigest() for spans in graph.base]
            spelled = [_spelled(sorted(b + a)) if a else _spelled(b) for b, a in zip(graph.base, added)]
            more = pa.array([len(a) for a in added], pa.int64())
            arrays = [part.column("doc_id"), *counts, pa.array(digests), pa.array(spelled), more]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return docs.select("doc_id", "text").mapInArrow(run, columns)
