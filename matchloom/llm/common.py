"""What several operators share: tables, stored steps, free column names, pieces of text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.support import use_checkpoint_dir

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """New path below the folder that ``spark.checkpoint.dir`` names."""
    return f"{use_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: computed once, and safe from lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value) -> Broadcast:
    """Send a value of bounded size to every executor once; workers need not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(handle: Broadcast):
    """The value that was shared. A worker unpacks it once, so what it remembers serves later tasks."""
    if not hasattr(handle, "unpacked"):
        handle.unpacked = cloudpickle.loads(handle.value)
    return handle.unpacked


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that no column has, whatever its case."""
    used, names = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        names.append(name)
    return names


def replace_text(docs: DataFrame, text) -> DataFrame:
    """The documents with another text, and ``n_chars`` to match where that column exists."""
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(changed)


def byte_slices(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches: Iterable[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches balanced by bytes of ``text``, with the texts (null: empty)."""
    for batch in batches:
        column = batch.column("text")
        for start, stop in byte_slices(column, limit):
            texts = column.slice(start, stop - start).to_pylist()
            yield batch.slice(start, stop - start), [t or "" for t in texts]


# White space as Unicode has it, for a character class; libraries differ on the control characters in _CONTROL.
_WIDE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACES = r"\t-\r\x20" + "".join(map(chr, _WIDE))
_CONTROL = r"\x00\x1c-\x1f" + chr(0x180E)
ODD = re.compile(f"[{_CONTROL}]")
_UNSURE = re.compile(rf"[{SPACES}]\x20|[{_CONTROL}]")
_RUNS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")


def safe_pieces(text: str) -> tuple[str, list[str]]:
    """Cut a text where byte-level pre-tokenisation cuts it in any case.

    Returns the first piece and the parts after it, each of which stands for ``" " + part``.
    A cut lies between a character that is no white space and a space that follows it: no match
    of the pattern spans that place and none looks back. A text with a run of white space is cut
    only before such runs; then the first piece is empty and each part carries what it stands for
    after a marker. A text with a control character that libraries class in different ways is not cut.
    """
    if not _UNSURE.search(text):
        parts = text.split(" ")
        return parts[0], parts[1:]
    if ODD.search(text):
        return text, []
    return "", [f"\0{p}" for p in _RUNS.findall(text)]


def piece_text(part: str) -> str:
    """What a part of ``safe_pieces`` stands for."""
    return part[1:] if part[:1] == "\0" else f" {part}"


class Pieces(dict):
    """Numbers of text pieces, and their values, worked out once for each different piece.

    ``number`` gives a piece its number, a new one if it was not met before; ``settle`` maps all new
    pieces at once by ``solve``, after which ``values`` has the value of every number. ``start`` empties
    the store beyond ``most`` pieces, so memory stays bounded. As part of a shared value it serves all
    tasks of a worker.
    """

    def __init__(self, solve: Callable[[list[str]], list], most: int = 500_000):
        self.solve, self.most, self.values, self.new = solve, most, [], []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number

    def start(self) -> Callable[[str], int]:
        if len(self) > self.most:
            self.clear()
            self.values = []
        return self.__getitem__

    def settle(self, spell: Callable[[str], str] | None = None) -> Callable[[int], object]:
        """Work out the new pieces; ``spell`` gives what a part stands for. Returns the way to a number's value."""
        if self.new:
            self.values += self.solve([spell(p) for p in self.new] if spell else self.new)
            self.new = []
        return self.values.__getitem__

    def texts(self, texts: list[str]) -> Iterator[list]:
        """For each text the values of its safe pieces, in order."""
        number = self.start()
        cut = []
        for text in texts:
            first, parts = safe_pieces(text)
            cut.append((first, list(map(number, parts))))
        value = self.settle(piece_text)
        heads = iter(self.solve([first for first, _ in cut if first]))
        for first, parts in cut:
            found = [next(heads)] if first else []
            found += map(value, parts)
            yield found
