"""Prefix trie of conversations as balanced parentheses, in shards that Spark sorts and merges.

A node stands for a sequence of turns that some conversation begins with. Conversations are cut into
segments of at most ``BAND`` turns; a segment hangs below the node that its conversation has reached
before it, so a conversation of any length is never one row. All segments are sorted by that node and
their path, which is the order of a walk through the trie, and dealt by ranges of this order: copies of
one conversation, or all that share a first turn, spread over as many tasks as their number asks for.

A shard is a run of this order with about ``SHARD`` nodes, kept as

    parentheses      an opening bit where the walk enters a node, a closing bit where it leaves it
    keys, chars      128-bit key and code points of the last text of each node, in the order of opening
    counts, least    segments that end at each node, and the smallest conversation among them

``findclose`` on blocks of least excess gives the extent of each subtree, the rank of leaf pairs its
leaves, and differences of cumulative arrays its conversations and savings. Shards that follow one
another share only a spine, the nodes on the path where the order was cut: a node counts as new in the
first shard that holds it and as a leaf in the last one, so what shards say of a node adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import stored
from matchloom.operators.support import lookup_join

BAND = 64  # turns of a segment
SHARD = 1 << 16  # nodes of a shard
ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below
KEY = 16  # bytes of a key
PIECE = 4096  # conversations spelled in one piece

SHARD_SCHEMA = (
    "part int, shard int, opening boolean, closing boolean, parentheses binary, keys binary, chars binary, counts binary, "
    "least binary, going binary, bands binary, first binary, last binary, before binary, after binary"
)
NODE_SCHEMA = (
    "key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, below boolean"
)


class Parentheses:
    """Balanced parentheses with a tree of least excess over blocks."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        blocks = max(1, 1 << max(0, int(-(-len(bits) // self.BLOCK) - 1)).bit_length())
        self.excess = np.full(blocks * self.BLOCK, np.iinfo(np.int32).max, np.int32)
        self.excess[: len(bits)] = excess
        self.rows = self.excess.reshape(blocks, self.BLOCK)
        self.least = [self.rows.min(axis=1)]  # from the blocks up to one number for all of them
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Place of the bit that closes each opening bit: the first one after it with less excess than before it."""
        target = self.excess[opens] - 1
        closes = np.full(len(opens), -1, np.int64)
        columns = np.arange(self.BLOCK)
        for start in range(0, len(opens), 1 << 15):
            some = slice(start, start + (1 << 15))
            row = opens[some] // self.BLOCK
            hit = (self.rows[row] <= target[some, None]) & (columns > (opens[some] % self.BLOCK)[:, None])
            found = hit.any(axis=1)
            closes[some] = np.where(found, row * self.BLOCK + hit.argmax(axis=1), -1)
        open_ones = np.flatnonzero(closes < 0)
        node, level = opens[open_ones] // self.BLOCK, np.zeros(len(open_ones), np.int64)
        climbing = np.ones(len(open_ones), bool)
        wanted = target[open_ones]
        for height in range(len(self.least) - 1):  # up until the sibling to the right holds the place
            right = np.minimum(node + 1, len(self.least[height]) - 1)
            here = climbing & (node % 2 == 0) & (self.least[height][right] <= wanted)
            node = np.where(here, right, node)
            level = np.where(here, height, level)
            climbing &= ~here
            node = np.where(climbing, node // 2, node)
        for height in range(len(self.least) - 2, -1, -1):  # down to the leftmost block below it
            down = level > height
            left = np.minimum(node * 2, len(self.least[height]) - 2)
            node = np.where(down, np.where(self.least[height][left] <= wanted, left, left + 1), node)
        hit = self.rows[node] <= wanted[:, None]
        closes[open_ones] = node * self.BLOCK + hit.argmax(axis=1)
        return closes


# --- conversations to segments -------------------------------------------------------------


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (1 for the first turn), ``digest`` of role and text, and ``chars`` of every turn.

    Turns are ordered by ``turn``, null first; turns of equal number by their digests. A null role or text is
    empty; rows without a ``conv_id`` belong to no conversation; repeated rows are turns each. Ranges of
    (conversation, turn) are sorted, not whole conversations, and texts are not moved.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).alias("chars"))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.select("conv_id", "digest", "chars", F.monotonically_increasing_id().alias("row")), "turns")
    part = F.shiftright("row", ROW_BITS).alias("part")
    runs = ordered.groupBy("conv_id", part).agg(F.min("row").alias("start"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    placed = ordered.withColumn("part", part).join(runs, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("row") - F.col("start") + F.col("n_before") + 1).alias("place"), "digest", "chars")


def share_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The conversations with heads in common, as rows like those of ``turn_digests``.

    Conversation c begins with the first h turns of conversation ``c - c % group`` (all if there are fewer,
    none if it does not exist), h being crc32 of c as text modulo ``most``, followed by its own turns after its
    first h. A conversation that has no turn left keeps one row, at place 0. The remainder has the sign of c.
    """
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % most
    base = (conv - conv % group).alias("base")
    heads = turns.where((conv % group == 0) & (F.col("place") < most)).withColumnRenamed("conv_id", "base")
    ids = turns.where("place = 1").select("conv_id", head.alias("h"), base)
    begun = ids.join(heads, "base").where("place <= h").select("conv_id", "place", "digest", "chars")
    sizes = heads.groupBy("base").agg(F.max("place").alias("there"))
    own = turns.select("conv_id", "place", "digest", "chars", head.alias("h"), base).where("place > h")
    own = lookup_join(own, sizes, "base", how="left")
    there = F.least(F.col("h"), F.coalesce(F.col("there"), F.lit(0)))
    own = own.select("conv_id", (F.col("place") - F.col("h") + there).alias("place"), "digest", "chars")
    empty = ids.select("conv_id", F.lit(0).cast("bigint").alias("place"), F.lit("").alias("digest"), F.lit(0).alias("chars"))
    return begun.union(own).union(empty)


def _as_key(*halves: Column) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(h), KEY, "0") for h in halves]))


def segments(turns: DataFrame, band: int = BAND) -> DataFrame:
    """At most ``band`` turns of a conversation each: ``above`` and ``below`` are the nodes before and after it.

    ``path`` holds the digests one after another, ``going`` tells whether the conversation goes on. Rows at
    place 0 only say that the conversation exists.
    """
    number = F.floor(F.greatest(F.col("place") - 1, F.lit(0)) / band).cast("int").alias("band")
    turn = F.struct("place", "digest", "chars")
    grouped = turns.groupBy("conv_id", number).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    real = F.filter("turns", lambda t: t["place"] > 0)
    cut = grouped.select(
        "conv_id",
        "band",
        F.unhex(F.array_join(F.transform(real, lambda t: t["digest"]), "")).alias("path"),
        F.transform(real, lambda t: t["chars"]).alias("chars"),
    )
    cut = cut.withColumns({"x": F.xxhash64("band", "path"), "y": F.xxhash64("path", "band")})
    order = Window.partitionBy("conv_id").orderBy("band")
    upto = {c: F.bit_xor(c).over(order.rowsBetween(Window.unboundedPreceding, 0)) for c in ("x", "y")}
    going = F.lead("band").over(order).isNotNull()
    cut = cut.select("conv_id", "band", "path", "chars", "x", "y", *[v.alias(f"{c}_all") for c, v in upto.items()], going.alias("going"))
    before = [F.col(f"{c}_all").bitwiseXOR(F.col(c)) for c in ("x", "y")]
    return cut.select(
        "conv_id", "band", "path", "chars", "going", _as_key(*before).alias("above"), _as_key(F.col("x_all"), F.col("y_all")).alias("below")
    )


def node_key(above: bytes, below: bytes, path: bytes, turns: int, band: int = BAND) -> bytes:
    """Key of the node so many turns into a segment; the last of a full segment is the node above the next one."""
    return hashlib.md5(below if turns == band else above + path[: KEY * turns]).digest()


# --- shards -------------------------------------------------------------------------------


class _Shard:
    """A shard while segments arrive in order."""

    def __init__(self):
        self.bits, self.keys, self.chars, self.counts, self.least = bytearray(), [], [], [], []
        self.going, self.bands, self.stack, self.first = bytearray(), [], [], None
        self.above = self.path = None

    def add(self, conv: int, number: int, path: bytes, chars: list[int], going: bool, above: bytes, below: bytes, band: int) -> None:
        shared = -1
        if above == self.above:
            size = min(len(path), len(self.path)) // KEY
            shared = next((i for i in range(size) if path[KEY * i : KEY * i + KEY] != self.path[KEY * i : KEY * i + KEY]), size)
        leave = len(self.stack) - shared - 1
        self.bits += b"\0" * leave
        del self.stack[len(self.stack) - leave :]
        for turns in range(shared + 1, len(path) // KEY + 1):
            self.stack.append(len(self.keys))
            self.bits.append(1)
            self.keys.append(node_key(above, below, path, turns, band))
            self.chars.append(chars[turns - 1] if turns else 0)
            self.counts.append(0)
            self.least.append(conv)
            self.going.append(0)
            self.bands.append(number)
        at = self.stack[-1]
        self.counts[at] += 1
        self.least[at] = min(self.least[at], conv)
        self.going[at] |= going
        self.above, self.path = above, path
        if self.first is None:
            self.first = self.spine()

    def spine(self) -> bytes:
        """Keys of the open nodes; that of a later band's root is turned round, as the band above has a node with its key."""
        keys = [self.keys[i] for i in self.stack]
        if keys and self.bands[self.stack[0]]:
            keys[0] = keys[0][::-1]
        return b"".join(keys)

    def values(self) -> dict[str, bytes]:
        last = self.spine()
        bits = np.frombuffer(bytes(self.bits) + b"\0" * len(self.stack), np.uint8)
        return {
            "parentheses": np.packbits(bits, bitorder="little").tobytes(),
            "keys": b"".join(self.keys),
            "chars": np.array(self.chars, "<i8").tobytes(),
            "counts": np.array(self.counts, "<i8").tobytes(),
            "least": np.array(self.least, "<i8").tobytes(),
            "going": bytes(self.going),
            "bands": np.array(self.bands, "<i8").tobytes(),
            "first": self.first,
            "last": last,
        }


def encode_shards(cut: DataFrame, band: int = BAND, nodes: int = SHARD) -> DataFrame:
    """Shards of the trie of the segments, stored in the shared folder; neighbours' spines are in ``before`` and ``after``.

    Within a part a shard learns them as segments pass; at the edges of a part they come from the parts
    next to it, of which there are as many as tasks.
    """
    names = ["conv_id", "band", "path", "chars", "going", "above", "below"]
    fields = [f.strip().split(" ")[0] for f in SHARD_SCHEMA.split(",")]
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[f.strip().split(" ")[1]] for f in SHARD_SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def row(number: int, done: dict, before: bytes | None, after: bytes | None) -> pa.RecordBatch:
            place = {"part": part, "shard": number, "opening": before is None, "closing": after is None}
            values = {**place, **done, "before": before or b"", "after": after or b""}
            return pa.RecordBatch.from_arrays([pa.array([values[f]], t) for f, t in zip(fields, types)], fields)

        number, shard, before, waiting = 0, _Shard(), None, None
        for batch in batches:
            for conv, n, path, chars, going, above, below in zip(*(batch.column(c).to_pylist() for c in names)):
                if len(shard.keys) >= nodes:
                    if waiting is not None:
                        yield row(number - 1, waiting, before, shard.first)
                        before = waiting["last"]
                    waiting, shard, number = shard.values(), _Shard(), number + 1
                shard.add(conv, n, path, chars, going, above, below, band)
        if shard.first is not None:
            done = shard.values()
            if waiting is not None:
                yield row(number - 1, waiting, before, shard.first)
                before = waiting["last"]
            yield row(number, done, before, None)

    order = ["above", "path", "going", "conv_id"]
    shards = cut.select(*names).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARD_SCHEMA)
    shards = stored(shards, "trie-shards")
    edges = shards.groupBy("part").agg(
        F.max(F.when(F.col("opening"), F.col("first"))).alias("first"), F.max(F.when(F.col("closing"), F.col("last"))).alias("last")
    )
    parts = Window.orderBy("part")
    edges = edges.select("part", F.lag("last").over(parts).alias("left"), F.lead("first").over(parts).alias("right"))
    placed = shards.join(F.broadcast(edges), "part")
    missing = F.lit(b"")
    return placed.withColumns(
        {
            "before": F.when(F.col("opening"), F.coalesce("left", missing)).otherwise(F.col("before")),
            "after": F.when(F.col("closing"), F.coalesce("right", missing)).otherwise(F.col("after")),
        }
    ).drop("left", "right")


def shard_nodes(shard: dict[str, bytes], band: int = BAND) -> dict[str, np.ndarray]:
    """What a shard says of each of its nodes; ``below`` marks roots of later bands, which are nodes of the band above."""
    numbers = {c: np.frombuffer(shard[c], "<i8") for c in ("chars", "counts", "least", "bands")}
    n = len(numbers["chars"])
    whole = [shard["keys"][i : i + KEY] for i in range(0, KEY * n, KEY)]
    bits = np.unpackbits(np.frombuffer(shard["parentheses"], np.uint8), bitorder="little")[: 2 * n]
    trie = Parentheses(bits)
    opens = np.flatnonzero(bits)
    closes = trie.findclose(opens)
    size = (closes - opens + 1) // 2
    level = trie.excess[opens] - 1
    until = np.arange(n) + size

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[until] - total[:n]

    def spine(name: str) -> set[bytes]:
        return {shard[name][i : i + KEY] for i in range(0, len(shard[name]), KEY)}

    root = level == 0
    parent, least = np.full(n, -1, np.int64), numbers["least"].copy()
    at_level = [np.flatnonzero(level == d) for d in range(int(level.max()) + 1)]
    for above, here in zip(at_level, at_level[1:]):
        parent[here] = above[np.searchsorted(above, here) - 1]
    for here in at_level[:0:-1]:
        np.minimum.at(least, parent[here], least[here])
    seen, later = spine("before"), spine("after")
    new = np.ones(n, bool)
    for i in range(min(n, len(shard["first"]) // KEY)):  # the first path is the first nodes to open
        new[i] = whole[i] not in seen
    pair = np.zeros(2 * n, bool)  # an opening bit before a closing one
    pair[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
    pair[opens[np.frombuffer(shard["going"], np.uint8) > 0]] = False  # goes on in a later band
    end = opens[np.flatnonzero(level == len(shard["last"]) // KEY - 1)[-1]]
    if shard["last"][-KEY:] in later:
        pair[end] = False
    rank = np.concatenate([[0], np.cumsum(pair)])
    leaves = rank[closes] - rank[opens]
    convs = subtree(numbers["counts"])
    children = np.bincount(parent[~root & new], minlength=n)
    below = root & (numbers["bands"] > 0)
    cost = np.where(below, 0, numbers["chars"] * (convs - new))
    return {
        "key": whole,
        "parent": [None if p < 0 else whole[p] for p in parent],
        "depth": numbers["bands"] * band + level,
        "conv_id": least,
        "n_convs": convs,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": subtree(cost),
        "below": below,
    }


# --- nodes --------------------------------------------------------------------------------


def _ends(cut: DataFrame, band: int) -> DataFrame:
    """Digest of the conversations that end at a node, in ascending order, as they pass by.

    Ranges of (node, conversation) are spelled first, in pieces of at most ``PIECE`` conversations, so the task that
    takes the digest of a node reads pieces, not conversations.
    """
    last = cut.where("not going")
    whole = F.length("path") == KEY * band
    key = F.unhex(F.md5(F.when(whole, F.col("below")).otherwise(F.concat("above", "path"))))
    rows = last.select(key.alias("key"), "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces: list[tuple] = []
            keys, convs = (batch.column(c).to_pylist() for c in ("key", "conv_id"))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start] or i - start == PIECE:
                    pieces.append((keys[start], convs[start], ",".join(map(str, convs[start:i]))))
                    start = i
            columns = list(zip(*pieces)) or [[], [], []]
            types = (pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "first", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
                if k != key:
                    if key is not None:
                        done[0].append(key)
                        done[1].append(digest.hexdigest())
                    key, digest = k, hashlib.sha256(piece.encode())
                else:
                    digest.update(f",{piece}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])

    pieces = rows.mapInArrow(spell, "key binary, first bigint, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(run, "key binary, ends string")


def _carried(cut: DataFrame, nodes: DataFrame, band: int) -> DataFrame:
    """Leaves and savings of later bands, for every node above them.

    The subtree below a band's edge counts for all nodes on the path of one conversation that goes
    through it. Only conversations of more than ``band`` turns have such segments.
    """
    later = nodes.where("below").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")], F.min("conv_id").alias("conv_id"))
    long = cut.where("going or band > 0").withColumn("key", F.unhex(F.md5("above")))
    found = long.join(later, ["conv_id", "key"], "left")
    above = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    sums = {c: F.sum(c).over(above) for c in ("n_leaves", "saved_tokens")}
    found = found.select("band", "path", "above", "below", *[v.alias(c) for c, v in sums.items()]).where("n_leaves is not null")
    start = F.when(F.col("band") == 0, 0).otherwise(1)
    turns = found.withColumn("turns", F.explode(F.sequence(start, (F.length("path") / KEY).cast("int"))))
    prefix = F.concat("above", F.expr(f"substring(path, 1, {KEY} * turns)"))
    key = F.unhex(F.md5(F.when(F.col("turns") == band, F.col("below")).otherwise(prefix)))
    return turns.select(key.alias("key"), "n_leaves", "saved_tokens")


def conversation_trie(turns: DataFrame, band: int = BAND, nodes: int = SHARD) -> DataFrame:
    """Every node of the prefix trie of conversations given as by ``turn_digests``.

    ``conv_id`` (smallest member) and ``depth`` name a node; ``parent_conv_id`` (root: null), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes below, itself included), ``saved_tokens`` (code points that
    members share instead of repeating, over the subtree) and ``ends_sha256`` (digest of the conversations
    that end there, ascending and comma-joined). No conversation, no row. The digest of one node's
    conversations is worked out by one task, which holds none of them.
    """
    cut = stored(segments(turns, band), "trie-segments")
    fields = [f.strip().split(" ")[0] for f in NODE_SCHEMA.split(",")]
    kinds = {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[f.strip().split(" ")[1]] for f in NODE_SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in range(batch.num_rows):
                row = {c: batch.column(c)[shard].as_py() for c in batch.schema.names}
                found = shard_nodes(row, band)
                yield pa.RecordBatch.from_arrays([pa.array(found[f], t) for f, t in zip(fields, types)], fields)

    read = ["parentheses", "keys", "chars", "counts", "least", "going", "bands", "first", "last", "before", "after"]
    said = stored(encode_shards(cut, band, nodes).select(*read).mapInArrow(run, NODE_SCHEMA), "trie-nodes")
    own = said.select(
        "key",
        *[F.when(~F.col("below"), F.col(c)).alias(c) for c in ("parent", "depth", "conv_id", "n_convs")],
        "n_children",
        *[F.when(~F.col("below"), F.col(c)).alias(c) for c in ("n_leaves", "saved_tokens")],
    )
    parts = own.unionByName(_carried(cut, said, band), allowMissingColumns=True)
    parts = parts.unionByName(_ends(cut, band), allowMissingColumns=True)
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = parts.groupBy("key").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.max("ends").alias("ends"),
    )
    merged = stored(merged, "trie-merged")
    parents = merged.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return lookup_join(merged, parents, "parent", how="left").select(
        "conv_id", "depth", "parent_conv_id", *sums, F.coalesce("ends", F.lit(none)).alias("ends_sha256")
    )
