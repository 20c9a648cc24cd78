"""Removal of repeated passages of three lines, in DataFrame operations only.

A window is three lines in a row that are not blank, without the white space at their ends.
Every window is hashed; of the places of a window that occurs more than once, all but the
first (by document, then place) are covered, and covered lines leave their text.

``remove_repeated_passages`` also looks inside long lines: their sentences are units like lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import free_names, replace_text

BLANKS = " \t\x0b\f\r"
WINDOW = 3
LONG_WORDS = 16  # lines of more words are cut into sentences
LEAST_WORDS = 12  # a window with a part of a line has as many words
SENTENCE = rf"(?<=[.!?])(?=[{BLANKS}]+[^{BLANKS}])"  # more of the line follows


def _windows(docs: DataFrame) -> DataFrame:
    """One row per window: ``doc_id``, ``doc`` (digest of the text), ``k``, two digests, the numbers of its lines."""
    split = docs.select(
        "doc_id", F.xxhash64("text").alias("doc"), F.split(F.coalesce(F.col("text"), F.lit("")), "\n").alias("lines")
    )
    trimmed = F.transform(F.col("lines"), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(BLANKS)).alias("x")))
    full = F.filter(trimmed, lambda s: s["x"] != "")
    digests = F.transform(
        full, lambda s: F.struct(s["i"].alias("i"), F.xxhash64(s["x"]).alias("a"), F.xxhash64(F.lit("b"), s["x"]).alias("b"))
    )
    rows = split.select("doc_id", "doc", digests.alias("rows")).where(F.size("rows") >= WINDOW)

    def window(k: Column) -> Column:
        at = [F.get(F.col("rows"), k + j) for j in range(WINDOW)]
        return F.struct(
            k.alias("k"),
            F.xxhash64(*[s["a"] for s in at]).alias("a"),
            F.xxhash64(*[s["b"] for s in at]).alias("b"),
            *[s["i"].alias(f"i{j}") for j, s in enumerate(at)],
        )

    windows = F.transform(F.sequence(F.lit(0), F.size("rows") - WINDOW), window)
    return rows.select("doc_id", "doc", F.inline(windows))


def covered_lines(docs: DataFrame) -> DataFrame:
    """Numbers of the lines to remove: ``doc_id``, ``doc``, ``lines`` (sorted), for documents that lose any.

    Counts and first places are combined before the shuffle, so a window that is everywhere
    sends one row per task; the join back is one that adaptive execution can split.
    """
    return _covered(_windows(docs), F.array(*[f"i{j}" for j in range(WINDOW)]))


def _covered(windows: DataFrame, numbers: Column) -> DataFrame:
    """``numbers`` of all but the first place of each window that occurs more than once."""
    place = F.struct("doc_id", "doc", "k")
    repeated = (
        windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    )
    later = windows.join(repeated, ["a", "b"]).where(place > F.col("first"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.collect_list(numbers))))
    return later.groupBy("doc_id", "doc").agg(covered.alias("lines"))


def remove_repeated_lines(docs: DataFrame, removed: str | None = None) -> DataFrame:
    """The documents without later occurrences of repeated three-line windows.

    ``removed`` names a column for the number of lines taken out. Blank lines stay where they are;
    a document whose every line is covered keeps an empty text, and fewer than three full lines are
    never touched. A null text stays null. Rows that agree in ``doc_id`` and text count as one document:
    they get the same result. Rows that share a ``doc_id`` but not the text are ordered by the digest of
    the text; a null ``doc_id`` comes first. Lines of a document are gathered only within that document.
    """
    doc, key, digest, lines, left = free_names(docs.columns, "doc", "key", "digest", "covered", "left")
    covered = covered_lines(docs).toDF(key, digest, lines)
    joined = docs.withColumn(doc, F.xxhash64("text")).join(
        covered, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(doc) == F.col(digest)), "left"
    )
    whole = F.split(F.col("text"), "\n")
    numbers = F.sequence(F.lit(0), F.size(whole) - 1)
    joined = joined.withColumn(left, F.when(F.col(lines).isNotNull(), F.array_except(numbers, F.col(lines))))
    source = free_names(joined.columns, "source_lines")[0]
    joined = joined.withColumn(source, F.when(F.col(lines).isNotNull(), whole))
    s = F.col(source)
    kept = F.array_join(F.transform(F.col(left), lambda i: F.get(s, i)), "\n")
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(kept)
    result = joined
    if removed:
        result = result.withColumn(removed, F.coalesce(F.size(F.col(lines)), F.lit(0)).cast("bigint"))
    names = [*docs.columns, *([removed] if removed else [])]
    return replace_text(result, text).select(*[F.col(f"`{c}`") for c in names])


def _units(text: Column, long_words: int) -> Column:
    """Array of ``line`` (its number), ``part`` (within the line), ``cut`` (the line has more parts), ``x``."""

    def cut(line: Column, i: Column) -> Column:
        words = F.size(F.split(F.trim(line, F.lit(BLANKS)), f"[{BLANKS}]+"))
        sentences = F.when(words > long_words, F.split(line, SENTENCE)).otherwise(F.array(line))
        return F.struct(i.alias("line"), sentences.alias("sentences"))

    def parts(s: Column) -> Column:
        return F.transform(
            s["sentences"],
            lambda x, j: F.struct(s["line"].alias("line"), j.alias("part"), (F.size(s["sentences"]) > 1).alias("cut"), x.alias("x")),
        )

    return F.flatten(F.transform(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), cut), parts))


def _passage_windows(docs: DataFrame, long_words: int, least_words: int) -> DataFrame:
    """One row per window of lines or units: ``doc_id``, ``doc``, first and last unit (``k``, ``to``), two digests.

    Windows of units without a part of a line are windows of lines already and do not come twice.
    """
    blanks = F.lit(BLANKS)

    def digests(x: Column) -> list[Column]:
        return [F.xxhash64(x).alias("a"), F.xxhash64(F.lit("b"), x).alias("b")]

    units = docs.select("doc_id", F.xxhash64("text").alias("doc"), "text", _units(F.col("text"), long_words).alias("units"))
    starts = F.transform(
        F.filter(F.transform("units", lambda s, u: F.struct(s["part"].alias("part"), u.alias("u"))), lambda s: s["part"] == 0),
        lambda s: s["u"],
    )
    units = units.withColumn("starts", starts)
    lines = F.transform(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
        lambda x, i: F.struct(
            F.get("starts", i).alias("k"),
            (F.coalesce(F.get("starts", i + 1), F.size("units")) - 1).alias("to"),
            F.lit(True).alias("cut"),
            F.lit(least_words).alias("words"),
            F.trim(x, blanks).alias("x"),
        ),
    )
    parts = F.transform(
        "units",
        lambda s, u: F.struct(
            u.alias("k"),
            u.alias("to"),
            s["cut"].alias("cut"),
            F.size(F.split(F.trim(s["x"], blanks), f"[{BLANKS}]+")).alias("words"),
            F.trim(s["x"], blanks).alias("x"),
        ),
    )

    def full(rows: Column) -> Column:
        return F.transform(
            F.filter(rows, lambda s: s["x"] != ""),
            lambda s: F.struct(*[s[c].alias(c) for c in ("k", "to", "cut", "words")], *digests(s["x"])),
        )

    rows = units.select("doc_id", "doc", full(lines).alias("lines"), full(parts).alias("parts"))

    def windows(column: str) -> Column:
        def window(_: Column, k: Column) -> Column:
            at = [F.get(column, k + j) for j in range(WINDOW)]
            counts = reduce(lambda a, b: a | b, [s["cut"] for s in at])
            counts = counts & (reduce(lambda a, b: a + b, [s["words"] for s in at]) >= least_words)
            return F.struct(
                at[0]["k"].alias("k"),
                at[-1]["to"].alias("to"),
                F.xxhash64(*[s["a"] for s in at]).alias("a"),
                F.xxhash64(*[s["b"] for s in at]).alias("b"),
                counts.alias("counts"),
            )

        return F.filter(F.transform(column, window), lambda w: w["counts"] & w["to"].isNotNull())

    return rows.select("doc_id", "doc", F.inline(F.concat(windows("lines"), windows("parts")))).drop("counts")


def remove_repeated_passages(docs: DataFrame, long_words: int = LONG_WORDS, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without later occurrences of repeated windows of three lines, or of three units in long lines.

    A unit is a sentence of a line of more than ``long_words`` words, or else a line. All that
    ``remove_repeated_lines`` takes goes here as well; windows with a part of a line count from ``least_words``
    words on. A sentence takes the white space before it along; a line that loses all its parts goes with its
    line end, blank lines stay. A long line without sentence marks is one unit. Nulls, repeated rows, rows that
    share a ``doc_id`` and order are as in ``remove_repeated_lines``; other columns pass through.
    """
    doc, key, digest, gone, units, left = free_names(docs.columns, "doc", "key", "digest", "covered", "units", "left")
    windows = _passage_windows(docs, long_words, least_words)
    covered = _covered(windows, F.sequence("k", "to")).toDF(key, digest, gone)
    joined = docs.withColumn(doc, F.xxhash64("text")).join(
        covered, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(doc) == F.col(digest)), "left"
    )
    hit = F.col(gone).isNotNull()
    joined = joined.withColumn(units, F.when(hit, _units(F.col("text"), long_words)))
    s, at = F.col(units), F.col(left)
    full = F.filter(F.col(gone), lambda u: F.trim(F.get(s, u)["x"], F.lit(BLANKS)) != "")
    joined = joined.withColumn(left, F.when(hit, F.array_except(F.sequence(F.lit(0), F.size(s) - 1), full)))
    kept = F.transform(
        at,
        lambda u, n: F.concat(
            F.when((n > 0) & (F.get(s, u)["line"] != F.get(s, F.get(at, n - 1))["line"]), "\n").otherwise(""), F.get(s, u)["x"]
        ),
    )
    text = F.when(hit, F.array_join(kept, "")).otherwise(F.col("text"))
    return replace_text(joined, text).select(*[F.col(f"`{c}`") for c in docs.columns])
