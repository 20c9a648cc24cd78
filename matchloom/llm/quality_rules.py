"""Quality rules whose cutoffs carry a guarantee, in DataFrame operations only.

Each rule rejects a document when one statistic lies above a cutoff. Settings hold one cutoff for
every rule, from loose to strict. Each stratum (language) gets the strictest setting for which its labelled
documents show, by an exact binomial test, that all rules together, the base rule among them, reject at most
``risk`` of the good ones: the promise is for the verdict, not for a rule. The level of the tests is shared out
over the strata; within a stratum settings are tried from the loosest on and each rejects what the one before
it does, so they need no further correction (fixed-sequence testing). A stratum with too few labels to show
anything gets no cutoff.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import free_names, stored
from matchloom.operators.support import fits_broadcast

BLANKS = "\t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

# Candidate cutoffs, loosest first. A document is rejected above its cutoff. Setting n takes the n-th of each, or the last.
GRID = {
    "symbol_share": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05),
    "mark_share": (1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05),
    "capital_share": (0.9, 0.7, 0.5, 0.3, 0.2, 0.15),
    "repeat_share": (0.9, 0.7, 0.5, 0.3, 0.2),
    "line_share": (0.9, 0.7, 0.5, 0.4, 0.3),
    "word_length": (15.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0),
}


@dataclass(frozen=True)
class RiskParams:
    """``risk``: share of a stratum's good documents that may be rejected; ``level``: chance that the claim of any stratum is wrong."""

    risk: float = 0.01
    level: float = 0.05
    grid: dict[str, tuple[float, ...]] = field(default_factory=lambda: dict(GRID))


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def with_statistics(docs: DataFrame, into: str) -> DataFrame:
    """The documents with a struct column of text statistics.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` are counts
    over the whole text; the shares of ``GRID`` follow. A null text counts as empty: all zero.
    Windows of words are compared by a 64-bit digest within their document. No row is shuffled,
    and work and memory are linear in the text but for one sort of a document with repeats.
    """
    words, lines, windows, order, at = free_names([*docs.columns, into], "words", "lines", "windows", "order", "at")
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    digests = F.transform(F.array_remove(F.split(spaced, " "), ""), lambda w: F.xxhash64(w))
    with_word = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " " + BLANKS, "")) > 0)
    step = docs.withColumns({words: digests, lines: F.transform(with_word, lambda x: F.xxhash64(x))})

    w = F.col(words)
    starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
    window = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    empty = F.array().cast("array<bigint>")
    step = step.withColumn(windows, F.when(F.size(w) >= WINDOW, window).otherwise(empty))

    pairs = F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct(F.col(windows))) < F.size(F.col(windows))
    step = step.withColumn(order, F.when(repeats, F.array_sort(pairs)))

    o = F.col(order)

    def twice(x: Column, i: Column) -> Column:
        same = [F.coalesce(F.get(o, j)["h"] == x["h"], F.lit(False)) for j in (i - 1, i + 1)]
        return same[0] | same[1]

    step = step.withColumn(at, F.array_sort(F.transform(F.filter(o, twice), lambda x: x["i"])))
    a = F.col(at)
    gaps = F.transform(a, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(p - F.get(a, i - 1), F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    counts = {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.length(F.translate(text, " " + BLANKS, "")).cast("bigint"),
        "n_symbols": _count(text, SYMBOLS),
        "n_dup_lines": (F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).cast("bigint"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("bigint")),
        "n_lines": F.size(F.col(lines)).cast("bigint"),
        "n_marks": _count(text, "!"),
        "n_capitals": _count(text, CAPITALS),
    }
    raw = free_names([*step.columns, into], "raw")[0]
    step = step.withColumn(raw, F.struct(*[c.alias(name) for name, c in counts.items()]))
    shares = {
        "symbol_share": ("n_symbols", "n_words"),
        "mark_share": ("n_marks", "n_words"),
        "capital_share": ("n_capitals", "word_chars"),
        "repeat_share": ("n_repeat_words", "n_words"),
        "line_share": ("n_dup_lines", "n_lines"),
        "word_length": ("word_chars", "n_words"),
    }
    r = F.col(raw)
    parts = [r[name].alias(name) for name in counts] + [
        F.when(r[below] > 0, r[above].cast("double") / r[below]).otherwise(F.lit(0.0)).alias(name)
        for name, (above, below) in shares.items()
    ]
    return step.withColumn(into, F.struct(*parts)).select(*[F.col(f"`{c}`") for c in docs.columns], into)


def base_failed(stats: Column) -> Column:
    """Fewer than 10 words, or over 20 % of the words in repeated windows."""
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def allowed_rejections(n: Column, risk: float, level: float) -> Column:
    """Largest k with P(Bin(n, risk) <= k) <= level, or -1: so many rejections of n good documents still prove the risk."""
    log_odds = F.lit(risk / (1 - risk))
    start = F.struct(
        (n.cast("double") * F.log(F.lit(1 - risk))).alias("term"), F.lit(0.0).alias("sum"), F.lit(-1).cast("bigint").alias("most")
    )

    def add(state: Column, i: Column) -> Column:
        total = state["sum"] + F.exp(state["term"])
        following = state["term"] + F.log(log_odds * (n - i).cast("double") / (i + 1).cast("double"))
        return F.struct(
            following.alias("term"), total.alias("sum"), F.when(total <= level, i).otherwise(state["most"]).alias("most")
        )

    steps = F.sequence(F.lit(0).cast("bigint"), F.floor(n * F.lit(risk)))
    return F.aggregate(steps, start, add, lambda state: state["most"])


def settings(grid: dict[str, tuple[float, ...]]) -> list[dict[str, float]]:
    """One cutoff for every rule each, from loose to strict."""
    return [{rule: cutoffs[min(n, len(cutoffs) - 1)] for rule, cutoffs in grid.items()} for n in range(max(map(len, grid.values())))]


def fit_cutoffs(labelled: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Cutoffs of the strictest proven setting: one row per stratum, NULL where none is proven.

    ``labelled`` holds ``stratum``, ``good`` (boolean) and ``stats``. One aggregation; its shuffle
    carries one row per stratum and task; the counts are stored, and their number sets the level of each claim.
    """
    good = labelled.where("good")
    tried = settings(params.grid)
    stats = F.col("stats")

    def rejects(setting: dict[str, float]) -> Column:
        verdict = base_failed(stats)
        for rule, cutoff in setting.items():
            verdict = verdict | (stats[rule] > cutoff)
        return verdict

    rejected = [F.count_if(rejects(s)).alias(f"setting_{n}") for n, s in enumerate(tried)]
    counts = stored(good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejected), "quality-counts")
    level = params.level / max(1, counts.count())
    proven = counts.withColumn("most", allowed_rejections(F.col("n"), params.risk, level))
    passed = F.array_max(F.array(*[F.when(F.col(f"setting_{n}") <= F.col("most"), F.lit(n)) for n in range(len(tried))]))
    picks = [F.get(F.array(*[F.lit(float(s[rule])) for s in tried]), passed).alias(rule) for rule in params.grid]
    return proven.select("stratum", *picks)


def judge(scored: DataFrame, cutoffs: DataFrame, stratum: Column, stats: str, into: str) -> DataFrame:
    """The rows with a boolean column: true for documents to keep.

    Cutoffs go out by broadcast when their number is proven small, else by a join on the stratum.
    """
    key, *rules = free_names([*scored.columns, into], "stratum", *cutoffs.columns[1:])
    named = cutoffs.toDF(key, *rules)
    if fits_broadcast(named, 200):
        named = F.broadcast(named)
    joined = scored.withColumn(f"{key}_", stratum).join(named, F.col(f"{key}_") == F.col(key), "left")
    s = F.col(stats)
    above = [F.coalesce(s[rule] > F.col(name), F.lit(False)) for rule, name in zip(cutoffs.columns[1:], rules)]
    reject = base_failed(s)
    for a in above:
        reject = reject | a
    return joined.withColumn(into, ~reject).select(*[F.col(f"`{c}`") for c in scored.columns], into)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    params: RiskParams = RiskParams(),
    stratum: str = "lang",
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, str, str]:
    """Documents (their ``keep`` columns, or all) with statistics and verdict; returns the table and the names of the new columns.

    Statistics are worked out once and stored in the shared folder with the rows given. A document
    labelled more than once counts as good if any label says so; null labels, and labels of
    documents that are not there, say nothing. A null stratum is a stratum of its own, like an empty
    one. Repeated rows are judged each by itself, and count each in the fit.
    """
    stats, kept = free_names(docs.columns, "stats", "kept")
    names = [F.col(f"`{c}`") for c in keep or docs.columns]
    scored = stored(with_statistics(docs, stats).select(*names, stats), "quality-statistics")
    group = F.coalesce(F.col(stratum), F.lit("")) if stratum in scored.columns else F.lit("")
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
    known = known.agg((F.max("quality") == 1).alias("good"))
    narrow = scored.select("doc_id", group.alias("stratum"), F.col(stats).alias("stats"))
    return judge(scored, fit_cutoffs(narrow.join(known, "doc_id"), params), group, stats, kept), stats, kept


def keep_good(docs: DataFrame, labels: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    judged, _, kept = quality_rules(docs, labels, params)
    return judged.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
