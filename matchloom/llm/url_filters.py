"""URL filters: host-suffix and path-prefix expressions, joined with rules on short hash prefixes.

A rule ``(verdict, host, path)`` fits its host and all subdomains where the path begins with the rule's.
Each URL is expanded into the expressions that some rule could name: the last k labels of its host for
every number of labels that a rule has, with the first l characters of its path for every length that a
rule's path has. Expressions and rules meet on the first ``PREFIX`` hex digits of a SHA-256 digest; a
meeting counts once the whole digests agree. Of the rules that fit, the longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import free_names, stored
from matchloom.operators.support import lookup_join

PREFIX = 8  # hex digits: 32 bits
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict, host, path.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``verdict``, ``host`` and ``path`` of rules that are given as tuples."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case (A-Z), and on up to ``?``, ``#`` or the end.

    Both are empty where the URL is null or has no ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels and lengths of paths that rules have: as many numbers as the longest host and path, not as rules."""
    row = rules.agg(F.collect_set(F.size(F.split("host", "[.]"))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    return sorted(row["labels"]), sorted(row["lengths"])


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """One row per hash prefix with the digests, spellings and verdicts of its rules.

    Hosts are put into lower case as those of URLs are. Rows with a null are no rules. A spelling that is
    both allowed and blocked is blocked.
    """
    host = F.translate("host", UPPER, LOWER)
    whole = rules.where("verdict is not null and host is not null and path is not null").select(F.concat(host, "path").alias("rule"), "verdict")
    once = whole.groupBy("rule").agg(F.max("verdict").alias("verdict"))
    digest = F.sha2("rule", 256)
    found = F.struct(digest.alias("digest"), "rule", "verdict")
    return once.groupBy(F.substring(digest, 1, PREFIX).alias("prefix")).agg(F.collect_list(found).alias("rules"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``, which take the place of columns so named.

    Only the ends of hosts and the beginnings of paths that rules can tell apart are expanded, once each
    whatever the number of pages that have them. Rules are broadcast while they are measured to be small;
    beyond that the hash prefix is the join key. Null and empty URLs, and URLs no rule fits, get the verdict
    ``otherwise``; repeated pages are judged each; no rules, no pages: nothing fails.
    """
    host, path = url_parts(F.col(url))
    named = {"host", "path", "rule", "verdict"}
    own = [c for c in pages.columns if c.lower() not in named]
    end, begin = free_names([*own, *named], "end", "begin")
    split = pages.withColumns({"host": host, "path": path}).select(*[F.col(f"`{c}`") for c in own], "host", "path")
    labels, lengths = _shapes(rules.where("verdict is not null and host is not null and path is not null"))
    if not labels:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)})
    # what all rules see of a URL; one label more than they have tells nothing
    key = F.struct(_suffix(F.col("host"), labels[-1]).alias("host"), F.substring("path", 1, lengths[-1]).alias("path"))
    split = split.withColumn(end, key)
    seen = split.select(F.col(end).alias("key")).distinct()
    k = F.col("key")
    parts = [
        F.when((F.size(F.split(k["host"], "[.]")) >= n) & (F.length(k["path"]) >= m), F.concat(_suffix(k["host"], n), F.substring(k["path"], 1, m)))
        for n in labels
        for m in lengths
    ]
    expressions = seen.select("key", F.explode(F.array_compact(F.array(*parts))).alias("expression"))
    expressions = expressions.withColumn("digest", F.sha2("expression", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX))
    met = lookup_join(expressions, prepared_rules(rules), "prefix")
    fits = F.filter("rules", lambda r: r["digest"] == F.col("digest"))
    fitting = met.select("key", F.explode(fits).alias("r"))
    rank = F.struct(F.length("r.rule"), "r.rule")  # rules of one length that fit one URL: the greater spelling
    best = fitting.groupBy("key").agg(F.max_by("r", rank).alias(begin)).withColumnRenamed("key", end)
    judged = lookup_join(split, stored(best, "url-rules"), end, how="left")
    return judged.select(
        *[F.col(f"`{c}`") for c in own],
        "host",
        "path",
        F.col(begin)["rule"].alias("rule"),
        F.coalesce(F.col(begin)["verdict"], F.lit(otherwise)).alias("verdict"),
    )
