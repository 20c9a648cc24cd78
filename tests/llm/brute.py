"""Plain versions of the operators, for small tables."""

import base64
import re

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])


def docs(spark, rows, extra=()):
    """Documents from (doc_id, text) pairs; ``extra`` columns get a number."""
    full = [(i, t, "en", "src", None if t is None else len(t), *range(len(extra))) for i, t in rows]
    schema = StructType([*DOCS.fields, *[StructField(c, IntegerType()) for c in extra]])
    return spark.createDataFrame(full, schema)


def tiktoken_encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[ \t-\r]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def components(texts):
    """Smallest id reachable of each id, over all pairs of fingerprints."""
    ids = sorted(texts)
    prints = np.array([fingerprint(texts[i]) for i in ids], np.uint64)
    pairs = [(ids[n], ids[m]) for n in range(len(ids)) for m in np.flatnonzero(np.bitwise_count(prints ^ prints[n]) <= 2)]
    return roots(ids, pairs)


def deduped(texts):
    """Texts without later occurrences of three-line windows."""
    seen, result = set(), {}
    for i in sorted(texts):
        lines = texts[i].split("\n")
        full = [n for n, x in enumerate(lines) if x.strip(" \t\x0b\f\r")]
        gone = set()
        for at in zip(full, full[1:], full[2:]):
            window = tuple(lines[n].strip(" \t\x0b\f\r") for n in at)
            if window in seen:
                gone.update(at)
            seen.add(window)
        result[i] = "\n".join(x for n, x in enumerate(lines) if n not in gone) if gone else texts[i]
    return result


def deduped_passages(texts, long_words=16, least_words=12):
    """Texts without later occurrences of windows of three lines, or of three units in lines of many words."""
    blanks = " \t\x0b\f\r"
    units, windows, seen, result = {}, {}, set(), {}
    for i in sorted(texts):
        flat, starts = [], []
        for n, line in enumerate(texts[i].split("\n")):
            parts = re.split(rf"(?<=[.!?])(?=[{blanks}]+[^{blanks}])", line) if len(re.split(rf"[{blanks}]+", line.strip(blanks))) > long_words else [line]
            starts.append((len(flat), len(flat) + len(parts), line.strip(blanks)))
            flat += [(n, x, len(parts) > 1) for x in parts]
        full = [u for u, (_, x, _) in enumerate(flat) if x.strip(blanks)]
        found = []
        lines = [s for s in starts if s[2]]
        for some in zip(lines, lines[1:], lines[2:]):
            found.append((some[0][0], tuple(s[2] for s in some), range(some[0][0], some[-1][1])))
        for at in zip(full, full[1:], full[2:]):
            key = tuple(flat[u][1].strip(blanks) for u in at)
            if any(flat[u][2] for u in at) and sum(len(re.split(rf"[{blanks}]+", x)) for x in key) >= least_words:
                found.append((at[0], key, range(at[0], at[-1] + 1)))
        units[i], windows[i] = flat, sorted(found, key=lambda w: w[0])
    for i in sorted(texts):
        gone = set()
        for _, key, covered in windows[i]:
            if key in seen:
                gone.update(u for u in covered if units[i][u][1].strip(blanks))
            seen.add(key)
        text, last = "", None
        for u, (n, x, _) in enumerate(units[i]):
            if u not in gone:
                text += ("\n" if last is not None and n != last else "") + x
                last = n
        result[i] = text if gone else texts[i]
    return result


def naive_spans(text):
    """Base spans by the patterns as given."""
    from matchloom.llm.pii import luhn

    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    found = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            )[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)
