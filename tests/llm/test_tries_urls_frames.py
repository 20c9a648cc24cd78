"""Conversation trie, URL filters, fill-in-middle."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import zstandard

from matchloom.llm import conversation_trie as trie
from matchloom.llm import fill_middle, url_filters
from tests.llm.brute import docs

TURNS = "conv_id bigint, turn int, role string, text string"


# --- conversation trie ------------------------------------------------------


def brute_trie(sequences):
    """All nodes of (conversation, list of (role, text)) by walking every prefix."""
    members, ends = {}, {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    rows = {}
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        parents = {n[:-1] for n in members if n}
        rows[(min(convs), len(node))] = (
            min(members[node[:-1]]) if node else None,
            len(convs),
            sum(1 for n in below if len(n) == len(node) + 1),
            sum(n not in parents for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
    return rows


def found(df):
    rows = df.collect()
    got = {
        (r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for r in rows
    }
    assert len(got) == len(rows)
    return got


def test_findclose():
    rng = random.Random(1)
    for size in (1, 5, 40, 3000):
        bits, depth = [], 0
        while len(bits) < 2 * size:
            left = 2 * size - len(bits)
            step = depth == 0 or (depth < left and rng.random() < rng.choice((0.3, 0.5, 0.9)))
            bits.append(int(step))
            depth += 1 if step else -1
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert dict(zip(opens.tolist(), trie.Parentheses(np.array(bits, np.uint8)).findclose(opens).tolist())) == want
    deep = np.array([1] * 5000 + [0] * 5000, np.uint8)
    assert trie.Parentheses(deep).findclose(np.arange(5000)).tolist() == list(range(9999, 4999, -1))


@pytest.mark.parametrize("band, nodes", [(64, 1 << 16), (3, 4), (2, 1), (1, 7)])
def test_trie_of_any_band_and_shard(spark, band, nodes):
    rng = random.Random(band)
    sequences = {c: [(rng.choice("ua"), rng.choice(["x", "yy", ""])) for _ in range(rng.randint(0, 9))] for c in range(-20, 40)}
    sequences |= {c: [("u", "hot")] * 4 for c in range(100, 130)} | {c: [("u", "hot")] * 4 + [("a", "on")] for c in range(130, 140)}
    sequences |= {7: [("u", "hot")] * 30, 200: [("u", "hot")] * 29 + [("a", "z")]}
    rows = [(c, i, role, text) for c, turns in sequences.items() for i, (role, text) in enumerate(turns)]
    turns = trie.turn_digests(spark.createDataFrame(rows, TURNS))
    alone = spark.createDataFrame([(c, 0, "", 0) for c, t in sequences.items() if not t], "conv_id bigint, place bigint, digest string, chars int")
    assert found(trie.conversation_trie(turns.union(alone), band, nodes)) == brute_trie(sequences)


def test_trie_of_shared_heads_and_odd_rows(spark):
    rng = random.Random(5)
    given = {c: [(rng.choice("ua"), f"t{rng.randint(0, 2)}") for _ in range(rng.randint(1, 8))] for c in [*range(90, 130), *range(300, 312), 415]}
    rows = [(c, None if i == 0 else i, role, text) for c, t in given.items() for i, (role, text) in enumerate(t)]
    rows += [(None, 1, "u", "nobody"), (500, 3, None, None), (500, 3, "", ""), (501, 0, "u", "é😀")]
    given |= {500: [("", ""), ("", "")], 501: [("u", "é😀")]}
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS + ", place int, digest int")
    want = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = given.get(c - c % 100, [])[:h] + own[h:]
    assert any(not t for t in want.values())
    assert found(trie.conversation_trie(trie.share_heads(trie.turn_digests(table)), 3, 5)) == brute_trie(want)
    empty = spark.createDataFrame([], TURNS)
    assert trie.conversation_trie(trie.share_heads(trie.turn_digests(empty))).count() == 0


# --- URL filters ------------------------------------------------------------


def test_urls(spark):
    rng = random.Random(3)
    urls = [None, "", "no scheme", "://", "http://", "http://ORG/", "http://org", "x://y://org/", "http://a.ORG.:80/", "http://.com/fr/", "http://com/fr?/fr/"]
    urls += ["http://Example.ORG/en/1é?x", "http://xexample.org/es/", "ftp://a.b.example.org/es/#", "http://é.com/de/\n/fr/", "http://" + "a." * 20_000 + "com/de/" + "x" * 50_000]
    parts = ["org", "example", "com", ".", "/", "/fr/", "/de/", "en/1", "/es/", "?", "#", "A", "://"]
    urls += ["http://" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(300)]
    rules = [*url_filters.RULES, ("block", "B.example.org", ""), ("allow", "com", "/de/"), ("allow", "a.com", ""), (None, "org", ""), ("block", "é.com", "/de")]
    pages = spark.createDataFrame([(i, u, "r", "end") for i, u in enumerate(urls)] + [(1, "http://org/", "r", "end")], "page_id bigint, url string, Rule string, end string")

    def plain(url):
        if not url or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = rest[:at].translate(str.maketrans(url_filters.UPPER, url_filters.LOWER))
        path = rest[at:].split("?")[0].split("#")[0]
        fits = {}
        for verdict, h, p in rules:
            h = h.lower()
            if verdict and (host == h or host.endswith("." + h)) and path.startswith(p):
                fits[h + p] = max(verdict, fits.get(h + p, ""))
        best = max(fits, key=lambda r: (len(r), r), default=None)
        return host, path, best, fits.get(best, "allow")

    for name, given in (("all", rules), ("dealt", list(url_filters.RULES))):
        table = url_filters.rule_table(spark, given)
        judged = url_filters.judge_urls(pages, table)
        assert judged.columns == ["page_id", "url", "end", "host", "path", "rule", "verdict"]
        rules = given
        got = judged.collect()
        assert len(got) == len(urls) + 1, name
        assert all((r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"]) for r in got)
    assert {r["verdict"] for r in url_filters.judge_urls(pages, url_filters.rule_table(spark, [])).collect()} == {"allow"}
    assert url_filters.judge_urls(pages.limit(0), url_filters.rule_table(spark)).count() == 0
    assert "Python" not in judged._jdf.queryExecution().toString()


# --- fill-in-middle ---------------------------------------------------------


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("size", [1, 3, 7, 1 << 16])
def test_fill_in_middle(spark, size):
    rng = random.Random(size)
    rows = [(i, "".join(rng.choice("ab<>PSM é😀\n") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "some text"), (202, "é<P>"), (203, "<<S"), (203, "<<S"), (204, "x" * 3000 + "😀" * 1000)]
    table = docs(spark, rows, extra=("frames", "n"))
    framed = fill_middle.text_frames(table, size)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in fill_middle.texts(framed).collect()) == sorted((i or -1, t or "") for i, t in rows)
    result = fill_middle.fill_in_middle(framed)
    got = sorted((r["doc_id"] or -1, r["n"], r["form"], r["prefix_chars"] or 0, r["middle_chars"] or 0, r["text"]) for r in fill_middle.texts(result).collect())
    want = [(i, *expected(i, t)) for i, t in rows]
    assert got == sorted((i or -1, n, form, p or 0, m or 0, t) for i, n, form, p, m, t in want)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    digests = sorted((r["doc_id"] or -1, r["output_sha256"], r["restored_sha256"]) for r in fill_middle.fill_in_middle(framed, digests=True).collect())
    assert digests == sorted((i or -1, sha(expected(i, t)[-1]), sha(t)) for i, t in rows)
    assert fill_middle.fill_in_middle(fill_middle.text_frames(docs(spark, [])), digests=True).count() == 0


def test_only_cut_frames_are_opened():
    data = ("é" * 500 + "x" * 1000).encode()
    frames, starts = fill_middle.to_frames(data, zstandard.ZstdCompressor().compress, 100)
    opened = []

    def decompress(frame):
        opened.append(frame)
        return zstandard.ZstdDecompressor().decompress(frame)

    part = fill_middle.select_units(frames, starts, 120, 1310, zstandard.ZstdCompressor().compress, decompress)
    assert len(opened) == 2 and set(part[1:-1]) <= set(frames)
    assert b"".join(map(zstandard.ZstdDecompressor().decompress, part)).decode() == data.decode()[120:1310]
