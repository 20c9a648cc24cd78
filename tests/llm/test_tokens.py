"""Token counts, BPE, token files."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchloom.llm import byte_bpe, token_counts, token_files
from matchloom.llm.common import Pieces, piece_text, safe_pieces
from tests.llm.brute import docs, tiktoken_encoding

PARTS = [" ", "  ", "\n", "\t", "a", "B", "é", "ß", "İ", "1", "9", ".", "!", "'s", "'", "\x1c", "\x85", "\xa0", chr(0x3000), chr(0x2028)]
PARTS += [chr(0x180E), chr(0x200B), "\0", "日", "😀", "é", "½", "<|endoftext|>", "<|", "the", "THE", "\r\n", "''s", "don't"]
TEXTS = ["", None, " ", "\n\n", "word", "a  b", "x" * 3000, "wordy " * 2000, "The end.\n\n\tNew  line", "日本語 テキスト 😀", "same", "same"]


def odd_texts(count=4000, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteBpe(byte_bpe.load_ranks(byte_bpe.RANKS))


@given(st.text(alphabet=st.sampled_from(" \n\ta.'1é")))
def test_pieces_spell_the_text(text):
    first, parts = safe_pieces(text)
    assert first + "".join(map(piece_text, parts)) == text


def test_store_starts_anew():
    store = Pieces(lambda parts: [len(p) for p in parts], most=3)
    for text in ("a bb ccc", "dddd e ff", "a bb", "zzz a"):
        assert [sum(v) for v in store.texts([text])] == [len(text)]


def test_perfect_hash(codec):
    slots = sorted(codec.whole.slots.tolist())
    assert slots == list(range(len(codec.tokens)))  # minimal: every slot holds one key
    assert all(codec.whole.get(t) == i for i, t in enumerate(codec.tokens))
    assert codec.whole.get(b"not a token of it") == -1
    assert byte_bpe.PerfectHash([]).get(b"x") == -1


def test_bpe_as_the_library(codec):
    library, texts = tiktoken_encoding(), odd_texts()
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_tables(spark, codec):
    library = tiktoken_encoding()
    table = docs(spark, list(enumerate(TEXTS)) + [(0, "again"), (None, "no id")], extra=("ids_", "decoded_"))
    rows = byte_bpe.decode(byte_bpe.encode(table, keep=("doc_id", "decoded_")), keep=("doc_id", "decoded_")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in rows) == sorted(
        (i is None, i or 0, library.encode_ordinary(t or "")) for i, t in [*enumerate(TEXTS), (0, "again"), (None, "no id")]
    )
    assert all(bytes(r["decoded"]) == library.decode_bytes(r["ids"]) for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(table.limit(0))).count() == 0


def test_counts_of_pieces_as_the_library():
    lengths, texts = token_counts.Lengths(token_counts.MODEL), odd_texts()
    assert [sum(v) for v in lengths.pieces.texts(texts)] == lengths.of_texts(texts)


def test_counts_table(spark):
    library = Tokenizer.from_file(token_counts.MODEL)
    rows = token_counts.token_counts(docs(spark, enumerate(TEXTS), extra=("n_tokens",))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


def test_sentencepiece_counts(spark):
    import public_tokenizers
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = token_counts.token_counts(docs(spark, enumerate(TEXTS)), model).collect()
    assert all(r["n_tokens"] == len(library.encode(TEXTS[r["doc_id"]] or "")) for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=300), max_size=6))
def test_segments(documents):
    arrays = [np.array(d, np.uint32) for d in documents]
    payload = token_files.write_segment(arrays)
    assert [x.tolist() for x in token_files.read_segment(payload)] == documents
    for i, d in enumerate(documents):
        assert token_files.read_document(payload, i).tolist() == d


def test_word_tokenizer_as_the_library():
    library, texts = Tokenizer.from_file(token_files.MODEL), odd_texts(6000, 5)
    for text, ids in zip(texts, token_files.WordTokenizer(token_files.MODEL).encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 500)
    library = Tokenizer.from_file(token_files.MODEL)
    rows = [(i * 3 % 101, f"Text number {i} " * (i % 7)) for i in range(101)] + [(7, "twice"), (500, None), (None, "first")]
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, rows, extra=("start", "segment")).repartition(5), path)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    start = 0
    for r, (_, text) in zip(got, want):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, []), path)
    assert token_files.read_token_files(spark, path).count() == 0
