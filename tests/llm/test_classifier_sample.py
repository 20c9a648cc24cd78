"""The classifier's bounded sample of labelled documents."""

import random

import numpy as np
import pytest
import zstandard

from matchloom.llm.compression_classifier import CompressionModel, CompressionParams, fit_quality
from tests.llm.brute import LABELS, docs


def labelled(spark, good, bad):
    """Documents whose classes overlap, and their labels."""
    rng = random.Random(7)
    words = [["".join(rng.choice(s) for _ in range(6)) for _ in range(200)] for s in ("abcdef", "defghi")]
    rows = []
    for i in range(good + bad):
        kind = int(i >= good)
        texts = [rng.choice(words[kind if rng.random() < 0.6 else 1 - kind]) for _ in range(60)]
        rows.append((i, " ".join(texts)))
    return docs(spark, rows), spark.createDataFrame([(i, int(i < good), 0) for i, _ in rows], LABELS)


def test_prior_is_that_of_all_labels(spark):
    table, labels = labelled(spark, 900, 150)
    whole = fit_quality(table, labels)
    cut = fit_quality(table, labels, CompressionParams(documents=100))
    middle = -whole.base / whole.slope
    assert abs((cut.slope * middle + cut.base) - (whole.slope * middle + whole.base)) < 0.9  # without weights: log(6)


def test_share_without_dictionaries_is_that_of_all_labels():
    model = CompressionModel(["x"], [], counts=(599, 99))
    assert model.score("any text") == pytest.approx(600 / 700)


def test_one_text_of_a_document(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("matchloom.llm.compression_classifier.CompressionModel", lambda *args: seen.append(args))
    rows = [(2, f"text {i}") for i in range(30)] + [(3, "other"), (3, "other"), (4, None)]
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (4, 0, 0)], LABELS)
    fit_quality(docs(spark, rows), labels, CompressionParams(documents=2))
    (good, bad, _, counts), = seen
    assert len(good) == 1 and good[0] in {t for i, t in rows if i == 2}
    assert set(bad) <= {"other", ""} and len(bad) == counts[1] and counts[0] == 1


def test_whole_texts_within_the_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("matchloom.llm.compression_classifier.CompressionModel", lambda *args: seen.append(args))
    rows = [(i, f"{i} " + "x" * (900 if i % 2 else 20)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 4 // 2, 0) for i, _ in rows], LABELS)
    for params in (CompressionParams(), CompressionParams(document_bytes=500), CompressionParams(class_bytes=3000)):
        fit_quality(docs(spark, rows), labels, params)
    whole, short, few = ([*good, *bad] for good, bad, *_ in seen)
    assert set(whole) <= {t for _, t in rows} and any(len(t) > 900 for t in whole)
    assert set(short) == {t for t in whole if len(t) <= 500} and all(args[3] == seen[0][3] for args in seen)
    assert set(few) < set(whole) and sum(len(t) for t in seen[2][0]) <= 3000


def test_scores_by_plain_zstandard():
    """Sizes with each dictionary by the library alone, and the curve by another way of fitting it."""
    rng = random.Random(3)
    good, bad = ([" ".join(rng.choice(kind) + str(rng.randint(0, 40)) for _ in range(150)) for _ in range(60)] for kind in (("fair", "sound"), ("spam", "junk")))
    params = CompressionParams(dictionary_bytes=4096)
    model = CompressionModel(good, bad, params, (300, 60))

    def difference(text):
        data, sizes = text.encode(), []
        for texts in (good, bad):
            samples = [t.encode()[i : i + params.piece] for t in texts[::2] for i in range(0, len(t.encode()), params.piece)]
            known = zstandard.ZstdCompressionDict(zstandard.train_dictionary(params.dictionary_bytes, samples).as_bytes())
            engine = zstandard.ZstdCompressor(level=params.level, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)
            sizes.append(sum(len(engine.compress(data[i : i + params.piece])) for i in range(0, len(data), params.piece)))
        return (sizes[1] - sizes[0]) / len(data)

    x = np.array([difference(t) for t in [*good[1::2], *bad[1::2]]])
    y, weight = np.repeat([1.0, 0.0], 30), np.repeat([300 / 30, 60 / 30], 30)
    scale = np.abs(x).max()
    at = np.zeros(2)
    for _ in range(200_000):  # plain descent on the weighted loss
        p = 1 / (1 + np.exp(-(at[0] * x / scale + at[1])))
        at -= 5e-3 * np.array([(weight * (p - y) * x / scale).sum() + 1e-3 * at[0], (weight * (p - y)).sum() + 1e-3 * at[1]])
    for text in [good[3], bad[3], "fair spam 1 2 3", "é" * 400]:
        want = 1 / (1 + np.exp(-(at[0] * difference(text) / scale + at[1])))
        assert abs(model.score(text) - want) < 1e-3
