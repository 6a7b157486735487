"""Encoding against the library, Viterbi against all segmentations, round trips."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from folioline.llm import arrays, pieces
from folioline.llm.queries import PIECES, QUERIES
from tests.llm.fixtures import DOCS, messy_rows, texts


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(PIECES)


def _ids(encoder, found):
    out = []
    for t in arrays.texts_of(pa.array(found, pa.string()), 5_000):
        ids, offsets = encoder.encode(t)
        out += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    return out


def test_ids_are_those_of_the_library(vocabulary):
    rng = random.Random(3)
    found = texts() + ["".join(rng.choice("ab  \n\té日x🙂the\r") for _ in range(rng.randint(0, 70))) for _ in range(500)]
    found += ["a" * 300, "the" * 80, " " * 70 + "x", "  hello   ", "\n", " \n ", "\u0000x", "ﬁ Ⅷ　x"]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = [x.replace("▁", " ") for x in found]
    assert _ids(pieces.Encoder(vocabulary), found) == [library.encode(x) for x in found]


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    expected = _ids(pieces.Encoder(vocabulary), texts())
    monkeypatch.setattr(pieces, "_REMEMBERED", 10)
    assert _ids(pieces.Encoder(vocabulary), texts()) == expected


def _segmentations(text, known, longest):
    if not text:
        yield []
    for k in range(1, min(longest, len(text)) + 1):
        if text[:k] in known or k == 1:
            for rest in _segmentations(text[k:], known, longest):
                yield [text[:k], *rest]


def test_viterbi_finds_the_best_of_all_segmentations():
    rng = random.Random(5)
    known = ["a", "b", "c", "ab", "abc", "bca", "aa", "ca", "cab", "▁", "▁a", "▁ab", "bb", "aab"]
    scores = {p: -rng.uniform(1, 8) for p in known}
    listed = [None, *known, *[f"<0x{b:02X}>" for b in range(256)]]
    v = pieces.Vocabulary([None, *known, *[None] * 256], np.array([0, *scores.values(), *[0] * 256], np.float32),
                          np.arange(len(known) + 1, len(listed), dtype=np.int32), 0, "unigram")
    encoder = pieces.Encoder(v)
    units = ["".join(rng.choice("abcabd") for _ in range(rng.randint(1, 8))) for _ in range(200)] + ["▁ab", "▁", "▁dab"]
    lengths, ids = encoder.encode_units(units)
    unknown = float(encoder.unknown_score)
    for unit, own in zip(units, np.split(ids, np.cumsum(lengths)[:-1])):
        best = max(sum(scores.get(p, unknown) for p in s) for s in _segmentations(unit, scores, 4))
        # a character without a piece is one byte here
        got = sum(unknown if i > len(known) else scores[listed[i]] for i in own.tolist())
        assert got == pytest.approx(best, abs=1e-4)
        assert "".join(chr(i - len(known) - 1) if i > len(known) else listed[i] for i in own.tolist()) == unit


def test_rows(spark, vocabulary):
    docs = spark.createDataFrame(messy_rows(), DOCS)
    found = pieces.encode_and_check(docs, vocabulary, keep=["doc_id", "text"]).collect()
    assert len(found) == docs.count()
    assert all(r.round_trip for r in found)
    assert all((r.ids == []) == (not r.text) for r in found)
    encoded = pieces.encode(docs, vocabulary, keep=["text"]).withColumnRenamed("text", "was")
    back = pieces.decode(encoded, vocabulary, keep=["was"]).collect()
    assert all(r.text == (r.was or "").replace("▁", " ") for r in back)
    assert pieces.encode(docs.limit(0), vocabulary).count() == 0


def test_round_trip_of_marks(spark, tmp_path):
    spark.createDataFrame([(1, "▁ mark"), (2, "no mark"), (3, None), (4, "")], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.round_trip for r in QUERIES["op4_sentencepiece"](spark, str(tmp_path)).collect()} == {
        1: False, 2: True, 3: True, 4: True}


def test_remembered_units_stay_small():
    """What a task keeps of the units it has met: a few plain numbers each, however many runs of rows they came in."""
    vocabulary = pieces.load_vocabulary(PIECES)
    encoder, once = pieces.Encoder(vocabulary), pieces.Encoder(vocabulary)
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for k in range(20):
        texts = [" ".join(f"u{10_000 * k + i}x" for i in range(10_000)), f"u{k}x u{19 - k}x end"]
        t = next(arrays.texts_of(pa.array(texts)))
        ids, offsets = encoder.encode(t)
        if k in (0, 19):
            alone, edges = once.encode(t)
            assert (ids == alone).all() and (offsets == edges).all()
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    # 200,000 units of about seven ids; numbers in a dictionary take more than 100 bytes each beside these
    assert kept < 200_000 * 110
