"""Piece encoding against the library, exhaustive search and exact round trips."""

import hashlib
import itertools
import math

import numpy as np
import pytest
import sentencepiece

from stresslake.llm import pieces
from stresslake.llm.common import read

SCHEMA = "doc_id long, text string, decoded string"


@pytest.fixture(scope="module")
def data():
    with open(pieces.MODEL_PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def encoder(data):
    return pieces.Encoder(pieces.PieceModel.load(data))


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


@pytest.fixture(scope="module")
def unigram(data):
    """The library reading the same pieces as a Unigram model (trainer field 3 set to 1)."""
    out = b""
    for number, value in pieces._fields(data):
        if number == 2:
            value += varint(3 << 3) + varint(1)  # the last value of a field counts
        out += varint(number << 3 | 2) + varint(len(value)) + value
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def score(encoder, ids):
    return sum(encoder.model.pieces[i][1] for i in ids)


def test_words_match_the_library(spark, encoder, unigram):
    """Against the lattice search of the library, on words without unknown characters.

    Its single precision loses what follows an unknown one, and its default search does
    not always return its own best path.
    """
    texts = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    words = sorted({w for t in texts for w in t.split()})[:8000]
    known = [w for w in words if all(c in encoder.model.codes for c in w)]
    assert len(known) > 3000
    for word in known:
        ours, theirs = encoder.encode(word), unigram.nbest_encode_as_ids(word, 2)[0]
        assert unigram.decode(theirs) == encoder.decode(ours) == word
        if ours.tolist() != theirs:  # equal sums may be cut differently
            assert math.isclose(score(encoder, ours.tolist()), score(encoder, theirs), rel_tol=1e-6)


def test_best_of_all_segmentations(encoder):
    ids = {p: i for i, (p, _, kind) in enumerate(encoder.model.pieces) if kind == pieces.NORMAL}
    for word in ("▁the", "▁hello", "▁naïve", "ing.,", "▁▁▁a", "ononed"):
        best = -math.inf
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in ids for p in parts):
                best = max(best, sum(encoder.model.pieces[ids[p]][1] for p in parts))
        assert score(encoder, encoder.model.best_path(word)) == best


TEXTS = [
    None, "", " ", "  two  blanks ", "line\nbreaks\n\n", "tab\tand ▁ marker", "é😀 日本語 \U0010ffff",
    "a" * 5000, "word " * 50_000, "\x00\x01", " leading", "trailing ",
]


def test_round_trips(spark, encoder):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] * 2, SCHEMA)
    encoded = pieces.encode(docs)
    assert encoded.columns == [*docs.columns, "piece_ids"]
    back = pieces.decode(encoded)
    assert back.columns == ["doc_id", "text", "piece_ids", "decoded"]
    rows = back.collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        # The marker itself decodes as a blank; everything else comes back.
        assert r.decoded == (r.text or "").replace(pieces.MARKER, " ")
        assert r.piece_ids == encoder.encode(r.text).tolist()
    assert pieces.encode(docs.where("false")).count() == 0


def test_cache_changes_nothing(spark, data, monkeypatch):
    texts = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    whole = pieces.Encoder(pieces.PieceModel.load(data))
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    tiny = pieces.Encoder(whole.model)
    for t in texts[:40]:
        assert (whole.encode(t) == tiny.encode(t)).all()
        uncut = whole.model.best_path(pieces.MARKER + t.replace(" ", pieces.MARKER))
        assert whole.encode(t).tolist() == uncut


def test_broken_bytes_decode(encoder):
    some = encoder.model.byte_ids[0xE3]
    assert encoder.decode(np.array([some])) == "�"


def test_query(spark, encoder):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in read(spark, folder, "documents").collect()}
    found = pieces.op7_pieces(spark, folder)
    assert found.columns == ["doc_id", "n_pieces", "n_bytes", "ids_sha256", "decoded_sha256", "lossless"]
    for r in found.collect():
        ids = encoder.encode(texts[r.doc_id])
        assert r.n_pieces == len(ids) and r.lossless
        assert r.ids_sha256 == hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_time_of_one_long_word_grows_in_proportion():
    """Text without blanks or breaks: twice the characters take about twice as long."""
    import time

    with open(pieces.MODEL_PATH, "rb") as file:
        model = pieces.PieceModel.load(file.read())
    times = []
    for n in (40_000, 160_000):
        word = "".join(chr(0x4E00 + i * 7919 % 5000) if i % 3 else "ab+/"[i % 4] for i in range(n))
        start = time.perf_counter()
        model.best_path(word)
        times.append(time.perf_counter() - start)
    assert times[1] < 6 * times[0] + 0.5, times
