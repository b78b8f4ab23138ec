"""Token counts by separator scan against counting each text, and scans of raw files."""

import numpy as np
import pytest

from stresslake.llm import tokens
from stresslake.llm.common import read


def encoding():
    with open(tokens.RANKS_PATH, "rb") as file:
        return tokens._encoding(file.read())


@pytest.mark.parametrize("block", [97, 1 << 16])
def test_query_counts_each_document(spark, monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", block)
    folder = "/root/testdata/sf0.001"
    one = encoding()
    expected = {r.doc_id: len(one.encode_ordinary(r.text)) for r in read(spark, folder, "documents").collect()}
    found = tokens.op4_token_counts(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ended"]
    rows = found.collect()
    assert {r.doc_id: r.n_tokens for r in rows} == expected and len(rows) == len(expected)
    assert all(r.ended for r in rows)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 8)
    texts = [None, "", "<|endoftext|>", "a b c", "long text " * 20_000, "é😀", None, "a b c"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x")],
                                 "doc_id long, text string, file string")
    blocks, order = tokens.write_flat(docs.repartition(3))
    found = order.join(tokens.scan(blocks), ["file", "ordinal"]).collect()
    one = encoding()
    expected = {i: len(one.encode_ordinary(t or "")) for i, t in enumerate(texts)} | {None: 1}
    assert {r.doc_id: r.n_tokens for r in found} == expected and len(found) == len(expected)
    blocks, order = tokens.write_flat(docs.where("false"))
    assert tokens.scan(blocks).count() == 0 and order.count() == 0


def plain_documents(stream, end):
    out, begin = [], 0
    for i, t in enumerate(stream):
        if t == end:
            out.append((begin, i - begin, True))
            begin = i + 1
    if begin < len(stream):
        out.append((begin, len(stream) - begin, False))
    return [(n, *d) for n, d in enumerate(out)]


@pytest.mark.parametrize("block", [1, 5, 1000])
def test_raw_files(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    end = tokens.END_OF_DOCUMENT
    streams = {
        "plain": rng.choice([1, 2, 3, end], 200), "ends": np.array([end] * 12), "none": np.array([7] * 33),
        "open": np.array([end, 1, 2, end, 5]), "empty": np.array([], int),
    }
    for name, stream in streams.items():
        (tmp_path / name).write_bytes(stream.astype("<u2").tobytes())
    blocks = tokens.read_flat(spark, str(tmp_path), block).repartition(4)
    found = {}
    for r in tokens.scan(blocks).collect():
        found.setdefault(r.file.rsplit("/", 1)[1], []).append((r.ordinal, r.start, r.n_tokens, r.ended))
    for name, stream in streams.items():
        assert sorted(found.get(name, [])) == plain_documents(stream, end)


def test_ranges_of_one_large_file(spark, tmp_path, monkeypatch):
    """Many ranges of blocks, an odd length, and a file that does not hold whole tokens."""
    monkeypatch.setattr(tokens, "RANGE_BLOCKS", 3)
    stream = np.random.default_rng(1).integers(0, 400, 10_007).astype("<u2")
    (tmp_path / "large.bin").write_bytes(stream.tobytes())
    rows = sorted((r.block, bytes(r.data)) for r in tokens.read_flat(spark, str(tmp_path), 64).collect())
    assert [b for b, _ in rows] == list(range(157)) and b"".join(d for _, d in rows) == stream.tobytes()
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole tokens"):
        tokens.read_flat(spark, str(tmp_path), 64).collect()
