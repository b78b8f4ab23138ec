"""The whole pipeline against a plain version of each stage."""

from collections import Counter

import duckdb
import pandas as pd

import corpus_pipeline
from stresslake.llm import mixing, pieces, secrets, toxicity
from stresslake.llm.common import read
from tests.llm.test_near_copies import plain_kept
from tests.llm.test_secrets import plain_base, plain_entropy

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_redaction(text):
    spans = sorted([(s, e) for s, _, _, e in plain_base(text)] + [
        (s, e) for c in secrets.ENTROPY_CLASSES for s, _, e in plain_entropy(text, c)])
    merged = []
    for s, e in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    for s, e in reversed(merged):
        text = text[:s] + secrets.MASK + text[e:]
    return text, bool(merged)


def test_run_matches_plain_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = read(spark, folder, "documents")
    model = toxicity.train(docs.select("doc_id", "text"), read(spark, folder, "labels"))
    rows = [tuple(r) for r in docs.select(*COLUMNS).orderBy("doc_id").collect()]

    rows = [r for r in rows if model is None or model.score(r[1]) < toxicity.THRESHOLD]
    kept = set(plain_kept([r[:2] for r in rows]))
    rows = [r for r in rows if r[0] in kept]
    masked = []
    for doc_id, text, lang, source, n_chars in rows:
        new, changed = plain_redaction(text)
        masked.append((doc_id, new, lang, source, len(new) if changed else n_chars))
    documents = pd.DataFrame(masked, columns=COLUMNS)  # noqa: F841  (read by the SQL)
    plan = duckdb.sql(mixing.OP1_SQL).fetchall()
    turns = {p[0]: -(-p[4] // p[1]) if p[1] else 0 for p in plan}
    with open(pieces.MODEL_PATH, "rb") as file:
        encoder = pieces.Encoder(pieces.PieceModel.load(file.read()))
    expected = Counter()
    for r in masked:
        if turns[r[0]]:
            expected[(*r, tuple(encoder.encode(r[1]).tolist()))] += turns[r[0]]

    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*COLUMNS, "piece_ids"]
    assert Counter((*r[:5], tuple(r[5])) for r in out.collect()) == expected
    assert len(rows) < docs.count() and any(secrets.MASK in r[1] for r in masked)


def test_stages_keep_the_columns_of_documents(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "secret_scan", "source_mixing", "sentencepiece"]
