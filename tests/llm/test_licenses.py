"""Licence scans against a plain version of the same model, and planted notices."""

import math
import re

import numpy as np
import pytest

from stresslake.llm import licenses
from stresslake.llm.common import read

LINES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def model(spark):
    return licenses.train(read(spark, "/root/testdata/sf0.01", "documents"))


def plain_findings(model, text):
    """(line, start, end, family, probability, confirmed) of one text."""
    at, out = 0, []
    for number, line in enumerate((text or "").split("\n")):
        grams = licenses.grams_of(licenses.words_of(line))
        z = np.array(model.bias)
        for g in grams & model.weights.keys():
            z = z + np.array(model.weights[g])
        e = np.exp(z / model.temperature)
        best = int(e[:-1].argmax())
        p = e[best] / e.sum()
        if p >= licenses.MIN_PROBABILITY:
            family = model.families[best]
            sure = any(f == family and len(grams & set(t)) >= licenses.MIN_CONTAINED * len(t)
                       for f, t in model.templates)
            out.append((number, at, at + len(line), family, p, sure))
        at += len(line) + 1
    return out


def same(found, expected):
    assert [tuple(f)[:4] for f in found] == [e[:4] for e in expected]
    assert [f.confirmed for f in found] == [e[5] for e in expected]
    assert all(math.isclose(f.probability, e[4], rel_tol=1e-6) for f, e in zip(found, expected, strict=True))


def test_scan_matches_plain_and_finds_notices(spark, model):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = licenses.scan_licenses(docs, model).select("text", "licenses").collect()
    planted = 0
    for r in rows:
        same(r.licenses, plain_findings(model, r.text))
        for line, family in LINES.items():
            if re.search(rf"^{re.escape(line)}$", r.text, re.M):
                planted += 1
                assert any(f.family == family and f.confirmed for f in r.licenses)
        if not re.search("licen|released|gnu|apache", r.text, re.I):
            assert not r.licenses
    assert planted > 5


def test_without_anchor_is_unknown(model):
    e = np.exp(np.array(model.bias) / model.temperature)
    assert e[:-1].max() / e.sum() < licenses.MIN_PROBABILITY


def test_odd_texts(spark, model):
    texts = [None, "", "\n\n", "a license to kill", "MIT", "über Released under the MIT License\n\nSPDX-License-Identifier: MIT\n",
             "word " * 100_000 + "\nLicensed under CC BY-NC 4.0.\n" + "license " * 3_000, "released released released"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, licenses string")
    out = licenses.scan_licenses(docs, model)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        same(r.licenses, plain_findings(model, r.text))
    assert licenses.scan_licenses(docs.where("false"), model).count() == 0
    assert licenses.train(docs.where("false")).families


def test_query(spark):
    found = licenses.op8_licenses(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_found", "n_confirmed", "families", "findings"]
    assert found.count() == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_notices_of_several_families_and_wrapped_ones(spark, model):
    body = "alpha beta gamma delta " * 20
    texts = {
        1: ("Released under the MIT License or Released under the Apache License 2.0", {"mit", "apache-2.0"}),
        2: (f"{body}Licensed under the Apache License, Version 2.0 {body}Licensed under CC BY 4.0 {body}", {"apache-2.0", "cc-by"}),
        3: ("some line\n\nLicensed under the Apache License,\nVersion 2.0\n\nend", {"apache-2.0"}),
        4: ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}),
        5: ("Licensed under the GNU Lesser General Public License, version 2.1", {"lgpl"}),
        6: ("Licensed under the Apache License, Version 2.0\nBericht mit Daten", {"apache-2.0"}),
        7: ("Released under\n\nthe MIT License", set()),
        8: (None, set()),
        9: ("Licensed under CC BY 4.0 and Licensed under CC BY-NC 4.0", {"cc-by", "cc-by-nc"}),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r.licenses for r in licenses.scan_notices(docs, model).collect()}
    assert {i: {f.family for f in found if f.confirmed} for i, found in rows.items()} == {i: f for i, (_, f) in texts.items()}
    wrapped = [(f.start, f.end) for f in rows[3]]
    assert wrapped and all(texts[3][0][a:b].strip().startswith("Licensed") for a, b in wrapped)


def test_a_line_that_names_two_licences(spark, model):
    lines = ["SPDX-License-Identifier: MIT OR Apache-2.0",
             "Licensed under the MIT license or the Apache License, Version 2.0"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    for r in licenses.scan_notices(docs, model).collect():
        assert {f.family for f in r.licenses if f.confirmed} == {"mit", "apache-2.0"}


def test_recall_and_precision_on_planted_notices(spark, model):
    """Every line that a plain pattern knows is confirmed, and little else is."""
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    known = {re.compile(rf"{re.escape(line)}"): family for line, family in LINES.items()}
    hit = missed = extra = 0
    for r in licenses.scan_notices(docs, model).select("text", "licenses").collect():
        expected = {family for p, family in known.items() if p.search(r.text or "")}
        found = {f.family for f in r.licenses if f.confirmed}
        hit += len(expected & found)
        missed += len(expected - found)
        extra += len(found - expected)
    assert hit > 50 and hit / (hit + missed) > 0.97 and hit / (hit + extra) > 0.97, (hit, missed, extra)


def test_calibration_is_of_the_probability_in_use():
    """Margins that are twice too sure are halved."""
    rng = np.random.default_rng(1)
    margin = rng.normal(size=4000) * 2
    is_family = rng.random(4000) < 1 / (1 + np.exp(-margin))
    z = np.stack([2 * margin, np.zeros(4000)], 1)
    assert 1.6 < licenses.calibrate(z, np.where(is_family, 0, 1)) < 2.5
    assert licenses.calibrate(z[:0], np.empty(0, int)) == 1.0
