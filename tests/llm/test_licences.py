import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from voltaflow.llm import licences, queries

LINES = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT",
         "This work is licensed under the GNU General Public License, version 3.": "GPL",
         "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "Proprietary"}


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(8)
    vocab = [f"w{k}" for k in range(2000)] + ["the", "of", "this", "under", "to", "version", "public", "work", "by", "and"] * 60
    return [[str(w) for w in rng.choice(vocab, int(n))] for n in rng.integers(1, 80, 900)]


@pytest.fixture(scope="module")
def model(prose):
    return licences.fit(prose[:600])


def test_held_out_accuracy_of_notices_prose_and_unknown_licences(model, prose):
    rng = np.random.default_rng(77)
    right = total = 0
    for family, notices in licences.NOTICES.items():
        for t in notices:
            for n in range(2, 12):
                text = " ".join(licences._varied(licences.words_of(t), prose[600:], rng, n))
                got = {f["family"] for f in licences.scan_text(text, model)}
                total += 1
                right += family in got and not got - {family, "unknown"}
    assert right / total >= 0.9
    wrong = sum(bool(licences.scan_text(" ".join(w), model)) for w in prose[600:])
    assert wrong <= 3
    for t in ("Distributed under the Bar License, version 7.", "Licensed under the Quux Public License agreement."):
        assert [f["family"] for f in licences.scan_text(t, model)] == ["unknown"]


def test_calibration(model, prose):
    rows = [model.features(w) for w in prose[600:]]
    assert model.probabilities(rows)[:, 0].mean() > 0.95
    assert np.allclose(model.probabilities(rows).sum(axis=1), 1)


def test_template_must_confirm(model, monkeypatch):
    text = "Released under the MIT License."
    assert licences.scan_text(text, model)[0]["family"] == "MIT"
    monkeypatch.setattr(licences, "ALIKE", 1.01)
    assert licences.scan_text(text, model)[0]["family"] == "unknown"


def test_whole_texts_are_covered_and_offsets_fit(model, prose):
    head = " ".join(w for p in prose[:300] for w in p)
    for line, family in LINES.items():
        text = f"é\n{head} {line} {head}"
        found = [f for f in licences.scan_text(text, model) if f["family"] == family]
        assert found and all(f["end"] - f["start"] < 1500 for f in found)
        assert any(line.rstrip(".")[:20] in text[f["start"]:f["end"]] for f in found)
        text = f"{head}\n{line}\r\n{head}"
        assert [text[f["start"]:f["end"]] for f in licences.scan_text(text, model) if f["family"] == family] == [line]


@pytest.mark.parametrize("mark", ["", "// ", " * ", "# "])
def test_templates_wrapped_at_72_columns(model, prose, mark):
    def wrapped(t):
        return "\n".join(mark + x for x in textwrap.wrap(t, 72 - len(mark)))
    code = "\n".join(" ".join(p[:9]) for p in prose[600:610])
    for family, notices in licences.NOTICES.items():
        for t in notices:
            for text in (wrapped(t), f"{code}\n{mark.rstrip()}\n{wrapped(t)}\n{mark.rstrip()}\n{code}", f"{code}\n{wrapped(t)}\n{code}"):
                got = licences.scan_text(text, model)
                assert family in {f["family"] for f in got} <= {family, "unknown"}, (t, got)
    both = wrapped(licences.NOTICES["GPL"][4]) + f"\n{mark}SPDX-License-Identifier: MIT\n" + wrapped(licences.NOTICES["ISC"][2])
    assert {"GPL", "MIT", "ISC"} <= {f["family"] for f in licences.scan_text(both, model)}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op10_licences(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = sorted({f for line, f in LINES.items() if line in text.split("\n")})
        assert got[i].families == ",".join(want) and got[i].n_found >= len(want)


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", "b"), (3, "Released under the MIT License.", None),
                                       (3, "Released under the MIT License.", None), (None, "\n\n", "c")]])
def test_nulls_repeats_clashing_names_and_empty_tables(frame, rows):
    docs = frame(rows, "doc_id long, text string, found string")
    got = docs.select("doc_id", licences.scan(F.col("text"), licences.train(docs)).alias("found")).collect()
    assert sorted((str(r.doc_id), [f.family for f in r.found]) for r in got) == sorted(
        (str(i), ["MIT"] if i == 3 else []) for i, _, _ in rows)
