import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from voltaflow.llm import queries, toxicity

MID = "/root/testdata/sf0.1"


def biased(n=400):
    """Toxic rows mention one group far more often; the insult is what counts."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 2
        group = "muslim" if rng.random() < (0.9 if toxic else 0.1) else "christian"
        words = [*rng.choice([f"w{j}" for j in range(60)], 12), group]
        if toxic and rng.random() < 0.8:
            words.append("scum")
        rng.shuffle(words)
        rows.append((k, " ".join(words), "x")), labels.append((k, int(toxic)))
    return rows, labels


def test_counterfactual_penalty_frees_neutral_mentions(frame):
    rows, labels = biased()
    docs, marked = frame(rows, "doc_id long, text string, score string"), frame(labels, "doc_id long, toxic int")
    plain = toxicity.train(docs, marked, swap=0.0)
    fair = toxicity.train(docs, marked, swap=10.0)

    def gap(model):
        return abs(model.logit(toxicity.words_of("a muslim family"), {}) - model.logit(toxicity.words_of("a christian family"), {}))
    assert gap(plain) > 1.0
    assert gap(fair) < 0.3 * gap(plain)
    assert fair.logit({"scum"}, {}) > fair.logit({"w1"}, {}) + 1


def test_a_sample_with_another_share_of_labels_gives_the_same_scores(frame):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(6000):
        toxic = int(rng.random() < 0.1)
        words = [str(w) for w in rng.choice([f"w{j}" for j in range(30)], 4)]
        rows.append((k, " ".join([*words, "hm"] if rng.random() < (0.7 if toxic else 0.2) else words), "x")), labels.append((k, toxic))
    docs, marked = frame(rows, "doc_id long, text string, score string"), frame(labels, "doc_id long, toxic int")
    share = np.mean([t for _, t in labels])
    for sample in ((10_000, 5_000), (400, 400)):
        model = toxicity.train(docs, marked, sample=sample)
        p = [1 / (1 + np.exp(-model.logit(toxicity.words_of(t), {}))) for _, t, _ in rows]
        assert abs(np.mean(p) - share) < 0.03


def test_labels_of_held_out_rows_never_matter(frame):
    rows, labels = biased(200)
    held = {k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0}
    docs = frame(rows, "doc_id long, text string, score string")
    a = toxicity.train(docs, frame(labels, "doc_id long, toxic int"))
    b = toxicity.train(docs, frame([(k, 1 - t if k in held else t) for k, t in labels], "doc_id long, toxic int"))
    assert a == b and len(held) > 10
    flags = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert {r.doc_id for r in flags if r.h} == held


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, None), (3, 7)], [(None, 1)], [(2, 0), (2, 0)]])
def test_few_or_odd_labels_and_odd_rows(frame, labels):
    docs = frame([(1, "a scum", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "text", "z")],
                 "doc_id long, text string, predicted string")
    model = toxicity.train(docs, frame(labels, "doc_id long, toxic int"))
    got = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == 5 and all(0 <= r.s <= 1 for r in got)


def test_empty_documents(frame):
    docs = frame([], "doc_id long, text string")
    model = toxicity.train(docs, frame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert docs.select(toxicity.score(F.col("text"), model)).count() == 0


def test_held_out_accuracy(spark):
    got = queries.op4_toxicity(spark, MID)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    r = (got.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect())
    n = {(x.toxic, x.predicted): x["count"] for x in r}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8  # the rest hold no sign of toxicity in their text
    assert n.get((0, 1), 0) <= 0.005 * n[0, 0]


def test_every_document_gets_a_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op4_toxicity(spark, SF)
    assert got.count() == docs.count()
    assert got.where("score is null or not score between 0 and 1 or predicted <> cast(score >= 0.5 as int)").count() == 0
