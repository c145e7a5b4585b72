import re

import corpus_pipeline as cp
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tests.llm.test_bpe import OWN
from tests.llm.test_pii import base
from tests.llm.test_simhash import brute_fp, brute_labels


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string"),
                                       "n_chars": F.lit(None).cast("long")})
    docs = docs.unionByName(extra).unionByName(docs.limit(2)).cache()

    clean = cp.reject_toxic(spark, docs, SF).cache()
    assert clean.columns == columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()}
    assert all(labels.get(i, 1) == 1 for i in gone)

    rows = clean.collect()
    fps = [brute_fp(r.text) for r in rows]
    group = {}
    for r, g in zip(rows, brute_labels(fps, 4)):
        group.setdefault(g, []).append(r.doc_id)
    one = cp.near_duplicates(spark, clean, SF).cache()
    assert one.columns == columns
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted(
        str(min((i for i in v if i is not None), default=None)) for v in group.values())

    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [flat(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = cp.benchmark_leaks(spark, one, SF).cache()
    assert kept.columns == columns
    assert ({r.doc_id for r in one.collect() if not any(i in flat(r.text) for i in items)}
            == {r.doc_id for r in kept.collect()})

    masked = cp.private_data(spark, kept, SF).cache()
    assert masked.columns == columns
    assert masked.count() == kept.count()
    before = {r.doc_id: r for r in kept.collect()}
    for r in masked.collect():
        assert base(r.text) == []
        assert (r.text == before[r.doc_id].text) or "[" in r.text
        assert r.text is None or r.n_chars == len(r.text)

    final = cp.tokens(spark, masked, SF).collect()
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert len(final) == len(texts)
    for r in final:
        assert r.round_trip and list(r.ids) == OWN.encode_ordinary(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)


def test_run_is_the_stages_and_empty_tables_pass(spark):
    whole = cp.run(spark, SF)
    assert whole.count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
