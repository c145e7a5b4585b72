import weakref
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from voltaflow.llm import common, toxicity


def test_texts_come_in_batches_of_a_megabyte(spark, frame):
    docs = frame([(k, "x" * 10_000) for k in range(600)], "doc_id long, text string").coalesce(1)
    common.bounded_batches()

    @F.pandas_udf("long")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([s.str.len().sum()] * len(s))
    sizes = [r[0] for r in docs.select(held("text")).collect()]
    assert len(sizes) == 600
    assert max(sizes) <= (1 << 20) + 10_000


def test_a_task_gives_back_memory_after_its_own_objects_are_gone(monkeypatch):
    class Big:
        pass

    seen, alive = [], []

    class Pool:
        def release_unused(self):
            seen.append([ref() for ref in alive])
    monkeypatch.setattr(pa, "default_memory_pool", Pool)

    @common.freeing
    def task(batches: Iterator[int]) -> Iterator[int]:
        own = Big()
        alive.append(weakref.ref(own))
        for k in batches:
            yield k + 1
    assert list(task(iter([1, 2, 3]))) == [2, 3, 4]
    assert seen == [[None]]


def test_training_takes_one_python_worker_a_task(spark, frame, monkeypatch):
    docs = frame([(k, f"he said w{k % 7} scum" if k % 2 else f"she said w{k % 7}") for k in range(60)], "doc_id long, text string")
    marked = frame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    plans, to_pandas = [], type(docs).toPandas

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return to_pandas(df)
    monkeypatch.setattr(type(docs), "toPandas", noted)
    model = toxicity.train(docs, marked)
    assert model.weights
    assert [p.split("Initial Plan")[0].count("ArrowEvalPython") for p in plans] == [1]
