import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from voltaflow.llm import queries, sharding


def bits(key):
    text = "null" if key is None else f"={key}"
    return f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"


def brute(rows, limit):
    """Shards by splitting one bit at a time: prefix -> rows."""
    done, todo = {}, {"": list(rows)}
    while todo:
        p, own = todo.popitem()
        if sum(b for _, b in own) <= limit or len(p) == 60:
            done[p] = own
            continue
        for bit in "01":
            if half := [r for r in own if bits(r[0])[len(p)] == bit]:
                todo[p + bit] = half
    return done


def check(got, rows, limit):
    want = brute(rows, limit)
    assert sorted(str((r.doc_id, r.bytes)) for r in got) == sorted(str(r) for r in rows)
    total = defaultdict(int)
    for r in got:
        p, _, over = r.shard.partition("+")
        p = "" if p == "*" else p
        assert p in want and (r.doc_id, r.bytes) in want[p] and bits(r.doc_id).startswith(p) and r.depth == len(p)
        assert bool(over) == (sum(b for _, b in want[p]) > limit)
        assert r.oversize == (r.bytes > limit)
        total[r.shard] += 0 if r.oversize else r.bytes
        if r.oversize:
            assert sum(x.shard == r.shard for x in got) == 1
    assert all(t <= limit for t in total.values())


def test_query(spark):
    rows = [(r.doc_id, len((r.text or "").encode())) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op5_sharding(spark, SF).collect(), rows, sharding.SHARD_BYTES)


@pytest.mark.parametrize("limit", [50, 700, 10 ** 9])
def test_hot_keys_nulls_long_texts_and_clashing_names(frame, limit):
    rows = [(k, "é" * (k % 30), "a") for k in range(200)] + [(7, "x" * 11, None)] * 120 + [(7, "y" * (limit // 2 + 1 if limit < 999 else 3), "b")] * 4
    rows += [(None, "n" * 20, "s")] * 30 + [(300, None, "s"), (301, "", "s"), (302, "z" * 5000, "s")]
    docs = frame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.assign(docs, limit).collect()
    check(got, [(i, len((t or "").encode())) for i, t, _ in rows], limit)


def test_empty_table(frame):
    assert sharding.assign(frame([], "doc_id long, text string")).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = queries.op5_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards_hold_every_row(frame, spark, tmp_path):
    docs = frame([(k, "t" * k) for k in range(100)], "doc_id long, text string")
    placed = sharding.write(docs, str(tmp_path / "s"), 400)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text) for r in back.select("doc_id", "text").collect()) == [(k, "t" * k) for k in range(100)]
    assert back.select("_shard").distinct().count() == placed.select("shard").distinct().count()


def test_written_shards_of_a_hot_key_keep_the_limit(frame, spark, tmp_path):
    limit = 2000
    docs = frame([(7, f"{n:04d}" * 40, "x") for n in range(150)] + [(None, "n" * 90, "y")] * 60 + [(8, "z" * 3000, "s")]
                 + [(k, "t" * (k % 50), "a") for k in range(100, 300)], "doc_id long, text string, shard string").repartition(5)
    placed = sharding.write(docs, str(tmp_path / "s"), limit).collect()
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text", "shard").collect())) == sorted(map(str, docs.collect()))
    size = {r["_shard"]: (r.b, r.n) for r in back.groupBy("_shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(b <= limit or n == 1 for b, n in size.values())
    want = {}
    for r in placed:
        name = "s" + r.shard.replace("*", "")
        want[name] = want.get(name, 0) + r.bytes
    assert {k: b for k, (b, _) in size.items()} == want
    assert len([k for k in size if "+" in k]) > 10
