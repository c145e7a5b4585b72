"""Numbered pages: ranges of numbers, tries, missing and malformed pages as rows."""

from voltaflow.sources import pages as P

DDL = "region string, v int"


def test_missing_and_malformed_pages_are_rows(spark, tmp):
    bodies = [(n, '{"page": %d, "data": [{"region": "R%d", "v": %d}, {"region": null, "v": 0}]}' % (n, n, n)) for n in range(3, 60) if n != 17]
    bodies += [(60, "{broken"), (61, '{"page": 61, "data": []}'), (62, '{"page": 62}')]
    P.land_numbered(spark.createDataFrame(bodies, "page long, body string").repartition(4), tmp + "/p")
    read = P.read_numbered(spark, tmp + "/p", 3, 63, per_task=7)
    assert read.rdd.getNumPartitions() == 9  # a task for seven pages
    records, faults = P.page_records(read, DDL)
    assert records.count() == 2 * 56 and records.where("page <> v and v <> 0").count() == 0
    assert sorted((r.page, r.status) for r in faults.collect()) == [(17, "missing"), (60, "malformed"), (62, "malformed"), (63, "missing")]
    again = spark.createDataFrame([(17, '{"page": 17, "data": [{"region": "R17", "v": 17}]}')], "page long, body string")
    P.land_numbered(again, tmp + "/p")
    assert P.page_records(P.read_numbered(spark, tmp + "/p", 17, 17), DDL)[0].count() == 1
    assert P.read_numbered(spark, tmp + "/p", 5, 4).count() == 0


def test_a_page_is_tried_again():
    calls = []

    def flaky(page):
        calls.append(page)
        if len(calls) < 3:
            raise OSError("busy")
        return b"text"
    assert P.fetch(flaky, 4, 3, 0) == (4, "ok", None, "text")
    calls.clear()
    assert P.fetch(flaky, 4, 2, 0) == (4, "failed", "OSError: busy", None)
