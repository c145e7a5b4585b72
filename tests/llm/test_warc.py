import hashlib
import io

import pytest
import zstandard

from tests.llm.conftest import SF
from voltaflow.llm import queries, warc


def expected(rows):
    full = [(i, (h or "").encode()) for i, h in rows]
    largest = {}
    for i, p in full:
        if i is not None:
            largest[p] = max(i, largest.get(p, i))
    out = []
    for i, p in full:
        again = len(p) >= 1000 and p in largest and i != largest[p]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", largest[p] if again else None))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = queries.op3_warc(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


@pytest.mark.parametrize("small", [False, True])
def test_duplicates_nulls_repeats_long_pages_and_exact_round_trip(frame, tmp_path, monkeypatch, small):
    if small:  # many frames, bundles and reading ranges
        monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
        monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
        monkeypatch.setattr(warc, "READ_BYTES", 5000)
    copy, near, long = "é" * 500, "x" * 999, "<p>\r\n\r\nWARC/1.1\r\n" * 40_000
    rows = [(k, copy) for k in range(0, 60, 3)] + [(k, near) for k in range(100, 104)]
    rows += [(200, None), (201, ""), (202, long), (203, long), (5, "é" * 499), (7, "y" * 1000), (7, "y" * 1000), (6, "y" * 1000),
             (None, copy), (None, "z" * 2000), (None, "z" * 2000)]
    pages = frame([(i, f"http://a.example/{i}\r\nx" if i else None, h, "q") for i, h in rows],
                  "page_id long, url string, html string, record_id string")
    got = queries.archived_pages(pages).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)

    manifest, folder = warc.archive(pages, str(tmp_path / "w"))
    places = manifest.collect()
    assert len(places) == len(rows)
    plain = {h or "" for _, h in rows}
    for p in places:
        head, block = warc.fetch(p, folder)
        assert head["warc-record-id"] == f"<{p.record_id}>"
        http, payload = warc.payload_of(block)
        if head["warc-type"] == "response":
            assert payload.decode() in plain and int(http["content-length"]) == len(payload)
            assert head["warc-payload-digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        else:
            assert payload == b"" and any(q.record_id == head["warc-refers-to"][1:-1] for q in places)
    assert sorted(r.payload.decode() for r in warc.read(manifest, folder).collect() if r.payload is not None) == sorted(
        h or "" for (i, h), e in zip(sorted(rows, key=lambda r: str((r[0], len((r[1] or "").encode()), hashlib.sha1((r[1] or "").encode()).hexdigest()))), expected(rows)) if e[3] == "response")
    for name in {p.bundle for p in places}:  # any Zstandard reader can read a bundle from end to end
        raw = (tmp_path / "w" / name).read_bytes()
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as f:
            data = f.read()
        assert len(list(warc.parse(data))) == sum(p.bundle == name for p in places)


def test_empty_table(frame):
    assert queries.archived_pages(frame([], "page_id long, url string, html string")).count() == 0
