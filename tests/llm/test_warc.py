import hashlib

import pytest

from ordermart.llm import warc

BIG = "x" * 3000
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [(1, "u1", "plain " * 30), (2, "u2\r\nX: y", "a" + FAKE + "b" + "WARC/1.0\r\nWARC/1.0\r\n"), (3, None, None),
        (4, "u", "plain " * 30), (None, "u", "plain " * 30), (5, "é", ""), (6, "u", BIG + FAKE * 40 + BIG),
        (7, "u", BIG + FAKE * 40 + BIG), (8, "u", "WARC/1.0\r\n"), (9, "ü", "ünï€" * 40), (1, "u1", "plain " * 30),
        (10, "u", "\r\n\r\n" * 30), (11, "u", FAKE), (12, "u", FAKE)]


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of 700 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def want(rows):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        h = h or ""
        f = first.get(h)
        again = f is not None and f != i
        out.append((i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=repr)


def test_round_trip_with_magic_in_payloads_and_cut_blocks(spark, small_blocks, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(2)
    assert sorted((tuple(r) for r in warc.op6_query(pages).collect()), key=repr) == want(ROWS)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path, payloads=True).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.digest == r.declared and len(r.payload) == r.n == r.declared_bytes
        else:
            assert r.n == 0 and r.refers


def test_whole_files_and_empty_table(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert sorted((tuple(r) for r in warc.op6_query(pages).collect()), key=repr) == want(ROWS)
    assert warc.op6_query(pages.limit(0)).count() == 0


def test_damaged_record_ends_its_file(spark, tmp_path):
    record = lambda i, n: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {n}\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((record(1, 5) + record(2, 9) + record(3, 5)).encode())
    (tmp_path / "b.warc").write_bytes(("junk" + record(4, 5)).encode())
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in got) == ["<urn:page:1>", "<urn:page:2>"]


def test_block_exits_follow_the_chain():
    assert warc._exit_of([0, 5, 9, 20], [9, 20, 30, 50]) == [30, 50, 30, 50]
    assert warc._exit_of([0, 5], [None, 7]) == [None, 7]
