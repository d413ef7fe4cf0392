"""The projection forest against brute force; revisits against SQL and hand-made cases."""
import numpy as np

from conftest import SF_SMALL
from martforge.llm import vector_dedup, warc
from martforge.llm.common import documents


def brute(rows, threshold=0.93):
    n = len(rows)
    unit = []
    for _, v, y in rows:
        x = np.array([np.nan if c is None else c for c in v] if v else [], float)
        ok = y is not None and len(x) and np.isfinite(x).all() and np.linalg.norm(x) > 0
        unit.append(x / np.linalg.norm(x) if ok else None)
    links = np.zeros(n, int)
    name = [r[0] for r in rows]
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if unit[i] is not None and unit[j] is not None
             and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    for _ in range(n):
        for i, j in pairs:
            name[i] = name[j] = min(name[i], name[j])
    return links, name


def test_forest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAF", 40)  # several splits also on a small table
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)  # and several blocks in a leaf
    rng = np.random.default_rng(5)
    rows = []
    for g in range(60):
        centre = rng.normal(size=32)
        for k in range(int(rng.integers(1, 12))):
            v = centre + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.2, 0.27])
            rows.append((len(rows), [float(x) for x in v], int(g % 3)))
    rows += [(1000, None, 1), (1001, [0.0] * 32, 1), (1002, [1.0] * 31 + [float("nan")], 1), (1003, rows[0][1], None),
             (1004, [1.0] * 31 + [None], 0), (1005, [1.0, 2.0], 0), (1006, [1.0, 2.0], 0), (1007, [], 0),
             (1008, [1.0] * 31 + [float("inf")], 0)]
    table = spark.createDataFrame([(*r, "x", 3) for r in rows],
                                  "vec_id long, embedding array<float>, label int, unit string, leaf int")
    as_read = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    links, name = brute(as_read)
    got = {r.vec_id: r for r in vector_dedup.near_duplicates(table).collect()}
    assert len(got) == len(rows)
    for r, n, c in zip(rows, links, name):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (n, c, c == r[0])
    assert vector_dedup.near_duplicates(table.limit(0)).count() == 0


def test_revisits_equal_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    cols = ["page_id", "canonical_url", "refers_to", "status", "n_payload", "payload_md5", "headers"]
    expect = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({warc.ORACLE})").fetchall(), key=str)
    got = warc.resolved_pages(documents(spark, SF_SMALL, "pages")).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == expect


def record(i, kind, url, time, headers, payload=None, status=None):
    return (i, kind, url, time, status or (200 if kind == "response" else 304), headers, payload, "x")


def test_revisit_rules(spark):
    rows = [
        record(1, "response", "http://A.com/x/", 10, {"etag": '"1"', "content-type": "text", "date": "10"}, "one"),
        record(2, "response", "https://www.a.com:443/x#top", 20, {"etag": '"2"'}, "two"),
        record(3, "revisit", "a.com/x?utm_source=f", 15, {"etag": 'W/"1"', "date": "15", "content-length": "0"}),
        record(4, "revisit", "a.com/x", 20, {"etag": '"1"'}),  # the answer of the same instant is not earlier
        record(5, "revisit", "a.com/x", 25, {"etag": '"1"'}),
        record(6, "revisit", "a.com/x", 5, {"etag": '"1"'}),
        record(7, "revisit", None, 30, {"etag": '"1"'}),
        record(8, "revisit", "a.com/x", 25, None),
        record(9, "response", "a.com/x", 22, {"etag": '"3"'}, None),  # no payload: no full response
        record(10, "response", "a.com/x", 23, {"etag": '"4"'}, "gone", 404),
        record(11, "response", "b.com/?q=1&utm_x=2", 1, {"last-modified": "m"}, "bee"),
        record(12, "response", "b.com?q=1", 1, {"last-modified": "m"}, "bee two"),  # a tie: the greater id counts
        record(13, "revisit", "b.com/?q=1", 900, {"last-modified": "m"}),
    ]
    table = spark.createDataFrame(rows, "record_id long, kind string, url string, time long, http_status int, "
                                        "headers map<string,string>, payload string, status string")
    got = {r.record_id: r for r in warc.resolve(table).collect()}
    assert {k: (r.status, r.refers_to) for k, r in got.items()} == {
        3: ("resolved", 1), 4: ("resolved", 1), 5: ("mismatch", 2), 6: ("missing", None), 7: ("missing", None),
        8: ("mismatch", 2), 13: ("resolved", 12)}
    assert got[3].payload == "one" and got[13].payload == "bee two" and got[5].payload is None
    assert got[3].headers == {"etag": 'W/"1"', "content-type": "text", "date": "15"}
    assert warc.resolve(table.limit(0)).count() == 0


def test_hot_url_over_time_slices(spark):
    rows = [record(2 * t, "response", "h.com/a", 2 * t, {"etag": f'"{t // 7}"'}, str(t)) for t in range(0, 2000, 7)]
    rows += [record(2 * t + 1, "revisit", "h.com/a", 2 * t + 1, {"etag": f'"{t // 7}"'}) for t in range(2000)]
    table = spark.createDataFrame(rows, "record_id long, kind string, url string, time long, http_status int, "
                                        "headers map<string,string>, payload string, status string")
    got = warc.resolve(table).collect()
    assert len(got) == 2000
    assert all(r.status == "resolved" and r.refers_to == 2 * ((r.record_id // 2) // 7 * 7) for r in got)


def test_repeated_record_ids_do_not_cross(spark):
    schema = "record_id long, kind string, url string, time long, http_status int, headers map<string,string>, payload string"
    tag = {"etag": '"t"'}
    rows = [(1, "response", "http://a/x", 1, 200, tag, "page a"), (1, "response", "http://b/x", 1, 200, tag, "page b"),
            (1, "response", "http://b/x", 1, 200, tag, "a lesser page"),
            (2, "revisit", "http://a/x", 5, 304, tag, None), (2, "revisit", "http://b/x", 5, 304, tag, None),
            (2, "revisit", "http://b/x", 1, 304, tag, None), (None, "revisit", "http://a/x", 6, 304, tag, None),
            (None, "response", "http://c/x", 1, 200, tag, "page c"), (3, "revisit", "http://c/x", 2, 304, tag, None)]
    got = sorted((str(r.record_id), r.canonical_url, r.time, r.status, r.payload)
                 for r in warc.resolve(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([("2", "a/x", 5, "resolved", "page a"), ("2", "b/x", 5, "resolved", "page b"), ("2", "b/x", 1, "missing", None),
                          ("None", "a/x", 6, "resolved", "page a"), ("3", "c/x", 2, "resolved", "page c")])


def test_vectors_of_extreme_size_are_linked(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [2e-200, 0.0], 1), (3, [1e200, 0.0], 1), (4, [0.0, 1e300], 1), (5, [5e-324, 0.0], 1),
            (6, [0.0, 0.0], 1), (7, [float("inf"), 0.0], 1), (8, [1e308, 1e308], 1), (9, [1.0, 1.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (0, 4), 6: (0, 6), 7: (0, 7), 8: (1, 8), 9: (1, 8)}
