import __spark_entry__ as contract
from chronofold.llm.revisits import resolve_revisits
from tests.oracle import connect, differences

SCHEMA = "id long, url string, time long, status int, etag string, last_modified string, headers map<string,string>"


def test_revisits_take_the_latest_earlier_response(spark):
    rows = [
        (1, "HTTP://Example.com:80/a#x", 10, 200, "e1", None, {"content-type": "html", "date": "d1"}),
        (2, "http://example.com/a", 9000, 304, "e1", None, {"date": "d2", "content-type": "other"}),
        (3, "http://example.com/a", 9001, 200, "e2", None, None),
        (4, "http://example.com/a", 9002, 304, "e1", None, None),
        (5, "http://example.com/a", 9003, 304, None, None, {"date": "d5"}),
        (6, "http://example.com", 5, 304, None, None, None),
        (7, None, None, 304, None, None, None),
        (8, "http://example.com/a", 9003, None, None, None, None),
    ]
    got = {r["id"]: r for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r["resolved_id"] for k, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: None, 5: 3, 6: None, 7: None, 8: None}
    assert got[2]["headers"] == {"content-type": "html", "date": "d2"} and got[5]["headers"] == {"date": "d5"}
    assert got[1]["canonical_url"] == "http://example.com/a" and got[6]["canonical_url"] == "http://example.com/"
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_last_modified_alone_decides(spark):
    rows = [
        (1, "http://a.b/", 1, 200, None, "m1", {}),
        (2, "http://a.b/", 2, 304, None, "m1", None),
        (3, "http://a.b/", 3, 304, None, "m0", None),
    ]
    got = {r["id"]: r["resolved_id"] for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: None}


def test_query_over_a_busy_url_in_several_stretches(spark, tmp_path):
    spellings = ["HTTP://Example.com:80/a#x", "http://example.com/a", "http://user@example.com/a"]
    bodies = ["<p>one</p>", None, "<p>one</p>", "", "<p>two é</p>", "<p>one</p>", "<p>two é</p>", None]
    rows = [(n * 997, spellings[n % 3], bodies[n // 5 % 8]) for n in range(120)] + [(5, None, "x"), (6, None, None), (7, "http://b.c", None), (8, "no scheme", "y")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    query = contract.queries()["op3_revisits"](spark, str(tmp_path))
    got = {r["id"]: r for r in query.collect()}
    # Brute force: the latest earlier full response, page by page.
    full, known = {}, set()
    for page, url, body in sorted(rows, key=lambda r: r[0]):
        u = url if url in (None, "no scheme") else "http://b.c/" if url == "http://b.c" else "http://example.com/a"
        fresh = bool(body) and (u, body) not in known
        before = full.get(u) if u else None
        if fresh:
            known.add((u, body))
            full[u] = (page, body)
            expected, length = page, len(body.encode())
        else:
            fits = before and (not body or body == before[1])
            expected, length = (before[0], len(before[1].encode())) if fits else (None, 0)
        lines = dict(line.split(": ") for line in got[page]["headers"].split("\n"))
        assert (got[page]["canonical_url"], got[page]["revisit"], got[page]["resolved_id"]) == (u, not fresh, expected)
        assert (lines["content-length"], lines["date"], "content-type" in lines) == (str(length), str(page), expected is not None)
        assert (lines["etag"] if expected is not None else None) == (got[expected]["headers"].split("etag: ")[1][:64] if expected is not None else None)
    assert len({page // 4096 for page, *_ in rows}) > 20 and sum(r["revisit"] and r["valid"] for r in got.values()) > 20
    sql = contract.oracle_sql()["op3_revisits"].replace("FROM pages", f"FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert differences(query, connect("/root/testdata/sf0.001"), sql) is None


def test_query_equals_sql(spark, sf_dir):
    assert differences(contract.queries()["op3_revisits"](spark, sf_dir), connect(sf_dir), contract.oracle_sql()["op3_revisits"]) is None
