"""Catalogue search: one rule for single texts and tables of requests, and an index that misses nothing."""

import random

import pytest
from pyspark.sql import functions as F

from tidelattice.plans import catalogue as C

SECTIONS = ["native,monthly", "native,daily", "native,snapshot", "latlon,monthly", "latlon,daily", "latlon,snapshot", "mixed,all"]
NOTES = [None, "plain note", "*native grid, daily means*", "*lat-lon grid, monthly means*", "*snapshots*"]
ROW = "section string, short_name string, note string, var string, description string, source_order int, entry_id long"


def entries():
    pick = random.Random(6)
    letters = "abAB_ é"
    text = lambda n: "".join(pick.choice(letters) for _ in range(n))
    rows = []
    for k in range(300):
        note = pick.choice(NOTES)
        rows.append((pick.choice(SECTIONS), f"DS_{text(4)}", note, text(pick.randint(0, 6)), pick.choice([None, text(12)]), 0, k))
    return rows


def sees(section, note, grid, time_res):
    """The rule, said over again: which sections are read, and which starred notes bar a row."""
    if section == "mixed,all":
        if not note or "*" not in note:
            return True
        return (grid is None or {"native": "native", "latlon": "lat-lon"}[grid] in note) and (time_res == "all" or time_res in note)
    grids = ["native", "latlon"] if grid is None else [grid]
    read = {f"{g},{r}" for g in grids for r in ("monthly", "daily", "snapshot") if time_res in ("all", r)}
    return section in read - {"latlon,snapshot"}


def hit(row, query):
    return any(query.lower() in (x or "").lower() for x in (row[1], row[2], row[3], row[4]) if x is not None)


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(entries(), ROW).repartition(4)


def test_one_text(spark, catalogue):
    for grid in (None, "native", "latlon"):
        for time_res in ("all", "monthly", "snapshot"):
            got = {r.short_name for r in C.search(catalogue, "Ab", grid, time_res).collect()}
            assert got == {r[1] for r in entries() if sees(r[0], r[2], grid, time_res) and hit(r, "Ab")}, (grid, time_res)


def test_requests_equal_a_scan(spark, catalogue):
    queries = ["", "a", "AB", "b_a", "É a", "native", "aab", "zzz", "abzab", "ds_", "snapshots*"]
    keys = ["native,all", "latlon,all", "native,daily", " latlon , monthly", "latlon,snapshot"]
    asked = [(k, q) for k in keys for q in queries]
    requests = spark.createDataFrame(asked + asked[:3], "key string, query string")
    want = set()
    for key, query in asked:
        grid, time_res = (x.strip() for x in key.split(","))
        want |= {(key, query, r[1]) for r in entries() if sees(r[0], r[2], grid, time_res) and hit(r, query)}
    held = C.index(catalogue)
    for source in (catalogue, held):
        rows = [tuple(r) for r in C.search_requests(source, requests).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    bad = spark.createDataFrame([("native", "a")], "key string, query string")
    with pytest.raises(Exception, match="request key"):
        C.search_requests(held, bad).collect()
    assert C.search_requests(catalogue.limit(0), requests).count() == 0 and C.search_requests(held, requests.limit(0)).count() == 0


def test_candidates_grow_with_hits(spark):
    rows = spark.range(5000).selectExpr(
        "'native,daily' AS section", "concat('DS_', lpad(id, 5, '0')) AS short_name", "CAST(NULL AS string) AS note", "'v' AS var",
        "'common words of all rows' AS description", "0 AS source_order", "id AS entry_id",
    )
    held = C.index(rows)
    requests = spark.range(0, 5000, 10).selectExpr("'native,daily' AS key", "concat('ds_', lpad(id, 5, '0')) AS query")
    met = C.candidates(held, requests).count()
    hits = C.search_requests(held, requests).count()
    assert hits == 500 and met < 0.05 * 500 * 5000
    plan = C.search_requests(held, requests)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert C.search_requests(held, requests.withColumn("query", F.lit("none of them"))).count() == 0


def test_an_index_holds_each_text_once(spark):
    """Postings grow with the texts and with the runs asked for, not with the rows that repeat a text."""
    rows = spark.range(2000).selectExpr(
        "'native,daily' AS section", "concat('DS_', id % 20) AS short_name", "CAST(NULL AS string) AS note", "concat('v', id % 40) AS var",
        "'words of all rows' AS description", "0 AS source_order", "id AS entry_id",
    )
    once = rows.dropDuplicates(["short_name", "var"])
    assert C.index(rows).postings.count() == C.index(once).postings.count() < 2000
    requests = spark.createDataFrame([("native,daily", "v39"), ("native,all", "V3"), ("latlon,daily", "v39"), ("native,daily", "")], "key string, query string")
    asked = C.index(rows, requests)
    assert {r["gram"] for r in asked.postings.collect()} == {"v39", "v3", ""}
    found = {tuple(r) for r in C.search_requests(rows, requests).collect()}
    assert found == {tuple(r) for r in C.search_requests(C.index(once), requests).collect()}
    by_v3 = {("native,all", "V3", f"DS_{k % 20}") for k in range(40) if f"v{k}".startswith("v3")}
    assert found == {("native,daily", "v39", "DS_19")} | by_v3 | {("native,daily", "", f"DS_{k}") for k in range(20)}
