"""Readers and writers on small files."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from tidelattice.sources import binary as B
from tidelattice.sources import fields as FS
from tidelattice.sources import granules as G
from tidelattice.sources import sinks as K
from tidelattice.sources import tables as T
from tidelattice.sources import varlist as V

VARLIST = """Release 4 of the model

These are the variables of the native grid:

ShortName         Variable Name     Description (units)

Time Series:

DS_L4_SEA_LEVEL_MONTHLY_V1    *monthly means*
                  global_mean_barystatic_sea_level_anomaly
                                    Barystatic sea level (m)
                  global_mean_sea_level_anomaly

                                    Mean sea level (m)

Grid Parameters:

DS_L4_GEOMETRY_V1
Note: see the guide
                  XC                Longitude (degrees)
Some remark that starts on the left
                  YC                Latitude (degrees)
"""


@pytest.mark.parametrize("block", [2, 100_000])
def test_varlist(spark, tmp_path, block):
    (tmp_path / "list.txt").write_text(VARLIST)
    got = V.parse_varlist(V.read_lines(spark, str(tmp_path / "list.txt")), "DS_L4_", block).orderBy("line_no").collect()
    assert [(r.short_name, r.note, r["var"], r.description) for r in got] == [
        ("DS_L4_SEA_LEVEL_MONTHLY_V1", "*monthly means*", "global_mean_barystatic_sea_level_anomaly", "Barystatic sea level (m)"),
        ("DS_L4_SEA_LEVEL_MONTHLY_V1", "*monthly means*", "global_mean_sea_level_anomaly", "Mean sea level (m)"),
        ("DS_L4_GEOMETRY_V1", "see the guide", "XC", "Longitude (degrees)"),
        ("DS_L4_GEOMETRY_V1", "see the guide", "YC", "Latitude (degrees)"),
    ]


def test_binary_files_round_trip(spark, tmp_path):
    n, levels, rng = 4, 2, np.random.default_rng(0)
    size = levels * 13 * n * n
    want = {}
    for name in ("UVEL", "VVEL"):
        for step in (12, 36, 60):
            raw = rng.normal(size=size).astype(">f4")
            raw[::9] = B.MISSING
            raw.tofile(tmp_path / f"{name}.{step:010d}.data")
            want[(name, step)] = raw
    cells = B.read_records(spark, str(tmp_path), n).cache()
    assert cells.count() == 6 * size
    assert cells.filter("value is null").count() == 6 * len(range(0, size, 9))
    out = tmp_path / "out"
    manifest = B.write_records(cells, str(out), n, levels).collect()
    for (name, step), raw in want.items():
        assert (out / f"{name}.{step}.data").read_bytes() == raw.tobytes()
    digests = {f"{name}.{step}.data": (raw.nbytes, hashlib.sha256(raw.tobytes()).hexdigest()) for (name, step), raw in want.items()}
    assert {r.file: (r.bytes, r.sha256) for r in manifest} == digests
    assert sorted(p.name for p in out.iterdir() if p.name[0] != ".") == sorted(["_manifests", *digests])


def test_record_filters_skip_files_and_levels(spark, tmp_path):
    n, levels = 4, 6
    level = 13 * n * n
    for name in ("UVEL", "VVEL"):
        for step in (12, 36):
            np.arange(levels * level, dtype=">f4").tofile(tmp_path / f"{name}.{step:010d}.data")
    (tmp_path / "UVEL.0000000012.meta.tmp").mkdir()
    reader = B.RecordReader({"path": str(tmp_path), "n": "4", "cores": "3", "partition_bytes": str(2 * level * 4)})
    rest = list(reader.pushFilters([EqualTo(("var",), "UVEL"), GreaterThan(("step",), 12), In(("k",), (0, 1, 2, 5)), EqualTo(("value",), 3.0)]))
    assert rest == [EqualTo(("value",), 3.0)]
    assert [(p.var, p.step, p.first, p.last) for p in reader.pieces()] == [("UVEL", 36, 0, 2), ("UVEL", 36, 2, 3), ("UVEL", 36, 5, 6)]

    cells = B.read_records(spark, str(tmp_path), n)
    some = cells.filter("var = 'VVEL' AND step = 36 AND k >= 4")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]  # the source has taken all three
    assert some.count() == 2 * level and some.agg(F.min("value")).first()[0] == 4 * level
    everything = B.read_levels(spark, str(tmp_path), n, partition_bytes=str(level * 4), cores="100")
    assert everything.rdd.getNumPartitions() == 4 * levels
    assert everything.filter("var = 'UVEL' AND step = 12 AND k = 3").rdd.getNumPartitions() == 1
    assert everything.filter("var = 'none'").count() == 0
    (tmp_path / "WVEL.0000000012.data").write_bytes(b"1234")
    with pytest.raises(Exception, match="no whole levels"):
        B.read_records(spark, str(tmp_path), n).count()


def test_records_are_there_as_a_whole_or_not_at_all(spark, tmp_path):
    cell = "var string, step long, k long, tile long, j long, i long, value double"
    good = [("V", 1, 1, 12, 1, 1, 5.0), ("V", 1, 0, 0, 0, 0, None)]
    B.write_records(spark.createDataFrame(good, cell), str(tmp_path / "one"), 2, 2)
    raw = np.fromfile(tmp_path / "one" / "V.1.data", ">f4")
    assert len(raw) == 104 and raw[-1] == 5.0 and (raw[:-1] == B.MISSING).all()
    for bad in ([*good, good[0]], [*good, ("V", 1, 2, 0, 0, 0, 1.0)]):
        with pytest.raises(Exception, match="record V.1.data"):
            B.write_records(spark.createDataFrame(bad, cell), str(tmp_path / "bad"), 2, 2)
        assert not list((tmp_path / "bad").glob("*")) if (tmp_path / "bad").exists() else True
    # A gap wider than what is written at once.
    sparse = spark.createDataFrame([("W", 1, 0, 0, 0, 0, 1.0), ("W", 1, 39, 12, 99, 99, 2.0)], cell)
    B.write_records(sparse, str(tmp_path / "wide"), 100, 40)
    raw = np.fromfile(tmp_path / "wide" / "W.1.data", ">f4")
    assert len(raw) == 40 * 130_000 and raw[0] == 1 and raw[-1] == 2 and (raw[1:-1] == B.MISSING).all()


def test_feed_pages(spark, tmp_path):
    def entry(day, url):
        links = [{"title": "doc.html", "href": "x"}, {"title": f"Download {url}.nc", "href": f"https://h/{url}.nc"}]
        return {"time_start": f"2000-01-{day:02d}T00:00:00.000Z", "time_end": f"2000-01-{day + 1:02d}T00:00:00.000Z", "granule_size": "1.5", "links": links}

    pages = [[entry(1, "a"), entry(2, "b")], [entry(2, "b"), entry(3, "c")], [{**entry(4, "d"), "links": []}]]
    for at, page in enumerate(pages):
        (tmp_path / f"p{at}.json").write_text(json.dumps({"feed": {"entry": page}}, indent=1))
    got = G.read_feed(spark, str(tmp_path)).orderBy("url").collect()
    assert [r.url for r in got] == ["https://h/a.nc", "https://h/b.nc", "https://h/c.nc"]
    assert str(got[0].time_start) == "2000-01-01 00:00:00" and got[0].size_mb == 1.5


def test_listing_keeps_the_whole_time(spark):
    url = "https://h/X/SSH_snap_2000-01-02T060000_MODEL_V1_native_g.nc"
    urls = [(url.replace("T060000", f"T{late}"),) for late in ("060000", "063000", "0630", "06")]
    got = G.listing_dates(spark.createDataFrame(urls, "url string")).collect()
    assert [r.date_text for r in got] == ["2000-01-02T060000", "2000-01-02T063000", "2000-01-02T0630", "2000-01-02T06"]
    assert [str(r.time_start)[11:16] for r in got] == ["06:00", "06:30", "06:30", "06:00"]


def test_harvest_last_match_wins(spark):
    paths = ["/d/a_20010101_v1.nc", "/d/b_20010101_v2.nc", "/d/nh/c_20010301.nc", "/d/sh/z_20010301.nc", "/d/x_20020101.nc"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {str(r.date): r.path for r in G.harvest_year(spark, files, 2001).collect()}
    assert len(got) == 365 and got["2001-01-01"] == "/d/b_20010101_v2.nc" and got["2001-01-02"] == ""
    north = {str(r.date): r.path for r in G.harvest_year(spark, files, 2001, hemisphere="/nh/").collect()}
    assert north["2001-03-01"] == "/d/nh/c_20010301.nc" and north["2001-01-01"] == ""
    day_of_year = spark.createDataFrame([("/d/a_2001032.nc",)], "path string")
    assert {str(r.date) for r in G.harvest_year(spark, day_of_year, 2001, pattern="yyyyDDD").filter("path <> ''").collect()} == {"2001-02-01"}


def field(spark):
    rows = [("D", f"2000-0{m}-05 00:00:00", k, 1, j, 0, "SSH", "c", None if j == 0 else float(m + k + j)) for m in (1, 2) for k in (0, 1) for j in (0, 1)]
    cols = "dataset string, t string, k int, tile int, j int, i int, var string, loc string, value double"
    return spark.createDataFrame(rows, cols).withColumn("time", F.to_timestamp("t")).drop("t")


def test_product_is_pruned_by_month(spark, tmp_path):
    K.write_product(field(spark), str(tmp_path / "p"), fill=-9999.0)
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert stored.count() == 8 and stored.filter("value = -9999").count() == 4
    january = stored.filter("year_month = '2000-01'").filter("tile = 1").select("value")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "GreaterThan" not in plan
    assert "EqualTo(tile,1)" in plan and "ReadSchema: struct<tile:int,value:float>" in plan
    assert stored.filter("year_month = '2000-01'").select("hours").distinct().first()[0] == 8 * 365 * 24 + 2 * 24 + 4 * 24 - 12


def test_dataset_folders_and_many_files(spark, tmp_path):
    base = field(spark).withColumns({"grid": F.lit("native"), "time_type": F.lit("daily")})
    base.repartition("time").write.partitionBy("grid", "time_type", "dataset").parquet(str(tmp_path / "f"))
    found = FS.dataset_folders(spark, str(tmp_path / "f")).collect()
    assert {(r.grid, r.time_type, r.dataset) for r in found} == {("native", "daily", "D")}
    assert len(found) == len({r.path for r in found}) == len(list((tmp_path / "f").rglob("*.parquet")))
    assert FS.open_many(spark, str(tmp_path / "f")).count() == 8


def test_stored_ranges_read_recursively(spark, tmp_path):
    rows = spark.createDataFrame([("10.9999/DS_1", "SSH", 0.0, 1.0)], "id string, var string, valid_min double, valid_max double")
    for sub in ("a", "b"):
        folder = tmp_path / sub
        folder.mkdir()
        rows.toPandas().to_parquet(folder / "valid_minmax_x.parquet")
        rows.toPandas().to_parquet(folder / "other.parquet")
    got = T.read_stored_ranges(spark, str(tmp_path)).collect()
    assert len(got) == 2 and {r.dataset for r in got} == {"DS_1"}


def test_csv_and_json_tables(spark, tmp_path):
    (tmp_path / "d.csv").write_text('name,text\nA,"two\nlines, and ""quotes"""\n')
    got = T.read_csv_table(spark, str(tmp_path / "d.csv"), spanning=True).first()
    assert tuple(got) == ("A", 'two\nlines, and "quotes"')
    (tmp_path / "groupings.json").write_text(json.dumps([{"name": "g1"}, {"name": "g2"}]))
    rows = T.read_json_list(spark, str(tmp_path / "groupings.json")).collect()
    assert {(r.name, r.list_name) for r in rows} == {("g1", "groupings"), ("g2", "groupings")}


def test_writers(spark, tmp_path):
    granules = spark.createDataFrame([("D1", "https://h/D1/a.nc", "T", "P1D")], "short_name string, url string, title string, duration string").withColumns(
        {"time_start": F.lit("2000-01-01").cast("timestamp"), "time_end": F.lit("2000-01-02").cast("timestamp")}
    )
    K.write_manifest(granules, str(tmp_path / "m"))
    entry = json.loads(spark.read.json(str(tmp_path / "m")).first().entry)
    assert entry == {"title": "T", "time_coverage_start": "2000-01-01T00:00:00", "time_coverage_end": "2000-01-02T00:00:00", "time_coverage_duration": "P1D"}
    ranges = spark.createDataFrame([("D1", "SSH", 0.0, 1.0)], "dataset string, var string, valid_min double, valid_max double")
    K.write_ranges(ranges, str(tmp_path / "r"), "native", "daily")
    assert spark.read.parquet(str(tmp_path / "r")).first().name == "valid_minmax_D1_native_daily"
    catalogue = spark.createDataFrame([("1", "D1", "T", "First part. MARK rest")], "id string, short_name string, title string, description string")
    K.write_summary(catalogue, str(tmp_path / "s"), " MARK", " Second.")
    assert spark.read.json(str(tmp_path / "s")).first().summary == "First part. Second."


def test_mapping_cache_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(5).select(F.col("id").alias("source_id"))

    grid = spark.range(20).selectExpr("id", "id / 3 AS lon")
    cached = lambda g, radius: K.stored_or_computed(spark, str(tmp_path / "e"), compute, {"grid": g}, radius=radius)
    for same in (grid, grid.repartition(3), grid.orderBy("lon").select("lon", "id")):
        assert cached(same, 5.0).count() == 5
    assert len(calls) == 1
    # Another radius or another grid never finds the old factors.
    for other, radius in ((grid, 6.0), (grid.withColumn("lon", F.col("lon") + 1e-9), 5.0), (grid.limit(19), 5.0)):
        assert cached(other, radius).count() == 5
    assert len(calls) == 4
    # Rows without their entry are not seen.
    for entry in (tmp_path / "e" / "entries").glob("*.json"):
        entry.unlink()
    assert cached(grid, 5.0).count() == 5 and len(calls) == 5


def test_nan_is_missing_in_opened_files(spark, tmp_path):
    rows = "timestamp'2000-01-01' AS time, 'A' AS var, explode(array(1D, double('NaN'))) AS value"
    spark.sql(f"SELECT {rows}").write.parquet(str(tmp_path / "s"))
    assert FS.open_series(spark, str(tmp_path / "s")).agg(F.count("value"), F.max("value")).first() == (1, 1.0)
    assert FS.open_many(spark, str(tmp_path / "s")).agg(F.count("value"), F.max("value")).first() == (1, 1.0)


def test_records_of_two_datasets_stay_apart(spark, tmp_path):
    rows = "'A' AS var, '20000101' AS time, 0 AS k, 1 AS tile, 0 AS j, 0 AS i"
    cells = spark.sql(f"SELECT explode(array('D', 'E')) AS dataset, {rows}, 1D AS value")
    assert B.write_records(cells, str(tmp_path / "a"), 2, 1, keys=("dataset", "var", "time")).count() == 2
    with pytest.raises(Exception, match="several rows for one cell"):
        B.write_records(cells, str(tmp_path / "b"), 2, 1, keys=("var", "time"))
