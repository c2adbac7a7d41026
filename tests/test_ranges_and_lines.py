"""Incremental ranges, lines of split files, and lists with attributes of any shape."""

import json

import pytest
from pyspark.sql import functions as F

from tidelattice.operators.aggregate import value_range
from tidelattice.plans import ranges as N
from tidelattice.sources import tables as T
from tidelattice.sources import varlist as V
from tests.test_sources import VARLIST

KEYS = ["dataset", "var"]


@pytest.fixture()
def product(spark, tmp_path):
    """Three months of two datasets, a file a month, some values missing."""
    rows = spark.range(3000).selectExpr(
        "concat('D', id % 2) AS dataset", "concat('V', id % 3) AS var", "date_format(timestamp_seconds(id * 2500), 'yyyy-MM') AS month",
        "if(id % 7 = 0, NULL, if(id % 11 = 0, double('NaN'), double(id * 37 % 1000))) AS value",
    )
    return rows, str(tmp_path / "granules"), str(tmp_path / "store")


def as_set(frame):
    return {tuple(r) for r in frame.select(*KEYS, "valid_min", "valid_max").collect()}


def whole(rows):
    clean = rows.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return as_set(value_range(clean, KEYS))


def write(rows, path, mode="append"):
    rows.coalesce(1).write.mode(mode).partitionBy("month").parquet(path)


def test_only_new_granules_are_scanned(spark, product):
    rows, granules, store = product
    months = sorted(r[0] for r in rows.select("month").distinct().collect())
    assert len(months) == 3
    write(rows.filter(F.col("month") < months[2]), granules)
    assert N.update(spark, store, granules, KEYS) == 2
    assert as_set(N.current(spark, store, granules, KEYS)) == whole(rows.filter(F.col("month") < months[2]))
    write(rows.filter(F.col("month") == months[2]), granules)
    # The old files cannot have been read: their ranges come from the store.
    assert N.update(spark, store, granules, KEYS) == 1 and N.update(spark, store, granules, KEYS) == 0
    assert as_set(N.current(spark, store, granules, KEYS)) == whole(rows)


def test_replaced_and_removed_granules_take_their_ranges_along(spark, product, tmp_path):
    rows, granules, store = product
    write(rows, granules)
    N.update(spark, store, granules, KEYS)
    months = sorted(r[0] for r in rows.select("month").distinct().collect())
    for file in (tmp_path / "granules" / f"month={months[0]}").glob("*.parquet"):
        file.unlink()
    assert as_set(N.current(spark, store, granules, KEYS)) == whole(rows.filter(F.col("month") > months[0]))
    higher = rows.filter(F.col("month") == months[0]).withColumn("value", F.col("value") + 5000)
    write(higher, granules)
    assert N.update(spark, store, granules, KEYS) == 1
    assert as_set(N.current(spark, store, granules, KEYS)) == whole(rows.filter(F.col("month") > months[0]).unionByName(higher))


def test_a_run_without_its_commit_does_not_count(spark, product, tmp_path):
    rows, granules, store = product
    write(rows, granules)
    assert N.update(spark, store, granules, KEYS) == 3
    for commit in (tmp_path / "store" / "commits").glob("*.json"):
        commit.unlink()
    assert N.current(spark, store, granules, KEYS).count() == 0
    assert N.update(spark, store, granules, KEYS) == 3 and as_set(N.current(spark, store, granules, KEYS)) == whole(rows)


def test_lines_of_a_split_file_keep_their_order(spark, tmp_path):
    long = VARLIST + "".join(f"DS_L4_MORE_{k}_V1\n{'':18}{f'name_{k}':18}text {k}\n\n" for k in range(400))
    (tmp_path / "a.txt").write_text(long)
    (tmp_path / "b.txt").write_text(VARLIST)
    want = [("a.txt", n, line) for n, line in enumerate(long.split("\n")[:-1])] + [("b.txt", n, line) for n, line in enumerate(VARLIST.split("\n")[:-1])]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        lines = V.read_lines(spark, str(tmp_path))
        assert sorted((r.file, r.line_no, r.line) for r in lines.collect()) == sorted(want)
        parsed = V.parse_varlist(lines, "DS_L4_", 50)
        rows = {(r.file, r["var"], r.description) for r in parsed.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 400 + 2 * 4 and ("a.txt", "name_399", "text 399") in rows
    assert ("b.txt", "global_mean_barystatic_sea_level_anomaly", "Barystatic sea level (m)") in rows


def test_csv_rows_in_blocks_and_spanning_lines(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("id,title\n" + "".join(f"{k},\"title, \"\"{k}\"\"\"\n" for k in range(500)))
    (tmp_path / "long.csv").write_text('id,title\n1,"two\nlines"\n')
    got = T.read_csv_table(spark, str(tmp_path / "plain.csv"), "id long, title string")
    assert got.count() == 500 and got.filter("title = concat('title, \"', id, '\"')").count() == 500
    assert T.read_csv_table(spark, str(tmp_path / "long.csv"), "id long, title string", spanning=True).first().title == "two\nlines"


def test_attributes_of_any_shape(spark, tmp_path):
    items = [{"name": "a", "attrs": {"Title": "T", "n": 1}}, {"name": "b", "attrs": {"Title": ["x", "y"]}}, {"name": "c", "attrs": None}]
    (tmp_path / "list.json").write_text(json.dumps(items, indent=1))
    got = T.read_json_list(spark, str(tmp_path / "list.json"), "name string, attrs variant")
    rows = got.select("name", "list_name", F.try_variant_get("attrs", "$.Title", "string").alias("title"), F.try_variant_get("attrs", "$.n", "int").alias("n"))
    found = {r.name: (r.list_name, r.n) for r in rows.collect()}
    assert found == {"a": ("list", 1), "b": ("list", None), "c": ("list", None)}
