"""The given relational tables seen as gridded-ocean data.

Every frame is computed by Spark from the tables of one folder with integer
arithmetic, whole tables at a time.  Grid dimensions come from `range`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import effective_radius
from ..session import stored

# Fixed sizes of the derived grids: native tile edge of fields and of the wider cell table,
# levels, days of the field, and the rows and columns of the 5-degree target grid.
FIELD_N = 5
CELL_N = 90
LEVELS = 2
DAYS = 91
TARGET_ROWS, TARGET_COLS = 36, 72


class Tables:
    """Lazy frames over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        stamps = [c for c, t in df.dtypes if t == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps}) if stamps else df

    # --- fields -----------------------------------------------------------------

    def field(self) -> DataFrame:
        """Native field (dataset, time, k, tile, j, i, var, loc, value) from line items.

        An order is one instant: a day of the first quarter of 2000 by its number, and the second of
        that day by its rank among the orders of the same day.  So there are about as many rows as line
        items, up to 91 days of 86,400 seconds each; only lines of one order in one cell fold.
        """
        return self._field(F.pmod(F.floor(F.col("l_orderkey") / DAYS), F.lit(86400)))

    def daily(self) -> DataFrame:
        """The field's daily maxima, for what sets whole days beside each other."""
        return self._field(F.lit(0))

    def _field(self, second: Column) -> DataFrame:
        li = self.table("lineitem")
        midnight = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("l_orderkey") % DAYS).cast("int"))
        keyed = li.select(
            F.concat(F.lit("DS_"), F.col("l_partkey") % 2).alias("dataset"),
            F.timestamp_seconds(F.unix_timestamp(midnight.cast("timestamp")) + second).alias("time"),
            ((F.col("l_linenumber") - 1) % LEVELS).cast("int").alias("k"),
            (F.col("l_partkey") % 13).cast("int").alias("tile"),
            (F.col("l_suppkey") % FIELD_N).cast("int").alias("j"),
            (F.col("l_orderkey") % FIELD_N).cast("int").alias("i"),
            F.concat(F.lit("V"), F.col("l_partkey") % 3).alias("var"),
            F.element_at(F.array(F.lit("c"), F.lit("w"), F.lit("s")), (F.col("l_partkey") % 3 + 1).cast("int")).alias("loc"),
            F.col("l_extendedprice").alias("price"),
        )
        dry = (F.col("tile") + F.col("j") + F.col("i") + F.dayofmonth("time")) % 7 == 0
        return (
            keyed.groupBy("dataset", "time", "k", "tile", "j", "i", "var", "loc")
            .agg(F.max("price").alias("_max"))
            .withColumn("value", F.when(~dry, F.col("_max")))
            .drop("_max")
        )

    def mask(self) -> DataFrame:
        """Grid dimension (k, tile, j, i, hfac, maskc, maskw, masks)."""
        n = FIELD_N
        at = F.col("id")
        cell = self.spark.range(LEVELS * 13 * n * n).select(
            F.floor(at / (13 * n * n)).cast("int").alias("k"),
            (F.floor(at / (n * n)) % 13).cast("int").alias("tile"),
            (F.floor(at / n) % n).cast("int").alias("j"),
            (at % n).cast("int").alias("i"),
        )
        k, tile, j, i = (F.col(c) for c in ("k", "tile", "j", "i"))
        hfac = ((tile * 31 + j * 7 + i * 3 + k) % 5) / F.lit(4.0)
        return cell.select(
            "*",
            hfac.alias("hfac"),
            (hfac > 0).alias("maskc"),
            ((tile + j + i + k) % 6 != 0).alias("maskw"),
            ((tile + j + i * 2 + k) % 6 != 0).alias("masks"),
        )

    def native_grid(self) -> DataFrame:
        """Grid dimension with positions, for the cells that occur in the field; a small written table."""
        tile, j, i = (F.col(c) for c in ("tile", "j", "i"))
        seen = self.field().select("k", "tile", "j", "i").distinct()
        placed = self.mask().join(seen, ["k", "tile", "j", "i"], "left_semi").select(
            "*",
            ((tile * 25 + j * 5 + i).cast("long")).alias("source_id"),
            (F.pmod(tile * 28 + i * 7, F.lit(360)) - 180.0).alias("lon"),
            (j * 36.0 - 80.0 + tile).alias("lat"),
        )
        return stored(placed, "native-grid")

    def cells(self) -> DataFrame:
        """Native cells (tile, j, i, xc, yc) that occur in line items, 90 x 90 per tile."""
        li = self.table("lineitem").select(
            (F.col("l_partkey") % 13).cast("int").alias("tile"),
            (F.col("l_suppkey") % CELL_N).cast("int").alias("j"),
            (F.col("l_orderkey") % CELL_N).cast("int").alias("i"),
        ).distinct()
        xc = F.pmod(F.col("tile") * 30 + F.col("i") / F.lit(3.0), F.lit(360.0)) - 180.0
        yc = F.least(F.greatest((F.col("j") * 2 - 90 + F.col("tile") % 2).cast("double"), F.lit(-89.0)), F.lit(89.0))
        return li.select("*", xc.alias("xc"), yc.alias("yc"))

    def layers(self) -> DataFrame:
        """Vertical layers (profile, k, dr) per supplier, one per ordered quantity."""
        li = self.table("lineitem").select(
            F.col("l_suppkey").alias("profile"), (F.col("l_quantity") - 1).cast("long").alias("k"), "l_tax"
        )
        return li.groupBy("profile", "k").agg(
            (F.round(F.max("l_tax") * 100.0, 0) + 10.0 + F.col("k") * 5.0).alias("dr")
        )

    def obs(self) -> DataFrame:
        """Scattered observations (source_id, ts, var, lon, lat, value) from events."""
        e, u = F.col("event_id"), F.col("user_id")
        return self.table("events").select(
            e.alias("source_id"),
            "ts",
            F.col("event_type").alias("var"),
            ((u * 3701 + e * 1301) % 36000 / F.lit(100.0) - 180.0).alias("lon"),
            ((e * 2903 + u * 701) % 18001 / F.lit(100.0) - 90.0).alias("lat"),
            F.when(e % 23 != 0, F.col("value")).alias("value"),
        )

    def target(self) -> DataFrame:
        """Regular 5-degree grid, row 0 in the north."""
        from ..plans.grids import regular_grid

        return regular_grid(self.spark, 360.0 / TARGET_COLS, 180.0 / TARGET_ROWS).withColumn(
            "radius", effective_radius(F.col("area"))
        )

    def series(self) -> DataFrame:
        """1-D series (time, var, value): hourly means of events."""
        return self.table("events").groupBy(
            F.date_trunc("hour", "ts").alias("time"), F.col("event_type").alias("var")
        ).agg(F.round(F.avg("value"), 7).alias("value"))

    # --- catalogues -------------------------------------------------------------

    def granules(self) -> DataFrame:
        """Granule listing (short_name, stem, period, url, size_mb, gdate, time_start, time_end) from orders."""
        kind = (F.col("o_orderkey") % 4).cast("int")
        mission = F.lpad((F.col("o_custkey") % 25).cast("string"), 2, "0")
        pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), kind + 1)
        day = F.to_date("o_orderdate")
        named = self.table("orders").select(
            F.concat(
                F.lit("DS_L4_"), pick("SSH", "SSH", "TEMP", "TEMP"), F.lit("_M"), mission, F.lit("_"),
                pick("LLC0090GRID_MONTHLY", "05DEG_DAILY", "LLC0090GRID_DAILY", "LLC0090GRID_SNAPSHOT"), F.lit("_V1"),
            ).alias("short_name"),
            F.concat(pick("SSH", "SSH", "TEMP", "TEMP"), F.lit("_M"), mission).alias("stem"),
            pick("mon_mean", "day_mean", "day_mean", "snap").alias("period"),
            pick("native", "latlon", "native", "native").alias("grid"),
            F.when(kind == 0, F.trunc(day, "MM")).otherwise(day).alias("gdate"),
            "o_totalprice",
            "o_orderkey",
            "o_orderstatus",
        )
        grouped = named.groupBy("short_name", "stem", "period", "grid", "gdate").agg(
            F.max("o_totalprice").alias("_price"),
            F.min("o_orderkey").alias("_key"),
            F.bool_or(F.col("o_orderstatus") == "F").alias("delivered"),
        )
        size = F.when(F.col("_key") % 17 == 0, F.lit(None).cast("double")).when(
            F.col("_key") % 19 == 0, F.lit(0.0005)
        ).otherwise(F.col("_price") / F.lit(10000.0))
        text = F.when(F.col("period") == "mon_mean", F.date_format("gdate", "yyyy-MM")).otherwise(F.date_format("gdate", "yyyy-MM-dd"))
        start = F.col("gdate").cast("timestamp")
        stop = F.when(F.col("period") == "mon_mean", F.add_months("gdate", 1)).when(
            F.col("period") == "snap", F.col("gdate")
        ).otherwise(F.date_add("gdate", 1))
        return grouped.select(
            "short_name", "stem", "period",
            F.concat(
                F.lit("https://h/"), F.col("short_name"), F.lit("/"),
                F.concat_ws("_", "stem", "period", text, F.lit("MODEL_V1"), "grid", F.lit("g.nc")),
            ).alias("url"),
            size.alias("size_mb"), "gdate", start.alias("time_start"), stop.cast("timestamp").alias("time_end"), "delivered",
        )

    def have(self) -> DataFrame:
        """File names already present: the delivered granules."""
        return self.granules().filter("delivered").select(F.substring_index("url", "/", -1).alias("basename"))

    def catalogue(self) -> DataFrame:
        """Variable catalogue (section, short_name, note, var, description, source_order) from parts."""
        size = F.col("p_size")
        brand = F.replace("p_brand", F.lit("Brand#"), F.lit("B"))
        pick = lambda m, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (size % m + 1).cast("int"))
        mixed = size % 5 == 0
        return self.table("part").select(
            F.when(mixed, "mixed,all").otherwise(
                F.concat(pick(2, "native", "latlon"), F.lit(","), pick(3, "monthly", "daily", "snapshot"))
            ).alias("section"),
            F.concat_ws(
                "_", F.lit("DS_L4"), "p_type", brand,
                F.when(mixed, "MIXED").otherwise(
                    F.concat(pick(2, "LLC0090GRID", "05DEG"), F.lit("_"), pick(3, "MONTHLY", "DAILY", "SNAPSHOT"))
                ), F.lit("V1"),
            ).alias("short_name"),
            F.when(mixed, F.concat(F.lit("*for "), pick(2, "native", "lat-lon"), F.lit(" grid, "), pick(3, "monthly", "daily", "snapshot"), F.lit("*"))).alias("note"),
            F.col("p_name").alias("var"),
            F.concat_ws(" ", "p_type", size.cast("string")).alias("description"),
            (F.col("p_partkey") % 2).cast("int").alias("source_order"),
            F.col("p_partkey").alias("entry_id"),
        )

    def metadata(self) -> DataFrame:
        """Dataset attributes from suppliers and nations."""
        s, key = self.table("supplier"), F.col("s_suppkey")
        nation = self.table("nation")
        joined = s.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        short = F.concat(F.lit("DS_"), key)
        return joined.select(
            key, "s_acctbal",
            F.concat(F.lit("10.9999/"), short).alias("id"),
            short.alias("short_name"),
            F.concat(F.lit("https://h/search?ShortName="), short, F.when(key % 7 == 0, "_OLD").otherwise("")).alias("link"),
            F.concat(F.col("s_name"), F.lit(" of "), F.col("n_name")).alias("title"),
            F.concat(F.lit("Fields of "), F.col("n_name"), F.lit(". Marker text "), key).alias("summary"),
            F.concat(F.lit("OCEAN, "), F.col("n_name"), F.lit(",ICE")).alias("keywords"),
            F.concat(F.lit("ICE, REGION_"), F.col("n_regionkey"), F.lit(" , ocean")).alias("keywords_extra"),
            F.create_map(
                F.lit("Title"), F.col("s_name"), F.lit("author"), F.col("n_name"),
                F.lit("Zone"), F.col("n_regionkey").cast("string"), F.lit("date"), F.lit("2000-01-01"),
            ).alias("attrs"),
            F.concat(F.lit("V"), key % 3, F.lit(" , V"), (key + 1) % 3, F.lit(",W"), key % 5).alias("fields"),
            F.concat(F.lit("V0:SSH,V"), key % 2 + 1, F.lit(":TEMP")).alias("rename"),
        )

    def repairs(self) -> DataFrame:
        """Corrected titles, names and summaries by dataset; some datasets have none."""
        m = self.metadata()
        key = F.col("s_suppkey")
        return m.filter(F.col("s_acctbal") >= 1000).select(
            "id",
            F.when(key % 10 == 0, F.concat("title", F.lit(" (new)"))).otherwise(F.col("title")).alias("fix_title"),
            F.col("short_name").alias("fix_short_name"),
            F.when(key % 4 == 0, F.concat("summary", F.lit(" revised"))).otherwise(F.col("summary")).alias("fix_summary"),
        )

    def stored_ranges(self) -> DataFrame:
        """Ranges per (dataset, var, month) as stored with granules; some months are wide, some narrow."""
        by_month = self.field().groupBy("dataset", "var", F.date_format("time", "yyyy-MM").alias("month")).agg(
            F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.month(F.max("time")).alias("_m")
        )
        pad = (F.col("_hi") - F.col("_lo")) * 0.1
        low = F.when(F.col("_m") == 1, F.col("_lo") - pad).when(F.col("_m") == 2, F.col("_lo") + pad).otherwise(F.col("_lo"))
        high = F.when(F.col("_m") == 1, F.col("_hi") + pad).when(F.col("_m") == 2, F.col("_hi") - pad).otherwise(F.col("_hi"))
        return by_month.select(
            "dataset", "var", "month", F.concat("dataset", F.lit("_"), "month", F.lit(".nc")).alias("file"),
            low.alias("valid_min"), high.alias("valid_max"),
        )
