"""P-2: search of the variable catalogue by text, grid and time resolution.

One rule says which rows a request may see, and both ways to search use it: one
text over the whole catalogue in a single pass, and a table of requests through
an inverted index of short character runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import contains_ci
from ..operators.sets import later_wins, parse_request_key
from ..session import stored

# The shared section, and how notes spell the two grids.
MIXED_SECTION = "mixed,all"
GRID_WORDS = {"native": "native", "latlon": "lat-lon"}
# The searched columns, and the length of the character runs that the index holds.
SEARCHED = ("short_name", "var", "description", "note")
GRAM = 3


def allowed(section: Column, note: Column, grid: Column, time_res: Column) -> Column:
    """SF-32 and the routing of P-2: whether a request for a grid (NULL for any) and a resolution (or `all`) sees a row.

    A request sees the sections of its own and the shared one, and there, of the rows with a starred note, those that name the
    grid and the resolution it asks for.  Snapshots exist only on the native grid.
    """
    any_grid, any_time = grid.isNull(), time_res == "all"
    own_grid, own_time = F.split_part(section, F.lit(","), F.lit(1)), F.split_part(section, F.lit(","), F.lit(2))
    own = (any_grid | (own_grid == grid)) & (any_time | (own_time == time_res)) & (section != "latlon,snapshot")
    word = F.when(grid == "latlon", F.lit(GRID_WORDS["latlon"])).otherwise(grid)
    starred = F.coalesce(F.contains(note, F.lit("*")), F.lit(False))
    noted = ~starred | ((any_grid | F.contains(note, word)) & (any_time | F.contains(note, time_res)))
    return F.when(section == MIXED_SECTION, noted).otherwise(own)


def matches(query: Column) -> Column:
    """SF-25 over every value of a catalogue row."""
    hit = contains_ci(F.col(SEARCHED[0]), query)
    for name in SEARCHED[1:]:
        hit = hit | contains_ci(F.col(name), query)
    return hit


def merged(catalogue: DataFrame) -> DataFrame:
    """SO-1: one row per dataset and variable, the later source wins."""
    return later_wins(catalogue, ["section", "short_name", "var"], ["source_order", "entry_id"])


def search(catalogue: DataFrame, query: str, grid: str | None = None, time_res: str = "all") -> DataFrame:
    """Datasets with the text in their name, variables, descriptions or note: (short_name, exact, position).

    One text costs one pass over the catalogue, less than an index of it.
    """
    seen = catalogue.filter(allowed(F.col("section"), F.col("note"), F.lit(grid).cast("string"), F.lit(time_res)))
    asked = F.lit(query)
    return (
        seen.groupBy("short_name")
        .agg(F.bool_or(matches(asked)).alias("_hit"), F.min("entry_id").alias("position"))
        .filter("_hit")
        .select("short_name", (F.lower("short_name") == F.lower(asked)).alias("exact"), "position")
    )


def choose(options: DataFrame, option: int = 1) -> DataFrame:
    """SR-4: an exact match first, else the n-th option in catalogue order."""
    ranked = options.orderBy(F.desc("exact"), "position", "short_name")
    return ranked.offset(option - 1).limit(1)


def grams(text: Column, size: int) -> Column:
    """The distinct runs of `size` characters of a text; none in a shorter one."""
    runs = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda at: F.substring(text, at, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Index:
    """An inverted index of the texts of a catalogue, each held once: where a text stands, texts by number, the numbers by
    character run, and how many texts hold each run."""

    places: DataFrame  # value, section, note, short_name
    values: DataFrame  # value, text
    postings: DataFrame  # gram, value
    counts: DataFrame  # gram, n


def asked_runs(query: Column) -> Column:
    """The character runs that a query is found by: those of `GRAM` characters, or all of a shorter one."""
    asked = F.lower(query)
    return F.when(F.length(asked) >= GRAM, grams(asked, GRAM)).otherwise(F.array(asked))


def index(catalogue: DataFrame, requests: DataFrame | None = None) -> Index:
    """The index of a catalogue, written so that many searches may use it, or so much of it as these requests need.

    Rows name the same dataset, note or variable again and again, so texts are indexed and not rows.  Runs of up to `GRAM`
    characters are held, the empty one of every text included, so that short and empty queries find theirs.
    """
    texts = F.array_distinct(F.array(*[F.lower(name) for name in SEARCHED]))
    placed = catalogue.select("section", "note", "short_name", F.explode(texts).alias("text")).filter("text IS NOT NULL").distinct()
    placed = stored(placed, "catalogue-places")
    values = placed.select("text").distinct().withColumn("value", F.monotonically_increasing_id())
    values = stored(values.select("value", "text"), "catalogue-values")
    places = stored(placed.join(values, "text").drop("text"), "catalogue-text-places")
    sizes, asked = list(range(GRAM + 1)), None
    if requests is not None:
        asked = requests.select(F.explode(asked_runs(F.col("query"))).alias("gram")).filter("gram IS NOT NULL").distinct()
        asked = stored(asked, "asked-grams")
        sizes = [r[0] for r in asked.select(F.length("gram")).distinct().collect()]
    runs = [grams(F.col("text"), size) if size else F.array(F.lit("")) for size in sizes] or [F.array().cast("array<string>")]
    postings = values.select("value", F.explode(F.flatten(F.array(*runs))).alias("gram"))
    if asked is not None:
        postings = postings.join(asked, "gram", "left_semi")
    postings = stored(postings.select("gram", "value"), "catalogue-grams")
    return Index(places, values, postings, stored(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts"))


def candidates(of: Index, requests: DataFrame) -> DataFrame:
    """The requests with the `value` numbers that may match: those of the rarest of a query's character runs.

    Every match holds all runs of the query, so none is missed; a query with a run that no text holds has no candidates.
    """
    runs = asked_runs(F.col("query"))
    spread = requests.select("query").distinct().select("query", F.explode(runs).alias("gram"), F.size(runs).alias("_runs"))
    rarest = (
        spread.join(of.counts, "gram")
        .groupBy("query", "_runs")
        .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count(F.lit(1)).alias("_found"))
        .filter("_found = _runs")
        .select("query", "gram")
    )
    return requests.join(rarest, "query").join(of.postings, "gram").drop("gram")


def search_requests(catalogue: DataFrame | Index, requests: DataFrame) -> DataFrame:
    """SO-6: many (key, query) requests at once, `key` being `grid,time_res`: (key, query, short_name).

    Queries meet texts by character runs, and the keys come in where the texts found stand, so what is compared grows with
    the texts that are hit and not with requests times rows.
    """
    requests = stored(requests.select("key", "query").distinct(), "search-requests")
    of = catalogue if isinstance(catalogue, Index) else index(catalogue, requests)
    parsed = requests.withColumn("_k", parse_request_key(F.col("key")))
    met = candidates(of, requests.select("query").distinct()).join(of.values, "value")
    hits = met.filter(contains_ci(F.col("text"), F.col("query"))).select("query", "value")
    found = hits.join(of.places, "value").select("query", "section", "note", "short_name").distinct()
    seen = allowed(F.col("section"), F.col("note"), F.col("_k.grid"), F.col("_k.time_res"))
    return found.join(parsed, "query").filter(seen).select("key", "query", "short_name").distinct()
