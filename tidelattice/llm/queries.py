"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_defaults
from . import (
    op1_decontamination,
    op2_substrings,
    op3_ordinal,
    op4_counts,
    op5_neardedup,
    op6_quality,
    op7_records,
    op8_toxicity,
    op9_packing,
    op10_sharding,
    op11_search,
    op12_fim,
    op13_mixing,
)
from .stages import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(apply_defaults(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_token_counts")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return op4_counts.token_counts(table(spark, folder, "documents"), vocabulary())


@query("op7_token_records")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return op7_records.written_and_read(spark, table(spark, folder, "documents"), vocabulary())


@query("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return op9_packing.pack(table(spark, folder, "documents"), vocabulary())


# Words, windows and joins written out; every window of every document is compared.
OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, sizes WHERE len(ws) >= size)),
hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontamination", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    judged = op1_decontamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return judged.drop("text_hash")


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
owner AS (SELECT win, min(doc_id) AS first FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM (SELECT win.doc_id, win.i FROM win JOIN owner USING (win) WHERE owner.first < win.doc_id)),
word AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (
  SELECT doc_id, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY p) AS text
  FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    left = op2_substrings.dedup_substrings(table(spark, folder, "documents"))
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op10_sharding")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return op10_sharding.shard(table(spark, folder, "documents"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return op8_toxicity.score(docs, op8_toxicity.fit(docs, table(spark, folder, "labels")))


@query("op3_quality_grades")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return op3_ordinal.score(docs, op3_ordinal.fit(docs, table(spark, folder, "labels")))


@query("op6_quality_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    judged = op6_quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


# All pairs of documents with a shingle in common; least ids spread along the links until nothing changes.
OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
copies AS (SELECT doc_id, CASE WHEN len(ws) > 0 THEN min(doc_id) OVER (PARTITION BY ws) ELSE doc_id END AS copy_of FROM w),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w JOIN copies USING (doc_id) WHERE len(ws) > 0 AND doc_id = copy_of)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other),
least AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id)
SELECT copies.doc_id, copy_of, class_id FROM copies JOIN least ON least.doc_id = copy_of
"""


@query("op5_near_dedup", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return op5_neardedup.near_classes(table(spark, folder, "documents"))


# Every (item, document) pair with a term in common is scored.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(ws)) AS BIGINT) AS big_l FROM d WHERE len(ws) > 0),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT item_id, term, qtf, CAST(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM q JOIN df USING (term), corpus),
m AS (SELECT doc_id, 100 - 75 + ((75 * CAST(len(ws) AS BIGINT) * big_n) // big_l) AS m FROM d, corpus WHERE len(ws) > 0),
scores AS (
  SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM w JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


@query("op11_lexical_search", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return op11_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP12_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    made = op12_fim.restore(op12_fim.transform(table(spark, folder, "documents")))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


@query("op13_source_mix")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return op13_mixing.mix(table(spark, folder, "documents"))
