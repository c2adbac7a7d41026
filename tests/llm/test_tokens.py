"""Token operators on long pieces and wide vocabularies, bounded samples, and the entry without a library."""

import json
import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelattice.llm import bytepairs, op4_counts as op4, op7_records as op7, op9_packing as op9
from tidelattice.llm.stages import fixed_sample
from tidelattice.session import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_of_more_than_65535_tokens(spark):
    texts = ["zq" * 60_000, "字" * 70_000, "ACGT" * 40_000, "short"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(VOCABULARY)
    want = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in enumerate(texts)}
    assert max(want.values()) > 65_535
    assert {r["doc_id"]: r["n_tokens"] for r in op4.token_counts(frame, VOCABULARY).collect()} == want


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """A tokenizer file with ids beyond 16 bits."""
    spec = json.loads(open(VOCABULARY, encoding="utf-8").read())
    spec["added_tokens"].append({"id": 70_000, "content": "<wide>", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True})
    spec["model"]["vocab"].update({f"☃{k}": k for k in range(len(spec["model"]["vocab"]), 70_000)} | {"<wide>": 70_000})
    path = tmp_path_factory.mktemp("wide") / "wide.json"
    path.write_text(json.dumps(spec))
    return str(path)


def test_ids_of_32_bits(spark, wide):
    assert bytepairs.id_kind(VOCABULARY).itemsize == 2 and bytepairs.id_kind(wide).itemsize == 4
    texts = ["some words here", "and <wide> ids <wide>", None]
    library = Tokenizer.from_file(wide)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 70_000] for d, t in enumerate(texts)}
    assert max(ids[1][:-1]) == 70_000
    want = {d: (len(i), zlib.crc32(np.array(i, "<u4"))) for d, i in ids.items()}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = shared_folder(spark, "wide-records")
    got = op7.read_records(op7.write_records(frame, folder, wide, end=70_000), folder)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got.collect()} == want
    packed = op9.pack(frame, wide, end=70_000).collect()
    assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packed} == want


def test_records_are_read_by_as_many_tasks_as_files(spark):
    frame = spark.range(400).selectExpr("id AS doc_id", "repeat('some words ', 50) AS text").repartition(4)
    folder = shared_folder(spark, "many-records")
    manifest = op7.write_records(frame, folder, VOCABULARY, file_bytes=4000)
    files = manifest.count()
    assert files > 8
    used = op7.read_records(manifest, folder).select(F.spark_partition_id().alias("part")).distinct().count()
    assert used >= files // 2


def test_fixed_sample(spark):
    frame = spark.range(50_000).selectExpr("id AS doc_id")
    want = [r[0] for r in frame.orderBy(F.xxhash64("doc_id"), "doc_id").limit(300).collect()]
    for parts in (1, 7):
        assert [r[0] for r in fixed_sample(frame.repartition(parts), 300, "doc_id").collect()] == want
    assert fixed_sample(frame.limit(0), 300, "doc_id").count() == 0
    assert fixed_sample(frame.limit(200), 300, "doc_id").count() == 200
    plan = fixed_sample(frame, 300, "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (xxhash64" in plan


def test_entry_without_a_library():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert said.stdout.split() == ["179", "False"], said.stderr
