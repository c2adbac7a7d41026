"""Near-duplicates with weights and crowds, and stages on hard rows and clashing column names."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelattice.llm import op2_substrings as op2, op5_neardedup as op5
from tidelattice.llm.stages import free_name

SMALL = "/root/testdata/sf0.001"


def shingle_counts(text):
    ws = (text or "").split()
    return Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)] if ws else [])


def by_formula(a, b):
    """Probability Jaccard similarity, summed as it is defined."""
    both = a.keys() | b.keys()
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in both) for x in a.keys() & b.keys())


def classes(texts, similar):
    label = {d: d for d in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if label[a] != label[b] and similar(texts[a], texts[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_probability_jaccard_of_weights():
    pick = np.random.default_rng(3)
    for _ in range(50):
        a, b = (pick.choice(60, pick.integers(1, 40), replace=False).astype(np.uint64) for _ in range(2))
        of_a, of_b = pick.integers(1, 9, len(a)), pick.integers(1, 9, len(b))
        want = by_formula(Counter(dict(zip(a.tolist(), of_a.tolist()))), Counter(dict(zip(b.tolist(), of_b.tolist()))))
        order_a, order_b = np.argsort(a), np.argsort(b)
        assert abs(op5.probability_jaccard(a[order_a], of_a[order_a], b[order_b], of_b[order_b]) - want) < 1e-9


def test_weighted_signatures_estimate_the_formula():
    pick = np.random.default_rng(1)
    a, b = {k: int(pick.integers(1, 9)) for k in range(300)}, {k: int(pick.integers(1, 9)) for k in range(60, 360)}
    hashes = op5.mix(np.array([k for s in (a, b) for k, n in s.items() for _ in range(n)], np.uint64))
    text = np.repeat([0, 1], [sum(a.values()), sum(b.values())])
    want = by_formula(Counter(a), Counter(b))
    made = op5.signatures(hashes, text, 2, 3000, weighted=True)
    assert abs((made[0] == made[1]).mean() - want) < 0.04
    plain = op5.signatures(hashes, text, 2, 3000)
    assert abs((plain[0] == plain[1]).mean() - 240 / 360) < 0.04 < abs(want - 240 / 360)


def crowd():
    """Families around the threshold, some rows with repeated passages."""
    pick, out = random.Random(8), {}
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(120)]
        for _ in range(14):
            text = list(base)
            for _ in range(pick.choice([0, 1, 2, 3, 4])):
                text[pick.randrange(120)] = f"e{pick.random()}"
            out[len(out)] = " ".join(text + base[:20] * pick.choice([0, 0, 1, 3]))
    return out


@pytest.mark.parametrize("weighted", [False, True])
def test_classes_of_a_crowd(spark, weighted):
    texts = crowd()
    counts = {d: shingle_counts(t) for d, t in texts.items()}
    if weighted:
        want = classes(counts, lambda a, b: by_formula(a, b) >= 0.8)
    else:
        want = classes(counts, lambda a, b: len(a.keys() & b.keys()) >= 0.8 * len(a.keys() | b.keys()))
    assert 6 < len(set(want.values())) < len(want)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op5.near_classes(frame, weighted=weighted).collect()}
    assert got == want


def linked_classes(pairs):
    least = {x: x for pair in pairs for x in pair}
    while changed := [(a, b) for a, b in pairs if least[a] != least[b]]:
        for a, b in changed:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_links_of_a_crowd_are_looked_up_once(spark, monkeypatch):
    """Rows that the joins on an end of a link make; a round over all links, both ways, would make some 2 x links each."""
    pick, pairs = random.Random(3), set()
    for member in range(100, 1100):
        pairs |= {(member, pick.choice(range(10 * (member % 3), 10 * (member % 3) + 10))) for _ in range(6)}
    pairs |= {(k, k + 1) for k in range(2000, 2040)} | {(3000 + (7 * k) % 41, 3000 + (7 * k + 7) % 41) for k in range(40)} | {(5000, k) for k in range(4000, 4050)}
    made, join = [], type(spark.range(0)).join

    def counted(left, right, on=None, how=None):
        out = join(left, right, on, how)
        if on in ("a", "b"):
            made.append(out.count())
        return out

    monkeypatch.setattr(type(spark.range(0)), "join", counted)
    frame = spark.createDataFrame(sorted(pairs), "a long, b long")
    got = {r["doc_id"]: r["class_id"] for r in op5.components(frame).collect()}
    assert got == linked_classes(pairs) and sum(made) < 2.2 * len(pairs)
    assert op5.components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("weighted", [False, True])
def test_rare_meetings_lose_no_link_and_make_few_pairs(spark, weighted):
    texts = crowd()
    counts = {d: shingle_counts(t) for d, t in texts.items()}
    rows = spark.createDataFrame([(d, d, t) for d, t in texts.items()], "doc_id long, class_id long, text string")
    made = {(r["a"], r["b"]) for r in op5._rare_meetings(rows, 5, 0.8, weighted).collect()}
    linked, family = set(), 0
    for a in texts:
        for b in texts:
            if a < b and counts[a].keys() & counts[b].keys():
                family += 1
                x, y = counts[a], counts[b]
                if (by_formula(x, y) if weighted else len(x.keys() & y.keys()) / len(x.keys() | y.keys())) >= 0.8:
                    linked.add((a, b))
    assert linked <= made and (weighted or len(made) < len(linked) + 0.3 * (family - len(linked)))


def test_words_are_cut_where_they_stand():
    text = "head line\n\tindented  code\nx y\n  end\n\tmore \n"
    # Words: head line indented code x y end more
    assert op2.without_words(text, [4, 6]) == "head line\n\tindented  code\nend\n\tmore \n"
    assert op2.without_words(text, [0, 2]) == "indented  code\nx y\n  end\n\tmore \n"
    assert op2.without_words(text, [2, 3, 6, 8]) == "head line\n\tcode\nx y \n"
    assert op2.without_words(text, [0, 8]) == "" and op2.without_words(text, []) == text
    assert op2.without_words("ü éé\nñ", [1, 2]) == "ü ñ"


ODD = ["_id", "_hash", "_sha", "_kept", "_spans", "_words_sha", "__id", "key", "starts", "class_id", "score", "window", "print", "bucket"]


def test_stages_on_hard_rows_and_clashing_names(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    texts = [
        (1, "first line\n\t" + passage + "\nlast line of one"),
        (2, "other line\n\tindented here\n" + passage + "\n  tail of two\n"),
        (2, "another text of the id two"),
        (3, None),
        (4, ""),
        (5, "A" * 70_000),
        (None, "nameless text of a few words more"),
        (None, "first line\n\t" + passage + "\nlast line of one"),
        (6, "x " * 30_000 + "end"),
        (6, "x " * 30_000 + "end"),
    ]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in ODD)
    docs = spark.createDataFrame([(d, t, *ODD) for d, t in texts], schema)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        left = stage(spark, docs, SMALL)
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert all(r[c] == c for r in rows for c in ODD), name
        if name == "near_dedup":
            assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted((d or 0, t or "") for d, t in [*texts[:7], texts[8]])
        if name == "substring_dedup":
            found = Counter((r["doc_id"], r["text"]) for r in rows)
            assert found[2, "other line\n\tindented here\ntail of two\n"] == 1
            assert sum((found - Counter(texts)).values()) == 1
        if name == "decontamination":
            assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(texts)
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).select("doc_id").distinct().count() == 7
    assert free_name(docs, "_id") == "___id"


def test_stage_without_n_chars(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").drop("n_chars")
    stage = dict(corpus_pipeline.STAGES)["substring_dedup"]
    assert stage(spark, docs, SMALL).columns == docs.columns
    with_chars = stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")), SMALL)
    assert with_chars.filter("n_chars <> length(text)").count() == 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_alone_bounds_the_batches_for_python(spark, monkeypatch, tmp_path, name):
    """On a session that nobody set up, a batch of Spark's default would hold all of these rows."""
    limit, set_at, plain = "spark.sql.execution.arrow.maxBytesPerBatch", [], type(spark.range(0)).mapInArrow
    before = spark.conf.get(limit)
    docs = spark.range(0, 24, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 100000) AS text")
    few = spark.createDataFrame([(k, f"text {k} of few words and a bad{k % 2} one") for k in range(40)], "doc_id long, text string")
    few.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    few.limit(1).selectExpr("doc_id AS item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")

    def sizes(batches):
        yield pa.RecordBatch.from_pydict({"largest": [max(b.nbytes for b in batches)]})

    def noted(frame, *args, **options):
        set_at.append(spark.conf.get(limit))
        return plain(frame, *args, **options)

    try:
        spark.conf.unset(limit)
        monkeypatch.setattr(type(docs), "mapInArrow", noted)
        dict(corpus_pipeline.STAGES)[name](spark, few, str(tmp_path))
        assert set_at and set(set_at) == {str(4 << 20)}
        assert plain(docs, sizes, "largest long").first()["largest"] < 8 << 20
    finally:
        spark.conf.set(limit, before)
