"""Training-data operators against brute force, on hard little tables and on the smallest test tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidelattice.llm import (
    op1_decontamination as op1,
    op2_substrings as op2,
    op3_ordinal as op3,
    op4_counts as op4,
    op5_neardedup as op5,
    op6_quality as op6,
    op7_records as op7,
    op8_toxicity as op8,
    op9_packing as op9,
    op10_sharding as op10,
)
from tidelattice.llm.queries import QUERIES, SQL
from tidelattice.session import shared_folder
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, window string, print long, shard int"


def texts():
    """NULL, empty, short, very long, tied, repeated and odd texts."""
    pick = random.Random(5)
    words = ["über", "le", "and", "of", "x", "don't", "#%$", "12", "ñandú", "…"]

    def some(n):
        return " ".join(pick.choice(words) for _ in range(n))

    base = some(60)
    parts = base.split()
    near = " ".join(parts[:30] + ["changed"] + parts[31:])
    return [
        None, "", "   \n\t ", "one", "a b c d", base, base, near, base.replace(" ", "\n"), some(40) + " " + " ".join(parts[10:30]),
        some(20_000), "again and again\n" * 50, "word " * 3000, "<|endoftext|> in <|endoftext|>text", "it's we'll　 'quoted' \x85x",
        some(13), some(12), " ".join(parts[5:18]), "\x1c\x1f odd \x0b white", "A" * 5000,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "w", i, 0) for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (None, texts()[5], None, None, None, None, None, None), (7, "another text of id seven " * 4, *rows[7][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_decontamination(spark, docs, plain, empty):
    item = ITEM.findall(texts()[5].lower())
    items = [(1, " ".join(item[3:20])), (2, "ONE"), (3, None), (4, ""), (5, " ".join(item[3:20])), (10, "word word word"), (6, "never seen here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for doc_id, text in plain:
        words = ITEM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hit, found = set(), set()
        for item_id, body in items:
            test = ITEM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), body or ""))
            size = min(13, len(test))
            windows = {tuple(test[k : k + size]) for k in range(len(test) - size + 1)} if size else set()
            for k in range(len(words) - size + 1) if size else ():
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((doc_id, len(words), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(words)))
    assert rows_of(op1.decontaminate(docs, bench).drop("text_hash")) == Counter(want)
    assert op1.decontaminate(empty, bench).count() == 0
    assert not op1.decontaminate(docs, bench.limit(0)).filter("contaminated OR n_items > 0").count()
    left = op1.without_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not w[-1] for w in want)


def test_substrings(docs, plain, empty):
    words = [(d, PLAIN.findall(t or "")) for d, t in plain]
    least = {}
    for d, ws in words:
        for k in range(len(ws) - 12):
            if d is not None:
                key = tuple(ws[k : k + 13])
                least[key] = min(least.get(key, d), d)
    want = []
    for d, ws in words:
        gone = set()
        for k in range(len(ws) - 12) if d is not None else ():
            if least[tuple(ws[k : k + 13])] < d:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        want.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = op2.dedup_substrings(docs, shard_windows=10, task_words=50)
    assert rows_of(got.select("doc_id", "n_words", "n_removed", "kept_sha256")) == Counter(want)
    assert op2.dedup_substrings(empty).count() == 0


def test_suffix_automaton_matches():
    pick = random.Random(1)
    for _ in range(200):
        spans = [[pick.randint(0, 2) for _ in range(pick.randint(0, 12))] for _ in range(4)]
        query = [pick.randint(0, 3) for _ in range(15)]
        automaton = op2.SuffixAutomaton()
        for owner, span in enumerate(spans):
            automaton.add(span, owner)
        automaton.finish(3)
        for end, (size, state) in enumerate(automaton.matches(query), 1):
            owners = {n: [o for o, s in enumerate(spans) if any(s[k : k + n] == query[end - n : end] for k in range(len(s) - n + 1))] for n in range(1, end + 1)}
            assert size == max((n for n in owners if owners[n]), default=0)
            if size >= 3:
                assert automaton.first[state] == owners[3][0]


def test_counts_and_records(spark, docs, plain, empty):
    library = Tokenizer.from_file(VOCABULARY)
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t in plain]
    want = Counter((d, len((t or "").encode()), len(i), len(i) > 1024) for (d, t), (_, i) in zip(plain, ids))
    assert rows_of(op4.token_counts(docs, VOCABULARY)) == want
    assert op4.token_counts(empty, VOCABULARY).count() == 0

    folder = shared_folder(spark, "records-test")
    manifest = op7.write_records(docs, folder, VOCABULARY, file_bytes=4000)
    got = op7.read_records(manifest, folder, chunk=1000)
    ordered = sorted((d is not None, d, *(len(i) + 1, zlib.crc32(np.array([*i, 0], "<u4")))) for d, i in ids)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == Counter(o[1:] for o in ordered)
    at = 0
    for r in sorted(got.collect(), key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    by_start = [r["doc_id"] for r in sorted(got.collect(), key=lambda r: r["start"])]
    assert by_start == sorted(by_start, key=lambda d: (d is not None, d or 0))
    assert op7.write_records(empty, shared_folder(spark, "no-records"), VOCABULARY).count() == 0


def test_record_damage_is_found():
    record = bytearray(op7.frame(b"payload"))
    assert bytes(op7.unframe(memoryview(bytes(record)), 0)[0]) == b"payload"
    for at in (0, 14):
        damaged = bytearray(record)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            op7.unframe(memoryview(bytes(damaged)), 0)


def test_packing(docs, plain, empty):
    library = Tokenizer.from_file(VOCABULARY)
    got = op9.pack(docs, VOCABULARY, length=64).collect()
    assert sum(r["length"] for r in got) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in plain)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for number, parts in by.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or number == max(by)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 0] for d, t in plain if d not in (None, 5, 7)}
    for r in got:
        if r["doc_id"] in ids:
            mine = ids[r["doc_id"]]
            assert r["doc_tokens"] == len(mine)
            assert r["ids_crc32"] == zlib.crc32(np.array(mine[r["start"] : r["start"] + r["length"]], "<u4"))
    assert op9.pack(empty, VOCABULARY).count() == 0


def test_near_classes(spark, docs, plain, empty):
    sets = defaultdict(list)
    for d, t in plain:
        ws = PLAIN.findall(t or "")
        sets[d].append({tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    names = sorted(d for d in sets if d is not None)
    label = {d: d for d in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                near = any(x and y and len(x & y) >= 0.8 * len(x | y) for x in sets[a] for y in sets[b])
                if near and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    got = {r["doc_id"]: r["class_id"] for r in op5.near_classes(docs).collect()}
    assert {d: c for d, c in got.items() if d is not None} == label and got[None] is None
    assert op5.near_classes(empty).count() == 0
    left = op5.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == sorted({*label.values()})


def test_signatures_estimate_probability_jaccard():
    a, b = np.arange(1, 401, dtype=np.uint64), np.arange(81, 481, dtype=np.uint64)
    both = op5.mix(np.concatenate([a, b]))
    made = op5.signatures(both, np.repeat([0, 1], 400), 2, 1200)
    assert abs((made[0] == made[1]).mean() - 320 / 480) < 0.06


def test_quality_counts(spark, docs, plain, empty):
    want = Counter()
    for d, text in plain:
        text = text or ""
        ws = PLAIN.findall(text)
        grams = Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4))
        hit = {p for k in range(len(ws) - 4) if grams[tuple(ws[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines, again = set(), 0
        for line in text.split("\n"):
            if PLAIN.search(line):
                again += line in lines
                lines.add(line)
        failed = len(ws) < 10 or 100 * len(hit) > 20 * len(ws)
        want[d, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit), failed] += 1
    labels = spark.createDataFrame([(5, 1), (10, 0), (None, 1), (6, None)], "doc_id long, quality int")
    got = op6.judge(docs, labels)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(got.select(*names)) == want
    assert not got.filter("base_failed AND kept").count()
    assert op6.judge(empty, labels).count() == 0


def test_forest_finds_outliers():
    random_ = np.random.default_rng(0)
    x = np.r_[random_.normal(size=(2000, 3)), random_.normal(8, 1, size=(20, 3))]
    scores = op6.grow(x, trees=50).scores(x)
    assert scores[2000:].min() > np.quantile(scores[:2000], 0.99)


def test_toxicity(spark, docs, empty):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op8_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.9
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = op8.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), labels)
    scored = op8.score(docs, model)
    assert scored.count() == docs.count() and not scored.filter("score IS NULL OR score < 0 OR score > 1").count()
    assert scored.filter("predicted = 0").count() == op8.accept(docs, model).count()
    assert op8.fit(docs, labels.limit(0)) is None and op8.score(docs, None).filter("score = 0").count() == docs.count()
    assert op8.score(empty, model).count() == 0


def test_sharding(docs, plain, empty):
    for shards, frame, rows in ((3, docs, plain), (24, docs, plain)):
        got = op10.shard(frame, shards=shards).collect()
        want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < shards
    assert op10.shard(empty).count() == 0


def test_shards_are_even(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 300 AS int)) || id AS text", "'a' AS source")
    sums = [r[1] for r in op10.shard(rows).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 24 and max(sums) < 1.05 * min(sums)


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SMALL)
        assert left.columns == docs.columns, name
        assert 0 < left.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == []


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    sets = [rng.choice(9000, rng.integers(0, 3000), replace=False).astype(np.uint64) for _ in range(40)]
    hashes, text = np.concatenate(sets), np.repeat(np.arange(40), [len(x) for x in sets])
    bits = op5.parities(hashes, text, 40)
    for a in range(40):
        for b in range(40):
            apart = len(np.setxor1d(sets[a], sets[b]))
            assert np.bitwise_count(bits[a] ^ bits[b]).sum() <= apart
    assert op5.parities(hashes[:0], text[:0], 3).shape == (3, op5.PARITY // 64) and not op5.parities(hashes[:0], text[:0], 3).any()


def test_repeated_shingles_do_not_hide_a_link(spark):
    rows = []
    for k in range(12):
        shared = [f"s{k}x{i}" for i in range(180)]
        added = [f"a{k}x{i}" for i in range(36)]
        rows += [(2 * k, " ".join(shared)), (2 * k + 1, " ".join(shared + added * 20))]  # 176 of 216 distinct shingles
    got = op5.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {d: d // 2 * 2 for d, _ in rows}


def test_rejection_keeps_clean_rows():
    clean = np.linspace(0, 0.99, 1000)  # 495 of them are above 0.5
    cut = op8._reject_cut(clean)
    assert (clean > cut).mean() <= op8.MAX_LOSS
    assert op8._reject_cut(clean[:40] / 2) == 0.5 and op8._reject_cut(clean[:0]) == 1.0


def test_stages_keep_the_right_rows(spark):
    def rows(frame):
        return sorted((r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect())

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = dict(rows(docs))
    assert len(texts) == docs.count()

    model = op8.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = op8._scores([texts[d] for d in sorted(texts)], model, op8.Savings(model.ordinary, model.both))
    assert rows(stages["toxicity"](spark, docs, SMALL)) == [(d, texts[d]) for d, s in zip(sorted(texts), scores) if s <= model.reject]

    sets = {}
    for d, t in texts.items():
        ws = PLAIN.findall(t)
        sets[d] = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()
    label = {d: d for d in texts}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[a] != label[b] and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    assert rows(stages["near_dedup"](spark, docs, SMALL)) == [(d, texts[d]) for d in sorted(texts) if label[d] == d]

    least = {}
    for d in sorted(texts):
        ws = PLAIN.findall(texts[d])
        for k in range(len(ws) - 12):
            least.setdefault(tuple(ws[k : k + 13]), d)
    want = []
    for d in sorted(texts):
        ws = PLAIN.findall(texts[d])
        gone = {p for k in range(len(ws) - 12) if least[tuple(ws[k : k + 13])] < d for p in range(k, k + 13)}
        want.append((d, " ".join(w for k, w in enumerate(ws) if k not in gone)))
    assert [(d, " ".join(PLAIN.findall(t))) for d, t in rows(stages["substring_dedup"](spark, docs, SMALL))] == want

    judged = QUERIES["op1_decontamination"](spark, SMALL).filter("NOT contaminated")
    assert rows(stages["decontamination"](spark, docs, SMALL)) == [(d, texts[d]) for d in sorted(r["doc_id"] for r in judged.collect())]


def test_ordinal_grades(spark, docs, empty):
    pick = random.Random(3)
    made = []
    for k in range(600):
        y = k % 3
        made.append((k, " ".join(["low", "high"][pick.random() < (y + 0.1) / 2.2] + str(pick.randint(0, 9)) for _ in range(40)), y * 2))
    frame = spark.createDataFrame(made, "doc_id long, text string, quality int")
    model = op3.fit(frame, frame)
    assert model.grades.tolist() == [0, 2, 4] and (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in op3.score(frame, model).collect()}
    unseen = [(got[d]["grade"], y) for d, _, y in made if got[d]["held_out"]]
    assert len(unseen) > 60 and np.mean([g == y for g, y in unseen]) > 0.8
    p = op3.probabilities(pa.array([t for _, t, _ in made]), model)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert all(abs(got[d]["expected_grade"] - p[d] @ [0, 2, 4]) < 1e-9 and abs(got[d]["top_probability"] - p[d, 2]) < 1e-9 for d, _, _ in made)
    # A word beyond any bound on length still counts.
    long_text = "filler " * 30_000
    ends = op3.probabilities(pa.array([long_text, long_text + " ".join(f"high{k % 10}" for k in range(90_000))]), model)
    assert ends[1, 2] > ends[0, 2]
    scored = op3.score(docs, model)
    assert scored.count() == docs.count() and not scored.filter("expected_grade IS NULL OR top_probability IS NULL").count()
    assert op3.fit(frame, frame.limit(0)) is None and op3.score(docs, None).filter("grade IS NULL").count() == docs.count()
    assert op3.score(empty, model).count() == 0
    assert QUERIES["op3_quality_grades"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_one_of_each_knows_rows_by_id_and_words(spark):
    first, other, third = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(1, first), (1, other), (1, first.replace(" ", "\n")), (2, first), (None, other), (None, third), (None, third), (None, ""), (None, None)]
    left = op5.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r["doc_id"], " ".join((r["text"] or "").split())) for r in left)
    assert got == Counter({(1, first): 1, (1, other): 1, (None, third): 1, (None, ""): 2})
