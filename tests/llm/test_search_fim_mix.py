"""Lexical search, fill-in-the-middle and source mixing against brute force, on hard little tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelattice.llm import op11_search as op11, op12_fim as op12, op13_mixing as op13
from tidelattice.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Extra columns with the names that the operators use inside.
SCHEMA = "doc_id long, text string, source string, item long, size long, number int, _size long, rate double, output string, n long"


def rows():
    pick = random.Random(9)
    words = ["über", "le", "AND", "of", "x", "don't", "#%$", "12", "ñandú", "…", "a_b", "the", "<", "𝒳y"]

    def some(n):
        return " ".join(pick.choice(words) for _ in range(n))

    texts = [None, "", "  \n\t ", "#!-", "le", "LE le Le", some(60), some(60), some(40_000), "a<P>b", "<S>", "x<M", "<P", "ends <", "𝒳𝒳𝒳ü", "\x00z\x00", some(7)]
    out = [(i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    out += [out[6], out[6], (6, "another text of six", "s1"), (None, some(12), "s2"), (None, some(12), None), (-3, "x of x", None)]
    return [(*r, 1, 2, 3, 4, 5.0, "o", 6) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ranking(docs, items, top):
    """Every item scored against every document, by the contract's formula."""
    terms = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    terms = [(d, c, sum(c.values())) for d, c in terms if c]
    big_n, big_l = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(TERM.findall(lowered(text)))
    out = Counter()
    for item, query in asked.items():
        scored = []
        for d, c, n in terms:
            m = 100 - 75 + (75 * n * big_n) // big_l
            score = sum(q * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in query.items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, None if none else d, -score] += 1
    return out


def test_search(spark, docs, empty):
    plain = [r[:2] for r in rows()]
    items = [(1, "LE über"), (2, None), (3, "#"), (1, "x x x"), (None, "ñandú of"), (5, "never seen"), (6, plain[8][1]), (7, "𝒳y 12"), (8, "le")]
    bench = spark.createDataFrame([(*i, 1, "s", 0) for i in items], "item_id long, text string, doc_id long, term string, block int")
    for options in ({}, {"top": 2}, {"block_bytes": 40}):
        got = Counter(tuple(r) for r in op11.search(docs, bench, **options).collect())
        assert got == ranking(plain, items, options.get("top", 10)), options
    assert op11.search(empty, bench).count() == 0 and op11.search(docs, bench.limit(0)).count() == 0


def test_search_of_many_hits_at_once(monkeypatch):
    monkeypatch.setattr(op11, "HITS_AT_ONCE", 7)
    found = op11.automaton("test", ["a", "ab", "b"])
    column = pa.array(["a ab a b", None, "", "b" + " a" * 30, "abb"])
    got = [tuple(x.tolist() for x in rest) for _, *rest in op11.matches(column, found, 3)]
    assert got == [([4, 0, 0, 31, 1], [0, 0, 0, 3, 3], [0, 1, 2, 0, 2], [2, 1, 1, 30, 1])]


def test_fill_in_middle(docs, empty):
    want = Counter()
    for d, text, *_ in rows():
        text = text or ""
        n, h = len(text), hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
        if not n or re.search("<[PSM]>", text) or h3 % 100 >= 90:
            want[d, n, "plain", None, None, text, text] += 1
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        form = "spm" if h4 % 100 < 20 else "psm"
        output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
        want[d, n, form, a, b - a, output, text] += 1
    made = op12.transform(docs)
    assert Counter(tuple(r) for r in op12.restore(made).collect()) == want
    # Restoring needs the output and the form only.
    back = op12.restore(made.select("output", "form")).select("restored").collect()
    assert Counter(r[0] for r in back) == Counter(r[1] or "" for r in rows())
    assert op12.restore(op12.transform(empty)).count() == 0


def test_rotations_restore_any_text():
    pick = random.Random(2)
    for k in range(3000):
        text = "".join(pick.choice("<PSM>aü𝒳") for _ in range(pick.randint(0, 12))).encode()
        n, form, _, _, output = op12.transformed(text, k)
        assert n == len(text.decode()) and op12.restored(output, form) == text
        assert form == "plain" or len(output) == len(text) + 9


def reshared(sizes, weights, total, most):
    """Targets by resharing the excess again and again."""
    target, below = dict.fromkeys(sizes, 0.0), set(sizes)
    while below:
        level = (total - sum(target[s] for s in sizes if s not in below)) / sum(weights[s] for s in below)
        for s in below:
            target[s] = level * weights[s]
        full = {s for s in below if target[s] > most * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = most * sizes[s]
        below -= full
    return target


def test_mix_of_hard_rows(docs, empty):
    got = op13.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in rows())
    assert all(r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2 for r in got)
    assert op13.mix(empty).count() == 0
    assert op13.mix(docs.filter("text IS NULL")).collect()[0]["taken"] == 0


def test_mix_meets_targets(spark):
    pick = random.Random(4)
    made = []
    for d in range(6000):
        source = pick.choice(["ä", "Z", "a", "b", "c", None]) if d % 3 else "hot"
        made.append((d, "w " * (7 if d % 4 == 0 and source == "hot" else max(1, int(pick.lognormvariate(4, 1)))), source))
    frame = spark.createDataFrame(made, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in op13.mix(frame).collect()}
    assert len(got) == len(made)
    sizes, members = Counter(), defaultdict(list)
    for d, text, source in made:
        sizes[source] += len(text) // 2
        members[source].append((d, len(text) // 2))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target = reshared(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for source, mine in members.items():
        assert all(got[d]["source_size"] == sizes[source] and abs(got[d]["target"] - target[source]) < 1e-6 for d, _ in mine)
        taken = sum(got[d]["taken"] for d, _ in mine)
        assert abs(taken - target[source]) <= 200 and abs(taken - target[source]) < 0.01 * target[source]
        # The rates are those of the convex dual, solved by bisection.
        x = np.array([s for _, s in mine], float)
        low, high = -50.0, 50.0
        for _ in range(200):
            tilt = (low + high) / 2
            low, high = (tilt, high) if (x * np.minimum(2, np.exp(np.minimum(tilt * x, 700)))).sum() < target[source] else (low, tilt)
        want = np.minimum(2, np.exp(np.minimum(tilt * x, 700)))
        assert np.abs(want - [got[d]["rate"] for d, _ in mine]).max() < 1e-3
        # Copies follow the rates in order of size: sums of both stay together.
        order_ = np.argsort(x, kind="stable")
        copies = np.array([got[d]["copies"] for d, _ in mine])
        assert abs(copies.sum() - want.sum()) < 0.05 * len(mine)
        assert np.abs(np.cumsum(copies[order_]) - np.cumsum(want[order_])).max() < 0.1 * len(mine)
    again = {r["doc_id"]: r["copies"] for r in op13.mix(frame.repartition(7)).collect()}
    assert again == {d: r["copies"] for d, r in got.items()}


def test_mix_splits_a_hot_cell(spark):
    frame = spark.range(9000).selectExpr("id AS doc_id", "repeat('w ', 5) AS text", "if(id < 3000, 'a', 'b') AS source")
    got = op13.mix(frame)
    sums = {r["size_"]: (r["taken"], r["target"]) for r in got.groupBy(F.col("source_size").alias("size_")).agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    # Weights 3 and 1 of 67,500 words: the smaller source stops at twice its 15,000 words.
    assert sums[15_000] == (30_000, 30_000.0) and abs(sums[30_000][0] - 37_500) <= 5 and sums[30_000][1] == 37_500.0


def test_mix_of_the_small_table(spark):
    got = QUERIES["op13_source_mix"](spark, SMALL).toPandas()
    assert len(got) == spark.read.parquet(f"{SMALL}/documents.parquet").count() and (got.taken <= 2 * got["size"]).all()
