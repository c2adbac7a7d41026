"""Models and placements against plain versions: forest, cumulative links, window lengths, k-d split."""

import random
import zlib

import numpy as np
import pyarrow as pa
import zstandard

from tidelattice.llm import op3_ordinal as op3, op6_quality as op6, op8_toxicity as op8, op10_sharding as op10


def search_depth(n):
    """Mean depth of an unsuccessful search among n values, by its recurrence over harmonic numbers."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def plain_forest(x, trees, per_tree, seed):
    """Trees grown by recursion, as functions from a row to its path length."""
    draw = np.random.default_rng(seed)
    size = min(per_tree, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))

    def build(rows, level):
        low, high = rows.min(0), rows.max(0)
        usable = np.flatnonzero(high > low)
        if level == depth or len(rows) <= 1 or not len(usable):
            return lambda v: level + search_depth(len(rows))
        f = int(draw.choice(usable))
        cut = draw.uniform(low[f], high[f])
        parts = rows[rows[:, f] < cut], rows[rows[:, f] >= cut]
        # The right half is grown first; an empty half is a leaf.
        right = build(parts[1], level + 1) if len(parts[1]) else lambda v: level + 1
        left = build(parts[0], level + 1) if len(parts[0]) else lambda v: level + 1
        return lambda v: right(v) if v[f] >= cut else left(v)

    grown = [build(x[draw.choice(len(x), size, replace=False)], 0) for _ in range(trees)]
    return lambda v: 2 ** (-np.mean([path(v) for path in grown]) / (search_depth(size) or 1.0))


def test_forest_equals_a_recursive_one():
    draw = np.random.default_rng(4)
    x = np.c_[draw.normal(size=(500, 3)), draw.integers(0, 3, 500), np.ones(500)]
    made, plain = op6.grow(x, trees=12, per_tree=64, seed=7), plain_forest(x, 12, 64, 7)
    rows = np.r_[x[:60], draw.normal(5, 3, size=(20, 5))]
    assert np.allclose(made.scores(rows), [plain(v) for v in rows])
    few = op6.grow(x[:1], trees=3, seed=1)
    assert np.allclose(few.scores(x[:4]), [plain_forest(x[:1], 3, 256, 1)(v) for v in x[:4]])


def test_calibrated_cut_keeps_good_rows(spark):
    """The cut is the one with the best balance among all that lose few enough good rows."""
    pick = random.Random(1)
    rows = [(k, False, min(0.999, max(0.0, pick.gauss(0.7 if k % 10 == 0 else 0.4, 0.1)))) for k in range(2000)]
    scored = spark.createDataFrame(rows, "doc_id long, base_failed boolean, anomaly double")
    labels = spark.createDataFrame([(k, int(k % 10 != 0)) for k in range(2000)], "doc_id long, quality int")
    cut = op6.calibrate(scored, labels, "quality")
    good, bad = ([a for k, _, a in rows if (k % 10 != 0) == g] for g in (True, False))
    best = -1.0
    for k in range(op6.BINS + 1):
        at = k / op6.BINS
        # Scores fall into bins, and a bin is rejected whole.
        lost = np.mean([np.floor(a * op6.BINS) >= k for a in good])
        caught = np.mean([np.floor(a * op6.BINS) >= k for a in bad])
        if lost <= op6.MAX_LOSS and caught - lost > best:
            best, want = caught - lost, at
    assert cut == want


def loss(w, edges, texts, y, weight, ridge):
    """The cumulative-link loss, text by text."""
    total = ridge / 2 * (w**2).sum()
    for row, grade, share in zip(texts, y, weight):
        score = sum(w[s] * v for s, v in row)
        high = 1.0 if grade == len(edges) else 1 / (1 + np.exp(-(edges[grade] - score)))
        low = 0.0 if grade == 0 else 1 / (1 + np.exp(-(edges[grade - 1] - score)))
        total -= share * np.log(high - low)
    return total


def test_cumulative_links_come_to_rest():
    """Of the fitted model's loss, by loops, no numeric slope is left, and probabilities follow from the thresholds."""
    pick = random.Random(2)
    y = [k % 3 for k in range(90)]
    made = [" ".join(pick.choice(["low", "mid", "high"][max(0, g - 1) : g + 1] + ["word"]) for _ in range(12)) for g in y]
    model = op3.train(made, y, {0: 0.5, 1: 0.3, 2: 0.2})
    rows = [[] for _ in y]
    for first, _, s in op3.slots(pa.array(made)):
        for t, slot, value in zip(s.text, s.slot, s.value):
            rows[first + t].append((slot, value))
    weight = np.array([{0: 0.5, 1: 0.3, 2: 0.2}[g] / 30 for g in y])
    at = lambda w, e: loss(w, e, rows, y, weight / weight.sum(), op3.RIDGE)
    here, step = at(model.weights, model.thresholds), 1e-4
    start = at(np.zeros(op3.SLOTS), np.log([1.0, 4.0]))
    assert here < 0.5 * start
    used = sorted({s for row in rows for s, _ in row})
    for slot in used[:12]:
        move = np.zeros(op3.SLOTS)
        move[slot] = step
        slope = (at(model.weights + move, model.thresholds) - at(model.weights - move, model.thresholds)) / (2 * step)
        assert abs(slope) < 0.02
    p = op3.probabilities(pa.array(made[:9]), model)
    for k in range(9):
        score = sum(model.weights[s] * v for s, v in rows[k])
        upto = [0.0, *(1 / (1 + np.exp(-(e - score))) for e in model.thresholds), 1.0]
        assert np.allclose(p[k], np.diff(upto))


def test_figures_are_of_window_lengths():
    """Each window compressed by itself, with either dictionary, and the figures taken by hand."""
    pick = random.Random(3)
    words = [f"word{k}" for k in range(300)]
    ordinary = " ".join(pick.choice(words) for _ in range(3000)).encode()
    both = ordinary + b" nasty vile wording here "
    measure = op8.Savings(ordinary, both)
    for text in (b"", b"one", " ".join(pick.choice([*words, "nasty", "vile", "wording"]) for _ in range(200)).encode()):
        windows, now = [], []
        for word in text.split():
            now.append(word)
            if sum(len(w) + 1 for w in now) >= op8.WINDOW_BYTES:
                windows.append(b" " + b" ".join(now) + b" ")
                now = []
        if now or not windows:
            windows.append(b" " + b" ".join(now) + b" ")
        saved = []
        for w in windows:
            sizes = []
            for content in (ordinary, both):
                raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(level=op8.LEVEL)
                made = zstandard.ZstdCompressor(level=op8.LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
                sizes.append(len(made.compress(w)))
            saved.append(sizes[0] - sizes[1])
        top = sorted(saved, reverse=True)
        want = [top[0], np.mean(top[:2]), np.mean(top[:4]), np.mean(saved), np.std(saved), np.log(len(saved)), *(np.mean([s >= q for s in saved]) for q in (3, 5, 8))]
        assert np.allclose(measure.figures(text), want)


def kd_split(rows, shards):
    """Shards of (size, check, id) rows by sorted lists: widest dimension, cut at the weighted quantile."""
    dims = range(len(rows[0][1]))
    low, high = ([f(r[1][d] for r in rows) for d in dims] for f in (min, max))
    scaled = [(size, [0 if high[d] == low[d] else int((v[d] - low[d]) / (high[d] - low[d]) * ((1 << op10.VALUE_BITS) - 1)) for d in dims], check, key) for size, v, check, key in rows]

    def place(part, first, n):
        if n == 1 or not part:
            return {r[3]: first for r in part}
        wide = max(dims, key=lambda d: max(r[1][d] for r in part) - min(r[1][d] for r in part))
        part = sorted(part, key=lambda r: (r[1][wide], r[2]))
        wanted, sums, at = sum(r[0] for r in part) * (n // 2) / n, 0, 0
        while at < len(part) and sums + part[at][0] / 2 < wanted:
            sums += part[at][0]
            at += 1
        return place(part[:at], first, n // 2) | place(part[at:], first + n // 2, n - n // 2)

    return place(scaled, 0, shards)


def test_shards_are_those_of_a_plain_split(spark):
    """Distinct texts without tolerance: the distributed search finds the cuts that sorted lists have, give or take a row."""
    pick = random.Random(12)
    kinds = ["abc ", "abc\n ", "a\u00e9\u4e2d ", "abcdefgh"]
    texts = ["".join(pick.choices(pick.choice(kinds), k=pick.randint(1, 400))) for _ in range(1500)]
    texts = list(dict.fromkeys(texts))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["shard"] for r in op10.shard(frame, shards=8, tolerance=0.0, group_tolerance=0.0).collect()}
    rows = []
    for k, t in enumerate(texts):
        held = len(t.encode())
        size, check = held + op10.OVERHEAD, zlib.crc32(t.encode())
        rows.append((size, (np.log2(size), np.log2(t.count("\n") + 1), t.count(" ") / size, (held - len(t)) / size), check, k))
    want = kd_split(rows, 8)
    assert sum(got[k] != want[k] for k in want) <= 8


def test_equal_texts_share_a_shard_and_dimensions_split(spark):
    """Copies stay together whatever their other columns say; NULL, empty and blank texts have defined dimensions."""
    texts = [None, "", " ", "\n\n", "same words here"] * 40 + [f"text {k} " + "w " * (k % 90) + "\n" * (k % 7) for k in range(2000)]
    rows = [(k, t, f"l{k % 5}") for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["shard"] for r in op10.shard(frame, shards=6).collect()}
    assert len(got) == len(rows) and set(got.values()) == set(range(6))
    by_text = {}
    for k, t, _ in rows:
        by_text.setdefault(t or "", set()).add(got[k])
    assert all(len(s) == 1 for s in by_text.values())
