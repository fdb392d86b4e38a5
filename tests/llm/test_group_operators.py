import random

import numpy as np
import pytest
from brute import near, near_rows
from pyspark.sql import functions as F

from nimbusmart.llm import licenses, neardup, packing, topk
from nimbusmart.llm.components import components
from nimbusmart.llm.runs import repeats

# --- runs ---


@pytest.mark.parametrize("partitions", [1, 2, 7, 30])
@pytest.mark.parametrize(("unit", "spare", "at_least"), [("doc", "doc", 5), ("place", "none", 2), ("place", "place", 2)])
def test_runs_match_brute_force(spark, partitions, unit, spare, at_least):
    r = random.Random(partitions)
    hot = [(0, 1, r.randint(0, 60), r.randint(0, 5)) for _ in range(400)]
    rows = hot + [(r.randint(0, 3), r.randint(0, 12), r.randint(0, 9), r.randint(0, 3)) for _ in range(300)]
    groups = {}
    for h, low, d, p in rows:
        groups.setdefault((h, low), []).append((d, p))
    want = []
    for places in groups.values():
        units = {d for d, _ in places} if unit == "doc" else set(places)
        if len(units) >= at_least:
            head = min(places)
            saved = {"doc": lambda x, h=head: x[0] == h[0], "place": lambda x, h=head: x == h, "none": lambda x: False}[spare]
            want += [x for x in places if not saved(x)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(rows, "high long, low long, doc long, pos long").repartition(5)
        assert sorted(map(tuple, repeats(df, at_least, unit, spare, "t").collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- components ---


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(200, 201), (201, 202), (202, 200)] + [(5, 5)]
    links += [(300 + i, 300 + j) for i in range(12) for j in range(12)]
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    want = {i: 100 for i in range(101, 141)} | {i: 7 for i in range(8, 60)} | {201: 200, 202: 200} | {300 + i: 300 for i in range(1, 12)}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- near-duplicates ---


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_match_brute_force(docs, rows, words):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, shingle_words=words).collect()}
    assert got == near(rows, words)


def test_near_duplicate_rows_repeats_nulls_and_empty(spark, docs, rows, none):
    out = neardup.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    df = spark.createDataFrame([(None, "a b c d e f g"), (None, "a b c d e f g"), (4, "a b c d e f g"), (5, None), (6, " ")], "doc_id long, text string")
    got = sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 3, None, True), (None, 3, None, True), (4, 3, 4, True), (5, 0, 5, True), (6, 0, 6, True)], key=repr)
    assert neardup.near_duplicates(none).count() == 0


def test_one_document_of_each_group_stays(docs, rows):
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {i for i, (_, c) in near(rows, neardup.SHINGLE_WORDS).items() if i == c}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want


def test_one_id_with_many_texts(spark):
    """Each text is a class of its own; the id links them, and nothing multiplies."""
    r = random.Random(8)
    prose = lambda n: " ".join("w%d" % r.randint(0, 10_000) for _ in range(n))
    rows = [(7, prose(30)) for _ in range(500)] + [(7, None), (7, "")]
    rows += [(9, rows[3][1] + " more"), (3, rows[4][1]), (20, prose(40)), (20, prose(40)), (21, prose(40))]
    rows += [(21, rows[-1][1])] * 5 + [(30, rows[-1][1] + " end"), (30, rows[-1][1] + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in neardup.near_duplicates(df).collect())
    assert got == sorted(near_rows(rows, neardup.SHINGLE_WORDS))
    assert {x.doc_id for x in neardup.drop_near_duplicates(df).collect()} == {3, 20, 21}


def test_words_with_equal_sums_of_powers_are_told_apart(spark):
    """Thue-Morse words collide under every multiplier modulo 2^64."""
    from nimbusmart.llm.hashing import word_hashes

    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        assert len(set(word_hashes(f"{word} {other}".encode())[0].tolist())) == 2
    df = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    assert {x.doc_id: x.component_id for x in neardup.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}


def test_regions_that_are_too_large_go_deeper_and_are_cut(spark, monkeypatch):
    """Small regions: every level and the blocks at the last one are used."""
    r = random.Random(3)
    base = ["w%d" % r.randint(0, 60) for _ in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(120)] = "x%d" % i
        texts.append((i, " ".join(words)))
    monkeypatch.setattr(neardup, "REGION", 8)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == near(texts, neardup.SHINGLE_WORDS)


def template_groups(groups: int, usual: float):
    """Pairs of near copies (similarity 0.82) of fillings of one template; in each
    place stands the usual word with that probability, or one of three others."""
    r, rows = random.Random(12), []
    for g in range(groups):
        filled = ["s%d_%d" % (i, 0 if r.random() < usual else r.randint(1, 3)) for i in range(200)]
        for d in (2 * g, 2 * g + 1):
            words = list(filled)
            for i in range(d % 2 * 10, d % 2 * 10 + 10):
                words[i] = "d%d_%d" % (d, i)
            r.shuffle(words)
            rows.append((d, " ".join(words)))
    return rows


def near_in_small_regions(spark, monkeypatch, rows):
    """Prefixes of 3 values only, and small regions: what longer prefixes can't
    part in a large table is one region here."""
    monkeypatch.setattr(neardup, "REGION", 4)
    monkeypatch.setattr(neardup, "DEPTHS", (3,))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df, shingle_words=1).collect()}


def test_many_small_groups_in_large_regions_are_all_found(spark, monkeypatch):
    """Similarity about 0.7 between groups, of which none dominates a region."""
    rows = template_groups(110, 0.96)
    assert near_in_small_regions(spark, monkeypatch, rows) == near(rows, 1)


def test_classes_without_a_candidate_in_cut_regions_stay_in(spark, monkeypatch):
    """Similarity about 0.5 between groups: hardly a class has a candidate but
    its partner, which the blocks of round one often part from it."""
    rows = template_groups(110, 0.85)
    assert near_in_small_regions(spark, monkeypatch, rows) == near(rows, 1)


def test_grid_holds_every_pair_whose_sizes_fit(spark, monkeypatch):
    monkeypatch.setattr(neardup, "REGION", 6)
    r = random.Random(5)
    sizes = [r.choice([1, 4, 5, 20, 25, 26, 31, 32, 40, 50, 500]) for _ in range(60)]
    region = spark.createDataFrame([(k, i, i, n) for k in (7, 8) for i, n in enumerate(sizes)], "key long, node long, label long, n_shingles long")
    cells = {}
    for x in neardup._grid(region, 80).collect():
        cells.setdefault(x.key, []).append((x.node, x.side))
    met = {}
    for members in cells.values():
        for a, side in members:
            for b, other in members:
                if a < b and (side != other or side == neardup.WHOLE):
                    met[a, b] = met.get((a, b), 0) + 1
    fits = {(a, b) for b in range(60) for a in range(b) if 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b])}
    assert fits <= set(met) and set(met.values()) == {2}  # once in each region
    assert not any(sizes[a] == 500 and sizes[b] < 100 for a, b in met)


def common_values(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


@pytest.mark.parametrize(("region", "batch"), [(4, 1), (4, 7), (6, 50), (1000, 13)])
def test_orders_keep_neighbours_together(region, batch):
    """Regions of a sorted partition: whole if they fit, cut where neighbours have
    the least in common if not; no pair of neighbours is parted."""
    r = random.Random(region + batch)
    depth = 2
    rows = [[t, *[min(r.randint(0, 3), r.randint(0, 3)) for _ in range(5)]] for t in (0, 1) for _ in range(150)]
    rows += [[2, 9, 9, 9, 9, 9]] * 40 + [[3, i, 0, 0, 0, 0] for i in range(9)]
    rows.sort()
    order, out = neardup._Order(region, depth), []
    for lo in range(0, len(rows), batch):
        order.feed(np.array(rows[lo : lo + batch], dtype=">u2"), np.arange(lo, min(lo + batch, len(rows))))
        out += order.out
        order.out.clear()
    order.close()
    blocks = {}
    for keys, nodes, cuts in out + order.out:
        for k, n, c in zip(keys.tolist(), nodes.tolist(), cuts.tolist(), strict=True):
            blocks.setdefault(k, []).append((n, c))
    together = {(a, b) for block in blocks.values() for a, _ in block for b, _ in block if b == a + 1}
    runs = [[0]]
    for i in range(1, len(rows)):
        if common_values(rows[i - 1], rows[i]) > depth:
            assert (i - 1, i) in together
            runs[-1].append(i)
        else:
            runs.append([i])
    assert all(len(block) <= region + 1 for block in blocks.values())
    cut = {n for block in blocks.values() for n, c in block if c}
    assert cut == {n for k, run in enumerate(runs) if len(run) > region or k in (0, len(runs) - 1) for n in run}
    whole = sorted([n for n, _ in block] for block in blocks.values() if not block[0][1])
    assert whole == [run for run in runs[1:-1] if 1 < len(run) <= region]
    for block in blocks.values():  # a cut block ends where the next row has the least in common with it
        end = block[-1][0]
        if block[0][1] and end + 1 < len(rows) and common_values(rows[end], rows[end + 1]) > depth:
            window = range(max(end - region // 2, block[0][0] + region // 2), end + 1)
            assert all(common_values(rows[i], rows[i + 1]) >= common_values(rows[end], rows[end + 1]) for i in window if i > block[0][0] + region // 2)


def test_trees_meet_similar_sets_almost_surely():
    columns = neardup.tree_columns()
    first = columns[:, : neardup.DEPTHS[0]]
    assert len(set(first.ravel().tolist())) == first.size  # independent first values
    assert (1 - 0.8 ** neardup.DEPTHS[0]) ** neardup.TREES < 1e-7
    assert all(len(set(c.tolist())) == len(c) for c in columns)


def test_forest_spans_what_is_linked():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(2, 20))
        m = r.integers(-1, 6, size=(n, n))
        m = np.minimum(m, m.T).astype(np.int16)
        np.fill_diagonal(m, -1)
        a, b = neardup._forest(m)

        def parts(links, n=n):
            root = list(range(n))
            for x, y in links:
                rx, ry = root[x], root[y]
                root = [rx if z == ry else z for z in root]
            return [[root[i] == root[j] for i in range(n)] for j in range(n)]

        assert parts(zip(a, b, strict=True)) == parts(zip(*np.nonzero(m >= 0), strict=True))
        assert all(m[x, y] >= 0 for x, y in zip(a, b, strict=True))


# --- exact top-k ---


def brute_topk(rows, k, step):
    usable = {}
    pool = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        v = [int(np.floor(float(np.float32(x)) * 1024)) for x in v]
        pool.append((i, v))
        if i % step == 0:
            usable[i] = min(v, usable.get(i, v))
    out = []
    for i, q in usable.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in pool if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def vectors(seed, n, width=12):
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(0, 0.3, width).tolist()) for i in range(n)]
    for i in range(30, 75):
        rows[i] = (i, rows[30][1])  # equal vectors
    rows += [(200, None), (201, [None] * width), (202, [float("nan")] * width), (203, [float("inf")] + [0.0] * (width - 1)), (None, rows[0][1])]
    return rows + [(204, []), (205, [1.0, -2.0]), (206, [0.0] * width), (3, rows[3][1]), (10, rows[11][1])]


@pytest.mark.parametrize("block", [8192, 16])
def test_topk_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", max(4, block // 8))
    monkeypatch.setattr(topk, "FIRST_STEP", 4)
    rows = vectors(1, 180)
    df = spark.createDataFrame([(i, v, "label", 1) for i, v in rows], "vec_id long, embedding array<float>, v string, id int").repartition(4)
    found = topk.vector_table(df)
    got = topk.exact_topk(found.where("id % 10 = 0"), found)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10, 10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_topk_rows_of_one_id_spread(spark, monkeypatch):
    """A third of the rows has one id: no block holds more than its share."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    r = random.Random(2)
    vector = lambda: [r.randint(-900, 900) / 1024 for _ in range(6)]
    rows = [(7, vector()) for _ in range(300)] + [(i, vector()) for i in range(100, 700)]
    vectors = topk.vector_table(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    sizes = [x["count"] for x in vectors.groupBy(topk._block(F.monotonically_increasing_id(), 15, 1)).count().collect()]
    assert max(sizes) < 120
    whole = [(i, [int(x * 1024 // 1) for x in v]) for i, v in rows]
    got = {(x.query_id, x.rank): (x.score, x.vec_id) for x in topk.exact_topk(vectors.where("id % 100 = 0"), vectors, 10).collect()}
    for q, v in whole:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:10]
            assert [got[q, k + 1] for k in range(10)] == [(-s, i) for s, i in best]


def test_topk_few_candidates_and_empty(spark):
    rows = [(100, [0.5, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])]
    found = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert sorted(map(tuple, topk.exact_topk(found.where("id = 100"), found).collect())) == brute_topk(rows, 10, 100)
    assert topk.exact_topk(found.limit(0), found.limit(0)).count() == 0


def test_topk_bound_stops_early():
    """Well separated clusters: most candidates are never scored."""
    r = np.random.default_rng(2)
    centres = r.normal(0, 1000, (8, 16))
    c = np.round(np.repeat(centres, 500, axis=0) + r.normal(0, 20, (4000, 16))).astype(np.int64)
    pivots = c[::500].astype(np.float64)
    q = c[5:6]
    scored = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                scored.append(len(key))
            return super().__getitem__(key)

    ids = np.arange(4000)
    found = topk._cell(np.array([5]), q, topk._distances(q, pivots), ids, c, topk._distances(c, pivots), 10)
    want = sorted((-int(x @ q[0]), i) for i, x in enumerate(c) if i != 5)[:10]
    assert [(-s, i) for i, s in zip(found[1], found[2], strict=True)] == want


# --- packing ---


def test_bounds_are_optimal():
    from itertools import combinations

    r = random.Random(6)
    for _ in range(30):
        values = sorted(r.sample(range(0, 60), r.randint(1, 9)))
        counts = [r.randint(1, 9) for _ in values]
        k = r.randint(1, 4)

        def padded(bounds, values=values, counts=counts):
            return sum(n * min(b for b in bounds if b >= v) for v, n in zip(values, counts, strict=True))

        best = min(padded([*c, values[-1]]) for m in range(k) for c in combinations(values[:-1], m))
        got = packing.optimal_bounds(np.array(values), np.array(counts), k)
        assert len(got) <= k and got[-1] == values[-1] and padded(got) == best
    assert packing.optimal_bounds(np.array([]), np.array([])) == []


def test_bounds_of_many_long_lengths_are_optimal():
    """Thousands of lengths, most of them far above 256, against all cuts of each step."""
    r = np.random.default_rng(3)
    values = np.unique((r.pareto(0.8, 3000) * 50).astype(np.int64) % 200_000)
    counts = r.integers(1, 1000, len(values))
    below = np.concatenate([[0], np.cumsum(counts)])
    cost = np.concatenate([[0.0], values * below[1:].astype(np.float64)])
    for k in range(2, 6):
        cost = np.array([0.0] + [(cost[:j] + values[j - 1] * (below[j] - below[:j]).astype(np.float64)).min() for j in range(1, len(values) + 1)])
        bounds = np.array(packing.optimal_bounds(values, counts, k))
        assert len(bounds) == k
        assert (bounds[np.searchsorted(bounds, values)] * counts).sum() == cost[-1]


def test_batches_keep_the_budget_and_every_document(docs, rows, none):
    out = [r.asDict() for r in packing.pack(docs, buckets=4, budget=512, shard=7).collect()]
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out) == sorted((i, len((t or "").split())) for i, t in rows)
    batches = {}
    for r in out:
        assert r["n_tokens"] <= r["bucket_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    last = {b: max(k for c, k in batches if c == b) for b, _ in batches}
    for (bucket, batch), members in batches.items():
        bound = members[0]["bucket_tokens"]
        size = max(1, 512 // max(bound, 1))
        assert sorted(m["place"] for m in members) == list(range(len(members)))
        assert len(members) == size if batch < last[bucket] else 1 <= len(members) <= size
        assert len(members) == 1 or len(members) * bound <= 512
    assert len({r["bucket"] for r in out}) <= 4
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("ids", [[None], [5], [None, 5, 6]])
def test_rows_without_ids_and_of_one_id_spread(spark, ids):
    """No shard holds many more rows than it should, and no place is given twice."""
    n = 4000
    df = spark.createDataFrame([(ids[i % len(ids)], "w " * (i % 40)) for i in range(n)], "doc_id long, text string").repartition(5)
    out = packing.pack(df, shard=100, budget=500)
    rows = out.collect()
    assert len(rows) == n and len({(r.bucket, r.batch, r.place) for r in rows}) == n
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), members in batches.items():
        assert len(members) * max(members[0].bucket_tokens, 1) <= 500
        assert sorted(r.place for r in members) == list(range(len(members)))


def test_bounds_are_lengths_that_occur(spark):
    r = random.Random(10)
    lengths = [r.choice([3, 200, 257, 259, 700, 1001, 1003, 5001, 5003, 9999]) for _ in range(80)]
    df = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    for buckets in (1, 3, 16):
        longest = {}
        out = packing.pack(df, buckets=buckets).collect()
        for x in out:
            longest[x.bucket] = max(longest.get(x.bucket, 0), x.n_tokens)
        assert all(x.bucket_tokens == longest[x.bucket] for x in out)
        values, counts = np.unique(lengths, return_counts=True)
        best = packing.optimal_bounds(values, counts, buckets)
        least = sum(min(b for b in best if b >= n) for n in lengths)
        assert least <= sum(x.bucket_tokens for x in out) <= least * (1 + 1 / 128)


# --- license scans ---


def license_brute(text, percent=80):
    import math
    import re

    def grams(s):
        w = re.findall("[a-z0-9]+", (s or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    g, out = grams(text), {}
    for name, t in licenses.TEMPLATES:
        want = set(grams(t))
        half = 2 ** math.ceil(math.log2(len(want)))
        counts = [(len(want & set(g[s : s + 2 * half])), -s) for s in range(0, max(len(g), 1), half)]
        n, back = max(counts)
        if n * 100 >= percent * len(want):
            out[name] = (n, len(want), -back)
    return out


def test_license_scan_matches_brute_force(spark, docs):
    r = random.Random(8)
    filler = lambda n: " ".join("w%d" % r.randint(0, 50) for _ in range(n))
    texts = [None, "", "MIT License", filler(300)]
    for _, t in licenses.TEMPLATES:
        w = t.split()
        texts += [t, t.upper(), filler(r.randint(0, 90)) + " " + t + " " + filler(r.randint(0, 90)), " ".join(w[: len(w) // 2]), " ".join(w[: -max(1, len(w) // 10)])]
        k = r.randrange(len(w))
        texts.append(filler(20) + " " + " ".join([*w[:k], "changed", *w[k:]]))
    texts.append(" ".join(t for _, t in licenses.TEMPLATES) + " " + filler(4000) + " " + licenses.TEMPLATES[1][1])
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, license string, n int")
    got = {}
    for x in licenses.license_scan(df).collect():
        got.setdefault(x.doc_id, {})[x.license] = (x.n_found, x.n_shingles, x.first_word)
    assert got == {i: b for i, t in enumerate(texts) if (b := license_brute(t))}
    assert licenses.license_scan(df.limit(0)).count() == 0
    assert licenses.license_scan(docs).columns == ["doc_id", "license", "n_found", "n_shingles", "first_word"]


def test_licenses_are_told_apart(spark):
    header = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    clauses = "Redistributions in binary form must reproduce the above copyright notice in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
    third = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
    texts = {
        header.format("", 2): {"GPL-2.0-header"}, header.format("", 3): {"GPL-3.0-header"}, header.format("Lesser ", "2.1"): {"LGPL-2.1-header"},
        header.format("Lesser ", 3): {"LGPL-3.0-header"}, header.format("Affero ", 3): {"AGPL-3.0-header"},
        clauses.format(""): {"BSD-2-Clause"}, clauses.format(third): {"BSD-3-Clause"},
        "This project is licensed under the MIT License.": {"MIT-licensed"}, "Licensed under CC BY-SA 4.0": {"CC-BY-SA-4.0-short"}, "Licensed under CC BY 4.0": {"CC-BY-4.0-short"},
        "This text is licensed under a Creative Commons Attribution 4.0 International License": {"CC-BY-4.0-notice"},
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for x in licenses.license_scan(df).collect():
        got.setdefault(x.doc_id, set()).add(x.license)
    assert got == dict(enumerate(texts.values()))
    names = [k for k, _ in licenses.TEMPLATES]
    assert len(set(names)) == len(names) and {"EPL-2.0", "CC0-1.0", "Unlicense", "MIT-body", "GPL-2.0-body"} <= set(names)


def test_license_bands_and_bounds(spark):
    least = 0.8 / 4.2
    assert 1 - (1 - least) ** licenses.n_bands() >= 1 - 1e-6
    with pytest.raises(ValueError):
        licenses.license_scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"), [("short", "All rights reserved")])
