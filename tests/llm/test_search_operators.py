"""Spelling variants, decontamination and lexical search against brute force."""

import random

import brute_search as brute
import pytest
from pyspark.sql import functions as F

from nimbusmart.llm import decontaminate, lexical, variants


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


# --- spelling variants ---------------------------------------------------------


def edited(r, word):
    at, kind = r.randrange(len(word)), r.randrange(3)
    letter = r.choice("abcdé")
    return word[:at] + (letter if kind else "") + word[at + (kind != 2) :]


def variant_rows(seed, every_word=3):
    r = random.Random(seed)
    base = ["".join(r.choices("abcdé", k=r.randint(5, 9))) for _ in range(60)] + ["aaaaaa", "aaaaab", "ababab", "÷÷÷×××"]
    long = ["".join(r.choices("acgt", k=n)) for n in (63, 64, 65, 66, 300)]
    words = base + long
    for w in base + long * 2:
        words += [edited(r, w), edited(r, edited(r, w))]
    words += [w + "a" for w in long] + [w[:-1] for w in long] + ["x" + w for w in long] + ["a" * n for n in range(60, 70)]
    rows = []
    for i in range(12):
        picked = [w.upper() if r.random() < 0.2 else w for w in r.choices(words, k=60) + words[i % 2 :: 2]]
        rows.append((i, " ".join(picked) + "1" + "\n".join(r.choices(words[:20], k=r.choice((0, 300))))))
    rows.append((49, "Chainaa " * 40 + "chainab " * 12 + "chainbb " * 4))  # a form of a form
    return rows + [(50, None), (51, ""), (52, "1 2 3, four"), (None, "rivers rivers rivers Riverz"), (None, None), rows[0], rows[0]]


def test_variants_equal_brute_force(spark):
    rows = variant_rows(1)
    got = {r["word"]: tuple(r)[1:] for r in variants.spelling_variants(frame(spark, rows)).collect()}
    assert got == brute.variants(rows)
    assert any(len(w) > 64 and v[3] for w, v in got.items()) and any(v[0] and v[0] != v[1] for v in got.values())


def test_near_words_of_repeated_letters(spark):
    words = ["a" * n for n in range(5, 12)] + ["b" + "a" * n for n in range(4, 10)] + ["a" * n + "b" for n in range(4, 10)] + ["abcab", "abcabc", "bcabc"]
    got = {tuple(r) for r in variants.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if brute.one_edit(a, b)}


def test_variants_of_nothing(spark, none):
    assert variants.spelling_variants(none).collect() == []
    assert variants.spelling_variants(frame(spark, [(1, None), (2, "short wds")])).collect() == []


def test_variants_take_extra_columns(docs, rows):
    got = {r["word"]: tuple(r)[1:] for r in variants.spelling_variants(docs.withColumn("word", F.lit("x"))).collect()}
    assert got == brute.variants(rows)


# --- decontamination -----------------------------------------------------------


def leak_tables(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choices("abcdefgß1", k=r.randint(1, 3))) for _ in range(40)] + ["w" * 50]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, prose(r.choice((9, 10, 11, 30, 60)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, " .,- "), (33, prose(3)), (34, "Ab b. AB"), (35, prose(1)), (None, prose(40)), (1, prose(20)), items[0], (36, items[2][1])]
    rows = []
    for i in range(60):
        parts = [prose(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            w = (r.choice(items)[1] or "").split()
            a = r.randrange(len(w) + 1)
            parts += [" ".join(w[a : a + r.choice((5, 9, 10, 12, 50))]), prose(r.randint(0, 5))]
        rows.append((i, r.choice((" ", "\n", "--")).join(parts).upper() if i % 3 else ", ".join(parts)))
    return rows + [(70, None), (71, ""), (72, "..."), (None, items[0][1]), rows[5], rows[5], (73, prose(60_000) + " " + items[3][1])], items


def found(df):
    rows = df.select("doc.doc_id", "hits.n_words", decontaminate.n_hit(F.col("hits.spans")), "hits.items").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("shard_words, piece_words", [(250_000, 4096), (150, 7)])
def test_leaks_equal_brute_force(spark, monkeypatch, shard_words, piece_words):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece_words)
    rows, items = leak_tables(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(1))
    got = found(decontaminate.find_contamination(frame(spark, rows), bench))
    assert got == sorted(brute.leaks(rows, items), key=repr)


def test_leaks_without_short_items(spark):
    rows, items = leak_tables(4)
    items = [x for x in items if len(brute.TERM.findall(brute.lower(x[1]))) >= 10]
    got = found(decontaminate.find_contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")))
    assert got == sorted(brute.leaks(rows, items), key=repr)


def test_leaks_of_empty_tables_and_clashing_columns(spark, docs, rows, none):
    bench = spark.createDataFrame([(1, rows[5][1][:300])], "item_id long, text string")
    assert decontaminate.find_contamination(none, bench).collect() == []
    assert all(n == 0 and items == [] for _, _, n, items in found(decontaminate.find_contamination(docs, bench.limit(0))))
    odd = docs.withColumns({"doc": F.lit("d"), "hits": F.lit(2), "a.b": F.lit("c")})
    out = decontaminate.decontaminate(odd, bench, max_percent=100)
    assert out.columns == odd.columns
    assert {(r["doc"], r["hits"], r["a.b"], r["source"]) for r in out.collect()} == {("d", 2, "c", "src")}


def test_spans_are_cut_and_covered_documents_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before it — {item.upper()}! And after, ünï."), (2, item), (3, "clean words only"), (4, None)]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(frame(spark, rows), bench, max_percent=80).collect()}
    assert got == {1: "Before it — ! And after, ünï.", 3: "clean words only", 4: None}


# --- lexical search ------------------------------------------------------------


def search_tables(seed, n=700):
    r = random.Random(seed)
    vocab = ["the", "of"] * 30 + [f"w{int(r.paretovariate(0.6))}" for _ in range(300)] + ["Ünï", "x" * 40]
    prose = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    rows = [(i, prose(int(r.paretovariate(0.9)) % 400 + 1)) for i in range(n)]
    rows += [(2000 + i, rows[7][1]) for i in range(30)] + [(3000, None), (3001, ""), (3002, "-.-"), (None, rows[8][1]), (None, rows[8][1]), rows[3], (4000, "the " * 70_000 + "of")]
    items = [(i, prose(r.choice((1, 3, 12, 40)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unheard"), (103, rows[7][1]), (None, rows[8][1]), (1, prose(5)), items[0], (104, "The OF the")]
    return rows, items


def top(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard_words, query_terms", [(4_000_000, 50_000), (3000, 60)])
def test_search_equals_brute_force(spark, monkeypatch, shard_words, query_terms):
    monkeypatch.setattr(lexical, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(lexical, "QUERY_TERMS", query_terms)
    rows, items = search_tables(5)
    index = lexical.build_index(frame(spark, rows, 1 if shard_words > 10_000 else 3))
    got = top(lexical.search(index, spark.createDataFrame(items, "item_id long, text string")))
    assert got == sorted(brute.search(rows, items), key=repr)


def test_search_of_nothing(spark, none):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    empty = lexical.build_index(none)
    assert lexical.search(empty, items).collect() == []
    index = lexical.build_index(frame(spark, [(1, "word"), (2, "other")]))
    assert lexical.search(index, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in lexical.search(index, items).collect()] == [(1, 1, 1)]


def test_search_takes_extra_columns(spark, docs, rows):
    items = [("a", rows[5][1][:200]), ("b", "two words")]
    bench = spark.createDataFrame(items, "item_id string, text string").withColumns({"rank": F.lit(1), "doc_id": F.lit(1)})
    got = top(lexical.search(lexical.build_index(docs.withColumn("term", F.lit("x"))), bench))
    assert got == sorted(brute.search(rows, items), key=repr)


def test_blocks_are_left_compressed():
    """A rare word settles the ten best; the blocks of a common one that can't
    reach them stay as they are."""
    import numpy as np

    m = np.full(100_000, 100, dtype=np.int64)
    m_of = lambda n: np.full(np.shape(n), 100, dtype=np.int64)
    term = np.zeros(50_000, dtype=np.int64)
    doc = np.arange(0, 100_000, 2)
    common = lexical._Encoded(term, doc, np.ones(50_000, dtype=np.int64), np.full(100_000, 7, dtype=np.int32))
    lists = {r[1]: r for b in common.rows(0, np.array([b"c"], dtype=object)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    _, _, df, _, blocks, postings = lists["c"]  # shard, term, df, words
    common = lexical._List(df, blocks, postings, m, m_of)
    assert len(common.last) == -(-50_000 // lexical.BLOCK)
    rare_docs = np.arange(10, 3000, 200)
    rare = lexical._Encoded(np.zeros(len(rare_docs), dtype=np.int64), rare_docs, np.ones(len(rare_docs), dtype=np.int64), np.full(100_000, 7, dtype=np.int32))
    row = next(iter(rare.rows(0, np.array([b"r"], dtype=object))))
    rare = lexical._List(len(rare_docs), None, row.column(5)[0].as_py(), m, m_of)
    top10 = lexical._Top(10)
    lexical._search_shard([(9000, rare), (10, common)], np.arange(100_000), top10)
    assert top10.id.tolist() == rare_docs[:10].tolist()
    assert len(common.decoded) <= len(rare_docs) and common.all is None
