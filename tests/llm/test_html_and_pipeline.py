import os
import shutil
import subprocess
import sys
import time
from functools import reduce
from operator import and_

import pytest
from pyspark.sql import functions as F

from nimbusmart.llm import dom, htmltext
from nimbusmart.llm.sample_pages import sample_pages

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def trees(spark):
    return htmltext.fit(spark)


# --- HTML ---


def text(page):
    return dom.blocks(page, [True] * len(page.tag))


def test_parser_reads_broken_markup():
    assert text(dom.parse("<p><b>one<br>two<p>three &amp; fo&uuml;r &#33;</p> tail")) == ["one two", "three & foür !", "tail"]
    assert text(dom.parse("a < b <!-- <p>no</p> --> c<script>if (a<b) '</p>'</script><style>p{}</style> d")) == ["a < b c", "d"]
    assert text(dom.parse("<p title='a > b'>x</p><p clas")) == ["x"]
    assert text(dom.parse("<ul><li>a<li>b<ul><li>c</ul></ul>&am")) == ["a", "b", "c", "&am"]
    assert text(dom.parse("<!DOCTYPE html><html><head><title>no</title></head><body>yes")) == ["yes"]
    assert text(dom.parse("<p>open <!-- never closed <p>x")) == ["open"]
    assert text(dom.parse("")) == [] and text(dom.parse("<")) == [] and text(dom.parse("<div")) == []


def test_letters_that_grow_when_lowered_lose_no_text():
    many = "\u0130" * 40
    for tag in ("script", "STYLE", "svg", "select", "Button", "iframe"):
        assert text(dom.parse(f"<p>{many}</p><{tag}>no</{tag.swapcase()}><p>one <b>two</b></p><p>three</p>")) == [many, "one two", "three"]
    assert text(dom.parse(f"<title>{many}</title><HEAD><meta></Head><body>{many}<p>one</p>")) == [many, "one"]


@pytest.mark.parametrize("soup", ["<div></x>", "<p><i></b>", "<button>x", "<b><div><i></b>", "<table><td></i><div>", "<select><li>", "<svg></p>"])
def test_a_megabyte_of_stray_tags_takes_seconds(soup):
    source = soup * (1_000_000 // len(soup))
    began = time.process_time()
    dom.parse(source)
    assert time.process_time() - began < 5


def test_decoding_has_no_contradictions_and_is_best():
    import itertools
    import random

    import numpy as np

    r = random.Random(4)
    for _ in range(60):
        n = r.randint(2, 8)
        page = dom.Page()
        for _ in range(n):
            page.tag.append("div")
            page.parent.append(r.randrange(len(page.tag) - 1))
            page.kinds.append(set())
            page.mark.append("")
        odds = np.array([r.uniform(-3, 3) for _ in page.tag])
        odds[0] = -3

        def allowed(states, page=page):
            return all((states[p], s) in {(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)} for s, p in zip(states[1:], page.parent[1:], strict=True))

        best = max(sum(o for o, s in zip(odds, states, strict=True) if s == 1) for states in itertools.product((0, 1, 2), repeat=len(odds)) if allowed(states))
        got = htmltext.decode(page, odds)
        assert abs(sum(odds[got]) - best) < 1e-9


def test_held_out_pages(trees):
    right = pieces = 0
    for source in sample_pages(200, seed=77):
        page = dom.parse(source)
        want = dom.blocks(page, htmltext.labels(page))
        got = htmltext.extract_page(source, trees).split("\n")
        right += len(set(want) & set(got))
        pieces += len(set(want) | set(got))
    assert right / pieces > 0.9


def test_parts_that_are_not_the_article_go(trees):
    words = "Some words of a paragraph that goes on for a while, as they do in articles, and then ends. " * 3
    page = f"""<html><head><title>T</title></head><body><header class="site-header"><a href="/">Logo</a></header>
    <nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><div class="cookie-notice"><p>We use cookies.</p></div>
    <article><h1>Headline</h1><p>{words}</p><div class="ad">Buy now</div><p>Second &quot;one&quot;<br>{words}</p>
    <section class="comments"><p>First! I liked this.</p><p>Me too, thanks.</p></section></article>
    <aside class="sidebar"><h3>Popular</h3><ul><li><a href="/c">Three</a></li></ul></aside><form><p>Search here</p></form><footer>&copy; Us</footer></body></html>"""
    body = " ".join(words.split())
    assert htmltext.extract_page(page, trees) == f"Headline\n{body}\nSecond \"one\" {body}"


def test_extract_odd_pages(spark):
    long = "<article>" + "".join(f"<p>Paragraph number {i} of a long article, with words.</p>" for i in range(4000)) + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<nav><a href=x>only</a></nav>", "x"), (4, "u", long, "x"), (4, "u", long, "x"), (None, "u", "plain", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract(df, 60).collect()
    assert len(got) == 6 and all(r.text is not None for r in got)
    assert {r.page_id: r.text for r in got}[1] == "" and {r.page_id: r.text for r in got}[2] == ""
    long_text = {r.page_id: r.text for r in got}[4]
    assert long_text.count("\n") == 3999 and long_text.endswith("Paragraph number 3999 of a long article, with words.")
    assert htmltext.extract(df.limit(0), 60).count() == 0


# --- pipeline ---


def brute_pipeline(rows):
    import public_tokenizers
    from brute import line_key, near

    from nimbusmart.llm import neardup, quality, secrets

    enc = secrets.tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [(i, t) for i, t in rows if brute_kept(t, quality)]
    holders = {}
    for i, t in rows:
        for line in t.split("\n"):
            if len(line_key(line)) >= 40:
                holders.setdefault(line_key(line), set()).add(i)
    rows = [(i, "\n".join(x for x in t.split("\n") if len(holders.get(line_key(x), ())) < 5 or max(holders[line_key(x)]) == i)) for i, t in rows]
    components = near(rows, neardup.SHINGLE_WORDS)
    rows = [(i, t) for i, t in rows if components[i][1] == i]
    out = []
    for i, t in rows:
        for a, _, b in sorted(secrets.spans_of(t, enc), reverse=True):
            t = t[:a] + "<secret>" + t[b:]
        out.append((i, len(t.split())))
    return sorted(out)


def brute_kept(text, quality):
    from brute import quality as counts

    n, chars, symbols, dup, _, failed = counts(text)
    if failed:
        return False
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    values = {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_lines": len(lines), "n_exclamations": text.count("!"),
        "n_stop_words": sum(w in quality.STOP_FORMS for w in text.split()), "n_ellipsis_lines": sum(x.endswith(("...", "…")) for x in lines),
        "n_bullet_lines": sum(x.startswith(("- ", "* ", "• ")) for x in lines),
    }
    return all(r.lowest <= values[r.numerator] / (values[r.denominator] or 1) <= r.highest for r in quality.RULES)


def test_pipeline_matches_brute_force(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.n_tokens) for r in got.collect()) == brute_pipeline(rows)


def test_stages_keep_columns_and_take_odd_rows(spark, rows, tmp_path):
    import corpus_pipeline

    data = [(i, t, "en", "s", len(t or ""), "extra") for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, key string")
    helpers = ["__key", "__id", "__lines", "__text", "__counts", "a.b", "row", "made", "n_lines", "keep", "node", "label"]
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in helpers})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        same = [F.col(f"`{c}`").eqNullSafe(F.concat(F.lit(c), F.col("doc_id").cast("string"))) for c in helpers]
        assert out.where(~reduce(and_, same)).count() == 0, name
        assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes, name
        assert out.where("n_chars <> length(text)").count() == 0
        out.write.parquet(f"{tmp_path}/{name}")
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()} == left


# --- the driver's entry ---


def test_every_operator_has_a_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_queries_match_their_sql(spark):
    import duckdb

    import __spark_entry__
    from helpers import canonical

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    for name in [n for n in sql if n.startswith("op")]:
        df, want = queries[name](spark, folder), con.execute(sql[name])
        columns = [d[0] for d in want.description]
        assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, want.fetchall()), name


def test_the_rest_imports_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q); assert 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": ""}, timeout=120)


def test_nothing_else_uses_the_subpackage():
    found = []
    for d, _, names in os.walk(os.path.join(ROOT, "nimbusmart")):
        for n in names:
            if n.endswith(".py") and f"{os.sep}llm" not in d:
                found += [n for line in open(os.path.join(d, n)) if "nimbusmart.llm" in line]
    assert found == []


def test_page_query_columns(spark):
    import __spark_entry__

    df = __spark_entry__.queries()["op8_html_extraction"](spark, "/root/testdata/sf0.001")
    assert df.columns == ["page_id", "url", "text", "n_chars"] and df.where(F.length("text") != F.col("n_chars")).count() == 0
    assert df.count() == 50
