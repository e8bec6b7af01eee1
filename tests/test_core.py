"""Core operators on small fixtures with edge rows."""

import gzip
import io
import json
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake.functions import quality as Q
from paperlake.functions import text as N
from paperlake.operators import chunking, cleaning, dedup, html, pages, parsing, retrieval, retriever, sinks, sparse, svd, tex, tfidf, upsert
from paperlake.sources import files


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "f, value, want",
    [
        (N.squeeze, " a  b\n\tc ", "a b c"),
        (N.squeeze, None, None),
        (N.lines_normal, "﻿a\r\nb­\n\n\n\nﬁn\x00", "a\nb\n\nfin"),
        (N.title_key, "A  Robust-Planner!", "a robust planner"),
        (N.heading_key, "## 2.1 Related Work:", "related work"),
        (N.heading_key, "Introduction", "introduction"),
        (N.base_id, "1021.07919v12", "1021.07919"),
        (N.version, "1021.07919v12", 12),
        (N.version, "30209458034", 0),
        (N.unquoted, ' "a b" ', "a b"),
        (N.unquoted, '"a b', '"a b'),
        (N.caption_text, "Figure 3: the arm", "the arm"),
        (N.caption_text, "Figure shows the arm", "Figure shows the arm"),
        (N.dehyphenated, "mem- ory", "memory"),
        (N.extension, "https://x.example/a.PDF?x=1", "pdf"),
        (Q.single_letter_run, "a b c word d", 3),
        (Q.split_words, "X shows it", 1),
        (Q.broken_tokens, "rm/er g_al baaad fine", 3),
        (Q.broken_tokens, "(lander/rover.) rhythmszzq PLLLNL _ 1_2 a_1", 4),
        (Q.single_letter_run, "(a) 1b c- word é d", 3),
        (Q.single_letters, "a I b (c) 9x word", 3),
        (Q.weird_ratio, "ab|*", 0.5),
        (N.paper_normal, "e\u0301 \u00a0x\x00 ", "é x"),
        (N.report_normal, "a ,b ( c )\r\n\n\n\nﬁn", "a,b (c)\n\nfin"),
        (N.parser_normal, "a\fb\n\n\n\n\nc", "a\n\nb\n\n\nc"),
        (N.unresidued, "x ¶ © 2012 IEEE. Project page: https://a.b Thanks: all", "x all"),
        (N.clean_line, " ﬁ\u00adn  al ", "fin al"),
        (N.unaccented, "Café ﬁ", "Cafe fi"),
        (N.nfc, None, None),
        (Q.alpha_ratio, "", 0.0),
        (Q.weird_ratio, "", 1.0),
    ],
)
def test_text_columns(spark, f, value, want):
    assert one(spark, f, value) == want


def test_gate_thresholds(spark):
    good = "The rover planner kept its map and the crew saw no fault during the whole long day of tests. " * 3
    rows = [(1, good), (2, good[:150]), (3, ""), (4, good + " �"), (5, "x y z " + good), (6, None)]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, "id int, t string").transform(lambda d: Q.gated(d, "t")).select("id", F.struct("accepted", "score", "reasons")).collect()}
    assert got[1].accepted and got[1].score == 1.0
    assert got[2].reasons[0] == "too_short_chars"
    assert "weird_signs" in got[3].reasons and not got[3].accepted
    assert "replacement_chars" in got[4].reasons
    assert "letter_run" in got[5].reasons


def test_duplicates_and_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, h string")
    got = {r.id: r.duplicate_of for r in dedup.duplicate_of(df, "h", "id").collect()}
    assert got == {1: None, 2: 1, 3: None, 4: None, 5: None}
    seq = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, None), (1, 4, None), (1, 5, "x")], "d int, p int, v string")
    assert [r.p for r in dedup.without_repeats(seq, ["d"], ["p"], "v").orderBy("p").collect()] == [1, 3, 5]
    assert dedup.duplicate_of(df.limit(0), "h", "id").count() == 0


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "s", "a", "one"), (7, "s", "b", "two")], "id bigint, source string, source_id string, title string")
    new = spark.createDataFrame([("s", "b", "TWO"), ("s", "c", "three"), ("r", "z", "four")], "source string, source_id string, title string")
    got = upsert.upsert(old, new, ["source", "source_id"])
    rows = {(r.source, r.source_id): (r.id, r.title, r.action) for r in got.collect()}
    assert rows == {("s", "a"): (1, "one", "kept"), ("s", "b"): (7, "TWO", "updated"), ("r", "z"): (8, "four", "inserted"), ("s", "c"): (9, "three", "inserted")}
    again = upsert.upsert(got.drop("action"), new, ["source", "source_id"])
    assert {r.action for r in again.collect()} == {"kept", "updated"} and again.count() == 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), max_size=12))
def test_pack_keeps_every_word(sizes):
    n = 0
    pieces = []
    for s in sizes:
        words = [f"w{n + i}" for i in range(s)]
        n += s
        pieces += [words[i : i + chunking.MOST] for i in range(0, s, chunking.MOST)]
    chunks = chunking.pack(pieces)
    assert all(len(c) <= chunking.MOST for c in chunks)
    seen = [w for c in chunks for w in c]
    assert list(dict.fromkeys(seen)) == [f"w{i}" for i in range(n)]


def test_units_and_sections(spark):
    assert [len(u) for u in chunking.units("a " * 421)] == [420, 1]
    df = spark.createDataFrame([(1, "before\n# One\nbody\n#######no\n# Title\nx\n## Two\n\n")], "id int, t string")
    got = [(r.heading, r.body) for r in chunking.sections(df, "id", "t").orderBy("section").collect()]
    assert got == [("Document Body", "before"), ("One", "body\n#######no")]
    assert [r.part for r in chunking.hard_split(spark.createDataFrame([(1, "w " * 841), (2, None), (3, " ")], "id int, t string"), "id", "t").orderBy("part").collect()] == [0, 1, 2]


def test_html_blocks_and_cleaning(spark):
    source = "<nav>menu</nav><script>var a='</p>';</script><h1>Intro</h1><p>A&amp;B planner text<p>A&amp;B planner text</p><ul><li>one item<li>two items</ul><h2>References</h2><p>[1] Gone away</p><h2>After it</h2><p>Still here today</p>"
    blocks = html.html_blocks(spark.createDataFrame([(1, source), (2, None)], "id bigint, t string"), "id", "t").cache()
    assert [(r.type, r.text) for r in blocks.orderBy("pos").collect()][:3] == [("heading", "Intro"), ("paragraph", "A&B planner text"), ("list_item", "one item")]
    skip = cleaning.clean(blocks, "id", False).first().clean_content
    stop = cleaning.clean(blocks, "id", True).first().clean_content
    assert "Gone" not in skip and "Still here" in skip and "Still here" not in stop and skip.startswith("## Intro")


def test_search_ties_nulls_and_metrics(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [2.0, 0.0])], "row_id bigint, v array<double>")
    q = rows.where("row_id = 1").select(F.col("row_id").alias("query_id"), "v")
    assert [(r.row_id, r.score) for r in retrieval.top_k(q, rows, 2).orderBy("place").collect()] == [(2, 1.0), (6, 1.0)]
    assert retrieval.top_k(q.limit(0), rows, 2).count() == 0
    hits = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (2, 1, 0)], "query_id bigint, rank int, rel int")
    totals = spark.createDataFrame([(1, 2), (2, 0)], "query_id bigint, relevant int")
    m = {r.query_id: r for r in retrieval.metrics(hits, spark.createDataFrame([(1, 2)], "query_id bigint, first int"), totals, 2).collect()}
    assert m[1].precision == 0.5 and m[1].recall == 0.5 and m[1].rr == 0.5 and round(m[1].ndcg, 4) == 0.3869
    assert m[2].recall == 0 and m[2].rr == 0 and m[2].ndcg == 0


def test_tfidf_rows_have_unit_length(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["red rover", "red arm", "blue arm", "", None, "red red rover"])], "id bigint, t string")
    w = tfidf.weights(docs, "id", "t")
    assert all(abs(r[1] - 1) < 1e-9 for r in w.groupBy("id").agg(F.sum(F.col("w") ** 2)).collect())


def test_sources(spark, tmp_path):
    (tmp_path / "sel.json").write_text(json.dumps({"selection_version": "1", "source": "s", "selected_documents": {"a": ["1v1", "2"], "b": ["1v2", " "]}}))
    sel = files.selection(spark, str(tmp_path / "sel.json"))
    assert {(r.fault, r.source_id.strip()) for r in files.selection_faults(sel).collect()} == {("repeated", "1"), ("blank", "")}
    for i in ("1v3", "2", "3v1", "3v2"):
        (tmp_path / "papers/a" / i).mkdir(parents=True)
        (tmp_path / "papers/a" / i / "paper.tex").write_text(r"\documentclass{a}")
    f = files.paper_files(spark, str(tmp_path / "papers"), "paper.tex")
    want = spark.createDataFrame([("a", "1v1"), ("a", "2"), ("a", "3v9"), ("a", "4")], "topic_axis string, source_id string")
    assert {r.source_id: r.state for r in files.lookup(want, f).collect()} == {"1v1": "base", "2": "exact", "3v9": "ambiguous", "4": "missing"}
    assert files.decoded(f, "tex").where("text like '%documentclass%'").count() == 4
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as o:
        o.writestr("word/document.xml", '<w:d xmlns:w="x"><w:p><w:t>a</w:t><w:tab/><w:t>b</w:t></w:p><w:p><w:t>c</w:t></w:p></w:d>')
    assert files.docx_text(z.getvalue()) == "a\tb\nc" and files.docx_text(b"no") is None and files.docx_text(None) is None
    assert files.tex_main(gzip.compress(b"x")) == "x" and files.tex_main(b"") is None


def test_saved_pages(spark, tmp_path):
    from paperlake.sources.api import SavedPages

    (tmp_path / "q1").mkdir()
    for k in range(2):
        (tmp_path / "q1" / f"{k}.json").write_text(json.dumps({"entries": [{"id": f"{k}", "title": " a  b "}]}))
    spark.dataSource.register(SavedPages)
    got = spark.read.format("saved_pages").option("path", str(tmp_path)).load().orderBy("rank").collect()
    assert [(r.rank, r.source_id, r.title, r.published) for r in got] == [(1, "0", "a b", None), (2, "1", "a b", None)]


def test_publish_only_what_passes(spark, tmp_path):
    path = str(tmp_path / "t")
    ok = spark.range(3)
    assert sinks.publish(spark, ok, path, {"negative": lambda d: d.where("id < 0")}) == {"negative": 0}
    assert sinks.publish(spark, spark.range(-1, 1), path, {"negative": lambda d: d.where("id < 0")}) == {"negative": 1}
    assert spark.read.parquet(path).count() == 3


def test_stream(spark, tmp_path):
    from paperlake.streaming.ingest import SCHEMA, ingest

    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("s", "1", "t", "a  b", t), ("s", "2", "t", "a b", t), ("s", "3", "t", "c", t)], SCHEMA).write.parquet(src)
    ingest(spark, src, out, cp).awaitTermination()
    assert sorted(r.clean_content for r in spark.read.parquet(out).collect()) == ["a b", "c"]
    spark.createDataFrame([("s", "4", "t", "c", t)], SCHEMA).write.mode("append").parquet(src)
    ingest(spark, src, out, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_new_ids_are_dense_for_many_partitions(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 32)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        key = F.concat(F.lit("k"), F.col("id")).alias("k")
        got = upsert.upsert(spark.range(1000).select("id", key, F.lit("x").alias("v")), spark.range(900, 101_000).select(key, F.lit("y").alias("v")), ["k"])
        r = got.agg(F.countDistinct("id"), F.min("id"), F.max("id"), F.count("*")).first()
        assert tuple(r) == (101_000, 0, 100_999, 101_000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_search_in_many_blocks_equals_one(spark, monkeypatch):
    import random

    r = random.Random(1)
    rows = spark.createDataFrame([(i, [r.choice([-1.0, 0.0, 1.0]) for _ in range(4)], i % 3) for i in range(90)] + [(500, None, 1), (501, [0.0] * 4, 1)], "row_id bigint, v array<double>, label bigint")
    q = rows.where("row_id % 2 = 0").withColumnRenamed("row_id", "query_id")
    t = rows.select("row_id", F.array(F.lit(1).cast("bigint"), (F.col("row_id") % 5 + 2)).alias("terms"), F.array(F.lit(0.6), F.lit(0.8)).alias("ws"))
    tq = t.where("row_id % 3 = 0").withColumnRenamed("row_id", "query_id")
    one_block = [sorted(map(tuple, x.collect())) for x in (retrieval.top_k(q, rows, 5), retrieval.first_relevant(q, rows), sparse.top_k(tq, t, 4))]
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 7)
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 11)
    many = [sorted(map(tuple, x.collect())) for x in (retrieval.top_k(q, rows, 5), retrieval.first_relevant(q, rows), sparse.top_k(tq, t, 4))]
    assert one_block == many and len(one_block[0]) > 100


HTML = """<html><head><meta name="citation_title" content=" A  Title "><title>Page</title></head><body><nav>menu</nav><article class="ltx_document"><h1 class="ltx_title_document">A Title<span class="ltx_note">Thanks: x</span></h1>
<div class="ltx_abstract"><h6>Abstract</h6>We test <math alttext="x^2"><mi>x</mi></math> here.</div><section><h2>Intro</h2><p>Speed is <math><mi>v</mi><annotation encoding="application/x-tex">v_1</annotation></math> now.
<p>Second one.<ul><li>first item<li><p>inner text</p></ul><table class="ltx_equationgroup"><tr><td><table class="ltx_equation"><tr><td><math alttext="a=b"></math></td></tr></table></td></tr></table>
<figure><figcaption>Figure 1: the arm <p>moves</p></figcaption></figure><h2>Contents</h2><section class="ltx_bibliography"><ul><li>[1] A book</li></ul></section></section></article></body></html>"""


def test_html_front_matter_and_blocks(spark):
    t = html.tree(HTML)
    assert html.title(t) == "A Title" and html.abstract(t) == "We test x^2 here."
    got = html.blocks(HTML)
    assert got == [("heading", 2, "Intro", False), ("paragraph", 0, "Speed is v_1 now.", False), ("paragraph", 0, "Second one.", False), ("list_item", 0, "first item", False), ("paragraph", 0, "inner text", False),
                   ("equation", 0, "a=b", False), ("figure_caption", 0, "Figure 1: the arm moves", False), ("list_item", 0, "[1] A book", True)]
    assert html.blocks(None) == [] and html.blocks("plain") == [] and html.title(html.tree("<h1>One Project page: x</h1>")) == "One"
    deep = "<div>" * 20_000 + "<p>end of it" + "</div>" * 20_000
    assert html.blocks(deep) == [("paragraph", 0, "end of it", False)]
    heads = html.html_heads(spark.createDataFrame([(1, HTML), (2, None), (3, "")], "id bigint, t string"), "id", "t")
    assert [tuple(r) for r in heads.orderBy("id").collect()] == [(1, "A Title", "We test x^2 here."), (2, None, None), (3, None, None)]


TEX = r"""\documentclass{article} % a comment
\title{A {Nested} \emph{Title}}
\begin{document}\begin{abstract}Short \textbf{one}.\end{abstract}
Before all. 5\% of it~\cite{x}.
\section*{First \emph{part}}
Text \href{http://a}{link} and $x_1$ here.

\[ a = b \]
\begin{figure} gone \end{figure}
\subsection[s]{Second} More. % \section{not one}
\end{document}"""


def test_tex_sections(spark):
    assert tex.title(TEX) == "A Nested Title" and tex.abstract(TEX) == "Short one."
    got = tex.sections(TEX)
    assert [(h, lv) for h, lv, _ in got] == [("Document Body", 1), ("First part", 1), ("Second", 2)]
    assert got[0][2] == [("paragraph", "Before all. 5% of it .")] and got[1][2] == [("paragraph", "Text link and x_1 here."), ("equation", "[EQUATION]")] and got[2][2] == [("paragraph", "More.")]
    assert tex.sections(None) == [] and tex.sections("") == [] and tex.braced("{a", 0) is None and tex.sections("only text") == [("Document Body", 1, [("paragraph", "only text")])]
    assert tex.uncommented(r"a \% b \\% c") == r"a \% b \\" and len(tex.plain("{" * 50_000)) == 0
    blocks = tex.tex_blocks(spark.createDataFrame([(1, TEX), (2, None)], "id bigint, t string"), "id", "t").orderBy("pos").collect()
    assert [(r.type, r.level) for r in blocks] == [("heading", 2), ("paragraph", 0), ("heading", 2), ("paragraph", 0), ("equation", 0), ("heading", 3), ("paragraph", 0)]


def test_pages(spark):
    body = "This is the text of one page and it goes on for a while."
    page = lambda k: f"RUNNING HEAD OF IT\n{body} No {k}.\n\n{k}"
    text = "\f".join(["1 Introduction\n" + page(1), page(2) + "\nFigure 2 shows it", "II. METHOD\narXiv:1234\n" + page(3), page(4), ("A long sentence of a page. " * 12 + "\n") * 3])
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id bigint, t string")
    assert [r.line for r in pages.repeated_lines(pages.page_lines(df, "id", "t"), "id").collect() if r.line.isupper()] == ["RUNNING HEAD OF IT"]
    got = pages.page_sections(df, "id", "t").orderBy("pos").collect()
    assert {r.id for r in got} == {1} and [r.pos for r in got] == list(range(len(got))) and {r.heading for r in got} == {"1 Introduction", "II. METHOD"}
    assert not any("RUNNING" in r.text or r.text.isdigit() for r in got) and [r.type for r in got if r.text.startswith("Figure 2")] == ["figure_caption"]
    assert [len(r.text) >= 500 for r in got if r.text.startswith("A long")] == [True, False]
    report = "My Title\n\n1.2 Planning Tools\nThe memo-\nry was read\nin one go.\n- first thing\nx = 2\nFig. 3. A rover\n---\n12\nSYSTEM STATE\nmore text here"
    rows = spark.createDataFrame([(1, report, "My title!")], "id bigint, t string, title string")
    assert [(r.type, r.level, r.text) for r in pages.report_blocks(rows, "id", "t", "title").orderBy("pos").collect()] == [
        ("heading", 3, "1.2 Planning Tools"), ("paragraph", 0, "The memory was read in one go."), ("list_item", 0, "first thing"), ("equation", 0, "x = 2"), ("figure_caption", 0, "Fig. 3. A rover"), ("heading", 2, "SYSTEM STATE"), ("paragraph", 0, "more text here")]
    assert pages.page_text(df, "id", "t").first().text.count(body) == 4


def test_parsed_documents_of_all_formats(spark):
    df = spark.createDataFrame([(1, HTML, "t"), (2, TEX, "t"), (3, "INTRODUCTION\nSome text\fMETHODS\nmore text", "t"), (4, "INTRODUCTION\nplain text", "t"), (5, None, None), (6, " ", "t")], "id bigint, x string, title string")
    b = parsing.parsed(df, "id", "x", "title").cache()
    assert {r.id for r in b.select("id").distinct().collect()} == {1, 2, 3, 4}
    assert [(r.type, r.text) for r in b.where("id = 3").orderBy("pos").collect()] == [("heading", "INTRODUCTION"), ("paragraph", "Some text"), ("heading", "METHODS"), ("paragraph", "more text")]
    assert {r.id: r.faults for r in parsing.parse_faults(df, b, "id").collect()}[5] == ["few_chars", "few_words", "no_section"]
    clean = {r.id: r.clean_content for r in cleaning.clean(b, "id", False).collect()}
    assert "A book" not in clean[1] and "[EQUATION] a=b" in clean[1] and clean[4] == "## INTRODUCTION\n\nplain text"
    raw = cleaning.raw_rendered(b, df.select("id", "title", F.lit("short").alias("abstract")), "id").where("id = 4").first().raw_content
    assert raw == "# t\n\n## ABSTRACT\n\nshort\n\n## INTRODUCTION\n\nplain text"
    lines = cleaning.corpus_text(spark.createDataFrame([(1, "a  b\n\n\n\nx \ufffd y\nc d e f g\ngood line"), (2, None), (3, "")], "id bigint, t string"), "id", "t")
    assert {r.id: (r.text, r.dropped) for r in lines.collect()} == {1: ("a b\n\ngood line", 2), 3: ("", 0)}


def test_records(spark, tmp_path):
    from paperlake.sources import cache, records

    j = json.dumps({"id": "7", "title": " a  b", "authorAffiliations": [{"meta": {"author": {"name": "X Y"}}}, {"meta": {"author": {"name": "X Y"}}}, {"meta": None}], "sourceIdentifiers": [{"type": "doi", "number": "10.1/x"}],
                    "publications": [{"publicationDate": ""}], "submittedDate": "2020-02-03T00", "downloads": [{"links": {"pdf": "/f/1.pdf"}}, {"links": {"fulltext": "https://z/t.txt"}}]})
    df = spark.createDataFrame([(1, j), (2, "{broken"), (3, None), (4, "{}")], "k int, json string")
    got = {r.k: r for r in records.reports(df, "json", "https://s.example/").collect()}
    assert (got[1].authors, got[1].doi, got[1].published_at, got[1].pdf_url, got[1].fulltext_url, got[1].has_download) == (["X Y"], "10.1/x", "2020-02-03", "https://s.example/f/1.pdf", "https://z/t.txt", True)
    assert got[2].source_id is None and got[4].authors == [] and not got[4].has_download
    xml = '<entry><id>http://a.example/abs/2101.00001v2</id><title> a\n b</title><summary>s</summary><published>2021-01-02T00:00:00Z</published><author><name>X</name></author><author><name>Y</name></author><category term="cs.AI"/><link href="http://a/p" type="application/pdf"/></entry>'
    e = records.entries(spark.createDataFrame([(xml,)], "xml string"), "xml", "http://a.example").first()
    assert (e.source_id, e.source_base_id, e.title, e.authors, e.categories, e.published_at, e.pdf_url, e.html_url) == ("2101.00001v2", "2101.00001", "a b", ["X", "Y"], ["cs.AI"], "2021-01-02", "http://a/p", "http://a.example/html/2101.00001")
    path = str(tmp_path / "cache")
    cache.write_pages(spark.createDataFrame([("1", "q a", 0, 10, "x"), ("0", "q b", 0, 10, "old")], "version string, query string, start int, size int, body string"), path)
    want = spark.createDataFrame([("q a", 0, 10), ("q a", 10, 10), ("q b", 0, 10)], "query string, start int, size int")
    assert {(r.query, r.start): r.body for r in cache.read_pages(spark, path, "1", want).collect()} == {("q a", 0): "x", ("q a", 10): None, ("q b", 0): None}


def test_retriever(spark, tmp_path):
    good = " The planner of the rover kept its map and the crew saw no fault in the whole long day of tests with it." * 3
    rows = [(i, i // 2, f"dust storm number {i}." + good, "dust storm planner" if i % 2 else "wheel slip") for i in range(12)] + [(50, 9, "x y z", "dust storm")]
    chunks = spark.createDataFrame(rows, "id bigint, document_id bigint, chunk_text string, retrieval_text string")
    r = retriever.Retriever(spark, str(tmp_path / "kept")).fit(chunks)
    out = r.retrieve_with_diagnostics('"dust storm"', "planner", 3)
    e = out["evidence"].orderBy("rank").collect()
    assert [x.rank for x in e] == [1, 2, 3] and len({x.document_id for x in e}) == 3 and all(x.complete for x in e)
    assert {x.id for x in out["rejected"].collect()} == {50} and out["summary"].first().rejected == 1
    for bad in ("", "  ", "zzz qqq"):
        with pytest.raises(ValueError):
            r.query(bad)


def test_svd_keeps_neighbours(spark):
    from paperlake.work import Work

    topics = [["wheel", "slip", "sand"], ["star", "tracker", "gyro"], ["dust", "storm", "power"]]
    docs = spark.createDataFrame([(i, " ".join(topics[i % 3][(i + k) % 3] for k in range(4)) + f" w{i % 7}") for i in range(60)] + [(99, None)], "id bigint, t string")
    w = tfidf.weights(docs, "id", "t").cache()
    s = svd.Svd(w, "id", 3, Work(spark, "t-svd"))
    v = {r.id: r.v for r in s.vectors(s.rows, 3).collect()}
    assert len(v) == 60 and sum(a * b for a, b in zip(v[0], v[3])) > 0.8 > 0.5 > abs(sum(a * b for a, b in zip(v[0], v[1])))
    assert 0.2 < s.explained(2) < s.explained(3) <= 1


def test_politeness_and_rounds():
    from paperlake.sources.api import Refused, in_rounds, politely

    slept, answers = [], [Refused(429, 30), OSError(), "page"]

    def fetch(*_):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert politely(fetch, sleep=slept.append, clock=lambda: 100.0)("q") == "page" and slept == [0, 30, 40]
    for bad in (Refused(404), Refused(503)):
        answers[:] = [bad] * 3
        with pytest.raises(Refused):
            politely(fetch, sleep=lambda _: None)("q")
        assert len(answers) == (2 if bad.status == 404 else 0)
    pages = {"a": [[1, 2], [3, 4], [5]], "b": [[2, 9], []]}
    get = lambda q, start, size: [{"id": i} for i in pages[q][start // size]]
    assert [(q, s) for q, s, _ in in_rounds(get, ["a", "b"], 2, 100)] == [("a", 0), ("b", 0), ("a", 2), ("a", 4)]
    assert [(q, s) for q, s, _ in in_rounds(get, ["a", "b"], 2, 3)] == [("a", 0), ("b", 0)]


def test_sinks_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "id bigint, text string")
    assert sinks.write_parted(df, F.col("text").isNull(), str(tmp_path / "t"), str(tmp_path / "q")) == {"kept": 2, "failed": 1}
    assert sinks.write_parted(df.where("id > 2"), F.col("text").isNull(), str(tmp_path / "t"), str(tmp_path / "q")) == {"kept": 1, "failed": 0}
    sinks.write_texts(df.where("id = 1"), str(tmp_path / "txt"))
    assert "".join(p.read_text() for p in (tmp_path / "txt").glob("part-*")) == "a b\n\n"
    (tmp_path / "m.json").write_text(json.dumps({"selection_version": "2", "source": "s", "selected_count": 4, "selected_documents": {"a": ["1", "2"], "b": ["3"]}}))
    got = {(r.fault, r.found) for r in files.manifest_faults(spark, str(tmp_path / "m.json"), "1", "s", {"a": 2, "b": 2, "c": 1}).collect()}
    assert got == {("version", "2"), ("total", "4"), ("count of b", "1"), ("count of c", "-1")}


def test_payloads_and_small_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, b"%PDF-1.7" + b"x" * 10_000), (2, b"%PDF"), (3, b"<html>" + b"x" * 20_000), (4, None)], "id int, b binary")
    assert {r.id for r in df.where(Q.pdf_payload(F.col("b"))).collect()} == {1}
    assert spark.range(1).select(N.vector_literal(F.array(F.lit(1.5), F.lit(-2.0)))).first()[0] == "[1.5,-2.0]"
    sinks.write_jsonl(df.select("id"), str(tmp_path / "l"))
    sinks.write_report(df.agg(F.count("*").alias("n")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "l")).count() == 4 and [json.loads(x.read_text()) for x in (tmp_path / "r").glob("part-*")] == [{"n": 4}]
