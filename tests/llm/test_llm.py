"""Training-data operators: small fixtures with nulls, empty and long texts, ties, repeats and hot groups, each
against brute force, an exact round trip or held-out accuracy."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.llm import covering, p1_neardup, p2_scans, p3_markup, p4_splits, p5_quality, p6_history, p7_knn, p8_tokens, p9_mixture, p10_personal
from paperlake.llm.work import Work

WORDS = [f"w{i}" for i in range(400)]


def grams(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def near(a, b):
    x, y = grams(a), grams(b)
    return bool(x and y) and len(x & y) * 10 >= 6 * min(len(x), len(y))


def texts(n=60, seed=3):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        base = [r.choice(WORDS) for _ in range(r.choice([5, 30, 80, 200]))]
        out.append(" ".join(base))
        if r.random() < 0.5:
            w = list(base)
            for _ in range(len(w) // 20):
                w[r.randrange(len(w))] = r.choice(WORDS)
            out.append(" ".join(w))
        if r.random() < 0.2:
            out.append(" ".join(base[: len(base) // 2]) + " tail of another text altogether")
    return out


def scattered(sizes, seed, n=60, inside=0):
    """Texts and versions with a word changed every 8 words or so: near, but hardly a passage of 8 words is left; with
    inside, the version stands in so many words of another text."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = [f"v{r.randrange(5000)}" for _ in range(r.choice(sizes))]
        v = [f"e{i}x{j}" if j % 9 == 4 else x for j, x in enumerate(w)]
        out += [" ".join(w), " ".join([f"f{r.randrange(5000)}" for _ in range(inside)] + v)]
    return out


def test_code_words_and_near_pairs():
    x = np.random.default_rng(1).integers(0, 1 << 23, 500).astype(np.int32)
    row, a = covering.anchors(x, covering.RADIUS)
    assert len(row) == 500 and (covering.syndrome(a) == 0).all() and np.bitwise_count((x[row] ^ a).astype(np.uint32)).max() <= 3
    y = x[:40] ^ (1 << 3) ^ (1 << 20)
    z = np.concatenate([x[:40], y])
    i, j = covering.near_pairs(np.zeros(80, int), z)
    want = {(p, q) for p in range(80) for q in range(80) if p != q and bin(int(z[p] ^ z[q])).count("1") <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_p1_against_brute_force(spark, monkeypatch):
    t = texts() + ["", None, "  ", "two words", "same text here three times", "Same, text here: three times!", "x " * 30_000]
    boiler = "this passage stands at the end of very many texts and must not tie them to each other at all"
    t += [" ".join(random.Random(i).choices(WORDS, k=60)) + " " + boiler for i in range(40)]
    rows = [("d", i, x) for i, x in enumerate(t)] + [("d", 1, t[1])] + [("e", 0, t[0])]
    df = spark.createDataFrame(rows, "tbl string, id bigint, text string")
    want = {("d", i, j) for i in range(len(t)) for j in range(i + 1, len(t)) if near(t[i], t[j])}
    for hot in (100, 10):  # with 10 the boilerplate goes the way of frequent passages
        monkeypatch.setattr(p1_neardup, "HOT", hot)
        got = [tuple(r) for r in p1_neardup.found(spark, df).select("tbl", "id_a", "id_b").collect()]
        assert len(got) == len(set(got)) and set(got) <= want
        assert len(want & set(got)) >= 0.97 * len(want)
    assert p1_neardup.found(spark, df.limit(0)).count() == 0


def test_p1_frequent_passages_alone(spark, monkeypatch):
    """Near texts that share only a frequent passage, well under 0.3 of either text's."""
    r = random.Random(21)
    monkeypatch.setattr(p1_neardup, "HOT", 10)
    boiler = "as shown in the last report of this long series of tests"
    t = [x + " " + boiler for x in scattered([60, 90], 22, 30)] + [" ".join(r.choices(WORDS, k=50)) + " " + boiler for _ in range(30)]
    want = {(i, j) for i in range(len(t)) for j in range(i + 1, len(t)) if near(t[i], t[j])}
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(t)], "tbl string, id bigint, text string")
    assert len(want) >= 25 and {tuple(x) for x in p1_neardup.found(spark, df).select("id_a", "id_b").collect()} == want


def test_p1_scattered_edits(spark):
    t = scattered([32, 50, 63, 64, 90, 120], 23) + scattered([40, 60], 24, inside=200)
    want = {(i, j) for i in range(len(t)) for j in range(i + 1, len(t)) if near(t[i], t[j])}
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(t)] + [("e", i, x) for i, x in enumerate(t)], "tbl string, id bigint, text string")
    got = [tuple(x) for x in p1_neardup.found(spark, df).collect()]
    assert len(want) > 100 and sorted(got) == sorted((d, i, j) for d in "de" for i, j in want)


def test_p1_lookup_leaves_few_pairs_to_check(spark):
    """Texts made of the same sentences share much, but only near pairs (and a few by clashes of hashes) leave the lookup."""
    r = random.Random(8)
    sentences = [" ".join(r.choice(WORDS) for _ in range(12)) for _ in range(60)]
    rows = [" ".join(r.sample(sentences, r.choice([6, 8, 10]))) for _ in range(250)]
    rows += [t + " " + " ".join(r.choice(WORDS) for _ in range(k)) for t, k in zip(rows[:40], range(1, 41))]
    rows += ["one two three four", "one two three four five", "one two three"]
    work = Work(spark, "p1-lookup")
    f = p1_neardup.featured(spark.createDataFrame([("t", i, t) for i, t in enumerate(rows)], "tbl string, id bigint, text string"), work)
    ids = dict(f.select("cls", "id").collect())
    own = f.select("cls", "grams")
    met = p1_neardup.lookup(own, own, p1_neardup.order(p1_neardup.frequencies(own)), work, "t").distinct().collect()
    got = {tuple(sorted((ids[x.a], ids[x.b]))) for x in met}
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if near(rows[i], rows[j])}
    assert len(want) >= 40 and want <= got and len(got) <= 1.2 * len(want)


def test_p1_stock_passages(spark):
    """Texts that have only a standard paragraph in common stay apart, even short ones that consist mostly of it; copies with
    that paragraph, and short texts equal but for signs, are pairs."""
    stock = "this report was prepared for the joint programme and reflects the state of the work at the time of writing and later revisions may change any figure without notice"
    r = random.Random(31)
    own = lambda i, n: " ".join(f"o{i}w{r.randrange(9000)}" for _ in range(n))
    t = [own(i, 14) + ". " + stock for i in range(12)] + [own(100 + i, 60) + ". " + stock for i in range(30)]
    edited = [x.replace(" ", " extra ", 1) for x in t[:3] + t[12:18]]
    t += edited + [t[0].upper()]
    n = len(t)
    copies = {(i, 42 + k) for k, i in enumerate([0, 1, 2, *range(12, 18)])} | {(0, n - 1), (42, n - 1)}
    near_pairs = {(i, j) for i in range(n) for j in range(i + 1, n) if near(t[i], t[j])}
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(t)], "tbl string, id bigint, text string")
    got = {(x.id_a, x.id_b) for x in p1_neardup.found(spark, df).collect()}
    assert got == copies and copies < near_pairs and len(near_pairs) > 300


def test_p1_replaced_passages(spark):
    """Texts of which a third of the sentences was replaced share only some passages, though 0.6 of their sequences; so do texts
    that have one paragraph in common. Edited and reordered copies and texts within longer ones are pairs."""
    r = random.Random(41)
    sentence = lambda: " ".join(r.choice(WORDS) for _ in range(12)) + "."
    t, want, apart = [], set(), set()
    for _ in range(12):
        s = [sentence() for _ in range(9)]
        replaced = [sentence() if k in (1, 4, 7) else x for k, x in enumerate(s)]
        edited = [x.replace(" ", f" e{k} ", 1) if k % 2 else x for k, x in enumerate(s)]
        typed = " ".join(f"x{k}" if k % 8 == 5 else w for k, w in enumerate(" ".join(s).split()))
        longer = [sentence() for _ in range(6)] + s
        i = len(t)
        t += [" ".join(x) for x in (s, replaced, edited, s[5:] + s[:5], longer)] + [typed]
        want |= {(i + a, i + b) for a, b in ((0, 2), (0, 3), (0, 4), (0, 5), (2, 3), (2, 4), (3, 4), (3, 5), (4, 5))}
        apart |= {(i, i + 1)}
        p = [sentence() for _ in range(4)]
        apart |= {(len(t), len(t) + 1)}
        t += [" ".join(p + [sentence()]), " ".join([sentence(), sentence()] + p)]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(t)] + [("d", 0, t[0]), ("e", 0, t[1])], "tbl string, id bigint, text string")
    got = {(x.id_a, x.id_b) for x in p1_neardup.found(spark, df).collect()}
    assert all(near(t[i], t[j]) for i, j in want | apart)
    assert want <= got and not apart & got


def test_p1_some_passages_not_single_edits():
    """Of near texts with words edited one by one hardly any look as if passages were replaced."""
    r = random.Random(43)
    pairs = told = 0
    for _ in range(2000):
        w = [f"v{r.randrange(3000)}" for _ in range(r.choice([32, 50, 90]))]
        e = [f"e{r.randrange(3000)}" if r.random() < 0.13 else x for x in w]
        a, b = " ".join(w), " ".join(e)
        pairs += near(a, b)
        told += near(a, b) and p1_neardup.some_passages(a, b)
    assert pairs > 1000 and told <= 0.005 * pairs
    assert not p1_neardup.some_passages("", "") and not p1_neardup.some_passages("one two three", "one two three")


def test_p1_star_of_many_copies(spark):
    df = spark.createDataFrame([("d", i, "the same five words here") for i in range(100)], "tbl string, id bigint, text string")
    got = {tuple(r) for r in p1_neardup.found(spark, df).select("id_a", "id_b").collect()}
    assert got == {(0, i) for i in range(1, 100)}


SCAN = "The sensor was checked before the nightly re-\nboot and it did not fail. The long-\nrange radar was\nAR-1999-1234   NOT FOR RELEASE\nPage 7 of 9\nof no help. The sensor tcst was done by the crew."


def test_p2_lines_and_repair(spark):
    plain = "The sensor test was done by the crew. The long-range radar was tested after the nightly reboot. " * 4
    rows = [("c", i, plain) for i in range(12)] + [("d", 1, SCAN), ("d", 1, SCAN), ("d", 2, None), ("d", 3, ""), ("d", 4, " \n ")]
    df = spark.createDataFrame(rows, "tbl string, rec_id bigint, text string")
    kinds, _ = p2_scans.marks(df, Work(spark, "t2"))
    got = {tuple(r) for r in kinds.where("tbl = 'd'").select("rec_id", "line_no", "kind").collect()}
    assert got == {(1, 1, "hyphen"), (1, 4, "header"), (1, 5, "page"), (1, 6, "misread")}
    fixed = {(r.tbl, r.rec_id): r.text for r in p2_scans.repaired(df, Work(spark, "t2r")).collect()}
    assert fixed[("d", 1)] == "The sensor was checked before the nightly reboot and it did not fail. The long-range radar was of no help. The sensor test was done by the crew."
    assert fixed[("d", 2)] is None and fixed[("d", 3)] == "" and len(fixed) == 16


def test_p2_more_known_lines_than_are_broadcast(spark, monkeypatch):
    """Running heads and section headings beyond those broadcast are told by a join, with the same rows; so are words."""
    names = ["Alpha Beta", "Gamma Delta", "Epsilon Zeta", "Eta Theta"]
    rows = [("c", 9 * k + i, f"Some words of text\n{a}x {name}\n{i + 1}\nand more of these re-\n{b} {name}\nlated words") for k, name in enumerate(names) for i, (a, b) in enumerate(zip("ABCDEFGH", ["Ix", "Jx", "Kx", "Lx", "Mx", "Nx", "Ox", "Px"]))]
    rows += [("d", i, f"Text of it\n{w} AND ITS USE IN ALL OF THIS\n{i + 1}\nNEVER SEEN TWICE {chr(65 + i) * 3}\nmore text here") for i, w in enumerate(["METHOD", "RESULT", "OUTLOOK"] * 7)]
    df = spark.createDataFrame(rows, "tbl string, rec_id bigint, text string")
    monkeypatch.setattr(p2_scans, "CAPITALS", 5)
    got = []
    for most in (200_000, 1):
        monkeypatch.setattr(p2_scans, "KNOWN_LINES", most)
        monkeypatch.setattr(p2_scans, "VOCABULARY", most)
        kinds = p2_scans.marks(df, Work(spark, "t2k"))[0].collect()
        got.append({tuple(r) for r in kinds})
        assert len(kinds) == len(got[-1])
    heads = {(t, i, n) for t, i, n, k in got[0] if k == "header"}
    assert heads == {("c", 9 * k + i, n) for k in range(4) for i in range(8) for n in (2, 5)} | {("d", i, 4) for i in range(21)}
    assert got[1] == got[0]


def test_p2_explains_only_misreadings():
    assert p2_scans.explains("planner", "plariner") and p2_scans.explains("needs", "neecls") and p2_scans.explains("confidence", "conhdence")
    assert not p2_scans.explains("recovered", "ercovered") and not p2_scans.explains("planner", "planner")


MARKED = {
    "html": ("<h2>One</h2><!-- <li>no</li> --><script>var t='<li>x</li>'</script><ul><li>a<li>b</ul><pre><h2>no</h2> $x$</pre><p>see <math><mi>v</mi></math> <div class=eq>\\[a &lt; b\\]</div>", {"any": 1, "heading": 1, "list_item": 2, "code": 1, "formula": 2}),
    "md": ("One\n===\n\n## Two ##\n\n- a\n    - b\n1. c\n\n```py\n# no\n- no\n```\n\ncosts $v_1$\n\n$$\nx^2\n$$\n\n<!-- # no -->\n**b**", {"any": 1, "heading": 2, "list_item": 3, "code": 1, "formula": 2}),
    "wiki": ("==One==\n* a\n** b\n#c\n<source lang=x>\n== no ==\n* no\n</source>\n'''b''' <math>x</math> [[l|t]]", {"any": 1, "heading": 1, "list_item": 3, "code": 1, "formula": 1}),
    "tex": ("\\section*{One} \\label{a}\n% \\section{no}\n\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}\n\\begin{verbatim}\n\\item no\n\\end{verbatim}\n$v_1$ \\(x\\) 5\\% \\begin{equation}\nx\n\\end{equation}\n\\emph{e}", {"any": 1, "heading": 1, "list_item": 2, "code": 1, "formula": 3}),
    "plain": ("The rig cost $9 million in the first year and $3 million later. See [3] and 2 * 3; C# is x < 5.\n- 20 -\n~ 4 ~", {}),
}


@pytest.mark.parametrize("kind", MARKED)
def test_p3_elements(kind):
    text, want = MARKED[kind]
    assert Counter(p3_markup.elements(text)) == want


def test_p3_edges(spark):
    rows = [(1, MARKED["md"][0]), (1, MARKED["md"][0]), (2, None), (3, ""), (4, " \n"), (5, MARKED["plain"][0]), (6, "<p>open <b>tag"), (7, "# a\n" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = [tuple(r) for r in p3_markup.found(df).collect()]
    assert len(got) == len(set(got)) and {r[0] for r in got} == {1, 6, 7}
    clean = {r.id: r.text for r in p3_markup.converted(df).collect()}
    assert clean[2] is None and clean[5] == MARKED["plain"][0] and "```\n# no" in clean[1] and "**" not in clean[1] and clean[1].startswith("# One")
    assert p3_markup.found(df.limit(0)).count() == 0


def test_p4_components_splits_and_additions(spark):
    schema = "id bigint, source string, source_id string, doi string, authors array<string>, topic_axis string"
    rows = [
        (1, "arxiv", "1.1v1", None, ["Ada Lo", None, "et al."], "a"), (2, "arxiv", "1.1v2", None, [], "a"), (3, "ntrs", "9", "DOI: 10.5555/X ", ["LO,  Ada¹"], "b"), (4, "ntrs", "10", "10.5555/x", None, "b"),
        (5, "ntrs", "11", "n/a", ["Anonymous"], None), (6, "ntrs", "12", "", ["Anonymous", "Bo Ek (2)"], "a"), (7, None, None, None, ["Ek, Bo"], "a"), (7, None, None, None, ["Ek, Bo"], "a"), (None, "arxiv", "1.1v1", None, None, "a"),
    ]
    rows += [(100 + i, "x", str(i), None, ["Hot Author"], "c") for i in range(200)] + [(1000 + i, "y", str(i), None, None, "c") for i in range(300)]
    docs = spark.createDataFrame(rows, schema)
    got = {r.id: r.group_id for r in p4_splits.grouped(docs, Work(spark, "t4")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 6: 6, 7: 6} | {100 + i: 100 for i in range(200)}
    targets = spark.createDataFrame([("train", 0.8), ("test", 0.2)], "split_name string, target_share double")
    out = p4_splits.splits(docs, targets, Work(spark, "t4s")).collect()
    split = {r.id: r.split_name for r in out}
    assert len(out) == len(split) == 7 + 500 and len({split[i] for i in (1, 2, 3, 4)}) == 1 and len({split[100 + i] for i in range(200)}) == 1
    kept = spark.createDataFrame([(1, 1, "train", "a"), (6, 6, "test", "a")], "id bigint, group_id bigint, split_name string, topic_axis string")
    ties = p4_splits.ties(docs.where("id in (1, 6)")).withColumnRenamed("id", "group_id")
    new = spark.createDataFrame([(20, "arxiv", "1.1v9", None, ["New Man"], "a"), (21, "z", "1", None, ["Ada Lo", "Ek Bo"], "a"), (22, "z", "2", None, None, "a")], schema)
    rows, clash = p4_splits.added(kept, ties, new, targets, Work(spark, "t4a"))
    # 21 joins groups of two splits, and 20 is tied to it: both wait
    assert {r.id for r in clash.collect()} == {20, 21} and {r.id for r in rows.collect()} == {22}
    rows, clash = p4_splits.added(kept, ties, new.where("id <> 21"), targets, Work(spark, "t4b"))
    assert {r.id: (r.group_id, r.split_name) for r in rows.collect()}[20] == (1, "train") and clash.count() == 0


def test_p4_kept_table(spark, tmp_path):
    """Batches against one batch: the same groups; what is there keeps its split; clashes are put into quarantine."""
    schema = "id bigint, source string, source_id string, doi string, authors array<string>, topic_axis string"
    r = random.Random(4)
    rows = [(i, "x", str(i), None, [f"Ann A{r.randrange(150)}", f"Ann A{r.randrange(150)}" if i >= 250 and i % 5 == 0 else f"Bob B{i}"], r.choice("abc")) for i in range(400)]
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    kept = p4_splits.Kept(spark, f"file://{tmp_path}/kept")
    df = spark.createDataFrame(rows, schema)
    kept.add(df.where("id < 250"), targets)
    before = {x.id: (x.group_id, x.split_name) for x in kept.records().collect()}
    kept.add(df, targets)
    after = {x.id: (x.group_id, x.split_name) for x in kept.records().collect()}
    out = {x.id for x in kept.quarantine().collect()}
    assert all(after[i] == v for i, v in before.items()) and set(after) | out == set(range(400)) and not set(after) & out
    for i in range(400):  # no author in two splits
        for j in range(i):
            if i in after and j in after and set(rows[i][4]) & set(rows[j][4]):
                assert after[i][1] == after[j][1]
    assert out and all(i >= 250 for i in out)
    many = spark.createDataFrame([(i, "x", str(i), None, [f"Solo S{i}"], "a" if i % 3 else "b") for i in range(3000)], schema)
    shares = {(x.topic_axis, x.split_name): x["count"] for x in p4_splits.splits(many, targets, Work(spark, "t4s")).join(many, "id").groupBy("topic_axis", "split_name").count().collect()}
    assert all(abs(shares[a, s] - n * t) <= 1 for a, n in (("a", 2000), ("b", 1000)) for s, t in (("train", 0.8), ("validation", 0.1), ("test", 0.1)))


def test_p4_long_chain(spark):
    n = 40
    links = spark.createDataFrame([(i + 1, i) for i in range(n)], "a bigint, b bigint")
    got = {r.id: r.group_id for r in p4_splits.components(links, Work(spark, "chain")).collect()}
    assert got == dict.fromkeys(range(n + 1), 0)


def test_p5_holdout_accuracy(spark):
    common = frozenset("the and of a in it was for on by with that is to we did not le la les des und der die de el que en was were all be but no this".split())
    prose = [f"We saw that the {a} of the rover was {b} in the cold room, and it did not fail for {i} days." for i, (a, b) in enumerate(zip("arm wheel mast drill map".split() * 20, "good bad slow fast safe".split() * 20))]
    lists = ["\n".join(f"- {x} {i} part" for x in ("arm", "wheel", "mast", "drill")) for i in range(60)]
    tables = ["\n".join(";".join(str(i * j) for j in range(4)) for i in range(5)) for _ in range(60)]
    r = random.Random(5)
    junk = ["\n".join("".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFG0123456789+/", k=60)) for _ in range(4)) for _ in range(60)]
    model, known = p5_quality.train(prose + lists + tables + junk, common)
    trees, rule = p5_quality.accuracy(model, common, known)
    assert trees >= 0.7
    df = spark.createDataFrame([("core_chunks", i, t) for i, t in enumerate(prose + lists + junk)] + [("core_chunks", 900, None), ("core_chunks", 901, " ")], "tbl string, rec_id bigint, text string")
    got = {r.rec_id: r.verdict for r in p5_quality.judged(df, spark.createDataFrame([("en", w) for w in common] + [("en", None)], "lang string, word string")).collect()}
    assert got[900] is None and got[901] is None and got[0] == "prose" and got[len(prose)] == "list" and got[len(prose) + len(lists)] == "junk"


def brute_history(core, cand):
    have_h, have_s, have_t, out = set(), set(), [], set()

    def key(s, i):
        if s is None or i is None:
            return None
        s, i = re.sub(r"\s", "", s).lower(), re.sub(r"\s", "", i).lower()
        i = i[len(s) :].lstrip(":-_/") if i.startswith(s) else i
        return s, re.sub(r"v\d+$", "", i)

    def add(s, i, h, t):
        have_h.add((h or "").lower().strip())
        have_s.add(key(s, i))
        have_t.append(t)

    for _, s, i, h, t in core:
        add(s, i, h, t)
    for c, s, i, h, t in sorted(set(cand)):
        why = set()
        if h and h.strip() and h.lower().strip() in have_h:
            why.add("content_hash")
        if key(s, i) and key(s, i) in have_s:
            why.add("source_id")
        if any(near(t, x) for x in have_t):
            why.add("near_text")
        out |= {(c, w) for w in why}
        if not why:
            add(s, i, h, t)
    return out


def test_p6_batches_equal_brute_force(spark, tmp_path):
    t = [x for x in texts(50, 8) if len(x.split()) > 20]
    r = random.Random(2)
    row = lambda i, x: (i, r.choice(["arxiv", "ntrs"]), r.choice([f"{i}v1", f"arXiv:{i // 2}v2", f"NTRS-{i // 3}", None]), r.choice([None, f"H{i // 2}", f"h{i // 2}"]), x)
    core = [row(i, x) for i, x in enumerate(t[:25])] + [(98, None, None, None, None), (99, "arxiv", "", "", "")]
    cand = [row(100 + i, x) for i, x in enumerate(t[15:])] + [(300, None, None, None, None), (301, "ntrs", " ", " ", "  ")]
    cand += [(400 + i, "ntrs", f"z{i}", "ABC", None) for i in range(30)] + [cand[0], cand[3]]
    schema = "id bigint, source string, source_id string, content_hash string, clean_content string"
    want = brute_history(core, cand)
    df, new = spark.createDataFrame(core, schema), spark.createDataFrame(cand, schema)
    # all in one batch, by the numbers of batches, and through the kept history
    named = lambda k: new.withColumnRenamed("id", "candidate_id").withColumn("batch_no", F.expr(k))
    for k, turns in enumerate(("1", "case when candidate_id < 110 then 2 when candidate_id < 250 then 5 else null end")):
        work = Work(spark, f"t6-{k}")
        assert {tuple(x) for x in p6_history.batches(df, named(turns), work.path("history"), work).collect()} == want
    h = p6_history.History(spark, f"file://{tmp_path}/history")
    h.create(df)
    kept = set()
    for lo, hi in ((0, 110), (110, 250), (250, 1000)):
        kept |= {(x.id, x.reason) for x in h.check(new.where(f"id >= {lo} and id < {hi}")).collect()}
    assert kept == want
    empty = p6_history.History(spark, f"file://{tmp_path}/empty")
    empty.create(df.limit(0))
    assert {(x.id, x.reason) for x in empty.check(new).collect()} == brute_history([], cand) and empty.check(new.limit(0)).count() == 0


def test_p6_reads_only_cells_that_can_be_near(spark, tmp_path, monkeypatch):
    """Cells whose texts share nothing with a batch aren't read, however many there are; small blocks give the same."""
    monkeypatch.setattr(p6_history, "CELL", 20)
    r = random.Random(6)
    text = lambda k, n=60: " ".join(f"g{k}x{r.randrange(300)}" for _ in range(n))
    core = [(k * 100 + i, "s", f"{k}-{i}", None, text(k)) for k in range(6) for i in range(20)]
    h = p6_history.History(spark, f"file://{tmp_path}/h")
    h.create(spark.createDataFrame(core, P6_SCHEMA))
    batch = [(1000, "t", "a", None, core[3][4]), (1001, "t", "b", None, text(0)), (1002, "t", "c", None, text(77))]
    new = spark.createDataFrame(batch, P6_SCHEMA)
    f = p6_history.prepared(new, "id", Work(spark, "t6c"), "rows").where("cls is not null").select("cls", "grams")
    cells = h._read("cells", p6_history.BOUND_SCHEMA).count()
    reached = h.reached(spark.sparkContext.broadcast(next(h._blocks(f)))).count()
    assert cells >= 6 and 1 <= reached <= cells // 2
    monkeypatch.setattr(p6_history, "BLOCK", 70)
    monkeypatch.setattr(p6_history, "FEW", 0)
    assert {(x.id, x.reason) for x in h.check(new).collect()} == brute_history(core, batch) == {(1000, "near_text")}


def p6_rows(t):
    return [(i, "arxiv", f"{i}", None, x) for i, x in enumerate(t[::2])], [(1000 + i, "ntrs", f"{i}", None, x) for i, x in enumerate(t[1::2])]


P6_SCHEMA = "id bigint, source string, source_id string, content_hash string, clean_content string"


def test_p6_scattered_edits_and_texts_inside_longer_ones(spark):
    core, cand = p6_rows(scattered([32, 45, 63], 11, inside=300) + scattered([90, 200], 12))
    want = brute_history(core, cand)
    assert len(want) > 100
    work = Work(spark, "t6s")
    df, new = spark.createDataFrame(core, P6_SCHEMA), spark.createDataFrame(cand, P6_SCHEMA)
    got = p6_history.batches(df, new.withColumnRenamed("id", "candidate_id").withColumn("batch_no", F.lit(1)), work.path("history"), work)
    assert {tuple(x) for x in got.collect()} == want


def test_p6_order_of_large_tables(spark):
    """Sequences of over a thousand texts are still told apart, and those of two texts from those of one."""
    f = spark.range(60_000).select(F.expr("array_compact(array(1, if(id % 40 = 0, 2, null), if(id % 400 = 0, 3, null), if(id < 2, 4, null), if(id < 1, 5, null)))").alias("grams"))
    levels = p6_history.order(p6_history.frequencies(f)).astype(int)
    assert levels[1] > levels[2] > levels[3] > levels[4] > levels[5] == levels[6] == 0


def test_p6_history_of_short_and_scattered_texts(spark, tmp_path):
    core, cand = p6_rows(scattered(range(3, 32), 13) + scattered([32, 63], 14, 20, inside=100) + scattered([90], 15, 10))
    cand += [(2000 + i, "x", f"{i}", None, x) for i, x in enumerate(scattered(range(3, 32), 16, 20))]
    want = brute_history(core, cand)
    h = p6_history.History(spark, f"file://{tmp_path}/history")
    h.create(spark.createDataFrame(core, P6_SCHEMA))
    new, kept = spark.createDataFrame(cand, P6_SCHEMA), set()
    for lo, hi in ((0, 1050), (1050, 2011), (2011, 9000)):
        kept |= {(x.id, x.reason) for x in h.check(new.where(f"id >= {lo} and id < {hi}")).collect()}
    assert len(want) > 50 and kept == want


def test_p7_recall_and_edges(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((150, 256))
    x = (centres[rng.integers(0, 150, 1500)] + 0.6 * rng.standard_normal((1500, 256))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, [0.0] * 256), (5002, [1.0] * 128), (5003, [float("nan")] + [1.0] * 255), (5004, [float("inf")] + [1.0] * 255), (None, [1.0] * 256), rows[0]]
    df = spark.createDataFrame(rows + odd, "id bigint, embedding array<float>")
    near_ = p7_knn.neighbours(p7_knn.valid_vectors(df), 1500)
    got = {}
    for r in near_.collect():
        got.setdefault(r.id, set()).add(r.other)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    true = np.argsort(-s, axis=1)[:, :5]
    assert set(got) == set(range(1500)) and all(len(v) == 5 for v in got.values())
    assert np.mean([j in got[i] for i in range(1500) for j in true[i]]) >= 0.9
    few = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:3])], "id bigint, embedding array<float>")
    assert p7_knn.neighbours(p7_knn.valid_vectors(few), 3).count() == 6
    assert p7_knn.neighbours(p7_knn.valid_vectors(few.limit(0)), 0).count() == 0


def test_p7_crowded_cells_and_copies(spark, monkeypatch):
    """A third of all rows in one cell, split over tasks, and a group of equal vectors: as by brute force."""
    monkeypatch.setattr(p7_knn, "TILE", 64)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 256)).astype(np.float32)
    x[:300] = x[0] + 0.3 * x[:300]
    x[450:520] = x[450]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, embedding array<float>")
    vectors = p7_knn.valid_vectors(df)
    c = p7_knn._matrix(vectors.orderBy("id").limit(1).toArrow().column("v").combine_chunks()) @ p7_knn.rotation()
    assert p7_knn.crowded(vectors, c)[0] > 4
    got = {}
    for r in p7_knn.neighbours(vectors, 600).collect():
        got.setdefault(r.id, []).append((r.rank, r.other))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u.astype(np.float64) @ u.T.astype(np.float64), 6)
    np.fill_diagonal(s, -9)
    want = {i: [int(j) for j in np.lexsort((np.arange(600), -s[i]))[:5]] for i in range(600)}
    assert set(got) == set(range(600)) and all(sorted(j for _, j in got[i]) == sorted(want[i]) for i in range(450, 520))
    assert np.mean([j in [o for _, o in got[i]] for i in range(600) for j in want[i]]) >= 0.9


def test_p8_long_words(spark):
    """Pieces too long for a matrix are merged as in one, without a pass over the piece for each merge."""
    e = p8_tokens.encoder("long", p8_tokens.read_vocabulary())
    r = random.Random(3)
    for t in ("a" * 3000, "".join(r.choices("abcdeéß", k=4000)), "".join(r.choices("the and", k=200)).replace(" ", "") * 12):
        raw = e.bytes[np.frombuffer(t.encode(), np.uint8)]
        assert e._merge_long(raw).tolist() == e._merge(raw[None, :].copy())[0].tolist()
    assert len(e.encode(["x" * 300_000])[1]) > 0


def test_p8_equals_reference_tokenizer(spark):
    tiktoken = pytest.importorskip("tiktoken")
    if not Path(p8_tokens.VOCABULARY).exists():
        pytest.skip("no vocabulary here")
    enc = tiktoken.Encoding("own", pat_str=p8_tokens.PATTERN, mergeable_ranks=p8_tokens.read_vocabulary(), special_tokens={})
    r = random.Random(1)
    t = ["", None, " ", "\n\n  x", "don't <|endoftext|> stop", "ünï çødé 日本語 👩‍🚀", "a" * 3000, "".join(r.choices("abcdefgh", k=5000)), "x" + "  " * 50]
    t += ["".join(r.choices("abc de\n1.é,-", k=80)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string")
    got = {x.doc_id: x.ids for x in p8_tokens.encoded(df).collect()}
    assert got == {i: enc.encode_ordinary(x) if x else [] for i, x in enumerate(t)}
    back = b"".join(enc.decode_single_token_bytes(i) for i in got[5]).decode()
    assert back == t[5]


def test_p9_apportionment_and_mixture(spark):
    assert p9_mixture.sainte_lague({"a": 0.53, "b": 0.24, "c": 0.23}, {"a": 99, "b": 99, "c": 99}, 7) == {"a": 3, "b": 2, "c": 2}
    assert p9_mixture.sainte_lague({"a": 0.5, "b": 0.5}, {"a": 1, "b": 99}, 5) == {"a": 1, "b": 4}
    rows = [(i, "big", "one two three four five " * 20) for i in range(300)] + [(1000 + i, "small", "a b c d e f " * 15) for i in range(20)] + [(2000, None, "x"), (2001, "big", None), (2002, "small", ""), (2003, "other", "z " * 50), (0, "big", "one two three four five " * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 4), ("absent", 0.1, 8)], "source string, target_share double, max_repeats int")
    mixed = p9_mixture.mixture(docs, targets, Work(spark, "t9"))
    got = {r.source: r for r in p9_mixture.shares(mixed, targets).collect()}
    assert abs(got["big"].actual_share - 2 / 3) < 0.02 and abs(got["small"].actual_share - 1 / 3) < 0.02 and got["absent"].tokens == 0
    assert got["small"].max_copies <= 4 and got["big"].max_copies == 1 and mixed.count() == mixed.select("doc_id").distinct().count()
    again = p9_mixture.mixture(docs, targets, Work(spark, "t9b"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    assert p9_mixture.mixture(docs.limit(0), targets, Work(spark, "t9c")).count() == 0


NAMES = [("Vesko", "given"), ("Milith", "given"), ("Tesduskar", "family"), ("Kelpysund", "family"), (None, "given")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Mail: vesko.t+lab@mail.example; phone: +1 (563) 555.0105 x23.", [("email", "vesko.t+lab@mail.example"), ("phone", "+1 (563) 555.0105 x23")]),
        ("ask m-kel [at] mail\n[dot] example now", [("email", "m-kel [at] mail [dot] example")]),
        ("Contact Vesko B. Kelpysund or KELPYSUND, Milith and M. Tesduskar.", [("name", "Vesko B. Kelpysund"), ("name", "KELPYSUND, Milith"), ("name", "M. Tesduskar")]),
        ("lives at 12A West Brastel Street, second floor, or Nolderstraße 299.", [("address", "12A West Brastel Street"), ("address", "Nolderstraße 299")]),
        ("number 321.043.616-9 (tax id XQ4405170)", [("id_number", "321.043.616-9"), ("id_number", "XQ4405170")]),
        ("Order 4711-870-22, Part 30-180-45, Report TM-2019-301, build 10.4.2.71@nominal, 5 @ 20 Hz, @flight_ops", []),
        ("Another 6 Reaction Wheel Drive units; Table 3 Main Road Wheel Court tests", []),
        ("Vesko alone and the Kelpysund ridge", []),
        ("in 2019-2021 and on pages 1204-1288, serial 4440187", []),
        ("call 2125550187 or 2124440187, ext. 9; Order 2124440187", [("phone", "2125550187"), ("phone", "2124440187")]),
        ("at 12 Rose Garden Street or 12 Elm St, in town", [("address", "12 Rose Garden Street"), ("address", "12 Elm St")]),
        ("passport no. C01X00T47; SSN 123456789; tax\nid 918 05 0573; 219-09-9999; 990230-1234", [("id_number", "C01X00T47"), ("id_number", "123456789"), ("id_number", "918 05 0573"), ("id_number", "219-09-9999"), ("id_number", "990230-1234")]),
        ("Signed: Vesko Kelpysund (0006-5118), +44 20 7946 0018 and 01 99 00 12 34 and 030/12345678", [("name", "Vesko Kelpysund"), ("id_number", "0006-5118"), ("phone", "+44 20 7946 0018"), ("phone", "01 99 00 12 34"), ("phone", "030/12345678")]),
        ("", []),
    ],
)
def test_p10_items(text, want):
    f = p10_personal.finder(NAMES)
    assert [(k, re.sub(r"\s+", " ", text[s:e])) for s, e, k in f.spans(text)] == want


def test_p10_initials_and_beginnings_without_a_listed_part():
    names = NAMES + [(h + t, "family") for h in ("Quil", "Mor") for t in ("poric", "xack", "retek", "dane")] + [(h + t, "given") for h in ("Orv", "Dre") for t in ("ane", "sko", "lith", "mira")]
    names += [(h + t, "given") for h in ("Bel", "Tor") for t in ("vane", "sane", "lane", "mane")] + [(h + "moxen", "family") for h in ("Zim", "Tal", "Rov", "Ner")]
    f = p10_personal.finder(names)
    text = "We met in May. D. Quilmoxen asked for it, and then M.\nMormoxen signed. Belane Quilmoxen left. The U.S. Quality test, Fig. A. Results."
    assert [(k, re.sub(r"\s+", " ", text[s:e])) for s, e, k in f.spans(text)] == [("name", "D. Quilmoxen"), ("name", "M. Mormoxen"), ("name", "Belane Quilmoxen")]


def test_p10_masks_and_nulls(spark):
    t = "Write to a.b@mail.example, or call 555-0145 ext. 24. Rest  stays.\n"
    docs = spark.createDataFrame([(1, t), (2, None), (3, ""), (4, "a.b@c.example a.b@c.example " + "x" * 100_000), (1, t)], "doc_id bigint, text string")
    names = spark.createDataFrame(NAMES, "name_part string, part_kind string")
    got = {r.doc_id: r.text for r in p10_personal.masked(docs, names).collect()}
    assert got[1] == "Write to [EMAIL], or call [PHONE]. Rest  stays.\n" and got[2] is None and got[3] == ""
    rows = [tuple(r) for r in p10_personal.found(docs, names).collect()]
    assert len(rows) == len(set(rows)) == 3


@pytest.mark.parametrize("name", ["p3_found", "p5_found", "p8_ids", "p10_found"])
def test_queries_on_tables(spark, sf, name):
    from paperlake.llm.queries import queries

    rows = [str(r) for r in queries()[name](spark, sf).collect()]
    assert rows and len(rows) == len(set(rows))
