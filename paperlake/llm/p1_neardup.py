"""Problem 1: groups of texts that are the same but for small edits, insertions or reordering.

Anchor-point covering. Every text gives fingerprints of passages (``features.py``); passages that
share eight words are compared by a 23-bit fingerprint of the words around them: each fingerprint goes
to every anchor within covering radius plus threshold (``covering.py``) and is compared at the anchors.
Pairs of texts that meet are then checked exactly on their sets of three-word sequences.

Nothing follows from that for scattered edits, short texts and passages of very many texts (groups of more than
HOT rows are not compared at all). So every text is also looked up by its rarest three-word sequences
(``sequences.py``), of which a near text must have some: this alone finds all near pairs.

Texts that share only some passages stay apart, even where a short text consists mostly of such a passage: see
``stock``. Without it every short text that ends in a standard paragraph would be near every text with that
paragraph, and the pairs would grow with the square of its holders. So do texts of which whole passages were replaced
by others: see ``some_passages``.

Null, empty and blank texts, and texts under three words, are in no pair. Rows repeated with the same
id count once. Texts equal as word sequences form one class; all pairs of its ids come out up to
CLASS_PAIRS copies, beyond that each copy is paired with the least id (linked, not multiplied).
"""

from __future__ import annotations

from itertools import chain, combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .covering import near_pairs
from .features import WORD, features
from .sequences import frequencies, lookup, order
from .work import Work

HOT, CLASS_PAIRS = 100, 64
HOLDERS, CORE = 8, 6  # a passage is stock if HOLDERS texts have it; what CORE of them have in common is its core
#: Shares of a text: that the core of copies makes up; that strangers share besides it; that a pair must share besides it; that pairs share
#: which are never set apart.
MOSTLY, STRANGE, OWN, ALIKE = 0.5, 0.15, 0.25, 0.8
#: Words of a passage of a text's own; words and share of both texts that such passages make up, at least, in pairs set apart.
RUN, FEWEST, REPLACED = 6, 10, 0.15
_MEET = "a bigint, b bigint"


def _compare(k, cls, ctx):
    """Pairs of classes that meet at an anchor."""
    order = np.lexsort((ctx, cls, k))
    k, cls, ctx = k[order], cls[order], ctx[order]
    keep = np.ones(len(k), bool)
    keep[1:] = (k[1:] != k[:-1]) | (cls[1:] != cls[:-1]) | (ctx[1:] != ctx[:-1])
    k, cls, ctx = k[keep], cls[keep], ctx[keep]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    if not many.any():
        return None
    group, cls, ctx = group[many], cls[many], ctx[many]
    i, j = near_pairs(group, ctx)
    a, b = np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])
    ok = a < b
    return np.unique(np.stack([a[ok], b[ok]], axis=1), axis=0) if ok.any() else None


def _meet(hot: int):
    """Maps batches sorted by k to pairs; keys with more than hot rows are left to the lookup of sequences."""

    def run(batches):
        held: list[tuple] = []
        hot_key = None

        def flush(parts, final):
            nonlocal hot_key
            k, cls, ctx = (np.concatenate(x) for x in zip(*parts))
            cut = len(k) if final else int(np.searchsorted(k, k[-1], "left"))
            rest = (k[cut:], cls[cut:], ctx[cut:])
            k, cls, ctx = k[:cut], cls[:cut], ctx[:cut]
            got = None
            if len(k):
                start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                size = np.diff(np.append(start, len(k)))
                big = np.repeat(size > hot, size) | (k == hot_key if hot_key is not None else False)
                if not big.all():
                    got = _compare(k[~big], cls[~big], ctx[~big])
            if len(rest[0]) > hot:  # streamed on: the group isn't kept in memory
                hot_key = rest[0][0]
                rest = tuple(x[:0] for x in rest)
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], names=["a", "b"])
            return rest

        rows = 0
        for b in batches:
            if b.num_rows:
                held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
                rows += b.num_rows
            if rows > 60_000:
                rest = yield from flush(held, False)
                held, rows = ([rest] if len(rest[0]) else []), len(rest[0])
        if held:
            yield from flush(held, True)

    return run


def meetings(lm: DataFrame) -> DataFrame:
    """lm (k, cls, ctx), one row per passage -> (a, b): classes that meet at an anchor."""
    return lm.select("k", "cls", "ctx").repartition("k").sortWithinPartitions("k").mapInArrow(_meet(HOT), _MEET)


def featured(texts: DataFrame, work: Work, name: str = "features", keep=("tbl", "id"), passages: bool = True) -> DataFrame:
    """texts with columns keep and text -> written table with cls (per tbl), n_words, grams, passages."""
    f = features(texts, list(keep), "text", passages)
    scope = [c for c in keep if c == "tbl"]
    f = f.withColumn("cls", F.xxhash64(*scope, "cls"))
    if passages:
        f = f.withColumn("row", F.monotonically_increasing_id())
        f = f.withColumn("passages", F.transform("passages", lambda p: F.struct(F.xxhash64(*scope, p["key"]).alias("key"), p["ctx"].alias("ctx"))))
    return work.table(f, name)


def one_each(f: DataFrame, work: Work) -> DataFrame:
    """f (tbl, cls, grams, row) with the first row of each class only: the other rows' numbers are taken out, so the
    sequences themselves aren't shuffled where these are few."""
    first = f.groupBy("cls").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").select("cls", "first")
    more = work.table(f.select("cls", "row").join(work.table(first, "firsts"), "cls").where("row > first").select("row"), "more")
    return f.select("tbl", "cls", "grams", "row").join(more, "row", "left_anti").drop("row")


def near_classes(f: DataFrame, work: Work) -> DataFrame:
    """Exactly near pairs (cls_a, cls_b) of different classes among the featured texts."""
    texts = one_each(f.where("n_words >= 3"), work)
    pairs = meetings(f.where("n_words >= 3").select("cls", F.inline("passages")).withColumnRenamed("key", "k"))
    for i, (tbl, n) in enumerate(sorted(texts.groupBy("tbl").count().collect())):
        own = texts.where(F.col("tbl") == tbl)
        met = lookup(own, own, order(frequencies(own, n)), work, f"p1-{i}")
        pairs = pairs if met is None else pairs.unionByName(met)
    return apart(f, checked(work.table(pairs.distinct(), "pairs"), texts, work), work)


def checked(pairs: DataFrame, texts: DataFrame, work: Work) -> DataFrame:
    """The pairs (a, b) whose three-word sequences overlap by at least 0.6 of either set."""
    need = work.table(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "need")  # written: its size is known before the join
    grams = work.table(texts.select("cls", "grams").join(need, "cls", "left_semi"), "needed")
    left = pairs.join(grams.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a")
    both = left.join(grams.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b")
    sizes = (F.size(F.array_intersect("ga", "gb")).alias("common"), F.least(F.size("ga"), F.size("gb")).alias("least"), F.greatest(F.size("ga"), F.size("gb")).alias("most"))
    return work.table(both.select(F.col("a").alias("cls_a"), F.col("b").alias("cls_b"), *sizes).where("common * 10 >= least * 6"), "near")


def _is_stock(sets: list[np.ndarray], core: np.ndarray) -> bool:
    """Whether texts with this core are otherwise different: it is less than MOSTLY of most of them, and what they
    have besides is not shared either (copies with many edits have a small core, but share much besides in pairs)."""
    if np.median([len(np.intersect1d(x, core, True)) / max(1, len(x)) for x in sets]) >= MOSTLY:
        return False
    rest = [np.setdiff1d(x, core, True) for x in sets]
    shares = [len(np.intersect1d(x, y, True)) / min(len(x), len(y)) if len(x) and len(y) else 1.0 for x, y in combinations(rest, 2)]
    return np.median(shares) < STRANGE


def _cores(batches):
    """(key, held): the sets of sequences of HOLDERS texts -> (key, core) if they are a stock passage."""
    for b in batches:
        key, out = [], []
        for s, held in zip(b.column(0).to_pylist(), b.column(1)):
            sets = [x.values.to_numpy() for x in held]
            g, n = np.unique(np.concatenate(sets), return_counts=True)
            core = g[n >= CORE]
            if _is_stock(sets, core):
                key.append(s)
                out.append(core)
        off = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
        flat = np.concatenate(out) if out else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.ListArray.from_arrays(off, pa.array(flat, pa.int32()))], names=["key", "core"])


def stock(f: DataFrame, pairs: DataFrame, texts: DataFrame, work: Work) -> DataFrame:
    """pairs (cls_a, cls_b) -> (cls_a, cls_b, core): the stock passage of those pairs that have one in common.

    Of the passages (eight words) both texts have, the one with most holders is looked at through HOLDERS of them,
    chosen by a hash: what CORE of them have in common is its core. In a group of copies the core is most of each
    text, or the texts share much besides it; where neither holds, they are different texts with a passage in common."""
    ids = work.table(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "unlike")
    held = f.select("cls", F.array_distinct("passages.key").alias("keys")).join(ids, "cls", "left_semi").dropDuplicates(["cls"]).select("cls", F.explode("keys").alias("key"))
    held = work.table(held, "held")
    often = held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= HOLDERS)
    often = work.table(held.join(often, "key").groupBy("cls").agg(F.collect_list(F.struct("n", "key")).alias("often")), "often")
    x = pairs.join(often.select(F.col("cls").alias("cls_a"), F.col("often").alias("oa")), "cls_a").join(often.select(F.col("cls").alias("cls_b"), F.col("often").alias("ob")), "cls_b")
    most = work.table(x.select("cls_a", "cls_b", F.array_max(F.array_intersect("oa", "ob"))["key"].alias("key")).where("key is not null"), "most")
    first = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(1), "cls"), "cls")
    few = held.join(most.select("key").distinct(), "key", "left_semi").withColumn("r", F.row_number().over(first)).where(f"r <= {HOLDERS}").select("key", "cls")
    cores = work.table(few, "few").join(texts.select("cls", "grams"), "cls").groupBy("key").agg(F.collect_list("grams").alias("held")).mapInArrow(_cores, "key bigint, core array<int>")
    return most.join(work.table(cores, "cores"), "key").select("cls_a", "cls_b", "core")


def apart(f: DataFrame, near: DataFrame, work: Work) -> DataFrame:
    """near (cls_a, cls_b, common, least, most) without the pairs that have only a stock passage in common. Pairs that
    share ALIKE of the larger text aren't looked at: they have hardly anything that is not shared."""
    texts = work.spark.read.schema("cls bigint, grams array<int>").parquet(work.path("needed"))
    unlike = near.where(F.col("common") < ALIKE * F.col("most")).select("cls_a", "cls_b")
    s = work.table(stock(f, unlike, texts, work), "stock")
    grams = texts.join(work.table(s.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "touched"), "cls", "left_semi")
    x = s.join(grams.select(F.col("cls").alias("cls_a"), F.col("grams").alias("ga")), "cls_a").join(grams.select(F.col("cls").alias("cls_b"), F.col("grams").alias("gb")), "cls_b")
    x = x.select("cls_a", "cls_b", F.array_except("ga", "core").alias("ra"), F.array_except("gb", "core").alias("rb"))
    own = F.size(F.array_intersect("ra", "rb"))
    gone = x.where((own == 0) | (own < OWN * F.least(F.size("ra"), F.size("rb")))).select("cls_a", "cls_b")
    return work.table(near.select("cls_a", "cls_b", "common", "most").join(work.table(gone, "gone"), ["cls_a", "cls_b"], "left_anti"), "kept")


def _left(words: list[str], common: set) -> list[list[str]]:
    """Runs of words that are in no common sequence."""
    held = bytearray(len(words))
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if w in common:
            held[i : i + 3] = b"\1\1\1"
    return [[words[i] for i in run] for h, run in groupby(range(len(words)), held.__getitem__) if not h]


def some_passages(a: str, b: str) -> bool:
    """Whether texts share only some passages: both have passages of their own besides. A passage of its own is a run of
    RUN words in no common sequence, most of which don't occur in what the other text doesn't share either: where words
    are edited one by one, the words between them do. A text that stands within a longer one has none."""
    x, y = WORD.findall(a.lower()), WORD.findall(b.lower())
    common = set(zip(x, x[1:], x[2:])) & set(zip(y, y[1:], y[2:]))
    left, right = _left(x, common), _left(y, common)
    for words, runs, others in ((x, left, right), (y, right, left)):
        there = set(chain.from_iterable(others))
        own = sum(len(r) for r in runs if len(r) >= RUN and 2 * sum(w in there for w in r) < len(r))
        if own < max(FEWEST, REPLACED * len(words)):
            return False
    return True


def _parted(batches):
    for b in batches:
        gone = [some_passages(x.as_py(), y.as_py()) for x, y in zip(b.column(2), b.column(3))]
        yield b.select([0, 1]).filter(pa.array(gone, pa.bool_()))


def parted(texts: DataFrame, f: DataFrame, near: DataFrame, work: Work) -> DataFrame:
    """near (cls_a, cls_b, common, most) without the pairs that share only some passages, told by the words of one text of
    each class. As in apart, pairs that share ALIKE of the larger text aren't looked at."""
    pairs = work.table(near.where(F.col("common") < ALIKE * F.col("most")).select("cls_a", "cls_b"), "doubtful")
    need = work.table(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "doubted")
    ids = f.where("id is not null").join(need, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("tbl", "id")).alias("one")).select("cls", "one.*")
    held = work.table(texts.join(work.table(ids, "ones"), ["tbl", "id"]).select("cls", "text"), "words")
    x = pairs.join(held.select(F.col("cls").alias("cls_a"), F.col("text").alias("ta")), "cls_a").join(held.select(F.col("cls").alias("cls_b"), F.col("text").alias("tb")), "cls_b")
    gone = work.table(x.select("cls_a", "cls_b", "ta", "tb").mapInArrow(_parted, "cls_a bigint, cls_b bigint"), "parted")
    return near.select("cls_a", "cls_b").join(gone, ["cls_a", "cls_b"], "left_anti")


def tables(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts of both tables: (tbl, id, text)."""
    docs = spark.read.parquet(f"{sf}/core_documents.parquet").select(F.lit("core_documents").alias("tbl"), "id", F.col("clean_content").alias("text"))
    chunks = spark.read.parquet(f"{sf}/core_chunks.parquet").select(F.lit("core_chunks").alias("tbl"), "id", F.col("chunk_text").alias("text"))
    return docs.unionByName(chunks)


def _members(f: DataFrame) -> DataFrame:
    return f.where("n_words >= 3 and id is not null").groupBy("tbl", "id").agg(F.first("cls").alias("cls"))


def found(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(tbl, id_a, id_b) of near texts of one table, id_a < id_b."""
    work = Work(spark, "p1")
    f = featured(texts, work)
    near = parted(texts, f, near_classes(f, work), work)
    members = work.table(_members(f), "members")
    classes = members.groupBy("cls").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    shared = members.join(classes.where("copies > 1"), "cls")
    small = shared.where(f"copies <= {CLASS_PAIRS}").select("tbl", "cls", "id")
    copies = small.alias("x").join(small.alias("y"), F.expr("x.cls = y.cls and x.id < y.id")).selectExpr("x.tbl as tbl", "x.id as id_a", "y.id as id_b")
    star = shared.where(f"copies > {CLASS_PAIRS} and id > least").selectExpr("tbl", "least as id_a", "id as id_b")
    # in classes of many copies the least id stands for all in pairs with other classes
    stand = members.join(classes, "cls").where(f"copies <= {CLASS_PAIRS} or id = least").select("tbl", "cls", "id")
    cross = (
        near.join(stand.select("tbl", F.col("cls").alias("cls_a"), F.col("id").alias("p")), "cls_a")
        .join(stand.select(F.col("cls").alias("cls_b"), F.col("id").alias("q")), "cls_b")
        .select("tbl", F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b"))
    )
    return copies.unionByName(star).unionByName(cross)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return found(spark, tables(spark, sf))
