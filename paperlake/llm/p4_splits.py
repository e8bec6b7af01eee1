"""Problem 4: train, validation and test splits that keep related records together.

Rows are tied by author, DOI and source record. Components are found by pointer jumping on a written table of
parents: every round each node takes the least root among its neighbours, then pointers are halved; only the
table moves between rounds. Joins with the root of a giant component have one row on the root's side, so the adaptive
engine can split the other side. The table of components is kept: new records are tied to the components they touch,
existing components keep their split, new ones fill the deficits, and a merge of components of different splits
is put into quarantine.

A tie that holds many rows costs one link for each (to the tie's least id), never a pair of rows.

Null ids are left out, repeated ids count once, null or empty authors and placeholders tie nothing. Rows without
ties are groups of their own. Ties of equal size are filled by group id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .work import Work

#: What stands for no author or no DOI, in lower case.
NO_AUTHOR = ["et al", "et al.", "anonymous", "anon", "anon.", "various authors", "various", "unknown", "unknown author", "n/a", "na", "none", "null", "-", "tbd", "staff", "author", "authors"]
NO_DOI = ["", "n/a", "na", "none", "null", "unknown", "-", "tbd"]


def author_key(a: Column) -> Column:
    """Given and family name without case, order, spacing and footnote marks; null for placeholders."""
    x = F.lower(F.trim(F.regexp_replace(a, r"[\s\u00a0\u2007\u202f]+", " ")))
    x = F.regexp_replace(x, r"\s*(?:\(\w{1,2}\)|\[\w{1,2}\]|[*†‡§¶#¹²³⁰-⁹]+|[\s,]\d{1,2}(?:,\d{1,2})*)+\s*$", "")
    none = x.isNull() | x.isin(NO_AUTHOR) | (F.length(x) < 2) | ~F.contains(F.translate(x, ",", " "), F.lit(" "))
    parts = F.array_sort(F.filter(F.split(F.translate(x, ",", " "), " +"), lambda p: F.length(p) > 0))
    return F.when(~none, F.array_join(parts, " "))


def doi_key(d: Column) -> Column:
    x = F.regexp_replace(F.lower(F.trim(d)), r"^(?:https?://(?:dx\.)?doi\.org/|doi:?\s*)+", "")
    x = F.trim(x)
    return F.when(~x.isin(NO_DOI) & x.rlike(r"^10\.\d{4,9}/\S+"), x)


def source_key(source: Column, source_id: Column) -> Column:
    """source and source_id without version, case, spaces and a leading name of the source."""
    s = F.lower(F.regexp_replace(source, r"\s+", ""))
    x = F.lower(F.regexp_replace(source_id, r"[\s\u00a0]+", ""))
    x = F.when(F.startswith(x, s), F.regexp_replace(F.substr(x, F.length(s) + 1), r"^[:\-_/]+", "")).otherwise(x)
    x = F.regexp_replace(x, r"v\d+$", "")
    return F.when((F.length(x) > 0) & (F.length(s) > 0), F.concat(s, F.lit("\x01"), x))


def ties(docs: DataFrame) -> DataFrame:
    """(id, tie): 64-bit keys of what each record can share."""
    h = lambda kind, c: F.when(c.isNotNull(), F.xxhash64(F.lit(kind), c))
    authors = F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: h("a", author_key(a)))
    keys = F.concat(authors, F.array(h("d", doi_key(F.col("doi"))), h("s", source_key(F.col("source"), F.col("source_id")))))
    return docs.where("id is not null").select("id", F.explode(F.array_distinct(F.array_compact(keys))).alias("tie"))


def components(links: DataFrame, work: Work, name: str = "c") -> DataFrame:
    """links (a, b), b < a -> (id, group_id): the least id of each connected component, of linked ids only.

    Rounds of hooking to the least neighbouring root and of pointer jumping, about the logarithm of the longest
    chain; each round is a written table."""
    both = work.table(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), f"{name}-links")
    parent = work.table(both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("id"), F.least("a", "p").alias("p")), f"{name}-0")
    k = 0
    while True:
        k += 1
        # jump: the parent's parent; hook: the least parent among the neighbours' parents, given to the own root too
        q = parent.select(F.col("id").alias("q"), F.col("p").alias("pp"))
        jumped = parent.join(q, F.col("p") == F.col("q")).select("id", F.col("pp").alias("p"))
        near = both.join(jumped.select(F.col("id").alias("b"), F.col("p").alias("bp")), "b").groupBy("a").agg(F.min("bp").alias("m")).withColumnRenamed("a", "id")
        low = jumped.join(near, "id").select("id", "p", F.least("p", "m").alias("m"))
        offers = low.select("id", F.col("m").alias("n")).union(low.select(F.col("p").alias("id"), F.col("m").alias("n")))
        new = offers.groupBy("id").agg(F.min("n").alias("p"))
        new = work.table(new, f"{name}-{k}")
        changed = new.join(parent.withColumnRenamed("p", "before"), "id").where("p <> before").limit(1).count()
        if k > 1:
            work.drop(f"{name}-{k - 2}")
        parent = new
        if not changed:
            return parent.select("id", F.col("p").alias("group_id"))


def grouped(docs: DataFrame, work: Work) -> DataFrame:
    """(id, group_id) of all records that share a group with another."""
    t = work.table(ties(docs).distinct(), "ties")
    least = t.groupBy("tie").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1").select("tie", "b")
    links = t.join(least, "tie").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    return components(links, work)


def assigned(groups: DataFrame, targets: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """groups (group_id, topic_axis, n), targets (split_name, target_share), old (group_id, split_name) ->
    (group_id, split_name).

    Within each axis new groups are laid in a hashed order along a line divided by the splits' deficits: a group goes to
    the split in whose interval its middle lies. Groups that hold more than BIG of their axis are put first, each to
    the split with the largest deficit left, so that small groups even out what they leave."""
    old_rows = groups.join(old, "group_id") if old is not None else groups.withColumn("split_name", F.lit(None).cast("string")).limit(0)
    new = groups.join(old_rows.select("group_id"), "group_id", "left_anti") if old is not None else groups
    totals = groups.groupBy("topic_axis").agg(F.sum("n").alias("axis_n"))
    had = old_rows.groupBy("topic_axis", "split_name").agg(F.sum("n").alias("had"))
    cells = totals.crossJoin(F.broadcast(targets)).join(had, ["topic_axis", "split_name"], "left").select("topic_axis", "split_name", F.greatest(F.lit(0.0), F.col("target_share") * F.col("axis_n") - F.coalesce("had", F.lit(0))).alias("want"))
    # the largest groups of an axis: at most 1 / BIG of them, so the table of them is bounded
    big = new.join(F.broadcast(totals), "topic_axis").where(F.col("n") >= BIG * F.col("axis_n")).orderBy(F.desc("n"), "group_id").collect()
    want = {(r.topic_axis, r.split_name): r.want for r in cells.collect()}
    placed = []
    for r in big:
        mine = [(w, s) for (a, s), w in want.items() if a == r.topic_axis]
        if mine:
            w, s = max(mine, key=lambda x: (x[0], x[1]))
            want[(r.topic_axis, s)] = w - r.n
            placed.append((r.group_id, s))
    spark = groups.sparkSession
    bigs = spark.createDataFrame(placed, "group_id long, split_name string")
    rest = new.join(F.broadcast(bigs.select("group_id")), "group_id", "left_anti")
    lines = []
    for axis in {a for a, _ in want}:
        part = sorted((s, max(0.0, w)) for (a, s), w in want.items() if a == axis)
        total = sum(w for _, w in part) or 1.0
        at = 0.0
        for s, w in part:
            lines.append((axis, s, at / total, (at + w) / total))
            at += w
    line = spark.createDataFrame(lines, "topic_axis string, split_name string, lo double, hi double")
    # The place of a group is what stands before its middle in a hashed order: sums over the hash's prefixes, and within a
    # prefix over its groups, so no axis is ordered in one task and the deficits are met to a group.
    hashed = rest.withColumn("h", F.xxhash64(F.lit(7), "group_id")).withColumn("p", F.pmod("h", F.lit(4096)))
    upto = Window.partitionBy("topic_axis").orderBy("p")
    sums = hashed.groupBy("topic_axis", "p").agg(F.sum("n").alias("k"))  # at most 4096 rows an axis
    sums = sums.select("topic_axis", "p", (F.sum("k").over(upto) - F.col("k")).alias("before"), F.sum("k").over(Window.partitionBy("topic_axis")).alias("total"))
    within = Window.partitionBy("topic_axis", "p").orderBy("h", "group_id").rowsBetween(Window.unboundedPreceding, 0)
    place = hashed.join(F.broadcast(sums), ["topic_axis", "p"]).withColumn("u", (F.col("before") + F.sum("n").over(within) - F.col("n") / 2) / F.col("total"))
    out = place.alias("g").join(F.broadcast(line).alias("l"), F.col("g.topic_axis").eqNullSafe(F.col("l.topic_axis")) & (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("group_id", "split_name")
    return old_rows.select("group_id", "split_name").unionByName(out).unionByName(bigs)


BIG = 0.002


class Kept:
    """The persisted table of components under one folder: ``records`` (id, group_id, split_name, topic_axis), ``ties`` (group_id,
    tie) and ``quarantine`` (id, splits). Batches are added; what is there keeps its group and split."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if p.getFileSystem(conf).exists(p) else self.spark.createDataFrame([], schema)

    def records(self) -> DataFrame:
        return self._read("records", "id bigint, group_id bigint, split_name string, topic_axis string")

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", "id bigint, splits array<string>")

    def add(self, docs: DataFrame, targets: DataFrame) -> None:
        """New records; ids that are there already, in quarantine too, are passed over."""
        work = Work(self.spark, "p4-add")
        kept = self.records()
        new = docs.join(kept.select("id").union(self.quarantine().select("id")), "id", "left_anti")
        rows, clash = added(kept, self._read("ties", "group_id bigint, tie bigint"), new, targets, work)
        rows = work.table(rows.select("id", "group_id", "split_name", "topic_axis"), "rows")
        found = work.table(ties(new).join(rows.select("id", "group_id"), "id").select("group_id", "tie").distinct(), "found")
        clash.write.mode("append").parquet(f"{self.path}/quarantine")
        found.write.mode("append").parquet(f"{self.path}/ties")
        rows.write.mode("append").parquet(f"{self.path}/records")
        work.drop("rows", "found")


def splits(docs: DataFrame, targets: DataFrame, work: Work) -> DataFrame:
    """(id, group_id, split_name) of every record, through a table of components made for it. A group counts to the axis of
    most of its rows."""
    kept = Kept(docs.sparkSession, work.path("kept"))
    kept.add(docs, targets)
    return kept.records().select("id", "group_id", "split_name")


def added(kept: DataFrame, kept_ties: DataFrame, docs: DataFrame, targets: DataFrame, work: Work) -> tuple[DataFrame, DataFrame]:
    """New records against the kept table (id, group_id, split_name, topic_axis) and its ties (group_id, tie).

    Returns the rows of the new records (id, group_id, split_name, topic_axis) and the quarantined ones (id,
    splits): those that would join groups of different splits."""
    t = ties(docs).distinct()
    new_nodes = t.select("tie", F.col("id").alias("node"))
    old_nodes = kept_ties.join(t.select("tie").distinct(), "tie", "left_semi").select("tie", (-F.col("group_id") - 1).alias("node")).distinct()
    nodes = work.table(new_nodes.unionByName(old_nodes), "nodes")
    least = nodes.groupBy("tie").agg(F.min("node").alias("b"))
    links = nodes.join(least, "tie").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    comp = work.table(components(links, work, "add"), "comp")
    known = comp.where("id < 0").select(F.col("group_id").alias("c"), (-F.col("id") - 1).alias("group_id"))
    known = known.join(kept.select("group_id", "split_name").distinct(), "group_id").groupBy("c").agg(F.collect_set("split_name").alias("splits"), F.min("group_id").alias("old_group"))
    ids = docs.where("id is not null").select("id", "topic_axis").dropDuplicates(["id"])
    mine = ids.join(comp, "id", "left").select("id", "topic_axis", F.coalesce("group_id", "id").alias("c")).join(known, "c", "left")
    clash = mine.where("size(splits) > 1").select("id", F.array_sort("splits").alias("splits"))
    joined = mine.where("size(splits) = 1").select("id", F.col("old_group").alias("group_id"), F.col("splits")[0].alias("split_name"), "topic_axis")
    least = mine.where("splits is null").groupBy("c").agg(F.min("id").alias("group_id"))
    fresh = work.table(mine.where("splits is null").join(least, "c").select("id", "group_id", F.coalesce("topic_axis", F.lit("")).alias("topic_axis")), "fresh")
    axis = F.max_by("topic_axis", F.struct("k", "topic_axis")).alias("topic_axis")
    sized = fresh.groupBy("group_id", "topic_axis").agg(F.count("*").alias("k")).groupBy("group_id").agg(axis, F.sum("k").alias("n"))
    before = kept.groupBy("group_id", "split_name", F.coalesce("topic_axis", F.lit("")).alias("topic_axis")).agg(F.count("*").alias("k")).groupBy("group_id", "split_name").agg(axis, F.sum("k").alias("n"))
    groups = work.table(sized.unionByName(before.select("group_id", "topic_axis", "n")), "all")
    placed = assigned(groups, targets, before.select("group_id", "split_name"))
    return joined.unionByName(fresh.join(placed, "group_id").select("id", "group_id", "split_name", "topic_axis")), clash


def p4_splits(spark: SparkSession, sf: str) -> DataFrame:
    """(id, group_id, split_name) of every core_documents row."""
    docs = spark.read.parquet(f"{sf}/core_documents.parquet").select("id", "source", "source_id", "doi", "authors", "topic_axis")
    return splits(docs, spark.read.parquet(f"{sf}/split_targets.parquet"), Work(spark, "p4s"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """(id, group_id) of the records that share their group with another, from the kept table of components."""
    rows = p4_splits(spark, sf).select("id", "group_id")
    many = rows.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id")
    return rows.join(many, "group_id").select("id", "group_id")
