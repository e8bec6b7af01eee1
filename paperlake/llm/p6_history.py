"""Problem 6: new batches checked against everything accepted before, without a pass over the stored texts.

``History`` is a persisted inverted file under one folder. A text's vector is its set of three-word sequences, in a
fixed order from rare to frequent:
* ``cells``: vectors of up to CELL texts each, texts with a common least hash side by side; a cell is one row that holds
  its full vectors as an inverted list (sequences in rising order, with the text each belongs to), and, in columns read by
  themselves, its bounds: bitmaps of all its sequences and of those in its texts' prefixes,
* ``keys`` (partitioned by bucket): content hashes, source records and texts (as word sequences) of accepted rows,
* ``order``: the order of sequences, made at the start and never changed (any order is right, this one is fast).

The bound of the probing: two texts are near if they share 0.6 of the smaller one's n sequences. If a text has
fewer than k of the n - ceil(0.6 n) + k rarest sequences of the smaller one (its prefix), the two can't be near. So a new
text looks up its prefix for larger texts, and all its sequences among the prefixes for smaller ones. The bitmaps tell
first in how many of them a cell can share at all: cells in which no text of the batch can reach k aren't read. In the
other cells the hits are counted text by text, and what has enough of them is compared exactly on the full vectors, in
the same task. Nothing is shuffled but near pairs. Accepted texts are appended as new cells.

Candidates are decided in the order of batch_no and candidate_id: a candidate has a reason if it matches a row
of the core or an earlier candidate without a reason. Batches go one after the other (small ones together, up to AT_ONCE rows,
which gives the same); the accepted rows of each are appended. The links within a batch are resolved in rounds, each deciding all whose earlier links are decided; keys shared
by many rows are resolved by their first accepted row, not by pairs.

Repeated candidates count once. Null, empty and blank texts, hashes and ids match nothing. A null batch_no is the last.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .p1_neardup import featured
from .p4_splits import source_key
from .sequences import frequencies, needed, order, ranks
from .work import Work

CELL, CELL_KEYS = 4096, 1 << 21  # texts and sequences of a cell, at most (a longer text is a cell of its own)
BUCKET = 1 << 16  # keys of a bucket when the history is made
BITS = 19  # of a bitmap: 64 KB
BLOCK = 1 << 22  # sequences (16 MB) of the part of a batch that is looked up at once
AT_ONCE = 8192  # rows of consecutive batches that are decided in one call, about: the order of rows decides, so nothing changes
FEW = 1000  # so many cells are named to the reader; more are picked by a join
COUNTERS = 1 << 18  # counters of hits at once: 4 MB
MEET = 8  # sequences of a prefix that must be shared: more make longer prefixes with more hits, and fewer pairs to compare
LAST = 2147483647
CELL_SCHEMA = "cell bigint, cls array<bigint>, n array<int>, keys binary, at binary"
BOUND_SCHEMA = "cell bigint, least int, full binary, rare binary"
ROWS = ["source", "source_id", "content_hash", "clean_content"]


def hash_key(c: Column) -> Column:
    x = F.lower(F.trim(c))
    return F.when(F.length(x) > 0, F.xxhash64(F.lit("h"), x))


def record_key(source: Column, source_id: Column) -> Column:
    k = source_key(source, source_id)
    return F.when(k.isNotNull(), F.xxhash64(F.lit("s"), k))


def once(f: DataFrame, key: str, work: Work, name: str) -> DataFrame:
    """The first row of each key. Only keys and numbers of rows are shuffled; the rows beyond are taken out by their number."""
    first = f.groupBy(key).agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").select(key, "first")
    first = work.table(first, f"{name}-first")
    more = work.table(f.select(key, "row").join(first, key).where("row > first").select("row"), f"{name}-more")
    return f.join(more, "row", "left_anti")


def prepared(df: DataFrame, ident: str, work: Work, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """From a written table: keep, who, hash, record, row, cls (null under three words), grams; each ident once."""
    x = df.where(F.col(ident).isNotNull()).select(
        *keep,
        F.col(ident).alias("who"),
        hash_key(F.col("content_hash")).alias("hash"),
        record_key(F.col("source"), F.col("source_id")).alias("record"),
        F.monotonically_increasing_id().alias("row"),
        F.col("clean_content").alias("text"),
    )
    f = featured(x, work, name, keep=(*keep, "who", "hash", "record", "row"), passages=False)
    return once(f.withColumn("cls", F.when(F.col("n_words") >= 3, F.col("cls"))).drop("n_words"), "who", work, name)


def resolved(rows: DataFrame, links: DataFrame, work: Work) -> DataFrame:
    """rows (who, ord, decided) and links (who, tie, hub): decided is true for rows with a reason from the history.

    A tie's hub rows reject all later rows of the tie once accepted. Returns (who, accepted)."""
    state = rows.select("who", "ord", F.when(F.col("decided"), F.lit(0)).otherwise(F.lit(None).cast("int")).alias("state"))
    k = 0
    while True:
        k += 1
        x = links.join(state, "who")
        first = x.groupBy("tie").agg(
            F.min(F.when(F.col("hub") & (F.col("state") == 1), F.col("ord"))).alias("accepted"),
            F.min(F.when(F.col("hub") & F.col("state").isNull(), F.col("ord"))).alias("open"),
        )
        y = x.where("state is null").join(first, "tie")
        y = y.groupBy("who").agg(F.max(F.coalesce(F.col("accepted") < F.col("ord"), F.lit(False))).alias("hit"), F.max(F.coalesce(F.col("open") < F.col("ord"), F.lit(False))).alias("wait"))
        new = state.join(y, "who", "left").select("who", "ord", F.when(F.col("state").isNotNull(), F.col("state")).when(F.coalesce("hit", F.lit(False)), F.lit(0)).when(F.coalesce("wait", F.lit(False)), F.lit(None).cast("int")).otherwise(F.lit(1)).alias("state"))
        left = Observation()
        new = new.observe(left, F.count_if(F.col("state").isNull()).alias("n"))
        state = work.table(new, f"state{k}")
        work.drop(f"state{k - 1}")
        if not left.get["n"]:
            return state.select("who", (F.col("state") == 1).alias("accepted"))


def _pruned(df: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """df without the partitions of buckets that are not wanted; their list is at most buckets long."""
    mine = [r[0] for r in wanted.select("bucket").distinct().collect()]
    return df if len(mine) == buckets else df.where(F.col("bucket").isin(mine) if mine else F.lit(False))


def _bits(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS, bool)
    out[keys & ((1 << BITS) - 1)] = True
    return out


class Batch:
    """Vectors of a batch's texts (or a block of them), ready to be looked up: cls, n and need of each text, the sequences of
    all, and which of them belong to a prefix. What is sent is that alone; each worker numbers its distinct sequences once."""

    def __init__(self, cls, n, row, keys, place):
        self.cls, self.n, self.need, self.keys = cls, n, needed(n, MEET), keys
        self.prefix = place < (n - (n * 6 + 9) // 10 + self.need)[row]

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("cls", "n", "need", "keys", "prefix")}

    @cached_property
    def start(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n)])

    @cached_property
    def row(self) -> np.ndarray:
        """The text of each sequence."""
        return np.repeat(np.arange(len(self.n), dtype=np.int32), self.n)

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct sequences in rising order, and the number of each sequence among them."""
        one, number = np.unique(self.keys, return_inverse=True)
        return one, number.astype(np.int32)

    def reachable(self, least: int, full: np.ndarray, rare: np.ndarray) -> bool:
        """Whether a cell with these bitmaps can hold a text near to one of these."""
        at = self.keys & ((1 << BITS) - 1)
        large = np.bincount(self.row[self.prefix], full[at[self.prefix]], len(self.n)) >= self.need
        return bool(large.any() or (np.bincount(self.row, rare[at], len(self.n)) >= least).any())

    def near(self, cls, n, keys, at):
        """Pairs (text of this, text of the cell) with enough hits and near in full; at: text of the cell and, in its
        highest bit, whether the sequence belongs to its prefix."""
        rare, text = at >> 15 == 1, at & 0x7FFF
        need = needed(n, MEET)
        order = first = None
        for larger, mine, theirs, here in ((True, self.prefix, keys, text), (False, None, keys[rare], text[rare])):
            for i, j, hits in self._hits(mine, theirs, here, len(cls), int((self.need if larger else need).min(initial=MEET))):
                ok = (hits >= (self.need[i] if larger else need[j])) & ((n[j] >= self.n[i]) == larger) & (self.cls[i] != cls[j])
                if not ok.any():
                    continue
                if order is None:
                    order = np.argsort(text, kind="stable")
                    first = np.searchsorted(text[order], np.arange(len(cls) + 1))
                for x, y in zip(i[ok], j[ok]):
                    common = len(np.intersect1d(self.keys[self.start[x] : self.start[x + 1]], keys[order[first[y] : first[y + 1]]], True))
                    if common * 10 >= min(self.n[x], n[y]) * 6:
                        yield self.cls[x], cls[y]

    def _hits(self, mine, keys, text, size, least):
        """(text of this, text of the cell, hits) of the pairs that have at least least sequences in common, of all of this or
        only those in the mask mine, and of the cell's keys (in rising order, text: the text of each). Counters are for so
        few texts at once that they stay in the processor's cache."""
        one, number = self.distinct
        left = np.searchsorted(keys, one, "left").astype(np.int32)
        m = np.searchsorted(keys, one, "right").astype(np.int32) - left
        found = m[number] > 0
        found = np.flatnonzero(found if mine is None else found & mine)
        row, number = self.row[found], number[found]
        step = max(1, COUNTERS // max(1, size))
        cut = np.searchsorted(row, np.arange(0, len(self.n) + step, step))
        for lo, begin, end in zip(range(0, len(self.n), step), cut, cut[1:]):
            if begin == end:
                continue
            base = (row[begin:end] - lo).astype(np.int64) * size
            w = m[number[begin:end]]
            first = left[number[begin:end]]
            ends = np.cumsum(w, dtype=np.int64)
            out, k = None, 0
            while k < len(w):  # in parts, so that many hits don't fill the memory
                stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + 8_000_000, "right")))
                part = w[k:stop]
                j = np.arange(part.sum()) - np.repeat(ends[k:stop] - part - (ends[k - 1] if k else 0) - first[k:stop], part)
                hits = np.bincount(np.repeat(base[k:stop], part) + text[j], minlength=step * size)
                out = hits if out is None else out + hits
                k = stop
            at = np.flatnonzero(out >= least)
            if len(at):
                yield at // size + lo, at % size, out[at]


def cells(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """texts (cls, grams), each cls once -> rows of CELL_SCHEMA and BOUND_SCHEMA. Texts come sorted by their least hash."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def row(cls, lists):
        n = np.array([len(x) for x in lists], np.int64)
        g = np.concatenate(lists)
        r, place = ranks(n, g, shared.value)
        need = needed(n, MEET)
        rare = place < (n - (n * 6 + 9) // 10 + need)[r]
        o = np.lexsort((r, g))
        at = (r | rare.astype(np.int64) << 15).astype(np.uint16)[o]
        cell = int(np.bitwise_xor.reduce(cls) >> 1)
        cols = [[cell], [cls.tolist()], [n.tolist()], [g[o].tobytes()], [at.tobytes()], [int(need.min())], [np.packbits(_bits(g)).tobytes()], [np.packbits(_bits(g[rare])).tobytes()]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["cell", "cls", "n", "keys", "at", "least", "full", "rare"])

    def run(batches):
        cls, lists, total = [], [], 0
        for b in batches:
            for c, x in zip(b.column(0).to_pylist(), b.column(1)):
                g = x.values.to_numpy()
                if cls and (len(cls) >= CELL or total + len(g) > CELL_KEYS):
                    yield row(np.array(cls), lists)
                    cls, lists, total = [], [], 0
                cls.append(c)
                lists.append(g)
                total += len(g)
        if cls:
            yield row(np.array(cls), lists)

    return texts.select("cls", "grams").mapInArrow(run, f"{CELL_SCHEMA}, {BOUND_SCHEMA.split(', ', 1)[1]}")


class History:
    """The kept inverted file: create it from accepted rows, then check and append batch by batch.

    Rows need id, source, source_id, content_hash and clean_content. Tables are appended to, never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.shared: list = []  # broadcasts of the call that is running

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def setup(self) -> tuple[int, np.ndarray]:
        """The number of buckets and the order of sequences, fixed when the history was made."""
        if not hasattr(self, "_setup"):
            n = self.spark.read.parquet(f"{self.path}/size").first()[0]
            self._setup = n, order(self._read("order", "w int, m bigint"))
        return self._setup

    def _append(self, texts: DataFrame, keys: DataFrame) -> None:
        """texts (cls, grams), each cls once, as new cells; near texts, with the same least hash, stand together."""
        n = -(-max(1, texts.count()) // CELL)
        least = texts.select("cls", "grams", F.array_min("grams").alias("_least"))
        sorted_ = least.repartitionByRange(n, "_least", "cls").sortWithinPartitions("_least", "cls") if n > 1 else least.coalesce(1)
        cells(sorted_, self.setup()[1]).write.mode("append").option("parquet.block.size", 1 << 24).parquet(f"{self.path}/cells")
        keys.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")

    def _ties(self, f: DataFrame) -> DataFrame:
        x = f.select(F.explode(F.array("hash", "record", "cls")).alias("tie")).where("tie is not null").distinct()
        return x.select("tie", F.pmod("tie", F.lit(self.setup()[0])).cast("int").alias("bucket"))

    def create(self, rows: DataFrame) -> None:
        work = Work(self.spark, "p6-create")
        f = prepared(rows.select("id", *ROWS), "id", work, "rows")
        n = f.count()
        self.spark.createDataFrame([(max(1, -(-3 * n // BUCKET)),)], "buckets int").write.parquet(f"{self.path}/size")
        frequencies(f, n).write.parquet(f"{self.path}/order")
        texts = once(f.where("cls is not null").select("cls", "grams", "row"), "cls", work, "cls").select("cls", "grams")
        self._append(texts, self._ties(f))
        work.drop("rows")

    def check(self, batch: DataFrame) -> DataFrame:
        """(id, reason) of the batch's rows that repeat the history or an earlier accepted row of the batch; the
        accepted ones are appended."""
        work = Work(self.spark, "p6-rows")
        return self.decide(prepared(batch.select("id", *ROWS), "id", work, "rows")).withColumnRenamed("who", "id")

    def _blocks(self, texts: DataFrame):
        """The texts (cls, grams) as Batch objects of at most BLOCK sequences, about."""
        total = texts.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
        parts = -(-total // BLOCK)
        for i in range(parts):
            t = (texts.where(F.pmod(F.xxhash64("cls"), F.lit(parts)) == i) if parts > 1 else texts).toArrow().combine_chunks()
            if t.num_rows:
                lists = t["grams"].combine_chunks()
                n, g = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
                row, place = ranks(n, g, self.setup()[1])
                yield Batch(t["cls"].to_numpy(), n, row, g, place)

    def reached(self, shared) -> DataFrame:
        """(cell): the cells of the history that can hold a text near to one of the batch."""

        def run(batches):
            for b in batches:
                full, rare = ([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8)).view(bool) for x in b.column(k)] for k in (2, 3))
                keep = [shared.value.reachable(least, f, r) for least, f, r in zip(b.column(1).to_pylist(), full, rare)]
                yield b.filter(pa.array(keep, pa.bool_())).select(["cell"])

        return self._read("cells", BOUND_SCHEMA).mapInArrow(run, "cell bigint")

    def near(self, texts: DataFrame, own: DataFrame) -> DataFrame | None:
        """texts (cls, grams) of a batch and their cells -> (a, b): near texts, a of the batch, b of the history or the batch."""
        out = None
        for block in self._blocks(texts):
            shared = self.spark.sparkContext.broadcast(block)
            self.shared.append(shared)

            def run(batches, shared=shared):
                for b in batches:
                    pairs = []
                    for i in range(b.num_rows):
                        cls, n = (b.column(k)[i].values.to_numpy() for k in (1, 2))
                        keys, at = (np.frombuffer(b.column(k)[i].as_buffer(), t) for k, t in ((3, np.int32), (4, np.uint16)))
                        pairs += shared.value.near(cls, n.astype(np.int64), keys, at)
                    a, c = zip(*pairs) if pairs else ((), ())
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

            which = [r[0] for r in self.reached(shared).orderBy("cell").limit(FEW + 1).collect()]  # one job, unlike a limit alone
            old = self._read("cells", CELL_SCHEMA)
            if len(which) > FEW:
                old = old.join(self.reached(shared), "cell", "left_semi").select("cell", "cls", "n", "keys", "at")
            else:
                old = old.where(F.col("cell").isin(which) if which else F.lit(False))
            met = old.unionByName(own).mapInArrow(run, "a bigint, b bigint")
            out = met if out is None else out.unionByName(met)
        if out is None:
            return None
        return out.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*").distinct()

    def decide(self, f: DataFrame) -> DataFrame:
        """check for prepared rows f (who, hash, record, cls, grams, and ord where their order isn't that of who) ->
        (who, reason), a written table."""
        work = Work(self.spark, "p6-batch")
        f = f if "ord" in f.columns else f.withColumn("ord", F.col("who"))
        texts = once(f.where("cls is not null").select("cls", "grams", "row"), "cls", work, "cls").select("cls", "grams")
        own = work.table(cells(texts, self.setup()[1]).select("cell", "cls", "n", "keys", "at"), "own")
        one = f.select("who", "ord", "hash", "record", "cls")
        why = [("content_hash", "hash"), ("source_id", "record"), ("near_text", "cls")]
        links = one.select("who", "ord", F.inline(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(c).alias("tie")) for r, c in why]))).where("tie is not null").withColumn("hub", F.lit(True))
        pairs = self.near(texts, own)
        if pairs is not None:
            # a row of class a is rejected by rows of class b: the tie of b has the row as one that is no hub
            links = links.unionByName(one.select("who", "ord", F.col("cls").alias("a")).join(pairs, "a").select("who", "ord", F.lit("near_text").alias("reason"), F.col("b").alias("tie"), F.lit(False).alias("hub")))
        links = links.distinct().withColumn("bucket", F.pmod("tie", F.lit(self.setup()[0])).cast("int"))
        links = work.table(links, "links")
        for b in self.shared:
            b.destroy()
        self.shared = []
        keys = _pruned(self._read("keys", "tie bigint, bucket int"), links, self.setup()[0])
        hits = work.table(links.join(keys, ["bucket", "tie"], "left_semi").select("who", "reason").distinct(), "hits")
        rows = one.select("who", "ord").join(hits.select("who").distinct().withColumn("decided", F.lit(True)), "who", "left").withColumn("decided", F.coalesce("decided", F.lit(False)))
        accepted = resolved(rows, links.select("who", "tie", "hub"), work)
        # reasons of the rejected: the first accepted row of the tie came earlier
        x = links.join(accepted, "who")
        first = x.where("hub and accepted").groupBy("tie").agg(F.min("ord").alias("first"))
        reasons = work.table(hits.unionByName(x.join(first, "tie").where("first < ord").select("who", "reason")).distinct(), "reasons")
        new = work.table(one.join(accepted.where("accepted"), "who", "left_semi").select("hash", "record", "cls"), "accepted")
        self._append(texts.join(new.select("cls").distinct(), "cls", "left_semi"), self._ties(new))
        work.drop("own", "links", "hits", "accepted")
        return reasons


def batches(core: DataFrame, candidates: DataFrame, path: str, work: Work) -> DataFrame:
    """core (id, ...) and candidates (candidate_id, batch_no, ...) -> (candidate_id, reason), through a history at path."""
    spark = core.sparkSession
    history = History(spark, path)
    history.create(core)
    cand = candidates.select("candidate_id", F.coalesce("batch_no", F.lit(LAST)).alias("turn"), *ROWS)
    f = prepared(cand, "candidate_id", work, "candidates", ("turn",))
    f = f.withColumn("ord", F.struct("turn", "who"))
    sizes = [tuple(r) for r in f.groupBy("turn").count().orderBy("turn").collect()]  # one row a batch
    out, first, held = spark.createDataFrame([], "who bigint, reason string"), None, 0
    for k, (turn, n) in enumerate(sizes):
        first, held = (turn, n) if first is None else (first, held + n)
        if held + (sizes[k + 1][1] if k + 1 < len(sizes) else AT_ONCE) > AT_ONCE:
            out = out.unionByName(history.decide(f.where(F.col("turn").between(first, turn)).drop("turn")))
            first = None
    return out.withColumnRenamed("who", "candidate_id")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """(candidate_id, reason)."""
    work = Work(spark, "p6")
    core, cand = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("core_documents", "candidates"))
    return batches(core, cand, work.path("history"), work)
