"""Problem 5: statistics of each text and with them a verdict: prose, list, table or junk.

Gradient-boosted trees (written here with numpy, one set of trees per kind) are trained on the statistics of
a bounded sample of texts. The labels are weak: a rule on the shape of each line says of which kind most of a text is,
and only clear cases are used. The rule is no feature: the trees see statistics of the whole text and
the shares of its characters in lines with simple properties. The scores are calibrated by a temperature fitted on
every other of the examples in ``p5_holdout``, written and labelled by hand; the rest of them tests the model (see
``accuracy``), and none trains it. The verdict of a text is the likeliest kind.

The sample has about SAMPLE texts per table, at most twice as many, chosen by a hash of the id; the statistics of the rows
themselves cover every text in full. Null, empty and blank texts have zero statistics and no verdict. Repeated
ids count once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .p5_holdout import HOLDOUT

KINDS = ("prose", "list", "table", "junk")
SAMPLE = 4000
CLEAR = 0.7  # share of a text in lines of one kind, by the rule, that makes it a training example
COMMON = 100_000  # a longer list of common words is refused: it is broadcast
STATS = ["words", "mean_word", "symbol_ratio", "closed_lines", "common_share"]
_MARK = re.compile(r"^\s*(?:[-*•·–]|\(?\d{1,3}[.)]|\[\d{1,3}\]|[a-z]\))\s+\S")
_WORD = re.compile(r"(?<![\w+/=])[^\W\d_]+(?:['’-][^\W\d_]+)*(?![\w+/=])")
_CELL = re.compile(r"\s*[|;\t]\s*|,(?=\S)|\s{2,}")
_VALUE = re.compile(r"[-+]?\d[\d.,]*%?$|-$|n/a$|yes$|no$|ok$|[A-Z]{3}$|[a-z]{2}=\S+$|run=\d+$|[a-z]+(?:_[a-z]+)+$|-{3,}$|-+\+-+$")
_CLOSED = re.compile(r"[.!?:…][\"'”’)\]]*$")

def line_kinds(text: str, common: frozenset, known: frozenset) -> np.ndarray:
    """Characters of a text in lines that look like each of KINDS."""
    out = np.zeros(4)
    lines = [x for x in text.replace("\r", "\n").split("\n") if x.strip()]
    for k, line in enumerate(lines):
        s = line.strip()
        n = len(s)
        words = _WORD.findall(s)
        low = [w.lower() for w in words]
        letters = sum(map(len, words))
        com = sum(w in common for w in low) / max(1, len(low))
        tok = s.split()
        cells = [c for c in _CELL.split(s) if c]
        values = sum(bool(_VALUE.match(c.strip())) for c in cells) / max(1, len(cells))
        kn = sum(all(p in known for p in w.split("-")) for w in low) / max(1, len(low))
        if len(cells) >= 2 and values >= 0.7:
            kind = 2
        elif letters < 0.6 * (n - s.count(" ")) and not (_MARK.match(s) and kn > 0.5) and com < 0.12:
            kind = 3
        elif kn < 0.35 and com < 0.12 and not re.match(r"^\[\d+\]", s):
            kind = 3 if len(words) > 1 or n > 25 else 0
        elif _MARK.match(s):
            kind = 1 if com < 0.26 or len(tok) < 12 else 0
        elif com >= 0.12:
            kind = 0
        elif s.count(",") >= 2 and s.count(",") * 5 >= len(tok):
            kind = 1
        elif len(tok) <= 12 and not _CLOSED.search(s):
            # a lone short line is a heading, and a line that goes on is wrapped prose
            alone = len(lines) < 4 or sum(len(x.split()) for x in lines[max(0, k - 1) : k + 2]) > 30
            kind = 0 if alone else 1
        else:
            kind = 0
        out[kind] += n
    return out


MORE = ["digits", "letters", "known", "distinct", "tokens_a_line", "longest", "marked", "closed", "common", "unlettered", "unknown", "short_open", "commas", "delimited", "valued", "vowels", "mixed"]
FEATURES = len(STATS) + len(MORE)
_VOWEL = re.compile(r"[aeiouyäöüáéíóúàèâêô]", re.I)
_MIXED = re.compile(r"\d[A-Za-z]|[A-Za-z]\d|[a-z][A-Z]")


def stats(text: str | None, common: frozenset, known: frozenset) -> list[float]:
    """The five published statistics and MORE, the further features of the trees: ratios of the whole text, and shares
    of its characters in lines that have a mark, are closed, hold common words, few letters, few known words, are
    short and open, have many commas, have delimiters, have mostly values between them."""
    if not text or not text.strip():
        return [0.0] * FEATURES
    tok = text.split()
    lines = [x for x in text.replace("\r", "\n").split("\n") if x.strip()]
    share = [0.0] * 9
    words, letters, com, kn, closed, size = [], 0, 0, 0, 0, 0
    for line in lines:
        s = line.strip()
        w = [x.lower() for x in _WORD.findall(s)]
        words += w
        n = len(s)
        size += n
        t = len(s.split())
        lw = sum(map(len, w))
        letters += lw
        cw = sum(x in common for x in w)
        com += cw
        kw = sum(x in known or "-" in x and all(y in known for y in x.split("-")) for x in w)
        kn += kw
        end = bool(_CLOSED.search(s))
        closed += end
        cells = [c for c in _CELL.split(s) if c]
        commas = s.count(",")
        valued = len(cells) > 1 and sum(bool(_VALUE.match(c)) for c in cells) >= 0.6 * len(cells)
        for k, yes in enumerate((_MARK.match(s), end, cw >= 0.12 * max(1, len(w)) and cw, lw < 0.6 * (n - s.count(" ")), kw < 0.35 * max(1, len(w)), t <= 12 and not end, commas > 1 and commas * 5 >= t, len(cells) > 1, valued)):
            if yes:
                share[k] += n
    solid = sum(map(len, tok))
    digits = sum(c.isdigit() for c in text)
    return [
        float(len(tok)),
        solid / max(1, len(tok)),
        max(0.0, solid - letters - digits) / max(1, solid),
        closed / max(1, len(lines)),
        com / max(1, len(tok)),
        digits / max(1, solid),
        letters / max(1, solid),
        kn / max(1, len(words)),
        len(set(words)) / max(1, len(words)),
        len(tok) / max(1, len(lines)),
        float(max(map(len, tok))),
        *(x / max(1, size) for x in share),
        len(_VOWEL.findall(text)) / max(1, letters),
        len(_MIXED.findall(text)) / max(1, len(tok)),
    ]


class Boosted:
    """Softmax boosting of depth-3 trees on binned features."""

    def __init__(self, rounds: int = 25, depth: int = 3, rate: float = 0.3, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[list[tuple]] = []
        self.temperature = 1.0

    def _tree(self, x, g, h):
        """Nested (feature, cut, left, right) or a leaf value; x is binned."""

        def grow(rows, depth):
            value = float(-g[rows].sum() / (h[rows].sum() + 1.0))
            if depth == 0 or len(rows) < 20:
                return value
            best = (1e-6, None)
            base = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
            for f in range(x.shape[1]):
                gs = np.bincount(x[rows, f], g[rows], self.bins).cumsum()
                hs = np.bincount(x[rows, f], h[rows], self.bins).cumsum()
                gain = gs**2 / (hs + 1.0) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1.0) - base
                k = int(gain[:-1].argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k))
            if best[1] is None:
                return value
            f, k = best[1]
            left = x[rows, f] <= k
            if left.all() or not left.any():
                return value
            return (f, k, grow(rows[left], depth - 1), grow(rows[~left], depth - 1))

        return grow(np.arange(len(x)), self.depth)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(x.shape[1])]
        b = self.bin(x)
        score = np.zeros((len(x), len(KINDS)))
        onehot = np.eye(len(KINDS))[y]
        for _ in range(self.rounds):
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            trees = [self._tree(b, (p[:, k] - onehot[:, k]) * weight, np.maximum(p[:, k] * (1 - p[:, k]), 1e-6) * weight) for k in range(len(KINDS))]
            self.trees.append(trees)
            for k, t in enumerate(trees):
                score[:, k] += self.rate * self._value(t, b)
        return self

    def bin(self, x):
        return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(self.cuts)], axis=1).astype(np.int64)

    def _value(self, t, b):
        if not isinstance(t, tuple):
            return np.full(len(b), t)
        f, k, left, right = t
        return np.where(b[:, f] <= k, self._value(left, b), self._value(right, b))

    def scores(self, x):
        b = self.bin(x)
        return sum(self.rate * np.stack([self._value(t, b) for t in trees], axis=1) for trees in self.trees)

    def calibrate(self, x, y):
        """The temperature of least log loss on checked examples."""
        s = self.scores(x)

        def loss(t):
            z = s / t
            z = z - z.max(1, keepdims=True)
            return float(-(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(1))).mean())

        self.temperature = min(np.geomspace(0.05, 20, 120), key=loss)
        return self

    def probabilities(self, x):
        z = self.scores(x) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(texts: list[str], common: frozenset) -> tuple[Boosted, frozenset]:
    """Model and known words from a bounded sample of texts."""
    seen: dict[str, int] = {}
    for t in texts:
        for w in {p for w in _WORD.findall(t.lower()) for p in w.split("-")}:
            seen[w] = seen.get(w, 0) + 1
    least = max(2, len(texts) // 400)  # of the bounded sample
    # letters and pairs of letters are words only where they are common
    known = frozenset(w for w, n in seen.items() if n >= least and len(w) > 2) | common
    rule = np.array([line_kinds(t, common, known) for t in texts]).reshape(-1, len(KINDS))
    rule = rule / np.maximum(1.0, rule.sum(1, keepdims=True))
    clear = rule.max(1, initial=0) >= CLEAR
    x = np.array([stats(t, common, known) for t, ok in zip(texts, clear) if ok]).reshape(-1, FEATURES)
    y = rule[clear].argmax(1) if len(x) else np.zeros(0, int)
    if not len(x):
        x, y = np.zeros((1, FEATURES)), np.zeros(1, int)
    share = np.bincount(y, minlength=len(KINDS)) / len(y)
    model = Boosted().fit(x, y, 1 / np.sqrt(np.maximum(share[y], 1e-6)))
    held = HOLDOUT[::2]
    return model.calibrate(np.array([stats(t, common, known) for _, t in held]), np.array([KINDS.index(k) for k, _ in held])), known


def accuracy(model: Boosted, common: frozenset, known: frozenset) -> tuple[float, float]:
    """Shares of right verdicts on the examples that calibrated nothing: of the trees, and of the bare rule."""
    held = HOLDOUT[1::2]
    want = np.array([KINDS.index(k) for k, _ in held])
    trees = model.probabilities(np.array([stats(t, common, known) for _, t in held])).argmax(1)
    rule = np.array([line_kinds(t, common, known) for _, t in held]).argmax(1)
    return float((trees == want).mean()), float((rule == want).mean())


def tables(spark: SparkSession, sf: str) -> DataFrame:
    """(tbl, rec_id, text); of chunks the retrieval text without its lines of title and heading."""
    docs = spark.read.parquet(f"{sf}/core_documents.parquet").select(F.lit("core_documents").alias("tbl"), F.col("id").alias("rec_id"), F.col("clean_content").alias("text"))
    chunks = spark.read.parquet(f"{sf}/core_chunks.parquet").select("id", "retrieval_text", "section_heading", F.length("chunk_text").alias("n"))
    rest = F.substring_index("retrieval_text", "\n", 1)
    after_title = F.substring(F.col("retrieval_text"), F.length(rest) + 2, F.lit(2147483647))
    headed = F.col("section_heading").isNotNull() & F.startswith(after_title, F.concat("section_heading", F.lit("\n")))
    body = F.when(headed, F.substring(after_title, F.length("section_heading") + 2, F.lit(2147483647))).otherwise(after_title)
    # where the title is missing, the text is what is as long as the chunk
    text = F.when(F.col("n").isNotNull() & (F.col("n") <= F.length("retrieval_text")), F.expr("right(retrieval_text, n)")).otherwise(body)
    return docs.unionByName(chunks.select(F.lit("core_chunks").alias("tbl"), F.col("id").alias("rec_id"), text.alias("text")))


def judged(texts: DataFrame, common_words: DataFrame) -> DataFrame:
    """texts (tbl, rec_id, text) -> their statistics, verdict (null for blank texts) and its probability."""
    spark = texts.sparkSession
    common = frozenset(r[0].lower() for r in common_words.select("word").where("word is not null").distinct().limit(COMMON + 1).collect())
    if len(common) > COMMON:
        raise ValueError(f"more than {COMMON} common words")
    sample = []
    for r in texts.groupBy("tbl").count().collect():  # one row per table
        share = min(1.0, SAMPLE / r["count"])  # by hash, so that SAMPLE texts are left, about, and never twice as many
        part = texts.where((F.col("tbl") == r["tbl"]) & (F.pmod(F.xxhash64("tbl", "rec_id"), F.lit(1 << 30)) < int(share * (1 << 30))) & (F.length(F.trim("text")) > 0))
        sample += sorted(x[0] for x in part.select("text").limit(2 * SAMPLE).toLocalIterator())
    shared = spark.sparkContext.broadcast((*train(sample, common), common))

    def run(batches):
        model, known, common = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                texts = part.column(2).to_pylist()
                x = np.array([stats(t, common, known) for t in texts]).reshape(-1, FEATURES)
                p = model.probabilities(x) if len(x) else np.zeros((0, 4))
                verdict = [KINDS[k] if t and t.strip() else None for k, t in zip(p.argmax(1), texts)]
                cols = [pa.array(x[:, k]) for k in range(len(STATS))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *cols, pa.array(verdict, pa.string()), pa.array(p.max(1, initial=0))], names=["tbl", "rec_id", *STATS, "verdict", "probability"])

    schema = "tbl string, rec_id bigint, " + ", ".join(f"{s} double" for s in STATS) + ", verdict string, probability double"
    return texts.select("tbl", "rec_id", "text").mapInArrow(run, schema)


def p5_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics and verdict of every text."""
    return judged(tables(spark, sf), spark.read.parquet(f"{sf}/common_words.parquet")).dropDuplicates(["tbl", "rec_id"])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """(tbl, rec_id, kind) of texts that are mostly not prose."""
    return judged(tables(spark, sf), spark.read.parquet(f"{sf}/common_words.parquet")).where("verdict <> 'prose' and rec_id is not null").select("tbl", "rec_id", F.col("verdict").alias("kind")).distinct()
