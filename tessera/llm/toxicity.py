"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed insult lexicon and of a lexicon of words and word
beginnings learned from labelled rows, how near its hits stand to second-person words, and
rates of capitals, punctuation and obfuscated spellings.  Language, source, ids and labels
are never inputs.

Fitting takes a sample of at most ``TRAIN_ROWS`` labelled rows (by hash of the id) of those that the
caller allows.  One part of it teaches the lexicon and the rest the trees, which are calibrated on margins of rows
that trees over other rows gave;
what the lexicon part counts is summed on the executors and cut to ``LEXICON`` entries.
Scoring sees every row and each whole text.

Defined results
---------------
* a null text counts as empty, and an empty text has a score like any other;
* labels that are null take no part; a document with several labels counts as toxic if one says so;
* without labels of both kinds the score is the smoothed share of toxic labels (0.001 to 0.999);
* repeated rows and null ids are scored like any row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import boosting
from tessera.llm.common import Stage, key_bits, small_batches, spread, table, tidy

#: Bound of the labelled sample; entries of the learned lexicon; cached words of a worker.
TRAIN_ROWS = 20_000
LEXICON = 4_000
CACHE = 200_000
THRESHOLD = 0.7
NEAR = 4

# Common insults of English, and second-person words of some languages.
INSULTS = """
asshole bastard bitch clown crap damn disgusting dumb dumbass fool freak garbage idiot idiotic jerk
loser moron moronic pathetic scum scumbag shit stupid trash ugly vermin worthless
""".split()
SECOND_PERSON = """
you your yours yourself u ur ya du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos
usted ustedes ti tus su sus
""".split()
# What digits and signs stand for in obfuscated words.
LEET = str.maketrans("013457@$!", "oieastasi")

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INSIDE = re.compile(r"[^\W\d_][\d@$!*]+[^\W\d_]")
_LONG = re.compile(r"([^\W\d_])\1\1")
_INSULTS, _SECOND = frozenset(INSULTS), frozenset(SECOND_PERSON)
FEATURES = (
    "insult_rate insult_log learned_rate learned_weight learned_log learned_kinds learned_top near_you you_rate "
    "capital_rate shout_rate exclaim_rate question_rate sign_rate obfuscated_rate unmasked_log stretched_rate words_log word_length"
).split()


def terms(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself (closed by a blank) and its beginnings."""
    return [word + " ", *(word[:n] for n in range(3, min(len(word), 9)))]


class Lexicon:
    """Weights of words, worked out once per distinct token."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.seen: dict[str, tuple] = {}

    def token(self, token: str) -> tuple:
        """insult, weight, second person, shouted, obfuscated, unmasked insult, stretched, capitals."""
        word = _EDGE.sub("", token)
        low = word.lower()
        get = self.weights.get
        weight = max((get(t, 0.0) for t in terms(low)), default=0.0) if low else 0.0
        insult, unmasked = low in _INSULTS, False
        hidden = bool(_INSIDE.search(word))
        if not insult and (hidden or "*" in token or any(c in "@$!0134578" for c in word)):
            plain = _EDGE.sub("", token.lower().translate(LEET))
            squeezed = re.sub(r"[\W_]+", "", plain)
            unmasked = plain in _INSULTS or squeezed in _INSULTS
        out = (insult, weight, low in _SECOND, len(word) > 2 and word.isupper(), hidden, unmasked, bool(_LONG.search(low)), 0 if token.islower() else sum(map(str.isupper, token)))
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[token] = out
        return out

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = text.split()
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        seen, token = self.seen, self.token
        insults = learned = shouted = obfuscated = unmasked = stretched = you = kinds = capitals = 0
        total = top = 0.0
        hits = set()
        for t, k in Counter(tokens).items():
            x = seen.get(t) or token(t)
            if x[0]:
                insults += k
            if x[1]:
                learned += k
                kinds += 1
                total += k * x[1]
                top = max(top, x[1])
            if x[0] or x[1] or x[5]:
                hits.add(t)
            you += k * x[2]
            shouted += k * x[3]
            obfuscated += k * x[4]
            unmasked += k * x[5]
            stretched += k * x[6]
            capitals += k * x[7]
        near = 0.0
        if hits and you:
            addressed = [i for i, t in enumerate(tokens) if (seen.get(t) or token(t))[2]]
            at = np.array([i for i, t in enumerate(tokens) if t in hits])
            place = np.searchsorted(addressed, at)
            ends = np.array([-(10**9), *addressed, 10**9])
            near = float((np.minimum(at - ends[place], ends[place + 1] - at) <= NEAR).mean())
        chars = len(text)
        letters = max(1, sum(map(len, tokens)))
        exclaims, questions = text.count("!"), text.count("?")
        signs = sum(map(text.count, "@#$%&*+=<>^~|\\")) / chars
        return [
            insults / n, math.log1p(insults), learned / n, total / n, math.log1p(learned), math.log1p(kinds), top, near, you / n,
            capitals / letters, shouted / n, exclaims / chars, questions / chars, signs, obfuscated / n,
            math.log1p(unmasked), stretched / n, math.log1p(n), letters / n,
        ]


@tidy
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic -> term, in toxic documents, in others: sums of a task."""
    bad, good = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {_EDGE.sub("", t).lower() for t in set((text or "").split())}
            (bad if toxic else good).update({t for w in words if w for t in terms(w)})
    kept = [t for t, k in bad.items() if k > 0]
    for i in range(0, len(kept), 50_000):
        part = kept[i : i + 50_000]
        cols = [pa.array(part), pa.array([bad[t] for t in part], pa.int64()), pa.array([good[t] for t in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["term", "bad", "good"])
    other = [t for t in good if t not in bad]
    for i in range(0, len(other), 50_000):
        part = other[i : i + 50_000]
        cols = [pa.array(part), pa.array([0] * len(part), pa.int64()), pa.array([good[t] for t in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["term", "bad", "good"])


def learn_lexicon(sample: DataFrame, entries: int = LEXICON) -> dict[str, float]:
    """Terms that stand in toxic documents far oftener than in others, with their log odds."""
    n = {bool(r["toxic"]): r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_bad, n_good = n.get(True, 0), n.get(False, 0)
    if not n_bad or not n_good:
        return {}
    counts = small_batches(sample.select("text", "toxic")).mapInArrow(_counted, "term string, bad long, good long")
    sums = counts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where("bad >= 4")
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("good") + 0.5) / (n_good + 1.0))
    sure = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = sums.select("term", odds.alias("odds"), sure.alias("sure")).where("odds >= 1.5 and sure >= 3.5")
    return {r["term"]: r["odds"] for r in best.orderBy(F.desc("sure"), "term").limit(entries).collect()}


def _measured(weights: dict[str, float]):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            rows = [lexicon.features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["part", "toxic", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[dict[str, float], boosting.Forest]:
    """Lexicon and calibrated trees from at most ``rows`` labelled documents."""
    stage = Stage(docs.sparkSession, "toxicity")
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic"))
        .withColumn("h", key_bits(F.col("doc_id")))
        .orderBy("h", "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample has at most `rows` ids, which bounds the broadcast.
    sample = texts.join(F.broadcast(known), "doc_id").withColumn("part", F.expr("cast(shiftright(h, 7) % 10 as int)"))
    sample = stage.keep(sample.select("text", "toxic", "part"), "sample")
    weights = learn_lexicon(sample.where("part < 4"))
    rest = small_batches(sample.where("part >= 4").select("part", "toxic", "text")).mapInArrow(_measured(weights), "part int, toxic boolean, x array<double>")
    got = rest.collect()
    stage.drop("sample")
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    y = np.array([r["toxic"] for r in got], float)
    part = np.array([r["part"] for r in got], int)
    return weights, boosting.fit_crossed(x, y, part % 3)


def score(docs: DataFrame, weights: dict[str, float], forest: boosting.Forest) -> DataFrame:
    """doc_id, score for every row of docs."""
    rows = spread(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.score(x), pa.float64())], names=["doc_id", "score"])

    return small_batches(rows).mapInArrow(run, f"doc_id {id_type}, score double")


def held_out(column):
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is under the threshold, with their columns."""
    weights, forest = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    names = docs.columns
    text = docs.columns.index("text") if "text" in docs.columns else [c.lower() for c in docs.columns].index("text")
    packed = docs.select(F.col(f"`{names[text]}`").cast("string").alias("text"), F.struct(*(docs[c] for c in names)).alias("row"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, len(FEATURES))
            yield batch.select([1]).filter(pa.array(forest.score(x) < threshold))

    schema = packed.select("row").schema
    return small_batches(packed).mapInArrow(run, schema).select("row.*")


def query(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights, forest = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, weights, forest).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
