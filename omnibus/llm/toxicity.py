"""Toxicity: boosted trees over dense text features, calibrated by isotonic regression.

Features are built-in expressions over the whole text: densities of a fixed and
of a learned lexicon, their distance to second-person words, capitals,
punctuation and obfuscation rates.  The lexicon, the trees and the calibration
are learned from a bounded sample of labelled rows; the scores cover every row.

Defined cases: NULL text scores as the empty text, which gets the model's score
of all-zero features.  Rows with a NULL label or without a matching document
teach nothing; a document labelled more than once counts as toxic if half of
its labels say so.  A NULL doc_id is the text '' for the fold.  Without labels
of both kinds every row gets the share of toxic labels (0 if there is none).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus.llm.common import WORD, stored

FOLDS = 5
HELD_OUT_FOLD = 0
CALIBRATION_FOLD = 1
#: At most so many labelled rows are learned from, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
LEXICON_WORDS = 400
#: A learned word stands in so many labelled texts at least.
LEXICON_SUPPORT = 5
STRONG_ODDS = 20.0
WEAK_ODDS = 4.0
NEAR_WORDS = 5

# Insults, and second-person words of four languages.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "garbage",
    "worthless", "pathetic", "disgusting", "clown", "clowns", "imbecile", "bastard", "bitch", "asshole",
    "dumbass", "retard", "shit", "fuck", "fucking", "vermin", "filth", "crap",
)
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu",
    "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros",
)
# Characters that stand in for letters.
LEET_FROM, LEET_TO = "013457@$!|+", "oieastasiit"

#: A letter, then symbols or digits between letters.  All repeats are possessive, as Java takes one stack frame for
#: each round of any other repeated group, and no branch starts inside a run that it has failed on from its start.
_MASKED = (
    r"(?<!\p{L})\p{L}++(?:[\d@$!*._|+\-]++\p{L}++)++|(?<![\d@$!])[\d@$!]++\p{L}++(?:[\d@$!*._|+\-]*+\p{L}++)*+"
)
#: Single letters with a gap after each, four at least.
_SPACED = r"(?<!\p{L})\p{L}(?:[ .*_\-]\p{L}(?!\p{L})){3,}+"

FEATURES = (
    "length", "fixed_rate", "strong_rate", "weak_rate", "fixed_any", "strong_any", "weak_any", "masked_hit_rate",
    "near_rate", "second_rate", "upper_rate", "shout_rate", "exclaim_rate", "question_rate", "symbol_rate",
    "masked_rate", "stretch_rate",
)


@dataclass(frozen=True)
class Model:
    strong: tuple[str, ...]
    weak: tuple[str, ...]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def _member(values) -> Column:
    return lambda w: w.isin(list(values)) if values else F.lit(False)


def features(df: DataFrame, text: str, strong=(), weak=()) -> DataFrame:
    """``df`` with one double column per name in ``FEATURES``."""
    lower = F.lower(F.col(text))
    df = df.withColumn("_words", F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)))
    df = df.withColumn("_masked", F.regexp_extract_all(lower, F.lit(_MASKED), F.lit(0)))
    df = df.withColumn("_spaced", F.regexp_extract_all(lower, F.lit(_SPACED), F.lit(0)))
    insults = tuple(dict.fromkeys((*INSULTS, *strong)))
    # Index of each lexicon word, from 1.
    df = df.withColumn(
        "_at",
        F.filter(
            F.transform("_words", lambda w, i: F.when(_member(insults)(w), i + 1)), lambda i: i.isNotNull()
        ),
    )
    letters = F.concat(
        F.transform(
            "_masked",
            lambda w: F.regexp_replace(F.translate(w, LEET_FROM, LEET_TO), r"[^\p{L}]", ""),
        ),
        F.transform("_masked", lambda w: F.regexp_replace(w, r"[^\p{L}]", "")),
        F.transform("_spaced", lambda w: F.regexp_replace(w, r"[^\p{L}]", "")),
    )
    n_words = F.greatest(F.size("_words"), F.lit(1))
    n_chars = F.greatest(F.length(text), F.lit(1))
    hits = lambda values: F.size(F.filter("_words", _member(values)))
    removed = lambda char: F.length(text) - F.length(F.replace(F.col(text), F.lit(char), F.lit("")))
    near = F.filter(
        "_at",
        lambda i: F.arrays_overlap(
            F.slice("_words", F.greatest(i - NEAR_WORDS, F.lit(1)), F.lit(2 * NEAR_WORDS + 1)),
            F.array(*[F.lit(w) for w in SECOND_PERSON]),
        ),
    )
    df = df.withColumns({"_fixed": hits(INSULTS), "_strong": hits(strong), "_weak": hits(weak)})
    out = {
        "length": F.log1p(F.size("_words")),
        "fixed_rate": F.col("_fixed") / n_words,
        "strong_rate": F.col("_strong") / n_words,
        "weak_rate": F.col("_weak") / n_words,
        "fixed_any": F.least("_fixed", F.lit(10)),
        "strong_any": F.least("_strong", F.lit(10)),
        "weak_any": F.least("_weak", F.lit(10)),
        "masked_hit_rate": F.size(F.filter(letters, _member(insults))) / n_words,
        "near_rate": F.size(near) / n_words,
        "second_rate": hits(SECOND_PERSON) / n_words,
        "upper_rate": F.regexp_count(F.col(text), F.lit(r"\p{Lu}")) / n_chars,
        "shout_rate": F.regexp_count(F.col(text), F.lit(r"\p{Lu}{3,}")) / n_words,
        "exclaim_rate": removed("!") / n_chars,
        "question_rate": removed("?") / n_chars,
        "symbol_rate": F.regexp_count(F.col(text), F.lit(r"[@#$%^&*]")) / n_chars,
        "masked_rate": (F.size("_masked") + F.size("_spaced")) / n_words,
        "stretch_rate": F.regexp_count(F.col(text), F.lit(r"(\p{L})\1\1")) / n_words,
    }
    df = df.withColumns({name: out[name].cast("double") for name in FEATURES})
    return df.drop("_words", "_masked", "_spaced", "_at", "_fixed", "_strong", "_weak")


def lexicon(sample: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Words of the sample that stand in toxic texts far more often than in others."""
    totals = sample.agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")).first()
    seen = sample.select(
        "y", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word")
    )
    counts = seen.groupBy("word").agg(F.sum("y").alias("c1"), F.sum(1 - F.col("y")).alias("c0"))
    odds = (F.col("c1") / totals["n1"]) / ((F.col("c0") + 0.5) / (totals["n0"] + 1))
    found = (
        counts.where(F.col("c1") >= LEXICON_SUPPORT)
        .select("word", odds.alias("odds"), (F.col("c1") * F.log(odds)).alias("weight"))
        .where(F.col("odds") >= WEAK_ODDS)
        .orderBy(F.desc("weight"), "word")
        .limit(LEXICON_WORDS)
        .collect()
    )
    strong = tuple(sorted(r["word"] for r in found if r["odds"] >= STRONG_ODDS))
    return strong, tuple(sorted(r["word"] for r in found if r["odds"] < STRONG_ODDS))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled rows outside the held-out fold."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id")) != HELD_OUT_FOLD)
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # ``known`` has sample_rows rows of two numbers at most, so the texts stay where they are.
    sample = stored(
        texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "y", fold(F.col("doc_id")).alias("fold")), "toxicity-sample"
    )
    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("n1")).first()
    base = totals["n1"] / totals["n"] if totals["n"] else 0.0
    if not 0 < totals["n1"] < totals["n"]:
        return Model((), (), None, None, base)
    # Words are learned apart from the calibration fold, as the trees are.
    learn = sample.where(F.col("fold") != CALIBRATION_FOLD)
    if learn.select("y").distinct().count() < 2:
        learn = sample
    strong, weak = lexicon(learn)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(
        features(sample, "text", strong, weak)
    )
    rows = stored(assembled.select("doc_id", "y", "fold", "_vector").coalesce(4), "toxicity-features")
    train = rows.where(F.col("fold") != CALIBRATION_FOLD)
    if train.select("y").distinct().count() < 2:
        train = rows
    trees = GBTClassifier(
        featuresCol="_vector", labelCol="y", maxIter=24, maxDepth=3, stepSize=0.3, maxBins=32, minInstancesPerNode=5,
        seed=7, checkpointInterval=-1,
    ).fit(train)
    held = rows.where(F.col("fold") == CALIBRATION_FOLD)
    if held.select("y").distinct().count() < 2:
        held = rows
    raw = trees.transform(held).select("y", vector_to_array("probability")[1].alias("_raw"))
    calibration = IsotonicRegression(featuresCol="_raw", labelCol="y", predictionCol="_score").fit(raw)
    return Model(strong, weak, trees, calibration, base)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, held_out, score, predicted): ``row`` holds the whole input row."""
    boxed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    if model.trees is None:
        scored = boxed.withColumn("_score", F.lit(model.base_rate))
    else:
        ready = features(boxed, "_text", model.strong, model.weak).drop("_text")
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(ready)
        raw = model.trees.transform(ready).withColumn("_raw", vector_to_array("probability")[1])
        scored = model.calibration.transform(raw)
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score")))
    return scored.select(
        "row",
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"),
        clipped.alias("score"),
        (clipped >= 0.5).cast("int").alias("predicted"),
    )
