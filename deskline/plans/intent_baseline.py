"""Intent classifiers on a labelled table, with a confidence for routing.

Naive Bayes is a grouped count and a lookup where the text is. A vocabulary of any size
stays a table: only a bounded number of its most frequent words is gathered and shared
with all tasks. The regression gathers sums of a size set by its features and intents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions import patterns as p
from deskline.functions.names import unused
from deskline.operators.cleaning import Projection
from deskline.operators.labels import INTENTS
from deskline.sources.shared import shared_folder

_NOT_WORD = r"[^\p{L}\p{N}_]+"


def _usable(training: DataFrame) -> DataFrame:
    """Rows that the merge would keep: neither text nor intent is missing."""
    return training.filter(F.col("text").isNotNull() & F.col("intent").isNotNull() & F.col("text").rlike(p.HAS_TEXT))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, however often
    it is read."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


# -- naive Bayes -----------------------------------------------------------------

# Words, the most frequent ones, that every task holds; up to this many bytes each.
COMMON_WORDS = 100_000
_LONGEST_COMMON = 64


@dataclass(frozen=True)
class NaiveBayes:
    """``intents``: (intent, its rows, its words in all), no more than the taxonomy has.
    ``counts``: a table ``word, n``, a count for each of ``intents``. ``vocabulary``: how
    many words differ. ``common``: the most frequent ones, in order, and their counts;
    ``rare``: the others, a part of ``counts``, or None if there are no others."""

    intents: tuple[tuple[str, int, int], ...]
    counts: DataFrame
    vocabulary: int
    common: tuple[list[str], list[list[int]]]
    rare: DataFrame | None


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _NOT_WORD), lambda w: w != "")


def train_naive_bayes(
    training: DataFrame, intents: Sequence[str] = INTENTS, common_words: int = COMMON_WORDS
) -> NaiveBayes:
    """Count ``text, intent``: rows and words of each intent, and each word in it. Rows of
    intents that are not in the taxonomy, or without text, teach nothing.

    ``training`` is computed once: its usable rows are written to the shared folder, and
    their texts are cut into words once. Counts are added up in each task before the
    shuffle, so it carries a row for each word a task has met, however often. They are
    written once too; at most ``common_words`` of them, of bounded length, are gathered.
    """
    rows = _written(_usable(training).filter(F.col("intent").isin(list(intents))).select("intent", "text"), "training-rows")
    found = sorted((r.intent, r["count"]) for r in rows.groupBy("intent").count().collect())
    each = [F.count_if(F.col("intent") == intent) for intent, _ in found]
    counted = rows.select("intent", F.explode(_words(F.col("text"))).alias("word")).groupBy("word")
    counts = _written(counted.agg((F.array(*each) if each else F.array().cast("array<bigint>")).alias("n")), "word-counts")
    sums = [F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(len(found))]
    vocabulary, *words = counts.agg(F.count("*"), *sums).first()
    sizes = tuple((intent, n, of_intent) for (intent, n), of_intent in zip(found, words))
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
    short = F.octet_length("word") <= _LONGEST_COMMON
    top = counts.filter(short).select("word", "n", total.alias("total")).orderBy(F.desc("total"), "word").limit(common_words).collect()
    common = sorted((r.word, list(r.n)) for r in top)
    rare = None
    if len(top) < vocabulary:
        beyond = ~short if top else F.lit(True)
        if top and len(top) == common_words:
            last = top[-1]
            beyond = beyond | (total < last.total) | ((total == last.total) & (F.col("word") > last.word))
        rare = counts.filter(beyond)
    return NaiveBayes(sizes, counts, vocabulary, ([w for w, _ in common], [n for _, n in common]), rare)


def _gains_udf(model: NaiveBayes, spark: SparkSession):
    """For the words of a text: how many are common ones, the sum of ln(1 + count) over
    them for each intent, and the words that are not common (if the model has rare ones)."""
    words, counts = model.common
    intents, rest = len(model.intents), model.rare is not None
    logs = np.log1p(np.array(counts, np.float64).reshape(len(words), intents))
    shared = spark.sparkContext.broadcast((pa.array(words, pa.string()), logs))

    def gains(texts: pa.Array) -> pa.Array:
        import numpy
        import pyarrow
        import pyarrow.compute

        known, logs = shared.value
        lines = pyarrow.compute.fill_null(texts, [])
        flat, owner = lines.flatten(), pyarrow.compute.list_parent_indices(lines).to_numpy()
        place = pyarrow.compute.index_in(flat, value_set=known)
        new = numpy.asarray(place.is_null())
        place = place.fill_null(0).to_numpy()[~new]
        held = owner[~new]
        columns = [numpy.bincount(held, minlength=len(texts)).astype(float)]
        columns += [numpy.bincount(held, weights=logs[place, i], minlength=len(texts)) for i in range(intents)]
        sums = pyarrow.array(numpy.column_stack(columns).ravel())
        ends = numpy.arange(0, len(sums) + 1, intents + 1, dtype=numpy.int32)
        others = flat.filter(pyarrow.array(new)) if rest else flat.slice(0, 0)
        counted = numpy.bincount(owner[new], minlength=len(texts)) if rest else numpy.zeros(len(texts), int)
        other_ends = numpy.concatenate([[0], numpy.cumsum(counted)]).astype(numpy.int32)
        return pyarrow.StructArray.from_arrays(
            [pyarrow.ListArray.from_arrays(ends, sums), pyarrow.ListArray.from_arrays(other_ends, others)], ["gains", "others"]
        )

    return F.arrow_udf(gains, "struct<gains:array<double>,others:array<string>>")


def with_intents(
    model: NaiveBayes,
    df: DataFrame,
    text_col: str = "text",
    out_cols: tuple[str, str, str] = ("predicted_intent", "log_score", "confidence"),
) -> DataFrame:
    """``df`` with ``predicted_intent``, ``log_score`` and ``confidence``, which replace
    columns of these names. Every row is judged by itself; none is lost or joined with
    another, whatever its other columns hold.

    A text's score for an intent is the logarithm of the intent's share of the rows plus,
    for each word of the text that the training table has, that of the word's share of
    the intent's words, with one added to each count; it has four places. Of equal scores
    the smallest intent wins; the confidence is its share of all intents' probabilities.
    A text with none of the words gets the intent with most rows; null texts, and a model
    of no rows, give neither intent nor confidence.

    Common words are looked up where the text is, in a table that all tasks share, so
    this is a projection: nothing is shuffled, and the frame is read once. If the model
    has rare words too, the frame is written once to the shared folder, the words of it
    that are not common meet the rare ones, and their sums are added to their rows.
    """
    spark = df.sparkSession
    text = F.col(f"`{text_col}`")
    found, given = unused("found", df), unused("given", df)
    frame = Projection(df)
    looked_up = frame.bind(_gains_udf(model, spark)(_words(text)))
    judged = frame.result(found, looked_up).withColumn(given, text.isNotNull())
    sums = F.col(found)["gains"]
    if model.rare is not None:
        judged = _with_rare(judged, model, found)
    total = sum(rows for _, rows, _ in model.intents)

    def score(i: int, rows: int, size: int) -> Column:
        return F.round(sums[i + 1] + math.log(rows / total) - sums[0] * math.log(size + model.vocabulary), 4)

    scores = [
        F.struct((-score(i, rows, size)).alias("cost"), F.lit(intent).alias("intent"))
        for i, (intent, rows, size) in enumerate(model.intents)
    ]
    kind = "array<struct<cost:double,intent:string>>"
    frame = Projection(judged)
    scores = frame.bind(F.when(F.col(given), F.array(*scores) if scores else F.array().cast(kind)))
    best = frame.bind(F.array_min(scores))
    odds = F.aggregate(scores, F.lit(0.0), lambda held, x: held + F.exp(best["cost"] - x["cost"]))
    values = (best["intent"], -best["cost"], F.when(best.isNotNull(), 1 / odds))
    kept = [c for c in df.columns if c not in out_cols]
    return frame.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(name) for v, name in zip(values, out_cols)])


def _with_rare(judged: DataFrame, model: NaiveBayes, found: str) -> DataFrame:
    """Adds the sums over rare words to those in ``found``.

    The words that texts share with the rare ones are few beside the texts' words. The
    most frequent of them are broadcast, so no word that most texts hold is shuffled by
    text; for the others, texts are joined by word.
    """
    row, extra = unused("row", judged), unused("more", judged)
    judged = _written(judged.withColumn(row, F.monotonically_increasing_id()), "judged")
    pairs = judged.select(row, F.explode(F.col(found)["others"]).alias("word"))
    met = _written(pairs.groupBy("word").agg(F.count("*").alias("times")).join(model.rare, "word"), "rare-words")
    short = F.octet_length("word") <= _LONGEST_COMMON
    often = met.filter(short).orderBy(F.desc("times"), "word").limit(COMMON_WORDS)
    often = _written(often, "often-met")
    seldom = met.join(F.broadcast(often.select("word")), "word", "left_anti")
    # Sums, of the number of words first.
    logs = F.concat(F.array(F.lit(1.0)), F.transform("n", lambda n: F.log1p(n.cast("double"))))
    hits = pairs.join(F.broadcast(often.drop("times")), "word").select(row, logs.alias("logs"))
    hits = hits.union(pairs.join(seldom.drop("times"), "word").select(row, logs.alias("logs")))
    parts = range(len(model.intents) + 1)
    more = hits.groupBy(row).agg(F.array(*[F.sum(F.col("logs")[i]) for i in parts]).alias(extra))
    old = F.col(found)["gains"]
    added = F.coalesce(F.zip_with(old, F.col(extra), lambda a, b: a + b), old)
    return judged.join(more, row, "left").withColumn(found, F.struct(added.alias("gains"))).drop(row, extra)


def predict_naive_bayes(model: NaiveBayes, df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``key``, ``predicted_intent``, ``log_score`` and ``confidence`` for each row of
    ``df``, as :func:`with_intents` finds them; keys may be repeated or null."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return with_intents(model, rows).select(F.col("id").alias(key), "predicted_intent", "log_score", "confidence")


# -- regression ------------------------------------------------------------------


def train_intent_baseline(
    training: DataFrame, intents: tuple[str, ...] = INTENTS, features: int = 1 << 14, iterations: int = 20
) -> PipelineModel:
    """Fit a bag-of-words logistic regression on ``text, intent``, for the intents of a
    taxonomy: rows of other intents, and without text or intent, teach nothing. Only sums
    over the rows travel to the driver, of a size set by ``features`` and ``intents``.

    The fit reads its rows several times. ``training`` is computed once: what is written
    to the shared folder and read again is a label and the hashed counts for each row."""
    rows = _usable(training).filter(F.col("intent").isin(list(intents))).select("text", "intent")
    labels = StringIndexerModel.from_labels(list(intents), inputCol="intent", outputCol="label")
    tokens = RegexTokenizer(inputCol="text", outputCol="words", pattern=_NOT_WORD)
    hashing = HashingTF(inputCol="words", outputCol="counts", numFeatures=features)
    counted = hashing.transform(tokens.transform(labels.transform(rows))).select("label", "counts")
    weights = IDF(inputCol="counts", outputCol="features")
    regression = LogisticRegression(maxIter=iterations, regParam=0.01)
    fitted = Pipeline(stages=[weights, regression]).fit(_written(counted, "hashed-counts"))
    named = IndexToString(inputCol="prediction", outputCol="predicted_intent", labels=list(intents))
    return PipelineModel([labels, tokens, hashing, *fitted.stages, named])


def predict_intents(model: PipelineModel, df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``predicted_intent`` and its probability as ``confidence``; both null for a
    null text."""
    text = F.col(f"`{text_col}`")
    # The model sees the text alone, so no column of df can meet one of its own.
    rows = df.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("text"), F.lit(model.stages[0].labels[0]).alias("intent"))
    scored = model.transform(rows)
    known = F.col(f"row.`{text_col}`").isNotNull()
    return scored.select(
        *[F.col(f"row.`{c}`") for c in df.columns],
        F.when(known, F.col("predicted_intent")).alias("predicted_intent"),
        F.when(known, F.array_max(vector_to_array("probability"))).alias("confidence"),
    )
