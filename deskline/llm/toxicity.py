"""Toxicity scores from class-conditional Kneser-Ney models.

The history of a word is the class of its text, toxic or ordinary. Each class has its
own discounted word counts, a word counting once in a text, and what the discounts free
goes to one backoff distribution that both classes share: the number of histories, that
is classes, a word was seen in. A rare expression, which one class has hardly seen, thus
costs both classes nearly the same.

A text is judged by the difference of its two log-likelihoods for each token: over the
whole text, and over the few tokens where it is largest, so that a few toxic words count
in a long text too. A logistic curve, fitted on labelled rows that the models have not
seen, turns both into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import fresh, saved
from deskline.llm.hashing import WordHasher
from deskline.llm.ngram_lm import discounts


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted word hashes and log-likelihood differences, bounded by the sample."""

    words: np.ndarray
    difference: np.ndarray  # log probability in toxic texts less that in ordinary ones
    unknown: float  # the same for words that the sample does not have
    weights: np.ndarray  # of the logistic curve: whole text, peak, constant
    peak: int  # tokens of a text whose differences make the peak


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    tune_on: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 8000,
    peak: int = 2,
) -> ToxicityModel:
    """Fit the models on labelled rows and the curve on others.

    ``learn_from`` and ``tune_on`` are conditions on the id column, by default one half
    of the ids each. ``max_rows`` bounds the labelled rows of each class: of more, those
    whose hashed id is below the bound's share are taken, about ``max_rows`` rows. Their
    ids are few enough to be broadcast, so no text is shuffled to find them. The ``peak``
    tokens with the largest differences are a feature of their own.

    The driver holds an entry for each word of the sample, some tens of megabytes.

    Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z folded.
    Rows with a null id, label or text teach nothing. An id with several labels is toxic
    if one of them is. Without labelled rows of both classes every score is 0.
    """
    half = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2))
    role = F.when(half == 0 if learn_from is None else learn_from, 0).when(half == 1 if tune_on is None else tune_on, 1)
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"), role.alias("role"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
        .where("role is not null")
    )
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(1.0)
    for label, size in sizes.items():
        share = F.when(F.col("toxic") == label, min(1.0, max_rows / size)).otherwise(share)
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000 < share
    sample = saved(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where("text is not null")
        .join(F.broadcast(known.where(drawn)), "id")
        .select("role", "toxic", "text")
    )
    counts = saved(
        sample.where("role = 0")
        .select("toxic", "text")
        .mapInArrow(_count_words, "toxic int, w long, n long")
        .groupBy("toxic", "w")
        .agg(F.sum("n").alias("n"))
    )
    model = replace(_compared(counts), peak=peak)
    features = sample.where("role = 1").mapInArrow(lambda b: _features_of(b, model, ["toxic"]), "toxic int, mean double, peak double")
    rows = features.toPandas()
    # Rows stand for all rows of their class.
    weight = rows["toxic"].map({label: max(1.0, size / max_rows) for label, size in sizes.items()})
    weights = _fit_curve(rows[["mean", "peak"]].to_numpy(float), rows["toxic"].to_numpy(float), weight.to_numpy(float))
    return replace(model, weights=weights)


def toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on), ``mean`` and
    ``peak`` (log-likelihood difference for each token: of the whole text, and of its few
    largest) of each row of ``docs``. Null texts and texts without words have
    differences of 0."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, mean double, peak double"
    found = rows.mapInArrow(lambda b: _features_of(b, held.value, ["id"]), schema)
    return found.select("id", _curve(model).alias("score"), "mean", "peak").select(
        "id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "mean", "peak"
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh(docs, "toxicity")

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            features = _features(column, held.value)
            yield pa.array(_curve_of(features, held.value.weights))

    scored = F.arrow_udf(score, "double")(F.coalesce(F.col(text_col), F.lit("")))
    return docs.withColumn(name, scored).where(F.col(name) < threshold).drop(name)


# -- counting ------------------------------------------------------------------


def _lines(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of runs of texts, and where each text begins."""
    for _, hashes, first in WordHasher(letters_only=True).texts(column):
        yield hashes, first


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a word is, summed for each run of texts."""
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        row = 0
        for hashes, first in _lines(batch.column("text")):
            held: list[list[np.ndarray]] = [[], []]
            for start, end in zip(first[:-1], first[1:]):
                held[int(toxic[row] > 0)].append(np.unique(hashes[start:end]))
                row += 1
            for label in (0, 1):
                if held[label]:
                    words, counts = np.unique(np.concatenate(held[label]), return_counts=True)
                    columns = [pa.array(np.full(len(words), label, np.int32)), pa.array(words.view(np.int64)), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(columns, ["toxic", "w", "n"])


def _compared(counts: DataFrame) -> ToxicityModel:
    """The model of the counts. The driver gets a row for each word of the sample."""
    words = (
        counts.groupBy("w")
        .agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in (0, 1)])
        .toPandas()
    )
    hashes = words["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    classes = [words[f"c{c}"].to_numpy(np.int64)[order] for c in (0, 1)]
    share, freed = _with_discount(sum((c > 0).astype(np.int64) for c in classes))
    rest = freed / (len(words) + 1)
    logs, unknown = [], []
    for own in classes:
        own_share, own_freed = _with_discount(own)
        logs.append(np.log(own_share + own_freed * (share + rest)))
        unknown.append(np.log(own_freed * rest))
    return ToxicityModel(hashes[order], logs[1] - logs[0], float(unknown[1] - unknown[0]), np.zeros(3), 1)


def _with_discount(counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Discounted shares of counts, and the mass that the discounts free."""
    total = counts.sum()
    if not total:
        return np.zeros(len(counts)), 1.0
    by = np.array([0.0, *discounts([(counts == n).sum() for n in range(1, 5)])])
    share = np.maximum(counts - by[np.minimum(counts, 3)], 0) / total
    return share, 1.0 - share.sum()


# -- scoring -------------------------------------------------------------------


def _features(column: pa.Array, model: ToxicityModel) -> np.ndarray:
    """Mean difference of each text, and of its few largest ones."""
    found = []
    for hashes, first in _lines(column):
        differ = np.full(len(hashes), model.unknown)
        if len(model.words) and len(hashes):
            place = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
            differ = np.where(model.words[place] == hashes, model.difference[place], model.unknown)
        for start, end in zip(first[:-1], first[1:]):
            own = differ[start:end]
            largest = np.partition(own, len(own) - model.peak)[-model.peak :] if len(own) > model.peak else own
            found.append((own.mean(), largest.sum() / model.peak) if len(own) else (0.0, 0.0))
    return np.array(found).reshape(-1, 2)


def _features_of(batches: Iterator[pa.RecordBatch], model: ToxicityModel, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features = _features(batch.column("text"), model)
        columns = [batch.column(c) for c in keep] + [pa.array(features[:, i]) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, [*keep, "mean", "peak"])


def _fit_curve(features: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small penalty."""
    if len(np.unique(toxic)) < 2:
        return np.zeros(3)
    x = np.concatenate([features, np.ones((len(features), 1))], axis=1)
    weights = np.zeros(3)
    penalty = np.diag([0.1, 0.1, 1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (weight * (toxic - chance)) - penalty @ weights
        curve = (x * (weight * chance * (1 - chance) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _curve_of(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not weights.any():
        return np.zeros(len(features))
    return 1 / (1 + np.exp(-np.clip(features @ weights[:2] + weights[2], -700, 700)))


def _curve(model: ToxicityModel) -> Column:
    mean, peak, constant = (float(w) for w in model.weights)
    if not model.weights.any():
        return F.lit(0.0)
    return 1 / (1 + F.exp(-(F.col("mean") * mean + F.col("peak") * peak + constant)))
