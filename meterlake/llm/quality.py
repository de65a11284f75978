"""A quality classifier that weighs a document's own evidence with that of its site."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import stage
from meterlake.llm.spans import WordHasher, window_hashes

#: Labelled documents that the document classifier is fitted on, at most.
SAMPLE = 20_000
#: Documents whose probability of good quality lies below are rejected.
THRESHOLD = 0.5
#: A share of a site's evidence counts as much as this many documents, at least.
LEAST_STRENGTH = 2.0
#: How strongly the log odds of a site count beside those of the document.
SITE_WEIGHT = 0.5

#: The look of a text alone gives no more log odds than this, either way.
MOST_ODDS = 10.0

RIDGE, ROUNDS = 1.0, 25

_SIGNS = np.frombuffer(b"!#$%&*|<>{}[]()@=+_/\\~^", np.uint8)
#: Copies of a site's row, so that the documents of a large site go to several tasks.
_SALTS = 16


def features(data: bytes, words: np.ndarray) -> list[float]:
    """What a text looks like: shares of kinds of characters, and of repetition."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, len(data))
    upper, lower = counts[65:91].sum(), counts[97:123].sum() + counts[128:].sum()
    number = max(1, len(words))
    _, each = np.unique(words, return_counts=True)
    triples = window_hashes(words, 3)

    def logged(share: float) -> float:
        return math.log(share + 1e-3)

    return [
        math.log1p(len(words)),
        logged(upper / max(1, upper + lower)),
        logged(counts[48:58].sum() / size),
        logged(counts[_SIGNS].sum() / size),
        logged(counts[[33, 46, 44, 58, 59, 63]].sum() / size),
        logged(counts[33] / size),
        logged(counts[124] / size),
        logged(counts[10] / size),
        logged(float(each.max(initial=0)) / number),
        logged(len(each) / number),
        logged(float((words[1:] == words[:-1]).sum()) / number),
        logged(1 - len(np.unique(triples)) / max(1, len(triples))),
        logged(len(data) / number / 20),
        logged((upper + lower) / size),
    ]


WIDTH = 14


def expand(raw: np.ndarray) -> np.ndarray:
    """Features, their squares and a constant."""
    return np.concatenate([raw, raw**2, np.ones((len(raw), 1))], axis=1)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHasher()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows = [features(t.encode(), hashes) for t, hashes in zip(texts, words(texts))]
        flat = np.array(rows, dtype=np.float64).reshape(-1)
        offsets = np.arange(0, WIDTH * len(texts) + 1, WIDTH, dtype=np.int32)
        others = [batch.column(name) for name in ("doc_id", "key", "host", "path")]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            ["doc_id", "key", "host", "path", "features"],
        )


def fit(raw: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights of a ridge logistic regression, by Newton's method."""
    middle, scale = raw.mean(axis=0), raw.std(axis=0) + 1e-9
    x = expand((raw - middle) / scale)
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (good - chance) - penalty * weights
        bend = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return middle, scale, weights


def _logit(chance: Column) -> Column:
    safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), chance))
    return F.log(safe / (1 - safe))


def _evidence(rows: DataFrame, labels: DataFrame, label_column: str, sample: int) -> DataFrame:
    """Log odds of good quality of each document on its own.

    Fitted on at most ``sample`` labelled documents, chosen by a hash of their id. Where
    labels are not of both kinds there is nothing to fit, and all odds are even.
    """
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("label_id"),
            F.col(label_column).cast("int").alias("good"),
        )
        .filter("label_id IS NOT NULL AND good IN (0, 1)")
        .orderBy(F.xxhash64("label_id"), "label_id", "good")
        .limit(sample)
    )
    found = rows.join(known, rows["doc_id"] == known["label_id"]).select("features", "good")
    chosen = found.limit(sample).collect()
    good = np.array([row["good"] for row in chosen], dtype=np.float64)
    if len(set(good.tolist())) < 2:
        return rows.withColumn("odds", F.lit(0.0)).drop("features")
    middle, scale, weights = fit(np.array([row["features"] for row in chosen]), good)
    count = len(middle)
    odds = F.lit(float(weights[-1]))
    for i in range(count):
        x = (F.col("features")[i] - float(middle[i])) / float(scale[i])
        odds = odds + float(weights[i]) * x + float(weights[count + i]) * x * x
    bounded = F.greatest(F.lit(-MOST_ODDS), F.least(F.lit(MOST_ODDS), odds))
    return rows.withColumn("odds", bounded).drop("features")


def _strength(sites: DataFrame, prior: Column) -> Column:
    """How many documents the level above is worth, from the spread of the sites' means.

    Moments of a beta distribution: the variance of the means beyond what sampling gives.
    """
    mean = F.col("good") / F.col("documents")
    variance = prior * (1 - prior)
    total, squares = F.sum("documents"), F.sum(F.pow("documents", F.lit(2)))
    spread = F.sum(F.col("documents") * F.pow(mean - prior, F.lit(2)))
    between = (spread - variance.cast("double") * (F.count(F.lit(1)) - 1)) / F.greatest(
        F.lit(1.0), total - squares / total
    )
    return F.greatest(F.lit(LEAST_STRENGTH), variance / F.greatest(F.lit(1e-6), between) - 1)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_column: str = "lang",
    label_column: str = "quality",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: the probability that its quality is good, and whether it stays.

    A logistic regression on the look of a text gives each document's own odds. Sites are
    hosts and, within them, paths. The expected share of good documents of a path shrinks
    towards that of its host, and a host's towards the share of all, the more the fewer
    documents there are; the strength of shrinking follows from how much sites differ. The
    odds of a document's path, without its own part in them, are added to its odds.

    Columns: doc_id, score, kept, own_score, site_score, site_documents. A null text is
    empty; null hosts and paths are sites of their own. Repeated rows are scored alike.
    Labels without an id or of other values are left out; without labels of both kinds own
    odds are even and all documents stay. An empty table gives no rows.
    """
    scored = _scores(
        docs, labels, id_column, text_column, host_column, path_column, label_column, sample,
        threshold,
    )
    return scored.drop("key")


def _scores(
    docs, labels, id_column, text_column, host_column, path_column, label_column, sample, threshold
) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col(host_column).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path_column).cast("string"), F.lit("")).alias("path"),
    )
    looks = stage(
        rows.mapInArrow(
            _feature_batches,
            "doc_id long, key long, host string, path string, features array<double>",
        ),
        "quality_features",
    )
    own = _evidence(looks, labels, label_column, sample)
    own = own.withColumn("own_score", 1 / (1 + F.exp(-F.col("odds"))))
    paths = stage(
        own.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("documents"), F.sum("own_score").alias("good")
        ),
        "quality_paths",
    )
    hosts = paths.groupBy("host").agg(
        F.sum("documents").alias("documents"), F.sum("good").alias("good")
    )
    whole = paths.agg(F.sum("documents").alias("n"), F.sum("good").alias("good")).collect()[0]
    if not whole["n"]:
        return own.select(
            "doc_id", "key", F.col("own_score").alias("score"), F.lit(True).alias("kept"),
            "own_score", F.col("own_score").alias("site_score"),
            F.lit(0).cast("long").alias("site_documents"),
        )
    share = min(max(whole["good"] / whole["n"], 1e-6), 1 - 1e-6)
    of_hosts, of_paths = (
        level.agg(_strength(level, F.lit(share)).alias("strength")).collect()[0]["strength"]
        for level in (hosts, paths)
    )
    hosts = hosts.select(
        F.col("host"),
        ((F.col("good") + of_hosts * share) / (F.col("documents") + of_hosts)).alias("host_score"),
    )
    sites = paths.join(hosts, "host").select(
        "host",
        "path",
        F.col("documents").alias("site_documents"),
        "good",
        "host_score",
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"),
    )
    salted = own.withColumn("salt", F.pmod(F.xxhash64("doc_id", "key"), F.lit(_SALTS)).cast("int"))
    joined = salted.join(stage(sites, "quality_sites"), ["host", "path", "salt"])
    others = F.col("site_documents") - 1
    site = (F.col("good") - F.col("own_score") + of_paths * F.col("host_score")) / (
        others + of_paths
    )
    odds = F.col("odds") + SITE_WEIGHT * (_logit(F.col("site_score")) - _logit(F.lit(share)))
    fitted = F.col("odds") != 0
    return (
        joined.withColumn("site_score", site)
        .withColumn("score", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id",
            "key",
            "score",
            ((F.col("score") >= threshold) | ~fitted).alias("kept"),
            "own_score",
            "site_score",
            "site_documents",
        )
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` of good quality, all columns as they were; labels as for all."""
    decided = (
        _scores(docs, labels, "doc_id", "text", "source", "lang", "quality", SAMPLE, THRESHOLD)
        .filter("not kept")
        .select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key"))
        .distinct()
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key"))
    return rows.join(decided, same, "left_anti").select("row.*")
