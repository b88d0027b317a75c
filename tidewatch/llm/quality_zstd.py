"""Quality classifier: a text is like the side whose zstandard dictionary shrinks it more."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import crc_fold, table


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the logistic curve from size difference to the chance of label 1.

    Without a dictionary (no labelled text of one side) every score is ``prior``.
    """

    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float
    level: int = 3


def _compressor(model: CompressionModel, content: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(content)
    trained.precompute_compress(level=model.level)
    return zstandard.ZstdCompressor(dict_data=trained, level=model.level)


def size_difference(model: CompressionModel) -> Column:
    """A Pandas UDF of a text column: (bytes with the bad dictionary - with the good one) / bytes.

    Whole texts are compressed; NULL counts as the empty text, whose difference is 0.
    """
    kept: dict[str, zstandard.ZstdCompressor] = {}

    @F.pandas_udf("double")
    def difference(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not kept:
            kept.update(good=_compressor(model, model.good), bad=_compressor(model, model.bad))
        good, bad = kept["good"].compress, kept["bad"].compress

        def one(text: str | None) -> float:
            raw = (text or "").encode("utf-8", "replace")
            return (len(bad(raw)) - len(good(raw))) / len(raw) if raw else 0.0

        for texts in batches:
            yield pd.Series([one(text) for text in texts], dtype="float64")

    return difference


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps; a slight penalty keeps separable data finite."""
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        weights = weights + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return float(weights[0] / scale), float(weights[1])


def _train(pieces: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; texts too few to train on are one as they are."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, pieces)) // 8)),
                                          pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-size:]


def fit_compression_model(
    labelled: DataFrame, *, text: str = "text", label: str = "label", order: Column | None = None,
    side_rows: int = 1500, curve_rows: int = 6000, piece_chars: int = 2000,
    dictionary_bytes: int = 256 * 1024,
) -> CompressionModel:
    """Learn from rows (text, label 0 or 1). Rows with another label or no text are left out.

    The fit uses a bounded sample in the order of ``order`` (a hash of the text if not given).
    Of the rows whose order is even, ``side_rows`` texts of each label feed the dictionaries
    over their whole length, in stretches of ``piece_chars`` characters; of the odd ones,
    ``curve_rows`` texts in their natural mix, compressed whole, fit the curve. The driver
    holds the texts of both sides.
    """
    order = F.xxhash64(text) if order is None else order
    rows = labelled.select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("label"), order.alias("_order")
    ).filter(F.col("text").isNotNull() & (F.col("text") != "") & F.col("label").isin(0, 1))
    even = F.pmod("_order", F.lit(2)) == 0
    taken = [
        [text[at:at + piece_chars].encode()
         for (text,) in _first(rows.filter((F.col("label") == side) & even), side_rows)
         .select("text").collect() for at in range(0, len(text), piece_chars)]
        for side in (0, 1)
    ]
    prior = 0.5 if bool(taken[0]) == bool(taken[1]) else float(bool(taken[1]))
    if not all(taken):
        return CompressionModel(b"", b"", 0.0, 0.0, prior)
    good, bad = _train(taken[1], dictionary_bytes), _train(taken[0], dictionary_bytes)
    difference = size_difference(CompressionModel(good, bad, 0.0, 0.0, prior))
    for part in (rows.filter(~even), rows):  # with few labels, all of them
        points = _first(part, curve_rows).select(difference("text").alias("x"), "label").collect()
        y = np.array([row["label"] for row in points], dtype=float)
        if 20 <= y.sum() <= len(y) - 20:
            break
    slope, offset = _fit_logistic(np.array([row["x"] for row in points], dtype=float), y)
    return CompressionModel(good, bad, slope, offset, prior)


def _first(rows: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows by ``_order``; the cut is found on that column alone."""
    cut = rows.select("_order").orderBy("_order").limit(count).agg(F.max("_order")).first()[0]
    return rows.filter(F.col("_order") <= F.lit(cut)).limit(count)


def quality_score(model: CompressionModel, text: Column) -> Column:
    """The calibrated score in [0, 1]; higher means label 1 is likelier."""
    if not model.good:
        return F.lit(model.prior)
    difference = size_difference(model)(text)
    return 1 / (1 + F.exp(-(F.lit(model.slope) * difference + F.lit(model.offset))))


HELD_OUT = 1


def labelled_texts(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000) -> DataFrame:
    """(text, label, order) of labelled documents outside the held-out third.

    Which rows are sampled is settled on ids alone: the first ``sample_rows`` labels in the
    order of a hash go to the documents as a broadcast of that bound.
    """
    known = labels.filter((crc_fold("doc_id", 3) != HELD_OUT) & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col("quality").alias("label"),
        F.xxhash64("doc_id").alias("order"),
    ).filter(F.col("_id").isNotNull())
    sample = known.orderBy("order").limit(sample_rows)
    return docs.select("doc_id", "text").join(
        F.broadcast(sample), F.col("doc_id") == F.col("_id")
    ).select("text", "label", "order")


def document_model(spark: SparkSession, folder: str, docs: DataFrame | None = None) -> CompressionModel:
    docs = table(spark, folder, "documents") if docs is None else docs
    labelled = labelled_texts(docs, table(spark, folder, "labels"))
    return fit_compression_model(labelled, order=F.col("order"))


def op7_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every whole text; a third of the labels is held out by CRC-32 of the id."""
    docs = table(spark, folder, "documents")
    model = document_model(spark, folder)
    return docs.select(
        "doc_id", (crc_fold("doc_id", 3) == HELD_OUT).alias("held_out"),
        quality_score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def reject_low_quality(docs: DataFrame, model: CompressionModel, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their own columns only."""
    names = docs.columns
    scored = docs.select(F.struct("*").alias("row"), quality_score(model, F.col("text")).alias("_s"))
    return scored.filter(F.col("_s") >= threshold).select(
        *[F.col("row")[name].alias(name) for name in names]
    )
