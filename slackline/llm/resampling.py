"""Importance resampling towards good text with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import row_key, stored, words

BUCKETS = 1 << 17
SLICE = 400_000
BINS = 1024
#: Shapes of the gamma distributions in the prior of the ratios, and rounds that weigh them.
SHAPES = 10.0 ** np.arange(-1, 7.5, 0.5)
ROUNDS = 100


def buckets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner) of all words and word pairs. ``owner`` is the text of each word."""
    h = hashes.view(np.uint64)
    half = np.uint64(BUCKETS // 2)
    one = h % half
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F)
    same = owner[:-1] == owner[1:]
    two = half + ((pair >> np.uint64(20)) % half)[same]
    return np.concatenate([one, two]).astype(np.int64), np.concatenate([owner, owner[:-1][same]])


def sliced(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words, owner) in runs of rows with a bounded number of words."""
    array = batch.column(column)
    values, ends = array.values.to_numpy(zero_copy_only=False), array.offsets.to_numpy()
    low = 0
    while low < len(array):
        high = int(np.searchsorted(ends, ends[low] + SLICE, side="left"))
        high = min(max(high, low + 1), len(array))
        owner = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
        yield low, values[ends[low] : ends[high]], owner
        low = high


def hashed_words(text) -> object:
    return F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))


def fit(df: DataFrame, target: str, text: str = "text", smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of target to raw probability of each bucket.

    The raw model counts all rows, the target model the rows where ``target`` is true; both over
    whole texts, summed in each task before anything is shuffled. The raw model is smoothed by
    adding ``smoothing`` to every count, the target model by ``ratios``.
    """
    rows = df.select(
        F.coalesce(F.col(target), F.lit(False)).alias("good"), hashed_words(F.col(text)).alias("words")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            flags = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            for low, values, owner in sliced(batch, "words"):
                found, of = buckets(values, owner)
                raw += np.bincount(found, minlength=BUCKETS)
                good += np.bincount(found[flags[low + of]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(good[at])], ["bucket", "raw", "good"]
        )

    parts = rows.mapInArrow(count, "bucket int, raw long, good long")
    table = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()
    raw, good = np.full(BUCKETS, smoothing), np.zeros(BUCKETS)
    at = table["bucket"].to_numpy(np.int64)
    raw[at] += table["raw"].to_numpy(float)
    good[at] += table["good"].to_numpy(float)
    raw /= raw.sum()
    target_model = raw * ratios(good, good.sum() * raw)
    return np.log(target_model / target_model.sum()) - np.log(raw)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers: Stirling's series at x + 8."""
    y = x + 8
    shift = sum(np.log(x + k) for k in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def ratios(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The posterior mean of every bucket's ratio of target to raw frequency.

    ``found`` of a bucket is Poisson around ratio * ``expected``. The prior of the ratios is a
    mixture of gamma distributions of mean one, ``SHAPES`` being how narrow they are; its weights
    are the likeliest ones for all buckets, found by expectation maximisation. So buckets that
    differ by chance only have a ratio near one, by as much as these counts show, and what is
    far from its expectation keeps its own ratio. Nothing is cut off.
    """
    s, found, expected = SHAPES[:, None], found[None, :], expected[None, :]
    like = log_gamma(s + found) - log_gamma(s) + s * np.log(s / (s + expected))
    like += found * np.log(np.maximum(expected, 1e-300) / (s + expected))
    like = np.exp(like - like.max(axis=0))
    weight = np.full(len(s), 1 / len(s))
    for _ in range(ROUNDS):
        share = weight[:, None] * like
        share /= share.sum(axis=0)
        weight = share.mean(axis=1)
    return (share * (s + found) / (s + expected)).sum(axis=0)


def score(df: DataFrame, model: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with ``log_weight``: the log importance ratio of its text, which is the sum of its
    n-grams' log ratios; null without words."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def weigh(column: pd.Series) -> pd.Series:
        ratios = shared.value
        out = np.full(len(column), np.nan)
        low = 0
        sizes = column.map(len).to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        while low < len(column):
            high = int(np.searchsorted(ends, ends[low] + SLICE, side="left"))
            high = min(max(high, low + 1), len(column))
            if ends[high] > ends[low]:
                values = np.concatenate([np.asarray(v, dtype=np.int64) for v in column.iloc[low:high]])
                owner = np.repeat(np.arange(high - low), sizes[low:high])
                found, of = buckets(values, owner)
                total = np.bincount(of, weights=ratios[found], minlength=high - low)
                n = np.bincount(of, minlength=high - low)
                out[low:high] = np.where(n > 0, total, np.nan)
            low = high
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return df.withColumn("log_weight", weigh(hashed_words(F.col(text))))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, by counting ever narrower bins; nothing is sorted or collected.

    Each round is one map-side aggregate. It ends when the bin that holds the k-th value has
    one value, or no number between its edges is left.
    """
    if k <= 0:
        return None
    v = F.col(column)
    edge = df.agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count(v).alias("n")).first()
    if edge["n"] < k:
        return edge["low"]
    low, high, above = edge["low"], edge["high"], 0
    while low < high:
        width = (high - low) / BINS
        bin_ = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        rows = (
            df.where(v.between(low, high)).groupBy(bin_.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).collect()
        )
        before = (low, high)
        for r in sorted(rows, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
        if (low, high) == before and width < 1e-12 * max(1.0, abs(low)):
            return low
    return low


def resample(
    df: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    temperature: float = 1.0,
    seed: int = 11,
) -> DataFrame:
    """(doc_id, log_weight, sample_key, kept): one row per row of ``df``.

    ``labels`` has (doc_id, quality, toxic). Target text is what labels call good (quality 1,
    toxic 0); an id labelled twice must be good both times. Gumbel top-k: ``sample_key`` is
    the log weight plus ``temperature`` times a Gumbel number, made of a hash of the row so
    that a repeated task gives the same. At 1, rows are drawn without replacement in proportion to
    their importance ratios. The ``share`` of rows with the largest keys is
    kept, by default the good share of all labels. Rows tied at the cut are all kept. Null
    texts and texts without words have null keys and are not kept.
    """
    good = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("_good")
    )
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Labels grow with the documents, so this is a shuffle join at any size.
    model = fit(rows.join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left"), "_good")
    if share is None:
        share = good.agg(F.avg(F.col("_good").cast("int"))).first()[0]
        share = 1.0 if share is None else float(share)
    draw = F.xxhash64(row_key(F.col("doc_id"), F.col("text")), F.lit(seed))
    unit = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / float(1 << 53)
    keyed = score(rows, model).select(
        "doc_id",
        "log_weight",
        (F.col("log_weight") - temperature * F.log(-F.log(unit))).alias("sample_key"),
    )
    keyed = stored(keyed)
    rows_with_key = keyed.where("sample_key IS NOT NULL").count()
    cut = kth_largest(keyed, "sample_key", int(np.ceil(share * rows_with_key)))
    kept = F.lit(False) if cut is None else F.coalesce(F.col("sample_key") >= F.lit(cut), F.lit(False))
    return keyed.withColumn("kept", kept)
