"""Benchmark items inside documents: size-partitioned MinHash containment, verified exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.llm import shingles as sh
from slackline.llm.common import row_key, stored
from slackline.session import small_batches

THRESHOLD = 0.8
HASHES = 48
MOST_BITS = 24


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for null."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(split, "")


def shingle_at(words: Column, first: Column) -> Column:
    return F.array_join(F.slice(words, first + 1, F.lit(sh.WIDTH)), " ")


def level_of(size: int) -> int:
    """Partition of an item by its number of shingles: 2^level to twice that, less one."""
    return size.bit_length() - 1


def salt(level: int, k: int) -> np.uint64:
    return sh.mixed(np.array([level * 1000 + k + 1], dtype=np.uint64))[0]


class Filter:
    """A Bloom filter of 64-bit keys; false positives only cost time.

    The first probe is a part of the key itself, the others of the key mixed anew, which only
    keys that pass the first one need.
    """

    SHIFT = 3
    MIXED = (0, 20, 40)

    def __init__(self, words: np.ndarray) -> None:
        self.table = np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)
        self.mask = np.uint64(len(self.table) - 1)

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys that may be in the filter."""
        found = np.flatnonzero(self.table[((keys >> np.uint64(self.SHIFT)) & self.mask).view(np.int64)])
        again = sh.mixed(keys[found])
        for shift in self.MIXED:
            held = self.table[((again >> np.uint64(shift)) & self.mask).view(np.int64)]
            found, again = found[held], again[held]
        return found


def bloom_words(keys: DataFrame, column: str, mixed: str, count: int) -> np.ndarray:
    """The 64-bit words of a filter with about 64 bits a key, 2^``MOST_BITS`` at most.

    ``mixed`` is ``column`` mixed anew. The words are put together by Spark; the driver gets at most
    2^18 pairs of numbers.
    """
    bits = 1 << min(MOST_BITS, max(16, (64 * max(1, count)).bit_length()))
    probes = [(column, Filter.SHIFT), *[(mixed, shift) for shift in Filter.MIXED]]
    spots = F.array(*[F.shiftrightunsigned(c, s).bitwiseAND(F.lit(bits - 1)) for c, s in probes])
    rows = (
        keys.select(F.explode(spots).alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot % 64 AS INT))")).alias("bits"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def item_signatures(items: DataFrame) -> DataFrame:
    """``items`` with ``sign``: a key per hash function and every shingle's hash, each with itself mixed anew."""
    pair = "array<struct<own:long,mixed:long>>"

    def pairs(values: np.ndarray) -> list[dict[str, int]]:
        both = zip(values.view(np.int64).tolist(), sh.mixed(values).view(np.int64).tolist(), strict=True)
        return [{"own": own, "mixed": mixed} for own, mixed in both]

    @F.pandas_udf(f"struct<level:int,keys:{pair},hashes:{pair}>")
    def sign(hashed: pd.Series) -> pd.DataFrame:
        out = []
        for values in hashed:
            words = np.asarray(values, dtype=np.int64).view(np.uint64)
            found = np.unique(sh.shingles(words, np.array([len(words)]))[0])
            level = level_of(len(found))
            keys = [
                (found * c).min() ^ salt(level, k) for k, c in enumerate(sh.constants(HASHES, 21))
            ]
            out.append((level, pairs(np.array(keys, dtype=np.uint64)), pairs(found)))
        return pd.DataFrame(out, columns=["level", "keys", "hashes"])

    return items.withColumn("sign", sign(F.transform("words", lambda w: F.xxhash64(w))))


def window_minima(values: np.ndarray, starts: dict[int, tuple], levels: list[int]) -> dict[int, np.ndarray]:
    """Minima of ``values`` over the windows of every level.

    A window is three neighbouring steps of 2^level shingles of one text, so it holds every
    run of up to 2^(level + 1) shingles that starts in its first step.
    """
    out, base = {}, values
    for level in levels:
        index, last, last_two = starts[level]
        steps = np.minimum.reduceat(base, index)
        low = steps.copy()
        low[:-1] = np.minimum(low[:-1], steps[1:] | last[:-1])
        low[:-2] = np.minimum(low[:-2], steps[2:] | last_two[:-2])
        out[level] = low
        base = steps
    return out


def step_starts(counts: np.ndarray, levels: list[int]) -> dict[int, tuple]:
    """For each level: where its steps begin among those of the level before (the first
    among shingles); all ones for a text's last step, and for its last two, else zero."""
    out, below, width = {}, counts, None
    for level in levels:
        size = 1 << (level if width is None else level - width)
        steps = -(-below // size)
        begin = np.cumsum(below) - below
        first = np.repeat(begin, steps)
        place = np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)
        left = np.repeat(steps, steps) - place
        marks = [np.where(left > n, np.uint64(0), sh.EMPTY) for n in (1, 2)]
        out[level] = (first + place * size, *marks)
        below, width = steps, level
    return out


def find(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """(row, doc_id, item_id, n_shingles, n_found, containment): items found in documents.

    An item is found where at least ``threshold`` of its different five-word shingles stand
    anywhere in the document. Words are lower-case runs of letters and digits; an item of
    fewer than five words is one shingle, which only a text of the same words holds. Null and
    empty texts, on either side, hold and are nothing. Rows equal in id and text count once,
    on either side; ``row`` is their key.

    Items are partitioned by their number of shingles. For each partition a document is cut
    into windows three steps long, a step being the partition's least size; an item that
    stands there together shares at least a quarter of the window. An item is a candidate
    if any of ``HASHES`` window minima is its own, which happens for all but one of a
    million such windows. Minima reach the join only if a Bloom filter of the items' minima
    has them. Candidates are verified on the shingles' text.
    """
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
        .select("item_id", row_key(F.col("item_id"), F.col("text")).alias("item"), tokens(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .dropDuplicates(["item"])
    )
    signed = stored(item_signatures(items))
    item_keys = signed.select("item", F.inline("sign.keys")).withColumnRenamed("own", "key")
    hashes = signed.select(F.inline("sign.hashes"))
    last = F.greatest(F.size("words") - sh.WIDTH, F.lit(0))
    item_shingles = signed.select(
        "item", "item_id",
        F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: shingle_at(F.col("words"), i))).alias("all"),
    ).select("item", "item_id", F.size("all").alias("n_shingles"), F.explode("all").alias("shingle"))

    levels = sorted(r["level"] for r in signed.select("sign.level").distinct().collect())
    size = signed.agg(F.count("*"), F.sum(F.size("sign.hashes"))).first()
    context = df.sparkSession.sparkContext
    shared = context.broadcast((
        bloom_words(item_keys, "key", "mixed", HASHES * size[0]), bloom_words(hashes, "own", "mixed", size[1] or 0),
    ))

    @F.pandas_udf("struct<keys:array<long>,at:array<int>>")
    def search(hashed: pd.Series) -> pd.DataFrame:
        keys_filter, hash_filter = (Filter(w) for w in shared.value)
        multipliers = sh.constants(HASHES, 21)
        salts = {(level, k): salt(level, k) for level in levels for k in range(HASHES)}
        keys_out: list = [np.empty(0, dtype=np.int64)] * len(hashed)
        at_out: list = [np.empty(0, dtype=np.int32)] * len(hashed)
        sizes = hashed.map(len).to_numpy(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        low = 0
        while low < len(hashed):
            high = int(np.searchsorted(ends, ends[low] + sh.SLICE, side="left"))
            high = min(max(high, low + 1), len(hashed))
            if levels and ends[high] > ends[low]:
                words = np.concatenate([np.asarray(v, dtype=np.int64) for v in hashed.iloc[low:high]]).view(np.uint64)
                found, owner, first = sh.shingles(words, sizes[low:high])
                counts = np.bincount(owner, minlength=high - low)
                starts = step_starts(counts, levels)
                owners = {level: owner[_origin(starts, levels, level)] for level in levels}
                hits: list[tuple[np.ndarray, np.ndarray]] = []
                for k, c in enumerate(multipliers):
                    for level, minima in window_minima(found * c, starts, levels).items():
                        key = minima ^ salts[level, k]
                        hit = keys_filter.hits(key)
                        if len(hit):
                            hits.append((owners[level][hit], key[hit]))
                if hits:
                    rows, keys = (np.concatenate(x) for x in zip(*hits, strict=True))
                    for row in np.unique(rows):
                        keys_out[low + row] = np.unique(keys[rows == row]).view(np.int64)
                        a, b = np.searchsorted(owner, [row, row + 1])
                        at_out[low + row] = first[a:b][hash_filter.hits(found[a:b])].astype(np.int32)
            low = high
        return pd.DataFrame({"keys": keys_out, "at": at_out})

    # The text goes past the search, not its words: few rows need them again.
    rows = df.select(
        F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text")
    )
    # Spark would search a deterministic hit twice, once for the filter and once for the columns, in
    # two Python workers a task.
    once = search.asNondeterministic()
    searched = rows.withColumn("hit", once(F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w))))
    hit = searched.where(F.size("hit.keys") > 0).select(
        "doc_id", "row", "hit.keys", "hit.at", tokens(F.col("text")).alias("words")
    ).select(
        "doc_id", "row", "keys",
        F.array_distinct(F.transform("at", lambda i: shingle_at(F.col("words"), i))).alias("held"),
    )
    with small_batches(df.sparkSession):
        hit = stored(hit)
    candidates = (
        hit.select("row", F.explode("keys").alias("key")).join(item_keys.select("item", "key"), "key").select("row", "item").distinct()
    )
    held = hit.select("doc_id", "row", F.explode("held").alias("shingle")).distinct()
    # Candidates come first: a shingle of many items and documents meets only pairs of these.
    pairs = candidates.join(held, "row").join(item_shingles, ["item", "shingle"])
    shares = pairs.groupBy("row", "item").agg(
        F.first("doc_id").alias("doc_id"), F.first("item_id").alias("item_id"),
        F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n_found"),
    )
    return shares.where(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles") - 1e-9).select(
        "row", "doc_id", "item_id", "n_shingles", "n_found",
        (F.col("n_found") / F.col("n_shingles")).alias("containment"),
    )


def _origin(starts: dict[int, tuple], levels: list[int], level: int) -> np.ndarray:
    """The first shingle of every step of ``level``."""
    at = starts[level][0]
    for below in reversed(levels[: levels.index(level)]):
        at = starts[below][0][at]
    return at


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``df`` in which no benchmark item is found, with all their columns."""
    bad = find(df, benchmark, doc_id, text).select(F.struct("row").alias("_bad")).distinct()
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        row_key(F.col(doc_id), F.col(text)).alias("_key"),
    )
    return whole.join(bad, F.col("_key") == F.col("_bad.row"), "left_anti").select("_row.*")
