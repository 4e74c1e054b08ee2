"""Jaccard join on word shingles with Bayesian pruning of candidate pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.llm import shingles as sh
from slackline.llm.common import digest, row_key, stored, words
from slackline.session import small_batches

THRESHOLD = 0.8
BANDS, ROWS = 30, 5
ROUND = 30
TOLERANCE = 1e-7
BLOCK = 1024
GROUP_ROWS = 1500


def needed(hashes: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values among ``hashes`` with which a pair is not dropped.

    With a uniform prior the similarity has the posterior Beta(m + 1, h - m + 1) after m
    equal values of h; it reaches the threshold with the probability that a binomial of
    h + 1 draws at the threshold is at most m.
    """
    total = 0.0
    for m in range(hashes + 1):
        total += math.comb(hashes + 1, m) * threshold**m * (1 - threshold) ** (hashes + 1 - m)
        if total >= tolerance:
            return m
    return hashes


def text_id(doc_id: Column, text: Column) -> Column:
    """Equal for equal texts; a null text is known by its row's id."""
    return F.coalesce(digest(text), row_key(doc_id, text))


def hashed(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.transform(words(low), lambda w: F.xxhash64(w))


def minima(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of ``BANDS * ROWS`` 32-bit minima per run of ``found``."""
    out = np.empty((len(starts), BANDS * ROWS), dtype=np.uint32)
    for k, c in enumerate(sh.constants(BANDS * ROWS, 7)):
        permuted = ((found * c) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(permuted, starts)
    return out


def _signed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, signatures, shingles, ends of the shingles) of rows that have words."""
    for low, _, values, counts in sh.slices(batch.column("words")):
        found, owner, _ = sh.shingles(values, counts)
        if not len(found):
            continue
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        fresh = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
        found, owner = found[fresh], owner[fresh]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        yield low + owner[starts], minima(found, starts), found, np.append(starts, len(found))


def bucket_rows(rows: DataFrame) -> DataFrame:
    """(bucket, band, tid): one row per band of every text with words, copies merged."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = sh.constants(BANDS * ROWS, 9)
        for batch in batches:
            names = batch.column("tid")
            for at, signature, _, _ in _signed(batch):
                wide = signature.astype(np.uint64) * salts
                mixed = sh.mixed(wide.reshape(len(at), BANDS, ROWS).sum(axis=2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mixed.view(np.int64).ravel()),
                        pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(at))),
                        names.take(pa.array(np.repeat(at, BANDS))),
                    ],
                    ["bucket", "band", "tid"],
                )

    return rows.mapInArrow(bands, "bucket long, band int, tid binary").distinct()


def buckets(rows: DataFrame) -> DataFrame:
    """(tid, bucket, band, n): rows of the buckets to compare.

    Buckets with one text need no comparison. Of buckets with the same texts the one of the
    lowest band stands for all: it compares every pair the others would.
    """
    with small_batches(rows.sparkSession):
        every = stored(bucket_rows(rows))
    h = F.xxhash64("tid")
    sizes = every.groupBy("bucket", "band").agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 20)).alias("s")
    )
    firsts = sizes.where("n > 1").groupBy("n", "x", "s").agg(F.min(F.struct("band", "bucket")).alias("b"))
    chosen = stored(firsts.select("b.band", "b.bucket", "n"))
    return every.join(chosen, ["bucket", "band"]).select("tid", "bucket", "band", "n")


def payload(rows: DataFrame) -> DataFrame:
    """(tid, signature, shingles) as bytes; the shingles sorted and distinct."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("tid")
            for at, signature, found, ends in _signed(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(at)),
                        pa.array([s.tobytes() for s in signature], type=pa.binary()),
                        pa.array([found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], type=pa.binary()),
                    ],
                    ["tid", "signature", "shingles"],
                )

    return rows.mapInArrow(make, "tid binary, signature binary, shingles binary")


def pairs_of(
    signatures: np.ndarray, sets: list[np.ndarray], band: int, left: np.ndarray, right: np.ndarray | None
) -> Iterator[tuple[int, np.ndarray]]:
    """(a, partners) of the pairs at or above the threshold whose first common band is ``band``.

    ``right`` None: the pairs within ``left``; else those between the two.
    """
    rounds = [(lo, min(lo + ROUND, BANDS * ROWS)) for lo in range(0, BANDS * ROWS, ROUND)]
    least = [needed(hi) for _, hi in rounds]
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(ids, np.cumsum(sizes)[:-1])
    mark = np.zeros(max((int(i.max()) for i in ids if len(i)), default=0) + 1, dtype=bool)
    for place, a in enumerate(left):
        js = left[place + 1 :] if right is None else right
        equal = np.zeros(len(js), dtype=np.int32)
        for (lo, hi), bar in zip(rounds, least, strict=True):
            equal += (signatures[js, lo:hi] == signatures[a, lo:hi]).sum(axis=1, dtype=np.int32)
            alive = equal >= bar
            if not alive.all():
                js, equal = js[alive], equal[alive]
            if not len(js):
                break
        if len(js) and band:
            same = signatures[js, : band * ROWS] == signatures[a, : band * ROWS]
            js = js[~same.reshape(len(js), band, ROWS).all(axis=2).any(axis=1)]
        if not len(js):
            continue
        mark[ids[a]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[js])[:-1]])
        both = np.add.reduceat(mark[np.concatenate([ids[j] for j in js])].astype(np.int64), starts)
        mark[ids[a]] = False
        linked = js[both >= THRESHOLD * (sizes[a] + sizes[js] - both) - 1e-9]
        if len(linked):
            yield a, linked


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """(tid, n_links, root) of the linked texts of every block pair in ``pdf``."""
    out: list[tuple[bytes, int, bytes]] = []
    for (_, p, q), group in pdf.groupby(["bucket", "p", "q"], sort=True):
        group = group.drop_duplicates("tid").sort_values("tid")
        names, blocks = list(map(bytes, group["tid"])), group["block"].to_numpy()
        signatures = np.frombuffer(b"".join(group["signature"]), dtype=np.uint32).reshape(len(names), -1)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
        left, right = np.flatnonzero(blocks == p), None if p == q else np.flatnonzero(blocks == q)
        root, count = np.arange(len(names)), np.zeros(len(names), dtype=np.int64)

        def top(i: int, root: np.ndarray = root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, partners in pairs_of(signatures, sets, int(group["band"].iloc[0]), left, right):
            count[a] += len(partners)
            count[partners] += 1
            for b in partners:
                x, y = top(int(a)), top(int(b))
                root[max(x, y)] = min(x, y)
        for i in np.flatnonzero(count):
            out.append((names[i], int(count[i]), names[top(int(i))]))
    return pd.DataFrame(out, columns=["tid", "n_links", "root"])


def links(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """(tid, n_links, root), stored: for every block of compared texts, how many others each
    text is linked to there, and the smallest text it hangs together with.

    ``rows`` has (doc_id, tid, words); ``reps`` (tid, doc_id) names one row of each text. A
    bucket with more than ``BLOCK`` texts is cut into blocks by a hash, and every pair of
    blocks is a group of its own; small buckets share groups. No pair becomes a row.
    """
    to_compare = stored(buckets(rows.select("tid", "words")))
    per_text = to_compare.groupBy("tid").agg(F.collect_list(F.struct("bucket", "band", "n")).alias("in"))
    one = per_text.join(reps, "tid").select(
        F.col("tid").alias("t"), F.col("doc_id").alias("d"), "in"
    )
    same = (F.col("tid") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    chosen = rows.join(one.select("t", "d"), same, "left_semi").select("tid", "words")
    full = payload(chosen).join(per_text, "tid").select("*", F.explode("in").alias("b"))
    blocks = F.ceil(F.col("b.n") / BLOCK).cast("int")
    total = to_compare.count()
    groups = max(1, -(-total // GROUP_ROWS))
    full = full.select(
        "tid", "signature", "shingles", "b.bucket", "b.band", blocks.alias("blocks"),
        F.pmod(F.xxhash64("tid", F.lit(3)), blocks.cast("long")).cast("int").alias("block"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    full = full.select(
        "tid", "signature", "shingles", "bucket", "band", "block",
        F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        F.when(F.col("blocks") > 1, F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")))
        .otherwise(F.pmod(F.xxhash64("bucket"), F.lit(groups))).alias("group"),
    )
    found = full.groupBy("group").applyInPandas(_links, "tid binary, n_links long, root binary")
    with small_batches(rows.sparkSession):
        return stored(found)


def components(edges: DataFrame) -> DataFrame:
    """(tid, component): the smallest text of each connected part, of (tid, root) edges.

    Alternates large and small stars until nothing changes, in a number of rounds that grows
    with the logarithm of the size. Minima are taken map-side; rounds are stored.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 24))).first())

    current = stored(ordered(edges.select(F.col("tid").alias("a"), F.col("root").alias("b"))))
    before = None
    while (now := state(current)) != before:
        before = now
        if not now[0]:
            break
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = ordered(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        current = stored(ordered(small))
    return current.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("tid"), "component")


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(tid, doc_id, class_id, keeper, n_links, n_copies): one row per different text, stored.

    ``class_id`` is the smallest id of all rows in the class; ``keeper`` marks the text
    that holds it and ``doc_id`` is the text's smallest id. ``n_links`` counts the other
    texts with a similarity of at least ``THRESHOLD``; ``n_copies`` the other rows with the
    same text. Texts without words, and null ones, link to no other text.
    """
    rows = df.select(
        F.col(doc_id).alias("doc_id"), text_id(F.col(doc_id), F.col(text)).alias("tid"), hashed(F.col(text)).alias("words")
    )
    reps = stored(
        rows.groupBy("tid").agg(F.min("doc_id").alias("doc_id"), (F.count("*") - 1).alias("n_copies"))
    )
    found = links(rows, reps.select("tid", "doc_id"))
    counted = found.groupBy("tid").agg(F.sum("n_links").alias("n_links"))
    part = components(found)
    joined = reps.join(counted, "tid", "left").join(part, "tid", "left").select(
        "tid", "doc_id", "n_copies", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "tid").alias("component"),
    )
    # A class holds different texts only: copies were merged, so a class of copies is one row.
    joined = stored(joined)
    first = joined.groupBy("component").agg(
        F.min_by(F.struct("doc_id", "tid"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tid"))).alias("first")
    )
    return stored(
        joined.join(first, "component").select(
            "tid", "doc_id", F.col("first.doc_id").alias("class_id"), (F.col("tid") == F.col("first.tid")).alias("keeper"),
            "n_links", "n_copies",
        )
    )


def join_similar(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_copies): one row per row of ``df``.

    Texts are compared as sets of five-word shingles of their lower-cased words. A null
    text is a class of the rows with its id.
    """
    known = classes(df, doc_id, text).select("tid", "class_id", "n_links", "n_copies")
    members = df.select(F.col(doc_id).alias("doc_id"), text_id(F.col(doc_id), F.col(text)).alias("tid"))
    return members.join(known, "tid").select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one with the smallest id, with all its columns. Of rows
    with equal id and text any one stays."""
    keepers = classes(df, doc_id, text).where("keeper").select(
        F.struct(F.col("tid"), F.col("doc_id")).alias("_keeper")
    )
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.struct(text_id(F.col(doc_id), F.col(text)).alias("tid"), F.col(doc_id).alias("doc_id")).alias("_name"),
    )
    alone = Window.partitionBy("_name.tid", "_name.doc_id").orderBy(F.lit(0))
    first = whole.withColumn("_place", F.row_number().over(alone)).where("_place = 1")
    same = (F.col("_name.tid") == F.col("_keeper.tid")) & F.col("_name.doc_id").eqNullSafe(F.col("_keeper.doc_id"))
    return first.join(keepers, same, "left_semi").select("_row.*")
