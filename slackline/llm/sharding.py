"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import digest, numbered, stored

SHARDS = 24
BATCH = 20_000


def difference(loads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions into one.

    ``loads`` has one row per partial partition, the loads of its parts. The two with the
    largest spread are combined, the heaviest part of one with the lightest of the other,
    until one is left. Returns for each row which final part its parts go to, and the loads.
    """
    n, parts = loads.shape
    if n == 0:
        return np.zeros((0, parts), dtype=np.int64), np.zeros(parts, dtype=np.int64)
    order = np.argsort(-loads, axis=1, kind="stable")
    sums: list = [None] * (2 * n - 1)
    for i in range(n):
        sums[i] = loads[i][order[i]]
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(sums[:n])]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    new = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        sort = np.argsort(-both, kind="stable")
        sums[new] = both[sort]
        sums[a] = sums[b] = None
        joined.append((a, b, sort))
        heapq.heappush(heap, (-int(sums[new][0] - sums[new][-1]), new))
        new += 1
    # Places of each partial's sorted parts in the final one, from the last step back.
    places: dict[int, np.ndarray] = {new - 1: np.arange(parts)}
    goes = np.empty((n, parts), dtype=np.int64)
    for step in range(len(joined) - 1, -1, -1):
        a, b, sort = joined[step]
        after = places.pop(n + step)
        place = np.empty(parts, dtype=np.int64)
        place[sort] = after  # place of part j of ``both``
        places[a], places[b] = place, place[::-1]
    for i in range(n):
        goes[i][order[i]] = places[i]
    return goes, sums[new - 1]


def balance(groups: DataFrame, key: str, load: str, shards: int = SHARDS, batch: int = BATCH) -> DataFrame:
    """(key, shard): every group whole in one shard, the loads near equal.

    Groups are dealt by a hash of the key into batches of about ``batch``; each is
    differenced in one task into a partial partition, a row of ``shards`` loads. Those rows
    are differenced in the same way, level by level, until one partition is left, so
    neither a task nor the driver sees more than one batch at a time.
    """
    level = stored(
        groups.select(
            F.col(key).alias("member"),
            F.concat(F.array(F.col(load).cast("long")), F.array_repeat(F.lit(0).cast("long"), shards - 1)).alias("loads"),
        )
    )
    steps = []
    while True:
        rows = level.count()
        batches = max(1, -(-rows // batch))
        dealt = level.withColumn("batch", F.pmod(F.xxhash64("member", F.lit(len(steps))), F.lit(batches)))

        def combine(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("member", ignore_index=True)
            goes, total = difference(np.stack(pdf["loads"].to_numpy()).astype(np.int64))
            out = pd.DataFrame({"batch": pdf["batch"], "member": pdf["member"], "goes": list(goes)})
            sums = pd.DataFrame({"batch": [pdf["batch"][0]], "member": [None], "goes": [total]})
            return pd.concat([out, sums], ignore_index=True)

        kind = level.schema["member"].dataType.simpleString()
        done = stored(dealt.groupBy("batch").applyInPandas(combine, f"batch long, member {kind}, goes array<long>"))
        steps.append(done.where("member IS NOT NULL"))
        if batches == 1:
            break
        level = stored(done.where("member IS NULL").select(F.col("batch").alias("member"), F.col("goes").alias("loads")))
    # From the top: where the parts of each partial partition end up.
    final = None
    for step in reversed(steps):
        if final is None:
            final = step.select("member", "goes")
        else:
            above = final.select(F.col("member").alias("batch"), F.col("goes").alias("after"))
            both = step.join(above, "batch")
            final = both.select("member", F.transform("goes", lambda p: F.get("after", p.cast("int"))).alias("goes"))
    return final.select(F.col("member").alias(key), F.get("goes", F.lit(0)).cast("int").alias("shard"))


def shard_documents(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per row of ``df``.

    Rows of equal text share a shard; all null texts are one group. ``size`` is the text's
    UTF-8 bytes (none for null) plus 8. The law is ``bytes``, so ``grown_shard`` is null.
    Slots number a shard's rows from 0, ordered within hashed chunks. A group with more
    than a shard's share of all bytes fills its shard alone and the others are balanced.
    """
    rows = stored(
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(digest(F.col(text)), F.lit(b"null").cast("binary")).alias("group"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        )
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("load"))
    dealt = stored(rows.join(balance(groups, "group", "load", shards), "group"))
    slots = numbered(dealt, ["shard"], ["doc_id", "group"], "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
