"""Best-fit packing of token pieces, planned on the counts of their lengths."""

from __future__ import annotations

import os
import string
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import numbered, row_key, stored
from slackline.session import small_batches

CAPACITY = 2048
CACHE = 800_000
PART_BYTES = 64
RUN_CHARS = 500_000
TOGETHER = 4096
# ASCII punctuation but the apostrophe, which begins parts of words such as 's.
MARKS = string.punctuation.replace("'", "").encode()

PIECES = "key binary, doc_id {id}, piece int, start long, length long, ids_crc32 long, ids binary"


class WordIds:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space, never looks across it, takes ASCII letters in lower case
    and cuts between letters and the marks after them. So a text is put in lower case as far as it
    is ASCII, cut at spaces, and each part is looked up. Unseen parts made of letters are encoded
    together and told apart by the tokenizer's word numbers; a part of letters with marks at
    its end is put together from both; any other unseen part is encoded alone. The table only
    saves time: it is emptied when it is full, long parts are not kept, and the tasks of a Python
    worker share it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode().lower() for token in special]
        self.table: dict[bytes, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """The one of this process. Task code comes by value and has no module to keep it."""
        held = sys.modules.setdefault("_slackline_worker", ModuleType("_slackline_worker")).__dict__
        if held.get("path") != path:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores are Spark's
            held["words"], held["path"] = cls(path), path
        return held["words"]

    def cut(self, text: str) -> list[bytes]:
        raw = text.encode()
        low = raw.lower()
        if any(token in low for token in self.special):
            low = raw  # special tokens are known by their exact letters
        return low.replace(b"\n", b" ").split(b" ")

    def encode(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each part by itself, a bounded number of bytes at a time: codes are large."""
        low = 0
        while low < len(parts):
            high, size = low, 0
            while high < len(parts) and (high == low or size + len(parts[high]) <= TOGETHER):
                size += len(parts[high])
                high += 1
            some = parts[low:high]
            codes = self.tokenizer.encode_batch_fast([part.decode() for part in some], add_special_tokens=False)
            yield from [(part, np.asarray(code.ids, dtype="<u4").tobytes()) for part, code in zip(some, codes, strict=True)]
            low = high

    def learn(self, parts: set[bytes]) -> list[bytes]:
        """Put all ``parts`` into the table; returns the long ones."""
        table = self.table
        new = parts.difference(table)
        if len(table) + len(new) > CACHE:
            table.clear()
            new = parts
        words, alone, ended = set(), set(), []
        for part in new:
            word = part.rstrip(MARKS) if len(part) <= PART_BYTES else b""
            # Lower case first: of some letters it has marks that are no letters.
            if not word or not (word.isalpha() or word.decode().lower().isalpha()):
                alone.add(part)
            elif len(word) == len(part):
                words.add(part)
            else:
                marks = part[len(word) :]
                ended.append((part, word, marks))
                if word not in table:
                    words.add(word)
                if marks not in table:
                    alone.add(marks)
        together = list(words)
        for low in range(0, len(together), 512):
            some = together[low : low + 512]
            code = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
            ids, numbers = np.asarray(code.ids, dtype="<u4"), np.asarray(code.word_ids)
            ends = (np.flatnonzero(numbers[1:] != numbers[:-1]) * 4 + 4).tolist()
            whole = ids.tobytes()
            if len(ends) + 1 != len(some):  # the tokenizer sees other letters than Python does
                table.update(self.encode(some))
            else:
                table.update(zip(some, map(whole.__getitem__, map(slice, [0, *ends], [*ends, len(whole)])), strict=True))
        table.update(self.encode(list(alone)))
        for part, word, marks in ended:
            table[part] = table[word] + table[marks]
        return [part for part in alone if len(part) > PART_BYTES]

    def of(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(text) for text in texts]
        long = self.learn(set().union(*cut))
        look = self.table.__getitem__
        ids = [b"".join(map(look, parts)) for parts in cut]
        for part in long:
            self.table.pop(part, None)
        return ids


def runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts with a bounded number of characters."""
    low = size = 0
    for at, text in enumerate(texts):
        if at > low and size + len(text) > RUN_CHARS:
            yield low, at
            low, size = at, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


def cut_pieces(
    df: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces (key, doc_id, piece, start, length, ids_crc32, ids) of every row.

    A row's ids end with ``end``. Only longer ones are cut, into pieces of ``capacity`` and a
    shorter last one. A null or empty text is one piece that holds ``end`` alone. ``ids``,
    little-endian 32-bit, are null unless ``with_ids``.
    """
    tail = np.asarray([end], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of_worker(tokenizer)
        for batch in batches:
            texts = [body or "" for body in batch.column("text").to_pylist()]
            for first, last in runs(texts):
                rows, numbers, parts = [], [], []
                for row, ids in enumerate(words.of(texts[first:last]), first):
                    ids = ids + tail
                    lows = range(0, len(ids), 4 * capacity)
                    rows += [row] * len(lows)
                    numbers += range(len(lows))
                    parts += [ids[low : low + 4 * capacity] for low in lows]
                at, number = pa.array(rows, pa.int64()), np.asarray(numbers, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(at), batch.column("doc_id").take(at), pa.array(number.astype(np.int32)),
                        pa.array(number * capacity), pa.array([len(part) // 4 for part in parts], pa.int64()),
                        pa.array([zlib.crc32(part) for part in parts], pa.int64()),
                        pa.array(parts if with_ids else [None] * len(parts), pa.binary()),
                    ],
                    ["key", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    rows = df.select(
        row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    return rows.mapInArrow(pieces, PIECES.format(id=df.schema[doc_id].dataType.simpleString()))


class _Plan:
    """Bins as ranges of equal content: (first bin, number of bins) by remaining gap."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.gaps: list[int] = []
        self.ranges: dict[int, list[tuple[int, int]]] = {}
        self.bins = 0
        self.used: dict[int, int] = {}
        self.moves: list[tuple[int, int, int, int, int, int]] = []

    def put(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in self.ranges:
                self.ranges[gap] = []
                insort(self.gaps, gap)
            self.ranges[gap].append((first, count))

    def take(self, gap: int) -> tuple[int, int]:
        spot = self.ranges[gap].pop()
        if not self.ranges[gap]:
            del self.ranges[gap]
            self.gaps.pop(bisect_left(self.gaps, gap))
        return spot

    def open(self, count: int) -> int:
        first, self.bins = self.bins, self.bins + count
        return first

    def place(self, length: int, first: int, count: int, each: int, gap: int) -> None:
        """``each`` pieces of ``length`` into every one of ``count`` bins with ``gap`` left."""
        rank = self.used.get(length, 0)
        self.moves.append((length, rank, first, each, self.capacity - gap, count))
        self.used[length] = rank + count * each


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """(moves, bins) for so many pieces of each length.

    Pieces above a third of the capacity share a bin with at most one other of them. They
    are matched greedily: the longest left takes the longest that still fits beside it.
    Shorter pieces go, longest first, into the smallest gap that holds them, as many as
    fit. A move is (length, rank of its first piece, first bin, pieces per bin, offset,
    bins); all its bins look alike, so a plan is short however many pieces there are.
    """
    build, left = _Plan(capacity), dict(counts)
    third = capacity // 3
    large = sorted(length for length in left if length > third)
    while large:
        length = large[-1]
        n = left[length]
        fit = capacity - length
        at = bisect_left(large, fit + 1) - 1
        if n == 0:
            large.pop()
        elif at < 0:
            first = build.open(n)
            build.place(length, first, n, 1, capacity)
            build.put(fit, first, n)
            left[length] = 0
        elif large[at] == length:
            pairs = n // 2
            if pairs:
                first = build.open(pairs)
                build.place(length, first, pairs, 2, capacity)
                build.put(capacity - 2 * length, first, pairs)
                left[length] -= 2 * pairs
            else:  # a single one left: the next shorter, if there is one, goes beside it
                if at:
                    other = large[at - 1]
                    first = build.open(1)
                    build.place(length, first, 1, 1, capacity)
                    build.place(other, first, 1, 1, fit)
                    build.put(fit - other, first, 1)
                    left[other] -= 1
                    if not left[other]:
                        large.pop(at - 1)
                else:
                    first = build.open(1)
                    build.place(length, first, 1, 1, capacity)
                    build.put(fit, first, 1)
                left[length] = 0
        else:
            other = large[at]
            pairs = min(n, left[other])
            first = build.open(pairs)
            build.place(length, first, pairs, 1, capacity)
            build.place(other, first, pairs, 1, fit)
            build.put(fit - other, first, pairs)
            left[length] -= pairs
            left[other] -= pairs
            if not left[other]:
                large.pop(at)
    for length in sorted((x for x in left if x <= third), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(build.gaps, length)
            if at < len(build.gaps):
                gap = build.gaps[at]
                first, count = build.take(gap)
            else:
                gap, count = capacity, -(-n // (capacity // length))
                first = build.open(count)
            each = gap // length
            full = min(count, n // each)
            if full:
                build.place(length, first, full, each, gap)
                build.put(gap - each * length, first, full)
                n -= full * each
            rest = count - full
            if rest and n:  # n < each: the last few share one bin
                build.place(length, first + full, 1, n, gap)
                build.put(gap - n * length, first + full, 1)
                n, rest, full = 0, rest - 1, full + 1
            build.put(gap, first + full, rest)
    return build.moves, build.bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (stored) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    The counts of the lengths, at most ``capacity`` numbers, and the plan made of them are
    all that the driver holds. Pieces of a length are numbered across the cluster and each
    finds its place in the plan by its number.
    """
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    moves, _ = plan({r["length"]: r["n"] for r in counted}, capacity)
    moves = sorted(moves)
    shift = 48
    starts = np.array([(m[0] << shift) + m[1] for m in moves], dtype=np.int64)
    firsts, eachs, offsets = (np.array([m[k] for m in moves], dtype=np.int64) for k in (2, 3, 4))
    shared = pieces.sparkSession.sparkContext.broadcast((starts, firsts, eachs, offsets))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        begin, first, each, offset = shared.value
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(begin, (lengths << shift) + ranks, side="right") - 1
        inside = ranks - (begin[at] & ((1 << shift) - 1))
        return pd.DataFrame({
            "sequence_id": first[at] + inside // each[at],
            "offset": offset[at] + (inside % each[at]) * lengths,
        })

    ranked = numbered(pieces, ["length"], ["key", "piece"], "_rank")
    return ranked.withColumn("_spot", place("length", "_rank")).select(
        *pieces.columns, "_spot.sequence_id", "_spot.offset"
    )


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece of
    every row. Repeated rows are packed as often as they stand there; ties in length are
    dealt by a hash of id and text. An empty table gives no rows.
    """
    pieces = cut_pieces(df, tokenizer, doc_id, text, capacity, with_ids=with_ids)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    with small_batches(df.sparkSession):
        pieces = stored(pieces if with_ids else pieces.drop("ids"))
    packed = pack(pieces, capacity)
    return packed.select(*columns, *["ids"] * with_ids)
