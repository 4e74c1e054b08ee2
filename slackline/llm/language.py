"""Language identification with n-gram filters that hold one bit per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slackline.llm.common import stored

ORDERS = (3, 4, 5)
PROBES = 4
PLANE = 62
LEAST_SHARE = 2e-6
RIVAL_SHARE = 0.3
PIECE = 1_000_000
FLUSH = 1_500_000

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of all n-grams of lower-cased letters.

    Other characters count as one blank, which may only stand at an n-gram's ends. Texts are
    taken in pieces of bounded size, so a very long text needs no more memory.
    """
    group: list[tuple[int, str, int]] = []
    size = 0
    for number, text in enumerate(texts):
        whole = f"\n{text.lower()}\n"
        for low in range(0, len(whole), PIECE):
            # A piece owns the n-grams that start in it, and sees where the last of them end.
            part = whole[low : low + PIECE + max(ORDERS) - 1]
            group.append((number, part, PIECE))
            size += len(part)
            if size >= PIECE:
                yield from _ngrams(group)
                group, size = [], 0
    if group:
        yield from _ngrams(group)


def _ngrams(group: list[tuple[int, str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(part) for _, part, _ in group])
    whole = "".join(part for _, part, _ in group)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.array([n for n, _, _ in group]), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = place < np.repeat(np.array([o for _, _, o in group]), sizes)
    known = letters()[codes]
    codes = np.where(known, codes, 32).astype(np.uint64)
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            continue
        inner = own[:n].copy()
        value = np.full(n, order, dtype=np.uint64)
        for k in range(order):
            value = value * np.uint64(0x100000001B3) + codes[k : k + n]
            if 0 < k < order - 1:
                inner &= known[k : k + n]
        inner &= known[:n] | known[order - 1 : order - 1 + n]
        yield owner[:n][inner], mixed(value[inner])


@dataclass
class Filters:
    """``planes[p][slot]`` has a bit per language of plane ``p``; all probes of an n-gram meet
    in the languages that contain it. ``false`` is each language's rate of false positives."""

    languages: list[str]
    planes: np.ndarray
    false: np.ndarray
    fallback: str | None

    def masks(self, grams: np.ndarray) -> np.ndarray:
        slots = np.uint64(self.planes.shape[1] - 1)
        step = (grams >> np.uint64(32)) | np.uint64(1)
        out = np.full((self.planes.shape[0], len(grams)), -1, dtype=np.int64)
        for k in range(PROBES):
            at = ((grams + np.uint64(k) * step) & slots).astype(np.int64)
            out &= self.planes[:, at]
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each language, all n-grams) per text."""
        hits = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for owner, grams in ngrams(texts):
            total += np.bincount(owner, minlength=len(texts))
            masks = self.masks(grams)
            for j in range(len(self.languages)):
                bit = (masks[j // PLANE] >> np.int64(j % PLANE)) & 1
                hits[:, j] += np.bincount(owner, weights=bit, minlength=len(texts))
        return hits, total

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        hits, total = self.counts(texts)
        clean = np.maximum(0.0, (hits - total[:, None] * self.false) / np.maximum(1e-9, 1 - self.false))
        best = clean.argmax(axis=1)
        top, all_ = clean.max(axis=1), clean.sum(axis=1)
        score = np.divide(top, all_, out=np.zeros(len(texts)), where=all_ > 0)
        names = []
        for text, b, found in zip(texts, best, all_, strict=True):
            if not any(c.isalpha() for c in text):
                names.append("und")
            else:
                names.append(self.languages[b] if found > 0 else self.fallback)
        return names, np.where(np.array(names) == "und", 0.0, np.clip(score, 0, 1))


def gram_counts(df: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text), summed in the tasks first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def reduced(parts):
            grams = np.concatenate([g for g, _ in parts])
            n = np.concatenate([c for _, c in parts])
            unique, inverse = np.unique(grams, return_inverse=True)
            return unique, np.bincount(inverse, weights=n).astype(np.int64)

        def frames():
            for lang, parts in held.items():
                unique, n = reduced(parts)
                yield pd.DataFrame({"lang": lang, "gram": unique.view(np.int64), "n": n})
            held.clear()

        size = 0
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for _, grams in ngrams(texts.tolist()):
                    unique, n = np.unique(grams, return_counts=True)
                    held.setdefault(lang, []).append((unique, n))
                    size += len(unique)
                    if size > 4 * FLUSH:
                        for name in held:
                            held[name] = [reduced(held[name])]
                        size = sum(len(p[0][0]) for p in held.values())
                        if size > FLUSH:
                            yield from frames()
                            size = 0
        yield from frames()

    parts = df.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from all rows with a text and a language.

    An n-gram enters a language's filter if it makes up at least ``LEAST_SHARE`` of that
    language's n-grams, so at most half a million enter, and if its share there is at least
    ``RIVAL_SHARE`` of its largest share in any language. The filters, of at most 2^23 slots
    for 62 languages, are what the driver and the tasks hold.
    """
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = stored(gram_counts(rows))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Filters([], np.zeros((1, 64), dtype=np.int64), np.zeros(0), None)
    spark = df.sparkSession
    names = spark.createDataFrame(
        [(name, i, float(totals[name])) for i, name in enumerate(languages)], "lang string, place int, total double"
    )
    share = F.col("n") / F.col("total")
    shared = counts.join(F.broadcast(names), "lang").select("place", "gram", share.alias("share"))
    best = F.max("share").over(Window.partitionBy("gram"))
    entered = stored(
        shared.withColumn("best", best)
        .where((F.col("share") >= LEAST_SHARE) & (F.col("share") >= RIVAL_SHARE * F.col("best")))
        .select("place", "gram")
    )
    most = max([r["n"] for r in entered.groupBy("place").agg(F.count("*").alias("n")).collect()], default=0)
    slots = 1 << int(min(23, max(12, np.ceil(np.log2(8 * max(1, most) + 1)))))

    # Positions as in ``Filters.masks``, in wrapping 64-bit arithmetic.
    step = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    probes = F.array(
        *[(F.lit(0).cast("long") + F.col("gram").bitwiseAND(F.lit(slots - 1)) + k * step).bitwiseAND(F.lit(slots - 1)) for k in range(PROBES)]
    )
    bits = (
        entered.select("place", F.explode(probes).alias("slot"))
        .groupBy("slot", F.floor(F.col("place") / PLANE).cast("int").alias("plane"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, place % {PLANE})")).alias("mask"))
        .toPandas()
    )
    planes = np.zeros((-(-len(languages) // PLANE), slots), dtype=np.int64)
    planes[bits["plane"].to_numpy(np.int64), bits["slot"].to_numpy(np.int64)] = bits["mask"].to_numpy(np.int64)
    fill = np.array([((planes[j // PLANE] >> np.int64(j % PLANE)) & 1).mean() for j in range(len(languages))])
    fallback = max(languages, key=lambda name: (totals[name], name))
    return Filters(languages, planes, fill**PROBES, fallback)


def predict(df: DataFrame, filters: Filters, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, lang_pred, score) for every row, from the text alone.

    A null text and one without a letter are ``und`` with score 0, as is every text if
    nothing was learned. A text with letters but no known n-gram gets the language with the
    most training n-grams and score 0. Ties go to the first language by name.
    """
    # A broadcast holds plain values only: executors may not know this module.
    shared = df.sparkSession.sparkContext.broadcast(
        (filters.languages, filters.planes, filters.false, filters.fallback)
    )

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        known, out = Filters(*shared.value), []
        for low in range(0, len(texts), 256):
            some = [t if isinstance(t, str) else "" for t in texts.iloc[low : low + 256]]
            names, score = known.decide(some)
            out.append(pd.DataFrame({"lang_pred": names, "score": score}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"lang_pred": [], "score": []})

    keep = [c for c in df.columns if c != text] if keep is None else keep
    found = df.select(*[F.col(f"`{c}`") for c in keep], decide(F.col(text)).alias("_found"))
    return found.select(*[F.col(f"`{c}`") for c in keep], "_found.lang_pred", "_found.score")


def held_out(doc_id) -> object:
    """True where crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(df: DataFrame) -> DataFrame:
    """The contract's columns: learned on the rows that are not held out, for every row."""
    rows = df.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    filters = learn(rows.where("NOT held_out AND doc_id IS NOT NULL"))
    return predict(rows.drop("lang"), filters, keep=["doc_id", "held_out"])
