"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.session import stored

__all__ = [
    "SPACE", "chunks", "digest", "earlier_max", "let", "numbered", "piece", "row_key", "running", "sampled", "spans_text",
    "stored", "word_count", "words",
]

# White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The maximal runs of other characters than white space; empty for null."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE + "+")).otherwise(none)


def word_count(text: Column) -> Column:
    """The number of ``words``, without an array of them; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


CHUNK = 512


def chunks(text: Column) -> Column:
    """The text in chunks of ``CHUNK`` code points, the last of which may be shorter.

    For ``piece``: a substring counts code points from the start of its text, so that many of one
    very long text take time with the square of its length; those of a chunk do not.
    """
    return F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}+" % CHUNK), F.lit(0))


def piece(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive, at least ``start``) of a text cut by ``chunks``."""
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor(end / CHUNK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(parts, first + 1, count), ""), start - first * CHUNK + 1, end - start)


def earlier_max(values: Column) -> Column:
    """For each of an array of integers the greatest of those before it; 0 for the first, and at least 0.

    Taken over blocks of ``BLOCK`` first and then inside each, so that a long array stays cheap.
    """
    none = F.array().cast("array<int>")

    def inside(block: Column, start: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            return F.struct(F.greatest(a["top"], x).alias("top"), F.concat(a["out"], F.array(a["top"])).alias("out"))

        return F.aggregate(block, F.struct(start.alias("top"), none.alias("out")), step, lambda a: a["out"])

    def of_blocks(blocks: Column) -> Column:
        starts = inside(F.transform(blocks, lambda b: F.array_max(b)), F.lit(0))
        return F.flatten(F.zip_with(blocks, starts, inside))

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    cut = F.transform(numbers, lambda n: F.slice(values, n * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.size(values) == 0, none).otherwise(let(cut, of_blocks))


def digest(text: Column) -> Column:
    """16 bytes that name a text; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by id and text. Rows equal in both share it."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat_ws("\n", *parts).cast("binary")))


def sampled(df: DataFrame, rows: int, seed: int = 3) -> DataFrame:
    """About ``rows`` rows drawn evenly from all of ``df``, stored; all rows if it has no more.

    Every task draws its own rows, so nothing but the sample leaves it; a limit would
    shuffle up to ``rows`` rows of every task into one. The sample is dealt anew, so that it
    does not become a small file per task.
    """
    total = df.count()
    return stored(df if total <= rows else df.sample(rows / total, seed).repartition(max(8, rows // 1000)))


def numbered(
    df: DataFrame, groups: list[str], order: list[str], name: str, chunk_rows: int = 200_000
) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, … without gaps within each group, of any size.

    A group is cut into chunks by a hash of ``order``; chunks are counted map-side, a
    window over those few counts gives each chunk its first number, and only rows of one
    chunk are sorted together. ``df`` should be stored: it is read twice and must be equal
    both times. Rows equal in ``order`` get different numbers in any sequence.
    """
    rows = df.count()
    chunks = max(1, -(-rows // chunk_rows))
    chunk = F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(chunks))
    cut = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*groups, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select(*groups, "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    )
    inside = Window.partitionBy(*groups, "_chunk").orderBy(*order)
    ranked = cut.withColumn("_place", F.row_number().over(inside) - 1)
    keyed = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*groups, "_chunk"]]
    both = ranked.alias("r").join(starts.alias("s"), keyed, "inner")
    return both.select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col("s._first") + F.col("r._place")).cast("long").alias(name),
    )


def running(
    df: DataFrame, groups: list[str], order: list[str], sums: dict[str, str], chunk_rows: int = 500_000
) -> DataFrame:
    """``df`` with a column per entry of ``sums``: the sum of a long column over the rows before.

    Rows are taken group by group in ascending ``order``, nulls first. All rows are dealt by
    ranges of groups and order, so a group of any size lies in many chunks; a window sums
    inside a chunk, and chunks that continue a group get the sum of its earlier chunks, one
    small row each. Groups must not be null. Rows equal in ``order`` follow each other in the
    order of their scan, which a repeated task keeps.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // chunk_rows))
    by = [*groups, *order, "_tie"]
    dealt = stored(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in by])
        .withColumn("_chunk", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*groups, "_chunk")
        .orderBy(*[F.col(c).asc_nulls_first() for c in [*order, "_tie"]])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        dealt.groupBy(*groups, "_chunk")
        .agg(*[F.sum(value).alias(f"_of_{name}") for name, value in sums.items()])
        .select(*groups, "_chunk", *[F.sum(f"_of_{name}").over(earlier).alias(f"_from_{name}") for name in sums])
        .where(" OR ".join(f"_from_{name} IS NOT NULL" for name in sums))
    )
    here = dealt.select("*", *[F.sum(value).over(inside).alias(f"_in_{name}") for name, value in sums.items()])
    zero = F.lit(0).cast("long")
    both = lookup_join(here, stored(carried), [*groups, "_chunk"], "left")
    return both.select(
        *df.columns,
        *[(F.coalesce(f"_from_{n}", zero) + F.coalesce(f"_in_{n}", zero)).alias(n) for n in sums],
    )


SPAN = "struct<kind:string,start:int,end:int,found:string>"
BLOCK = 256


def found_spans(text: Column, kind: str, pattern: str) -> Column:
    """array<struct<kind, start, end, found>> of the leftmost non-overlapping matches.

    The pieces between matches and the matches themselves give the positions, in code
    points, by running sums: first over blocks of ``BLOCK`` matches, then inside each, so
    that a text with very many matches stays cheap. The match must never be empty.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def block(pairs: Column, number: Column) -> Column:
        return F.slice(pairs, number * BLOCK + 1, F.lit(BLOCK))

    def total(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["match"]))

    def running(sums: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            sums,
            zero,
            lambda a, x: F.struct(
                (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")
            ),
            lambda a: a["out"],
        )

    def placed(pairs: Column, start: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            begin = a["at"] + x["gap"]
            end = begin + F.length(x["match"])
            span = F.struct(
                F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["match"].alias("found")
            )
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

        return F.aggregate(
            pairs, F.struct(start.alias("at"), none.alias("out")), step, lambda a: a["out"]
        )

    def spans(pairs: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
        starts = running(F.transform(blocks, lambda b: total(block(pairs, b))))
        return F.flatten(F.zip_with(blocks, starts, lambda b, s: placed(block(pairs, b), s)))

    whole = F.coalesce(text, F.lit(""))

    def pairs(found: Column) -> Column:
        pieces = F.slice(F.split(whole, pattern), F.lit(1), F.size(found))
        return F.zip_with(
            pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("match"))
        )

    return let(
        F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(let(pairs(found), spans)),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order given."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
