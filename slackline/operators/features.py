"""Panel features: rebased year, lags, row filters, account choice, holdout.

The frames are read more than once (the oldest and the newest year are subqueries), so
pass a stored panel rather than the join that builds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slackline.fixed_values import BALANCE_ACCOUNTS, CATEGORIES
from slackline.functions.joins import estimated_bytes
from slackline.functions.numbers import is_zero, scalar
from slackline.schema import SERIES, category_dim, require_columns
from slackline.session import stored

# Bytes of a stored table, by Catalyst's estimate, that one sorted chunk may hold.
CHUNK_BYTES = 64 << 20

LEAKS = ["realized", "budget", "budget_next", "slack"]


def newest_year(df: DataFrame):
    """The newest year of ``df`` as a scalar subquery."""
    return scalar(df, F.max("year"))


def rebase_year(df: DataFrame) -> DataFrame:
    """Years counted from the oldest year of the whole frame."""
    return df.withColumn("year", F.col("year") - scalar(df, F.min("year")))


def add_lags(
    df: DataFrame,
    ks: tuple[int, ...] = (1, 2),
    value: str = "realized",
    tie_break: tuple[str, ...] = (),
    by: str = "row",
) -> DataFrame:
    """Earlier values of the same region and account as ``<value>_lag<k>``.

    A panel has one row per series and year, or one per standard, so a window holds some
    dozen rows however large the tables are that the panel was summed from. For rows that
    were not summed, where one series can be too long for a task, see ``add_lags_in_chunks``.

    ``by="row"`` takes the k-th row before, whatever its year; equal years are ordered
    by ``tie_break`` and then by every other column, so that only equal rows tie.
    ``by="year"`` takes the value of exactly ``year - k``, of equal years the smallest.
    """
    require_columns(df, ["year", value])
    if by == "row":
        order = Window.partitionBy(*SERIES).orderBy("year", *_ties(df, tie_break))
        return df.select(
            "*", *[F.lag(value, k).over(order).alias(f"{value}_lag{k}") for k in ks]
        )
    if by != "year":
        raise ValueError(f"unknown lag mode: {by}")
    order = Window.partitionBy(*SERIES).orderBy("year")
    for k in ks:
        # In a window over the years themselves the frame holds year - k only.
        frame = order.rangeBetween(-k, -k)
        df = df.withColumn(f"{value}_lag{k}", F.min(value).over(frame))
    return df


def _ties(df: DataFrame, tie_break: tuple[str, ...]) -> list[str]:
    """Every column of ``df`` that can order rows of a series and year, ``tie_break`` first."""
    rest = [c for c, kind in df.dtypes if c not in {*SERIES, "year", *tie_break} and "map<" not in kind]
    return [*tie_break, *rest]


def add_lags_in_chunks(
    df: DataFrame,
    ks: tuple[int, ...] = (1, 2),
    value: str = "realized",
    tie_break: tuple[str, ...] = (),
    chunks: int | None = None,
) -> DataFrame:
    """``add_lags`` by row for series of any length; ``df`` must be a stored table.

    Rows are sorted into ``chunks`` ranges of (series, year, ties) and stored; by default
    as many as keep a chunk near ``CHUNK_BYTES``, so a long series spans many.
    Within its chunk a row finds its lags itself, unless it is among the first ``max(ks)``
    of its series there. Those find them in a thin table of the first and last ``max(ks)``
    rows of every chunk, which holds all their predecessors.
    """
    require_columns(df, ["year", value])
    reach = max(ks)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks or max(least, -(-estimated_bytes(df) // CHUNK_BYTES))
    order = ["year", *tie_break, "_tie"]
    # Any order of rows that tie is valid; numbering them lets even equal rows be split.
    # A task that is run again reads the same file range and gives the same numbers.
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = numbered.repartitionByRange(chunks, *SERIES, *order)
    chunked = stored(ranges.withColumn("_chunk", F.spark_partition_id()))
    part = Window.partitionBy("_chunk", *SERIES)
    lagged = [F.lag(value, k) for k in ks]
    names = [f"{value}_lag{k}" for k in ks]
    here = part.orderBy(*order)
    rows = chunked.select(
        "*",
        *[x.over(here).alias(n) for x, n in zip(lagged, names)],
        F.row_number().over(here).alias("_first"),
        F.lead(F.lit(1), reach).over(here).isNull().alias("_last"),
    )
    thin = rows.where((F.col("_first") <= reach) | F.col("_last")).drop(*names)
    series = Window.partitionBy(*SERIES).orderBy(*order)
    across = thin.select("*", *[x.over(series).alias(n) for x, n in zip(lagged, names)])
    whole = rows.where(F.col("_first") > reach).unionByName(across.where(F.col("_first") <= reach))
    return whole.select(*df.columns, *names)


def drop_zero_rows(df: DataFrame) -> DataFrame:
    """Drop rows without any amount, and balance-sheet rows without a budget.

    A missing amount is not a zero.
    """
    empty = is_zero("realized") & is_zero("budget")
    unbudgeted = is_zero("budget") & F.col("acc_id").isin(BALANCE_ACCOUNTS)
    return df.where(~empty & ~F.coalesce(unbudgeted, F.lit(False)))


def choose_accounts(df: DataFrame, category: str | None) -> DataFrame:
    """Keep the accounts of one group; ``None`` keeps all, an unknown name raises."""
    if category is None:
        return df
    if category not in CATEGORIES:
        raise ValueError(f"unknown category: {category}")
    accounts = (
        category_dim(df.sparkSession)
        .where(F.col("category") == category)
        .select(F.col("acc_id").cast(df.schema["acc_id"].dataType))
    )
    return df.join(F.broadcast(accounts), "acc_id", "left_semi").select(*df.columns)


def engineer(
    df: DataFrame, category: str | None = None, tie_break: tuple[str, ...] = (), by: str = "row"
) -> DataFrame:
    """Rebase, lag, drop zero rows, choose accounts; lags see the rows dropped later."""
    lagged = add_lags(rebase_year(df), tie_break=tie_break, by=by)
    return choose_accounts(drop_zero_rows(lagged), category)


def slice_rows(df: DataFrame, acc_id: int | None = None, region: str | None = None) -> DataFrame:
    """Rows of one account and / or one region."""
    if acc_id is not None:
        df = df.where(F.col("acc_id") == acc_id)
    if region is not None:
        df = df.where(F.col("region") == region)
    return df


def mark_holdout(
    df: DataFrame, acc_id: int | None = None, region: str | None = None, cutoff: str = "global"
) -> DataFrame:
    """Add ``split``: the newest year is ``test``, all years before are ``train``.

    ``cutoff="global"`` takes the newest year of the whole frame, ``"slice"`` the newest
    year among the chosen rows.
    """
    if cutoff not in ("global", "slice"):
        raise ValueError(f"unknown cutoff: {cutoff}")
    rows = slice_rows(df, acc_id, region)
    newest = newest_year(df if cutoff == "global" else rows)
    return rows.withColumn(
        "split", F.when(F.col("year") > newest - 1, "test").otherwise("train")
    )


def holdout(df: DataFrame, **kwargs) -> tuple[DataFrame, DataFrame]:
    """(train, test) of ``mark_holdout``."""
    marked = mark_holdout(df, **kwargs)
    return (
        marked.where("split = 'train'").drop("split"),
        marked.where("split = 'test'").drop("split"),
    )


def feature_columns(df: DataFrame) -> DataFrame:
    """Without the columns that give the target away."""
    return df.drop(*LEAKS)
