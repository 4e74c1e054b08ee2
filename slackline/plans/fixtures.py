"""Views of the given tables in the shape of the ledger and of the survey."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slackline.fixed_values import ARM_AI, ARM_NO_AI, CONSENT, SENTIMENTS
from slackline.functions.joins import lookup_join
from slackline.schema import inline_table
from slackline.session import fresh_path
from slackline.sources.text import split_lines


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str):
    return F.rint(F.col(column) * 100).cast("long")


def ledger_lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One row per line item: region, acc_id, year, budget and realized in cents.

    Supplier and part grow with the data, so they are broadcast only when small. Beyond
    that both are shuffle joins; their hot keys are split or salted by ``lookup_join``.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_linestatus") == "F", cents("l_extendedprice")).otherwise(F.lit(0)).alias(
            "budget_cents"
        ),
        F.when(F.col("l_returnflag") != "R", cents("l_extendedprice")).otherwise(F.lit(0)).alias(
            "realized_cents"
        ),
        *extra,
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("region")
    )
    supplier = lookup_join(
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
        nation,
        ["s_nationkey"],
        spread_by=F.col("l_suppkey"),
    ).select("l_suppkey", "region")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("acc_id")
    )
    located = lookup_join(lines, supplier, ["l_suppkey"], spread_by=F.col("l_partkey"))
    return lookup_join(located, part, ["l_partkey"], spread_by=F.col("l_suppkey")).drop(
        "l_partkey", "l_suppkey"
    )


def _amounts() -> list:
    return [
        (F.sum("budget_cents") / 100).alias("budget"),
        (F.sum("realized_cents") / 100).alias("realized"),
    ]


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, acc_id, year, budget, realized): one row per key, at most one per year."""
    return ledger_lines(spark, sf_dir).groupBy("region", "acc_id", "year").agg(*_amounts())


def panel_by_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with an accounting standard; most regions and years have both."""
    standard = F.when(F.col("l_linestatus") == "F", "HRM2").otherwise("HRM1").alias("standard")
    lines = ledger_lines(spark, sf_dir, "l_linestatus").withColumn("standard", standard)
    return lines.groupBy("region", "acc_id", "year", "standard").agg(*_amounts())


def panel_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel on the old chart of accounts, with its range accounts."""
    acc = F.col("acc_id")
    old = (
        F.when(acc.between(34, 37), "34 - 37")
        .when(acc.isin(41, 43), "41 / 43")
        .when(acc.between(44, 47), "44 - 47")
        .when(acc == 38, "32")
        .otherwise(acc.cast("string"))
    )
    return panel(spark, sf_dir).select("region", old.alias("acc_id"), "year", "budget", "realized")


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as text cells, some of them blank, no number or not an account."""
    acc, year = F.col("acc_id"), F.col("year")
    mark = acc * 31 + year
    realized = F.col("realized").cast("decimal(18,2)").cast("string")
    budget = F.col("budget").cast("decimal(18,2)").cast("string")
    return panel(spark, sf_dir).select(
        "region",
        "year",
        F.when(mark % 13 == 0, F.concat(F.lit("A"), acc.cast("string")))
        .otherwise(acc.cast("string"))
        .alias("acc_id"),
        F.when(mark % 7 == 0, "").otherwise(budget).alias("budget"),
        F.when(mark % 11 == 0, "n/a").otherwise(realized).alias("realized"),
        F.when(mark % 5 == 0, F.lit(None).cast("string")).otherwise(budget).alias("budget_next"),
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: the first order is the answer, the second the resubmission.

    Only two orders per customer are kept, and Spark applies that limit before the
    shuffle, so a customer with a third of all orders costs two rows per task.
    """
    in_time = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    firsts = (
        table(spark, sf_dir, "orders")
        .select(
            "o_custkey",
            "o_orderdate",
            "o_orderkey",
            "o_totalprice",
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"),
        )
        .withColumn("rn", F.row_number().over(in_time))
        .where("rn <= 2")
        .groupBy("o_custkey")
        .agg(
            F.max(F.when(F.col("rn") == 1, F.col("o_totalprice"))).alias("initial"),
            F.max(F.when((F.col("rn") == 2) & F.col("urgent"), F.col("o_totalprice"))).alias("resub"),
        )
    )
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pid"))
    pid = F.col("pid")
    check = F.when(pid % 7 == 0, F.lit(None).cast("string")).when(pid % 5 == 0, "wrong").otherwise("ok")
    return customers.join(firsts, customers.pid == firsts.o_custkey, "left").select(
        "pid",
        F.when(pid % 2 == 0, "AI").otherwise("NonAI").alias("arm"),
        "initial",
        "resub",
        check.alias("manip_check"),
    )


def survey_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey with the column names, codes and text cells of a survey export."""
    ai = F.col("arm") == "AI"
    fits = F.when(ai, "Yes").otherwise("No")
    fails = F.when(ai, "No").otherwise("Yes")
    text = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    return survey(spark, sf_dir).select(
        F.col("pid").cast("string").alias("PROLIFIC_PID"),
        F.when(F.col("pid") % 11 == 0, "No").otherwise(CONSENT).alias("Consent"),
        F.when(ai, ARM_AI).otherwise(ARM_NO_AI).alias("FL_23_DO"),
        text("initial").alias("Scenario1_Answer_1"),
        F.when(ai, text("resub")).alias("AI_Resubmission13_1"),
        F.when(~ai, text("resub")).alias("NoAI_Resubmission13_1"),
        F.when(F.col("manip_check") == "ok", fits)
        .when(F.col("manip_check") == "wrong", fails)
        .alias("Manip_Check"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, sex, age, nationality, experience), one row per customer."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nationality")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    segment = F.col("c_mktsegment")
    sex = (
        F.when(segment == "MACHINERY", "Male")
        .when(segment == "BUILDING", "Female")
        .when(segment == "AUTOMOBILE", "Non-binary")
        .when(segment == "HOUSEHOLD", "Prefer not to say")
    )
    key = F.col("c_custkey")
    return lookup_join(customers, nation, ["c_nationkey"], spread_by=key).select(
        key.alias("pid"),
        sex.alias("sex"),
        (key % 60 + 18).cast("int").alias("age"),
        "nationality",
        ((key % 130).cast("double") / 10).alias("experience"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-blank line of every document: (doc_id, line_no, text)."""
    return split_lines(documents(spark, sf_dir), ["doc_id"], "text")


def word_flags(spark: SparkSession) -> DataFrame:
    """A small word list over frequent words, one flag per sentiment."""
    marks = {
        "THE": ["positive"], "OF": ["negative"], "WAS": ["uncertainty"], "TO": ["litigious"],
        "WITH": ["strong_modal"], "FOR": ["weak_modal", "uncertainty"], "AND": ["constraining"],
    }
    rows = [(w, *[s in flags for s in SENTIMENTS]) for w, flags in marks.items()]
    return inline_table(spark, rows, ["word", *SENTIMENTS])


def word_polarity(spark: SparkSession) -> DataFrame:
    """The same words with a polarity and a subjectivity."""
    rows = [
        ("THE", 0.5, 0.25), ("OF", -0.5, 0.5), ("WAS", -0.25, 0.75), ("TO", 0.125, 0.0),
        ("WITH", 1.0, 1.0), ("FOR", 0.75, 0.5), ("AND", -1.0, 0.125),
    ]
    return inline_table(spark, rows, ["word", "polarity", "subjectivity"])


def sheet_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, sheet, lines): the panel written as sheets, one per region, year and standard.

    Years move to 2015-2021, so that all three layouts occur. A sheet holds one line per
    account, of which there are at most fifty.
    """
    base = panel_by_standard(spark, sf_dir)
    acc, old = F.col("acc_id"), F.col("standard") == "HRM1"
    code = F.concat(F.lit("N"), F.char(F.regexp_extract("region", r"\d+", 0).cast("int") + 65))
    rows = base.select(
        code.alias("code"),
        (F.col("year") + 20).alias("y"),
        "standard",
        acc.alias("acc"),
        F.col("budget").cast("decimal(18,2)").cast("string").alias("b"),
        F.col("realized").cast("decimal(18,2)").cast("string").alias("r"),
    )
    new = ~old & (F.col("y") >= 2019)
    legacy = (
        F.when(F.col("acc").between(34, 37), "34 - 37")
        .when(F.col("acc").isin(41, 43), "41 / 43")
        .otherwise(F.col("acc").cast("string"))
    )
    name = F.concat(F.lit('"Konto, '), F.col("acc").cast("string"), F.lit('"'))
    reference = F.when(F.col("acc") % 9 == 0, "").otherwise(
        F.concat(F.lit("HRM2_ER"), F.col("acc").cast("string"))
    )
    four = F.col("y") % 2 == 0
    line = (
        F.when(old, F.concat_ws(",", legacy, name, "b", "r", F.lit("x"), "r"))
        .when(~new, F.concat_ws(",", F.col("acc").cast("string"), name, "b", "r", "r"))
        .when(four, F.concat_ws(",", reference, F.col("acc").cast("string"), name, "b",
                                F.lit("n/a"), F.lit("7"), "r", "r"))
        .otherwise(F.concat_ws(",", reference, F.col("acc").cast("string"), name, "b", "r", "r"))
    )
    sheets = (
        rows.withColumn("line", F.struct("acc", line.alias("text")))
        .groupBy("code", "y", "standard")
        .agg(F.array_sort(F.collect_list("line")).alias("data"))
    )
    y, y1 = F.col("y").cast("string"), (F.col("y") + 1).cast("string")
    header = (
        F.when(old & four, F.concat_ws(",", F.lit("0"), F.lit("0"), y, y, F.lit("diff"), y1))
        .when(old, F.concat_ws(",", F.lit(""), F.lit(""), y, y, F.lit("diff"), y1))
        .when(~new, F.concat_ws(",", F.lit(""), F.lit("in 1000 Franken"), y, y, y1))
        .when(four, F.concat_ws(",", F.lit("Referenz-ID"), F.lit("HRM 2"),
                                F.lit("in 1 000 Franken"), y, y, y, y, y1))
        .otherwise(F.concat_ws(",", F.lit("Referenz-ID"), F.lit("HRM 2"),
                               F.lit("en 1 000 frs."), y, y, y1))
    )
    above = F.when(new, F.array_repeat(F.lit("note"), 4)).otherwise(F.array(F.lit("note")))
    lines = F.concat(
        above, F.array(header), F.array(F.lit("units,30,30,30,30,30,30")),
        F.transform("data", lambda d: d["text"]),
    )
    sheet = F.when(
        F.col("y") % 3 == 0, F.concat("code", F.lit("_"), "standard")
    ).otherwise(F.concat("standard", F.lit("_KT_"), "code"))
    path = F.concat(F.lit("/ledger/"), y, F.lit("/"), sheet, F.lit(".csv"))
    return sheets.select(path.alias("path"), sheet.alias("sheet"), lines.alias("lines"))


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, sheet, line_no, line): the sheets, line by line."""
    sheets = sheet_exports(spark, sf_dir)
    lines = sheets.select("path", "sheet", F.posexplode("lines").alias("line_no", "line"))
    return lines.withColumn("line_no", F.col("line_no").cast("long"))


def sheet_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with a file per sheet, named by its folder."""
    folder = fresh_path(spark)
    sheets = sheet_exports(spark, sf_dir).select(
        F.regexp_extract("path", r"/(\d{4})/", 1).alias("year"), "sheet", F.array_join("lines", "\n").alias("value")
    )
    sheets.repartition("year", "sheet").write.partitionBy("year", "sheet").text(folder)
    return folder


def panel_mark():
    """A number per key by which some rows are spoilt."""
    return F.col("acc_id") * 31 + F.col("year") + F.regexp_extract("region", r"\d+", 0).cast("int")


def panel_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with a CSV file per year of the panel, in two layouts, with malformed rows.

    Some rows have a cell too many or too few or bytes that are no text, every file ends
    with a quote that nothing closes, and names hold separators, quotes and line breaks.
    """
    folder = fresh_path(spark)
    acc, mark = F.col("acc_id").cast("string"), panel_mark()
    name = F.when(mark % 3 == 0, F.concat(F.lit('"Konto, '), acc, F.lit('"'))).when(
        mark % 3 == 1, F.concat(F.lit('"a ""b""\n'), acc, F.lit('"'))
    ).otherwise(F.concat(F.lit("5 inch "), acc, F.lit('"')))
    name = F.when(mark % 29 == 0, F.concat(F.lit("Stra"), F.unhex(F.lit("DF")).cast("string"), F.lit("e"))).otherwise(name)
    budget, realized = (F.col(c).cast("decimal(18,2)").cast("string") for c in ("budget", "realized"))
    # concat_ws leaves out a NULL: the last cell and its separator.
    region = F.when(mark % 17 == 0, F.concat("region", F.lit(",extra"))).when(mark % 19 != 0, F.col("region"))
    year = F.col("year").cast("string")
    new = F.concat_ws(",", acc, name, year, budget, realized, region)
    old = F.concat_ws(",", realized, budget, year, acc, region)
    line = F.when(F.col("year") % 2 == 0, new).otherwise(old)
    header = F.when(F.col("year") % 2 == 0, "Acc-ID,Name,Year,Budget y,Realized,Region").otherwise(
        "Realized,Budget y,Year,Acc-ID,Region"
    )
    files = (
        panel(spark, sf_dir).withColumn("line", line)
        .groupBy("year").agg(F.array_sort(F.collect_list("line")).alias("lines"))
        .select("year", F.concat(header, F.lit("\n"), F.array_join("lines", "\n"), F.lit('\n"never closed,1\n')).alias("value"))
    )
    files.repartition("year").write.partitionBy("year").text(folder)
    return folder
