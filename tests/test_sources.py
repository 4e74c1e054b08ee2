import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from slackline.operators import survey
from slackline.plans import jobs
from slackline.schema import require_columns
from slackline.sources import csvs, records
from slackline.sources import text as lines
from slackline.sources.cells import split_cells
from tests.conftest import values


@pytest.fixture
def yearly(tmp_path):
    folder = tmp_path / "processed"
    folder.mkdir()
    (folder / "y_2010_single_digit.csv").write_text("\n")
    (folder / "y_2011_single_digit.csv").write_text(
        "Acc-ID,Name,Budget y,Realized,Budget y+1,Region,Year,Slack\n3,\"a, b\",10.5,9.0,11.0,AG,2011,1.5\n4,,1,1,1,AG,2011,0\n"
    )
    (folder / "y_2012_single_digit.csv").write_text(
        "Name,Acc-ID,Budget y,Realized,Budget y+1,Region,Year,Slack\nErtrag,4,1.0,2.0,3.0,AG,2012,-1.0\n"
    )
    (folder / "y_2019_single_digit.csv").write_text(
        "Ref-ID,Acc-ID,Name,Budget y,Realized,Budget y+1,Region,Year,Slack\nHRM2_ER3,3,Aufwand,0.0,5.0,6.0,ZH,2019,0.0\n"
    )
    (folder / "y_2020_single_digit.csv").write_text("foo,bar\n1,2\n")
    (folder / "y_2019_double_digit.csv").write_text("Acc-ID\n30\n")
    return str(folder)


def test_union_matches_columns_by_name(spark, yearly):
    panel, rejects = csvs.read_union_by_name(spark, yearly, "*_single_digit.csv")
    assert values(panel, "acc_id", "name", "budget", "region", "year", "ref_id") == [
        ("3", "Aufwand", 0.0, "ZH", "2019", "HRM2_ER3"),
        ("3", "a, b", 10.5, "AG", "2011", None),
        ("4", None, 1.0, "AG", "2011", None),
        ("4", "Ertrag", 1.0, "AG", "2012", None),
    ]
    assert sorted(r["reason"] for r in rejects.collect()) == ["empty file", "unknown columns"]


def test_union_loses_no_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '"Acc-ID","Name",Extra,"Budget y",Year,Region\n3,"two\nlines",x,1.5,2011,AG\n"4","a ""b""",,2,2011,AG\n'
        "Acc-ID,Name,Extra,Budget y,Year,Region\n"
    )
    panel, rejects = csvs.read_union_by_name(spark, str(tmp_path), "*.csv")
    assert values(panel, "acc_id", "name", "budget", "region", "year") == [
        ("3", "two\nlines", 1.5, "AG", "2011"),
        ("4", 'a "b"', 2.0, "AG", "2011"),
        ("Acc-ID", "Name", None, "Region", "Year"),
    ]
    assert rejects.count() == 0


def test_no_files_match(spark, yearly):
    panel, rejects = csvs.read_union_by_name(spark, yearly, "*_2020_*.csv")
    assert (panel.count(), rejects.count()) == (0, 1)


def test_merge_job_writes_the_final_panel_by_year(spark, yearly, tmp_path):
    out = str(tmp_path / "final")
    jobs.merge_panels(spark, yearly, "*_single_digit.csv", out)
    panel = csvs.read_panel(spark, out)
    assert values(panel, "year", "acc_id", "slack") == [
        (2011, 3, 1.5), (2011, 4, 0.0), (2012, 4, -1.0), (2019, 3, 0.0),
    ]
    assert (tmp_path / "final" / "year=2019").is_dir()


def test_list_files_reads_names_only(spark, yearly):
    found = csvs.list_files(spark, yearly, "*_single_digit.csv")
    assert found.where("usable").count() == 5
    assert found.count() == 6


def test_panel_csv_uses_the_published_headers(spark, tmp_path):
    out = str(tmp_path / "csv")
    csvs.write_panel_csv(spark.createDataFrame([(3, 1.0)], "acc_id int, budget double"), out)
    assert spark.read.option("header", True).csv(out).columns == ["Acc-ID", "Budget y"]


def test_final_panel_csv_round_trip(spark, tmp_path):
    row = [(2015, "AG", 30, 1.5, 2.5, 3.5, 1.0)]
    columns = "year int, region string, acc_id int, realized double, budget double, budget_next double, slack double"
    out = str(tmp_path / "final")
    csvs.write_panel_csv(spark.createDataFrame(row, columns).coalesce(1), out)
    panel, rejects = csvs.read_panel_csv(spark, out)
    assert values(panel) == row and rejects.count() == 0
    other = str(tmp_path / "other")
    csvs.write_panel_csv(spark.createDataFrame(row, columns).select(*reversed(columns.split()[::2])), other)
    assert values(csvs.read_panel_csv(spark, other)[0]) == row
    lacking = str(tmp_path / "lacking")
    csvs.write_panel_csv(spark.createDataFrame(row, columns).drop("slack"), lacking)
    with pytest.raises(ValueError, match="CSV header"):
        csvs.read_panel_csv(spark, lacking)


def test_predictions_of_different_runs_do_not_collide(spark, tmp_path):
    rows = spark.createDataFrame(
        [("AG", 30, 5, 1.0, 2.0, 3.0)],
        "region string, acc_id int, year int, realized double, prediction double, budget double",
    )
    out = str(tmp_path / "predictions")
    csvs.write_predictions(rows, out, "xgboost", "Ertrag")
    csvs.write_predictions(rows, out, "xgboost", None)
    csvs.write_predictions(rows, out, "hgb", "Ertrag", 30, "AG")
    csvs.write_predictions(rows, out, "hgb", "Ertrag", 30, "AG")
    stored = spark.read.parquet(out)
    assert values(stored, "model", "category", "slice_acc_id", "slice_region") == [
        ("hgb", "Ertrag", "30", "AG"), ("xgboost", "Ertrag", "all", "all"), ("xgboost", "all", "all", "all"),
    ]


def test_trials_round_trip(spark, tmp_path):
    out = str(tmp_path / "trials")
    csvs.write_trials(spark.createDataFrame([(0, 0.5)], "trial int, mse double"), out)
    assert values(csvs.read_trials(spark, out)) == [(0, 0.5)]


def test_survey_answers_may_span_lines(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text('Consent,Explainer\nYes,"first line\nsecond, ""quoted"""\nNo,\n')
    rows, rejects = csvs.read_survey(spark, str(path), ["Consent", "Explainer"])
    assert rejects.count() == 0
    assert values(rows) == [("No", None), ("Yes", 'first line\nsecond, "quoted"')]


def test_blank_answers_drop_and_export(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", ""), ("", ""), (None, "b"), (None, None)], "first string, again string"
    )
    kept = survey.with_any_text(rows, ["first", "again"])
    assert values(kept) == [(None, "b"), ("a", None)]
    out = str(tmp_path / "answers")
    csvs.write_answers(kept.where("first IS NOT NULL"), "first", out)
    assert values(lines.read_lines(spark, out, "first"), "text") == [("a",)]


def test_lines_drop_header_and_blanks(spark, tmp_path):
    path = tmp_path / "answers.txt"
    path.write_text("Explainer\n  one  \n\n \t \n two \n", encoding="utf-8")
    assert values(lines.read_lines(spark, str(path), "Explainer"), "text") == [("one",), ("two",)]


def test_only_the_first_line_is_a_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Explainer\none\nExplainer\n")
    (tmp_path / "b.txt").write_text("two\nExplainer\n")
    kept = lines.read_lines(spark, str(tmp_path), "Explainer")
    assert values(kept, "text") == [("Explainer",), ("Explainer",), ("one",), ("two",)]


def test_scores_keep_the_order_of_the_lines(spark, tmp_path):
    words = spark.createDataFrame([("GOOD", *[False, True, False, False, False, False, False])], [
        "word", "negative", "positive", "uncertainty", "litigious", "strong_modal", "weak_modal", "constraining"])
    source = tmp_path / "answers.txt"
    texts = [f"line {i} good" if i % 3 else f"line {i}" for i in range(50)]
    source.write_text("\n".join(["Explainer", *texts]))
    out = str(tmp_path / "scores")
    jobs.score_answers(spark, str(source), "Explainer", words, out)
    got = [r["Text"] for f in sorted((tmp_path / "scores").glob("part-*")) for r in csvs.read_lexicon_result(spark, str(f)).collect()]
    assert [t.split()[1] for t in got] == [str(i) for i in range(50)]


def test_lexicon_flags(spark, tmp_path):
    path = tmp_path / "lexicon.csv"
    path.write_text(
        "Word,Seq,Count,Prop,Avg,Std,Docs,Neg,Pos,Unc,Lit,Strong,Weak,Con,Syl,Source\n"
        "bad,1,5,0,0,0,1,2009,0,0,0,0,0,,1,x\n"
        "maybe,2,5,0,0,0,1,0,0,2009,0,0,2011,0,1,x\n"
        "old,3,5,0,0,0,1,-2020,0,0,0,0,0,0,1,x\n"
        ",4,5,0,0,0,1,2009,0,0,0,0,0,0,1,x\n"
    )
    words = lines.read_lexicon(spark, str(path))
    assert values(words, "word", "negative", "uncertainty", "weak_modal") == [
        ("BAD", True, False, False), ("MAYBE", False, True, True), ("OLD", False, False, False),
    ]
    assert values(lines.lexicon_long(words)) == [
        ("BAD", "negative"), ("MAYBE", "uncertainty"), ("MAYBE", "weak_modal"),
    ]


def test_result_files_round_trip(spark, tmp_path):
    out = str(tmp_path / "polarity")
    row = [('a "b", c', 0.5, 0.25, 0.5)]
    csvs.write_result(
        spark.createDataFrame(row, "Text string, Polarity double, Subjectivity double, Intensity double"), out
    )
    assert values(csvs.read_polarity_result(spark, out)) == row
    counts = str(tmp_path / "counts")
    csvs.write_result(spark.range(1).select(F.lit("t").alias("Text"), *[
        F.lit(i).alias(n) for i, n in enumerate(
            ["negative", "positive", "uncertainty", "litigious", "strong_modal", "weak_modal", "constraining"])
    ]), counts)
    assert values(csvs.read_lexicon_result(spark, counts)) == [("t", 0, 1, 2, 3, 4, 5, 6)]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        require_columns(spark.range(1), ["id", "year"])


def test_constants_with_quotes_and_backslashes(spark):
    from slackline.schema import inline_table

    odd = ["a\\b", "it's", 'x"y', "\\", "\\'"]
    assert values(inline_table(spark, [(x,) for x in odd], ["v"])) == sorted((x,) for x in odd)
    assert inline_table(spark, [], ["v", "w"]).columns == ["v", "w"]


def test_malformed_rows_are_rejects_and_all_rows_add_up(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b"Acc-ID,Name,Year,Region\n3,fine,2011,AG\n4,too,2011,AG,many\n5,few,2011\n\n6,Stra\xdfe,2011,AG\n"
        b'7,"two\nlines",2011,AG\n8,5 inch",2011,AG\n9,"a "b" c",2011,AG\n10,"never closed,2011,AG\n11,after it,2011,AG\n'
    )
    panel, rejects = csvs.read_union_by_name(spark, str(tmp_path), "*.csv")
    assert values(panel, "acc_id", "name") == [
        ("11", "after it"), ("3", "fine"), ("7", "two\nlines"), ("8", '5 inch"'), ("9", 'a "b" c'),
    ]
    assert values(rejects, "record_no", "reason") == [
        (2, "more cells than the header"), (3, "fewer cells than the header"), (5, "undecodable text"), (9, "unclosed quote"),
    ]
    assert all(r["path"].endswith("a.csv") and r["record"] for r in rejects.collect())
    kept, others = csvs.read_union_by_name(spark, str(tmp_path), "*.csv", short_rows="keep")
    assert (kept.count(), others.count()) == (6, 3)
    assert values(kept.where("acc_id = '5'"), "name", "region") == [("few", None)]
    with pytest.raises(ValueError, match="short rows"):
        csvs.read_union_by_name(spark, str(tmp_path), "*.csv", short_rows="drop")


def test_malformed_survey_and_panel_rows(spark, tmp_path):
    survey_file = tmp_path / "survey.csv"
    survey_file.write_text('Consent,Explainer\nYes,ok\nNo,too,many\nYes\nNo,"open\n')
    rows, rejects = csvs.read_survey(spark, str(survey_file), ["Explainer"])
    assert values(rows) == [("ok",)]
    assert values(rejects, "record_no", "reason") == [
        (2, "more cells than the header"), (3, "fewer cells than the header"), (4, "unclosed quote"),
    ]
    with pytest.raises(ValueError, match="lacks one of"):
        csvs.read_survey(spark, str(survey_file), ["Consent", "Age"])


RECORD_CELLS = ["a", "b c", "x,y", 'q"q', "two\nlines", "", '"', '""', "1\n\n2", ",", "é"]


@pytest.mark.parametrize("block", ["128m", "64"])
def test_records_match_a_csv_parser(spark, conf, tmp_path, block):
    """Blocks of 64 bytes cut files inside cells, quotes and records."""
    conf("spark.sql.files.maxPartitionBytes", block)
    conf("spark.sql.files.openCostInBytes", "1")
    rng, want = random.Random(1), {}
    for name in ("a.csv", "b.csv", "c.csv", "d.csv"):
        rows = [[rng.choice(RECORD_CELLS) for _ in range(rng.randint(2, 5))] for _ in range(rng.randint(0, 40))]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n", quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(rows)
        (tmp_path / name).write_text(out.getvalue(), encoding="utf-8")
        want[name] = rows or [[""]]
    found = records.read_records(spark, str(tmp_path)).withColumn("cells", split_cells(F.col("record")))
    got = {}
    for r in found.orderBy("path", "record_no").collect():
        mine = got.setdefault(r["path"].rsplit("/", 1)[-1], [])
        assert r["record_no"] == len(mine)
        mine.append(r["cells"])
    assert got == want


def test_cells_of_odd_lines(spark):
    cases = {
        'a,b "c,d': ["a", 'b "c', "d"],
        ' "a, b" ,c': ["a, b", "c"],
        '"open,b': ['"open', "b"],
        '""': [""],
        '""""': ['"'],
        ",": ["", ""],
        "": [""],
        '"a"b,c': ['"a"b', "c"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    assert {r["line"]: r["cells"] for r in df.withColumn("cells", split_cells(F.col("line"))).collect()} == cases
    piped = spark.createDataFrame([('a|"b|c"|d,e',)], "line string")
    assert piped.select(split_cells(F.col("line"), "|")).first()[0] == ["a", "b|c", "d,e"]
    with pytest.raises(ValueError, match="separator"):
        split_cells(F.col("line"), '"')
