import pytest

from slackline.operators import ledger
from slackline.plans import jobs
from slackline.session import stored
from slackline.sources import csvs, sheets
from tests.conftest import values

HRM1_BLANK = "note\n,,2015,2015,diff,2016\nunits,,,,,\n3,Aufwand,100,90,1,110\n34 - 37,\"Div, e\",8,4,0,12\nx,y,1,1,1,1\n0,zero,5,5,5,5\n"
HRM1_ZERO = "note\n0,0,2016,2016,2017\nunits,,,,\n38,Rest,10,20,30\n"
HRM2_OLD = "\n,in 1000 Franken,2015,2015,2016\nunits,,,,\n30,Personal,50,40,60\n"
HRM2_NEW = "a\nb\nc\nd\nReferenz-ID,HRM 2,en 1 000 frs.,2020,2020,2020,2020,2021\nunits,,,,,,,\nHRM2_ER30,30,Pers,10,1,2,7,11\n,31,Sach,10,1,2,7,11\n"
HRM2_TWO = "a\nb\nc\nd\nReferenz-ID,HRM 2,in 1 000 Franken,2020,2020,2021\nunits,,,,,\nHRM2_ER30,30,Pers,10,7,11\n"


@pytest.fixture
def folder(tmp_path):
    def write(path, content):
        target = tmp_path / "in" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(content)

    write("ledger_2015/HRM1_KT_AG.csv", HRM1_BLANK)
    write("ledger_2016/BE HRM1.csv", HRM1_ZERO)
    write("ledger_2015/ZH_HRM2.csv", HRM2_OLD)
    write("ledger_2020/HRM2 KT_AG.csv", HRM2_NEW)
    write("ledger_2020/HRM2_KT_BE.csv", HRM2_TWO)
    write("ledger_2020/HRM2 alle.csv", HRM2_TWO)
    write("ledger_2020/Notes.csv", "x\n")
    write("ledger_2020/HRM_X.csv", "x\n")
    write("ledger_2020/HRM3_KT_BE.csv", HRM2_TWO)
    write("ledger_2020/HRM2_KT_UR.csv", "a\nb\n")
    write("ledger_2020/skipped.txt", "x\n")
    return str(tmp_path / "in")


def test_names(spark):
    names = ["HRM2_KT_AG", "HRM2 KT_AG", "AG HRM1", "AG_HRM2", "HRM2KT_AG", "HRM2 alle", "Notes", "HRM_X"]
    frame = spark.createDataFrame(
        [(f"/x/2015/{n}.csv", n) for n in names], "path string, sheet string"
    )
    out = {r["sheet"]: r for r in sheets.parse_sheets(frame).collect()}
    for n in ("HRM2_KT_AG", "HRM2 KT_AG", "AG_HRM2", "HRM2KT_AG"):
        assert (out[n]["standard"], out[n]["region"], out[n]["reason"]) == ("HRM2", "AG", None)
    assert (out["AG HRM1"]["standard"], out["AG HRM1"]["layout"]) == ("HRM1", "HRM1")
    assert out["HRM2 alle"]["reason"] == "not a region sheet"
    assert out["Notes"]["reason"] == "not a region sheet"
    assert out["HRM_X"]["reason"] == "invalid sheet name"


def test_year_is_the_first_four_digits_of_the_path(spark):
    rows = spark.createDataFrame([("/a/2015_x/2016.csv",), ("/a/b.csv",), ("/20151/x",)], "path string")
    out = [r[0] for r in rows.select(sheets.year_of_path("path")).collect()]
    assert out == [2015, None, 2015]


def located(spark, folder):
    return sheets.located_sheets(sheets.read_sheets(spark, folder))


def rows_of(spark, folder):
    lines = stored(sheets.read_sheets(spark, folder))
    return sheets.sheet_rows(lines, sheets.located_sheets(lines))


def test_every_layout_from_files(spark, folder):
    out = ledger.clean_rows(rows_of(spark, folder))
    assert values(out, "region", "year", "standard", "acc_id", "budget", "realized", "budget_next", "slack") == [
        ("AG", 2015, "HRM1", "3", 100.0, 90.0, 110.0, 10.0),
        ("AG", 2015, "HRM1", "34", 2.0, 1.0, 3.0, 1.0),
        ("AG", 2015, "HRM1", "35", 2.0, 1.0, 3.0, 1.0),
        ("AG", 2015, "HRM1", "36", 2.0, 1.0, 3.0, 1.0),
        ("AG", 2015, "HRM1", "37", 2.0, 1.0, 3.0, 1.0),
        ("AG", 2020, "HRM2", "30", 10.0, 7.0, 11.0, 3.0),
        ("BE", 2016, "HRM1", "35", 10.0, 20.0, 30.0, -10.0),
        ("BE", 2020, "HRM2", "30", 10.0, 7.0, 11.0, 3.0),
        ("ZH", 2015, "HRM2", "30", 50.0, 40.0, 60.0, 10.0),
    ]
    names = {(r["region"], r["acc_id"]): r["name"] for r in out.collect()}
    assert names[("AG", "34")] == "Div, e"
    assert names[("BE", "35")] == "Rest"
    assert names[("ZH", "30")] == "Personal"


def test_rejects_carry_a_reason(spark, folder):
    out = {(r["sheet"], r["reason"]) for r in sheets.rejected(located(spark, folder)).collect()}
    assert out == {
        ("HRM2 alle", "not a region sheet"),
        ("Notes", "not a region sheet"),
        ("HRM_X", "invalid sheet name"),
        ("HRM3_KT_BE", "unknown standard"),
        ("HRM2_KT_UR", "no column for acc_id, budget, realized, budget_next"),
    }


def test_tab_separated_cells(spark):
    text = HRM1_ZERO.replace("2016", "2015").replace("2017", "2016").replace(",", "\t")
    frame = spark.createDataFrame(
        [("/2015/HRM1_KT_AG.csv", "HRM1_KT_AG", i, line) for i, line in enumerate(text.split("\n"))],
        "path string, sheet string, line_no long, line string",
    )
    rows = sheets.sheet_rows(frame, sheets.located_sheets(frame, "\t"), "\t")
    assert values(rows.where("acc_id IS NOT NULL"), "acc_id", "name", "budget") == [("38", "Rest", "10")]


def test_build_panels_job(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    jobs.build_panels(spark, folder, out)
    one = csvs.read_panel(spark, f"{out}/single_digit")
    two = csvs.read_panel(spark, f"{out}/double_digit")
    assert values(one, "region", "acc_id", "slack") == [("AG", 3, 10.0)]
    assert two.count() == 8
    assert set(two.columns) == {"year", "region", "acc_id", "realized", "budget", "budget_next", "slack"}
    assert spark.read.parquet(f"{out}/rejects").count() == 5


def test_missing_folder_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sheets.read_sheets(spark, str(tmp_path / "nowhere")).count()


def test_cells_with_line_breaks(spark, tmp_path):
    target = tmp_path / "2015" / "HRM1_KT_AG.csv"
    target.parent.mkdir(parents=True)
    target.write_text('note\n,,2015,2015,diff,2016\nunits,,,,,\n3,"Auf\nwand, x",100,90,1,110\n30,"a ""b""",1,2,0,3\n31,"c\n\nd",4,5,0,6\n')
    rows = rows_of(spark, str(tmp_path))
    assert values(rows.where("acc_id IS NOT NULL"), "acc_id", "name", "budget") == [
        ("3", "Auf\nwand, x", "100"), ("30", 'a "b"', "1"), ("31", "c\n\nd", "4"),
    ]


def test_a_line_of_very_many_quoted_cells(spark, tmp_path):
    target = tmp_path / "2015" / "HRM1_KT_AG.csv"
    target.parent.mkdir(parents=True)
    wide = ",".join(['"x, ""y"""'] * 50_000)
    target.write_text(f"note\n,,2015,2015,diff,2016,{wide}\nunits,,,,,\n3,Aufwand,100,90,1,110,{wide}\n" + "4,Rest,1,2,0,3\n" * 2000)
    rows = rows_of(spark, str(tmp_path)).where("acc_id IS NOT NULL")
    assert rows.count() == 2001
    assert values(rows.where("acc_id = '3'"), "name", "budget") == [("Aufwand", "100")]


def test_digits_above_the_input_folder_are_no_year(spark, tmp_path):
    target = tmp_path / "run 2023" / "in" / "ledger_2015" / "HRM1_KT_AG.csv"
    target.parent.mkdir(parents=True)
    target.write_text(HRM1_BLANK)
    rows = located(spark, str(tmp_path / "run 2023" / "in")).collect()
    assert [r["year"] for r in rows] == [2015]


def test_accounts_that_meet_in_the_crosswalk_are_summed(spark, tmp_path):
    target = tmp_path / "in" / "2015" / "HRM1_KT_AG.csv"
    target.parent.mkdir(parents=True)
    target.write_text('note\n,,2015,2015,diff,2016\nunits,,,,,\n32,Old,10,4,0,8\n34 - 37,Div,8,4,0,12\n')
    out = str(tmp_path / "out")
    jobs.build_panels(spark, str(tmp_path / "in"), out)
    two = csvs.read_panel(spark, f"{out}/double_digit")
    assert two.groupBy("year", "region", "acc_id").count().where("count > 1").count() == 0
    sums = two.agg({"budget": "sum", "realized": "sum", "budget_next": "sum"}).first()
    assert sorted(sums) == [8.0, 18.0, 20.0]
