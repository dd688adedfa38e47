import datetime as dt
import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from staffwise.plans import jobs
from staffwise.sources import files as S
from staffwise.sources import json as SJ
from staffwise.sources import sinks, workbook

d = dt.date
HC_HEADER = "Pers.No.,Personnel Number,Orgunit,Reporting Officer,Personnel Subarea,Pay Scale Group,Zip Code,Date Joined,Birth Date,Todays Date"


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_title_line_csv_and_header_groups(spark, tmp_dir):
    write(f"{tmp_dir}/a_headcount.csv", "Report title\nPers.No.,Name (full)\n12.0,Ann\n13,Bob\n,\n")
    write(f"{tmp_dir}/b_headcount.csv", "Report title\nPers.No.,Extra\n14,x\n")
    write(f"{tmp_dir}/ml_pipeline_headcount.csv", "t\nPers.No.\n99\n")
    df = S.read_delimited(spark, f"{tmp_dir}/*headcount.csv", title_line=True, exclude=["ml_pipeline"])
    assert set(df.columns) == {"persno", "name_full", "extra", "_file", "_row"}
    got = sorted((r["persno"], r["name_full"], r["extra"], r["_file"]) for r in df.filter("persno is not null").collect())
    assert got == [("12.0", "Ann", None, "a_headcount.csv"), ("13", "Bob", None, "a_headcount.csv"),
                   ("14", None, "x", "b_headcount.csv")]


def test_header_with_quoted_newline_and_empty_file(spark, tmp_dir):
    write(f"{tmp_dir}/n_x.csv", 'Title\n"Date\nJoined",Pers.No.\n01/01/2020,5\n')
    write(f"{tmp_dir}/n_y.csv", "")
    df = S.read_delimited(spark, f"{tmp_dir}/n_*.csv", title_line=True)
    assert [(r["date_joined"], r["persno"]) for r in df.collect()] == [("01/01/2020", "5")]


def test_latest_file_and_name_parts(spark, tmp_dir):
    write(f"{tmp_dir}/2023-01_leavers.csv", "x\n1\n")
    write(f"{tmp_dir}/2023-02_leavers.csv", "x\n2\n")
    os.utime(f"{tmp_dir}/2023-01_leavers.csv", (time.time() + 100, time.time() + 100))
    assert S.latest_file(spark, f"{tmp_dir}/*_leavers.csv").endswith("2023-01_leavers.csv")
    df = S.year_month_from_name(S.read_delimited(spark, f"{tmp_dir}/*_leavers.csv"))
    assert sorted((r["year"], r["month"]) for r in df.collect()) == [(2023, 1), (2023, 2)]
    tagged = S.tag_by_name(df, {"01": "jan", "02": "feb"})
    assert sorted(r["source"] for r in tagged.collect()) == ["feb", "jan"]


def test_pipe_text_and_sink_roundtrip(spark, tmp_dir):
    write(f"{tmp_dir}/claims.txt", "EmployeeNumber|TreatmentDate|Consult Fee|Drug Fee|Other\n"
                                   "1.0|31/01/2024|10.5|2|x\n2|2024-02-29|bad|3|y\n")
    long = jobs.claims_long(spark, f"{tmp_dir}/claims.txt", ["employeenumber"],
                            {"medical": ["consult_fee", "drug_fee"]}, date_cols=["treatmentdate"], eom_of="treatmentdate")
    assert long.count() == 4
    assert long.agg(F.sum("amount")).first()[0] == 10.5 + 2 + 3
    assert sorted({r["eom"] for r in long.collect()}) == [d(2024, 1, 31), d(2024, 2, 29)]
    out = f"{tmp_dir}/sink"
    sinks.write_table(long, path=out, partition_by=["eom"])
    assert spark.read.parquet(out).count() == 4
    sinks.write_table(long.limit(0), path=out)  # full refresh with empty input leaves an empty table
    assert spark.read.parquet(out).count() == 0
    sinks.write_extract(long, f"{tmp_dir}/extract")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/extract").count() == 4


def test_table_full_refresh_swaps(spark):
    spark.range(5).write.mode("overwrite").saveAsTable("refresh_t")
    sinks.write_table(spark.range(3), table="refresh_t")
    assert spark.read.table("refresh_t").count() == 3
    sinks.write_table(spark.range(0), table="refresh_t")
    assert spark.read.table("refresh_t").count() == 0
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("refresh_t")] == ["refresh_t"]


def test_failed_swap_keeps_the_old_table(spark, monkeypatch):
    sinks.write_table(spark.range(4), table="swap_t")
    real = type(spark).sql

    def failing(self, text, *args, **kw):
        if "staging" in text:
            raise RuntimeError("no swap")
        return real(self, text, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        sinks.write_table(spark.range(2), table="swap_t")
    monkeypatch.undo()
    assert spark.read.table("swap_t").count() == 4


def _hc_file(path, day, rows):
    lines = ["Headcount report", HC_HEADER] + [",".join(r + [day]) for r in rows]
    write(path, "\n".join(lines) + "\n")


def test_daily_listing_job(spark, tmp_dir):
    rows1 = [["1.0", "A1", "OU1", "", "MANAGERIAL GRADE", "H5", "100", "01/01/2020", "01/01/1990"],
             ["2", "A2", "OU1", "1", "STAFF", "", "200", "", "01/01/1991"],
             ["2", "A2", "OU1", "1", "STAFF", "", "200", "", "01/01/1991"],  # duplicate row
             ["3", "A3", "OU2", "2", "STAFF", "", "300", "05/05/2021", ""]]
    rows2 = [["1", "A1", "OU1", "", "MANAGERIAL GRADE", "Def for NA", "100", "01/01/2020", "01/01/1990"],
             ["2", "A2", "OU1", "1", "STAFF", "", "200", "02/02/2022", "01/01/1991"]]
    _hc_file(f"{tmp_dir}/d1_Headcount.csv", "30/01/2024", rows1)
    _hc_file(f"{tmp_dir}/d2_Headcount.csv", "2024-01-31", rows2)
    write(f"{tmp_dir}/x_leavers.csv", "Leavers\n" + HC_HEADER + ",Date Left\n"
          "9,A9,OU1,1,STAFF,,100,01/01/2019,01/01/1980,31/01/2024,15/01/2024\n9,A9,OU1,1,STAFF,,100,,,31/01/2024,\n")
    geo = spark.createDataFrame([("100", 1.3), ("200", 1.4)], "zip_code string, lat double")
    out = jobs.daily_listing(spark, f"{tmp_dir}/*Headcount.csv", f"{tmp_dir}/*_leavers.csv", geo, root_id="1")
    got = {(r["persno"], r["_file"]): r for r in out.collect()}
    assert len(got) == 6
    a = got[("1", "d1_Headcount.csv")]
    assert a["personnel_subarea"] == "H5" and a["span"] == 1 and a["layer"] == 0 and a["lat"] == 1.3
    assert got[("1", "d2_Headcount.csv")]["personnel_subarea"] == "MANAGERIAL GRADE"
    b = got[("2", "d1_Headcount.csv")]
    assert b["layer"] == 1 and b["span"] == 1 and b["date_joined"] == d(2022, 2, 2)  # latest join date backfilled
    assert got[("3", "d1_Headcount.csv")]["layer"] == 2 and got[("3", "d1_Headcount.csv")]["span"] is None
    lv = got[("9", "x_leavers.csv")]
    assert lv["active"] is False and lv["date_left"] == d(2024, 1, 15) and lv["eom"] == d(2024, 1, 31)


def test_timeoff_days_job(spark):
    t = spark.createDataFrame([
        ("1", "AL", "01/01/2024", "02/01/2024"), ("1", "AL", "01/01/2024", "02/01/2024"),
        ("1", "SL", "03/01/2024", "03/01/2024"), ("1", "AL", "06/01/2024", "05/01/2024"),
        ("2", "AL", "10/01/2024", "11/01/2024")], "persno string, leave_type_code string, startdate string, enddate string")
    out = jobs.timeoff_days(t)
    got = sorted((r["persno"], r["leave_day"], r["streak"]) for r in out.collect() if r["leave_day"])
    assert out.count() == len(got) + 1  # the reversed record stays, without a day
    assert got == [("1", d(2024, 1, 1), 0), ("1", d(2024, 1, 2), 1), ("1", d(2024, 1, 3), 2),
                   ("2", d(2024, 1, 10), 0), ("2", d(2024, 1, 11), 1)]


def test_timeoff_keeps_reversed_and_missing_ranges(spark):
    t = spark.createDataFrame([
        ("1", "AL", "06/01/2024", "05/01/2024"), ("1", "SL", None, "05/01/2024"), ("1", "AL", "01/01/2024", "03/01/2024")],
        "persno string, leave_type_code string, startdate string, enddate string")
    days = jobs.timeoff_days(t)
    none = days.filter("leave_day is null").collect()
    assert len(none) == 2 and all(r["gap_days"] is None and not r["gap"] and r["streak"] == 0 for r in none)
    records = jobs.timeoff_records(days).collect()  # one row a record, its last day
    assert sorted((r["leave_type_code"], str(r["leave_day"]), r["streak"]) for r in records) == [
        ("AL", "2024-01-03", 2), ("AL", "None", 0), ("SL", "None", 0)]


def test_dependants_education_and_work_passes(spark, tmp_dir):
    write(f"{tmp_dir}/Dependant.csv", "t\nPersno,Relationship,Dependent First Name,Dependent Date of Birth\n"
          "1,Child,Al,01/02/2010\n1,Child,Al,01/02/2010\n1,,Bo,01/02/2012\n2,Spouse,Cy,bad\n")
    got = sorted((r["persno"], r["dependent_first_name"], r["d_age"])
                 for r in jobs.dependants(spark, f"{tmp_dir}/*Dependant*.csv", F.lit("2024-02-02").cast("date")).collect())
    assert got == [("1", "Al", 14), ("2", "Cy", 0)]  # no birth date: age 0
    write(f"{tmp_dir}/Education.csv", "t\nPersno,Qualification,Date Attained,End Date\n"
          "1,BA,01/02/2010,\n1,MA,01/02/2014,\n1,MSc,01/02/2014,\n1,,01/02/2020,\n2,BA,,\n")
    got = sorted((r["persno"], r["qualification"], r["latest_qual"]) for r in jobs.education(spark, f"{tmp_dir}/*Education*.csv").collect())
    assert got == [("1", "BA", False), ("1", "MA", True), ("1", "MSc", True), ("2", "BA", False)]
    write(f"{tmp_dir}/workpermit.csv", "t\nPersno,Issue Date,Expiry Date,Todays Date,Doc Type\n"
          "1,01/01/2020,01/01/2022,,EP\n1,01/01/2023,01/01/2025,,SP\n2,,,,WP\n")
    got = sorted((r["persno"], r["doc_type"]) for r in jobs.work_passes(spark, f"{tmp_dir}/*workpermit*.csv").collect())
    assert got == [("1", "SP"), ("2", "WP")]


def test_promotions(spark, tmp_dir):
    write(f"{tmp_dir}/promotion.csv", "t\nPersno,Personnel Number,Start Date,Todays Date\n"
          "12.0,A,01/01/2024,30/01/2024\n12,A,01/01/2024,31/01/2024\n13,B,05/01/2024,31/01/2024\n")
    daily = jobs.daily_promotions(spark, f"{tmp_dir}/*promotion*.csv")
    assert sorted((r["persno"], r["start_date"], r["todays_date"]) for r in daily.collect()) == [
        ("12", d(2024, 1, 1), d(2024, 1, 30)), ("13", d(2024, 1, 5), d(2024, 1, 31))]
    old = spark.createDataFrame([("9", d(2022, 1, 1))], "persno string, start_date date")
    monthly = spark.createDataFrame([("8", d(2023, 1, 1), "Non-SF")], "persno string, start_date date, source string")
    got = sorted((r["persno"], r["source"]) for r in jobs.consolidation_promotions(old, monthly, daily).collect())
    assert got == [("13", None), ("8", "Non-SF"), ("9", "Old")]  # the daily row of the 30th is not the month's last


def test_daily_listing_keeps_every_row_and_cleans_groups(spark, tmp_dir):
    header = HC_HEADER.replace("Todays Date", "Fund Type,Work Schedule,Leave Eligibility Start Date,Todays Date")
    rows = [["1", "A1", "100.0", "NO_MANAGER", "Managerial Grade 1", "H5", "00100", "01/05/2020", "", "", "Office Work Schedule", "02/05/2020"],
            ["2", "A2", "200.0", "1", "managerial grade 2", "OTHERS", "1", "01/03/2021", "", "X", "Shift", ""],
            ["2", "A2", "300", "1", " staff ", "", "1", "01/03/2021", "", "X", "", ""],
            ["3", "A3", "300", "2", "STAFF", "", "1", "", "", "", "", ""]]
    write(f"{tmp_dir}/d_Headcount.csv", "\n".join(["t", header] + [",".join(r + ["31/01/2024"]) for r in rows]) + "\n")
    write(f"{tmp_dir}/x_leavers.csv", "Leavers\n" + header + ",Date Left\n" + "9,A9,1,1,S,,100,01/01/2019,,,,,31/01/2024,15/04/2024\n")
    for root in (None, "1"):
        out = jobs.daily_listing(spark, f"{tmp_dir}/*Headcount.csv", f"{tmp_dir}/*_leavers.csv", root_id=root).collect()
        assert len(out) == 5
    by = {(r["persno"], r["orgunit"]): r for r in out}
    assert set(by) == {("1", "100"), ("2", "200"), ("2", "300"), ("3", "300"), ("9", "1")}
    assert by[("2", "200")]["layer"] == by[("2", "300")]["layer"] == 1 and by[("3", "300")]["layer"] == 2
    a, b = by[("1", "100")], by[("2", "200")]
    assert a["personnel_subarea"] == "H5" and b["personnel_subarea"] == "MANAGERIAL GRADE 2" and by[("2", "300")]["personnel_subarea"] == "STAFF"
    assert a["reporting_officer"] is None and a["zip_code"] == "100" and a["fund_type"] == "NA" and b["fund_type"] == "X"
    assert [r["on_shift"] for r in (a, b, by[("2", "300")])] == [False, True, False]
    assert a["leave_eligibility_start_date"] == d(2020, 5, 2)
    assert (a["_datejoined_month"], a["_datejoined_year"], a["_datejoined_fy"]) == (5, "2020", "2021")
    lv = by[("9", "1")]
    assert (lv["_dateleft_month"], lv["_dateleft_year"], lv["_dateleft_fy"]) == (4, "2024", "2425")


def test_consolidation_marks_one_row_of_ties(spark):
    rows = [("1", d(2024, 1, 31), d(2020, 1, 1), u, True, None) for u in ("OU1", "OU2", "OU2")]
    df = spark.createDataFrame(rows, "persno string, todays_date date, date_joined date, orgunit string, active boolean, gender_key string")
    df = df.withColumn("birth_date", F.lit(None).cast("date")).withColumn("date_left", F.lit(None).cast("date"))
    out = jobs.consolidation_current(df, []).collect()
    assert [r["joiner_mark"] for r in out].count(True) == 1 and {r["gender_key"] for r in out} == {"M"}


def test_recruitment_missing_rule_column_raises(spark):
    tr = spark.createDataFrame([("Ann", "YES")], "candidate_name string, shortlisted_for_interview string")
    with pytest.raises(ValueError, match="date_of_interview"):
        jobs.recruitment_checks(tr)


def test_recruitment_rules_job(spark):
    cols = ["candidate_name", "date_of_application_received", "nationality", "bu", "job_grade", "parent_department",
            "position", "source", "shortlisted_for_interview", "employment_type", "date_of_interview",
            "final_interview_outcome", "reason_why_application_is_not_shortlisted_for_interview", "filename",
            "tracker_source"]
    later = sorted({c for _, cs, cond in jobs.RECRUITMENT_RULES for c in (*cs, *([cond[0]] if cond else []))} - set(cols))
    full = ["Ann", "1/1/24", "SG", "BU", "G1", "PD", "P", "web", "yes", "perm", "2/1/24", "pending", "", "f1", "main"]
    rows = [full, full[:0] + ["Bé", ""] + full[2:], full[:8] + ["no"] + full[9:]]
    tr = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).withColumns({c: F.lit(None).cast("string") for c in later})
    res = jobs.recruitment_checks(tr, stamp=F.lit(dt.datetime(2024, 1, 1, 0, 0, 30)))
    errs = [r["error"] for r in res["tracker"].orderBy("candidate_name").collect()]
    assert errs == [None, "Cat C error; ", "Cat A error; "]
    assert res["tracker"].first()["load_stamp"] == dt.datetime(2024, 1, 1, 8, 0)
    assert res["report"].count() == 2 and res["errors"].count() == 2


def test_history_diff_and_consolidation(spark):
    hist = spark.createDataFrame([("1", d(2024, 1, 31), True, "ou1", "j1", "FT"), ("2", d(2024, 1, 31), True, "ou1", "j1", "temp")],
                                 "persno string, eom date, active boolean, orgunit string, job string, employee_group string")
    cur = spark.createDataFrame([("1", d(2024, 2, 29), True, "ou2", "j1", "FT"), ("2", d(2024, 2, 29), True, "ou1", "j1", "TEMP")],
                                "persno string, eom date, active boolean, orgunit string, job string, employee_group string")
    res = jobs.history_diff(hist, cur, flexi_values=["TEMP"])
    assert res["listing"].filter("flexi").count() == 2
    assert [(r["persno"], r["field"], r["change"]) for r in res["diff"].collect()] == [("1", "orgunit", "modified")]
    daily = spark.createDataFrame([
        ("1", d(2024, 1, 30), d(2020, 1, 1), d(1990, 6, 1), None, True, "g1"),
        ("1", d(2024, 1, 31), d(2020, 1, 1), d(1990, 6, 1), None, True, "g1"),
        ("1", d(2024, 2, 29), d(2020, 1, 1), d(1990, 6, 1), d(2024, 2, 10), False, "g1")],
        "persno string, todays_date date, date_joined date, birth_date date, date_left date, active boolean, grade string")
    ref = spark.createDataFrame([("G1", 10)], "grade string, sort int")
    out = jobs.consolidation_current(daily, [(ref, "grade", None)])
    rows = sorted(out.collect(), key=lambda r: r["todays_date"])
    assert [r["todays_date"] for r in rows] == [d(2024, 1, 31), d(2024, 2, 29)]
    assert [r["joiner_mark"] for r in rows] == [True, False] and rows[0]["sort"] == 10
    assert rows[1]["age"] == 33 and rows[0]["tenure"] == 4.08


def test_json_records_and_pages(spark, tmp_dir):
    write(f"{tmp_dir}/rates.json", json.dumps({"result": {"records": [
        {"quarter": "2023-Q1", "occupation1": "total", "industry3": "total", "recruitment_rate": "2.5", "resignation_rate": "1.0", "note": None},
        {"quarter": "2022-Q4", "occupation1": "total", "industry3": "food, beverages and tobacco", "recruitment_rate": "1", "resignation_rate": "2", "note": "x"},
        {"quarter": "2023-Q4", "occupation1": "total", "industry3": "retail", "recruitment_rate": "1", "resignation_rate": "2", "note": "x"},
        {"quarter": "2023-Q4", "occupation1": "clerks", "industry3": "total", "recruitment_rate": "1", "resignation_rate": "2", "note": "x"},
        {"quarter": "2023-Q2", "occupation1": "total", "industry3": "total", "recruitment_rate": "na", "resignation_rate": "1.5", "note": "x"}]}}))
    out = jobs.benchmark_rates(spark, f"{tmp_dir}/rates.json")
    assert "note" not in out.columns
    assert [(r["year"], r["q"], r["recruitment_rate"], r["resignation_rate"]) for r in out.collect()] == [
        (2023, 2, None, 0.015), (2023, 1, 2.5, 0.01), (2022, 4, 1.0, 0.02)]
    for i, nxt in enumerate(["page2", None]):
        page = {"d": {"results": [{"personIdExternal": f"p{i}", "startDate": "/Date(1704067200000)/",
                                   "meta": {"uri": f"u{i}"}}], "__next": nxt}}
        write(f"{tmp_dir}/page{i}.json", json.dumps(page))
    rows = jobs.employment_pages(spark, f"{tmp_dir}/page*.json")
    got = sorted((r["personIdExternal"], r["startDate"], r["meta_uri"]) for r in rows.collect())
    assert got == [("p0", dt.datetime(2024, 1, 1), "u0"), ("p1", dt.datetime(2024, 1, 1), "u1")]
    assert SJ.flatten(spark.createDataFrame([((1, (2,)),)], "a struct<b:int, c:struct<d:int>>")).columns == ["a_b", "a_c_d"]


def test_geo_enrich_job(spark):
    def resolver(pdf):
        z = pdf["zip_code"]
        return pd.DataFrame({"zip_code": z, "lat": z.astype(float) / 1000, "long": 103.0,
                             "road_name": "R" + z, "address": None}).where(z != "999", None).assign(zip_code=z)

    listing = spark.createDataFrame([("1", "100"), ("2", "100"), ("3", "999")], "persno string, zip_code string")
    got = sorted((r["persno"], r["lat"]) for r in jobs.geo_enrich(listing, resolver).collect())
    assert got == [("1", 0.1), ("2", 0.1)]


def test_workbook_rows_through_spark(spark, tmp_dir):
    # defined inside the test so that it is shipped to the Python workers by value
    def _text_book(content, header):
        """Stand-in workbook parser: sheets separated by '## name' lines, CSV inside."""
        import io

        book, name, buf = {}, None, []
        for line in content.decode().splitlines():
            if line.startswith("## "):
                if name is not None:
                    book[name] = pd.read_csv(io.StringIO("\n".join(buf)), header=header, dtype=str)
                name, buf = line[3:], []
            else:
                buf.append(line)
        if name is not None:
            book[name] = pd.read_csv(io.StringIO("\n".join(buf)), header=header, dtype=str)
        return book

    write(f"{tmp_dir}/2024-01 monthly.book", "## Departure\npersno,date_left\n1,01/01/2024\n"
          "## Names Jan\npersno,grade\n2,G1\n3,\n## Prom\npersno\n4\n")
    write(f"{tmp_dir}/2024-02 monthly.book", "## NAMES feb\npersno,grade\n5,G2\n## departure\npersno,date_left\n6,\n")
    rows = workbook.read_sheets(spark, f"{tmp_dir}/*.book", sheet_regex=r"^name", parser=_text_book)
    wide = workbook.cells_to_columns(rows)
    got = sorted((r["file"], r["sheet"], r["row_no"], r["persno"], r["grade"]) for r in wide.collect())
    assert got == [("2024-01 monthly.book", "Names Jan", 0, "2", "G1"), ("2024-01 monthly.book", "Names Jan", 1, "3", None),
                   ("2024-02 monthly.book", "NAMES feb", 0, "5", "G2")]
    leavers = workbook.read_sheets(spark, f"{tmp_dir}/*.book", sheet_regex=r"^departure$", parser=_text_book)
    assert leavers.count() == 2
    first = workbook.read_sheets(spark, f"{tmp_dir}/*.book", sheet=0, parser=_text_book)
    assert sorted(r["sheet"] for r in first.collect()) == ["Departure", "NAMES feb"]
    by_name = workbook.read_sheets(spark, f"{tmp_dir}/*.book", sheet="Prom", parser=_text_book)
    assert [r["cells"]["persno"] for r in by_name.collect()] == ["4"]


@pytest.mark.skipif(not workbook.available(), reason="openpyxl is not installed")
def test_workbook_sheets(spark, tmp_dir):
    with pd.ExcelWriter(f"{tmp_dir}/2024-01 book.xlsx") as xw:
        pd.DataFrame({"A": [1, 2]}).to_excel(xw, sheet_name="Departure", index=False)
        pd.DataFrame({"A": [3]}).to_excel(xw, sheet_name="Names Jan", index=False)
    rows = workbook.read_sheets(spark, f"{tmp_dir}/*.xlsx", sheet_regex="^name")
    assert workbook.cells_to_columns(rows).count() == 1


def test_headers_batched_and_large_files(spark, tmp_dir):
    for i in range(5):
        write(f"{tmp_dir}/s{i}_hc.csv", f"Title {i}\nPers.No.,Grade\n{i},G{i}\n")
    big_rows = "".join(f"{100 + k},GX\n" for k in range(2000))
    write(f"{tmp_dir}/z_big_hc.csv", "Big title\nPers.No.,Grade,Extra\n" + big_rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # the big file now spans several splits
    try:
        df = S.read_delimited(spark, f"{tmp_dir}/*_hc.csv", title_line=True)
        assert set(df.columns) == {"persno", "grade", "extra", "_file", "_row"}
        assert df.count() == 5 + 2000
        assert df.filter("persno = 'Pers.No.' OR persno LIKE 'Big%' OR persno LIKE 'Title%'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_long_headers_and_titles_keep_every_column_and_file(spark, tmp_dir):
    names = [f"Name\nno {i}" for i in range(60)]
    header = ",".join(f'"{n}"' for n in names)
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write(header + "\n" + ",".join(str(i) for i in range(60)) + "\n")
    got = S.read_delimited(spark, os.path.join(tmp_dir, "a.csv"))
    assert len(got.columns) == 62 and got.first()[59] == "59"

    os.mkdir(os.path.join(tmp_dir, "t"))
    with open(os.path.join(tmp_dir, "t", "long.csv"), "w") as f:
        f.write('"' + "title\n" * 60 + '"\nx,y\n1,2\n')
    with open(os.path.join(tmp_dir, "t", "short.csv"), "w") as f:
        f.write("title\nx,y\n3,4\n")
    heads = S.headers_of(spark, [r["path"] for r in S.list_files(spark, os.path.join(tmp_dir, "t", "*.csv")).collect()], 2)
    assert [h for h, _ in heads.values()] == [["x", "y"], ["x", "y"]]
    assert sorted(spanned for _, spanned in heads.values()) == [False, True]
    rows = S.read_delimited(spark, os.path.join(tmp_dir, "t", "*.csv"), title_line=True).select("x", "y", "_file").collect()
    assert sorted(map(tuple, rows)) == [("1", "2", "long.csv"), ("3", "4", "short.csv")]


@pytest.mark.parametrize("text", ["only a title\n", 'title\n"x,y\n1,2\n'])
def test_missing_or_unfinished_header_raises_with_the_file_name(spark, tmp_dir, text):
    for name, t in (("good.csv", "title\nx,y\n1,2\n"), ("bad.csv", text)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(t)
    with pytest.raises(ValueError, match="bad.csv"):
        S.read_delimited(spark, os.path.join(tmp_dir, "*.csv"), title_line=True)
