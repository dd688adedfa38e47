import datetime as dt

from pyspark.sql import functions as F

from staffwise.plans import sheet_jobs as SJ

d = dt.date


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_compensation_latest_pay(spark, tmp_dir):
    head = "Comp extract\nPersNo,Frequency Name,Total Monthly Basic,Effective Start Date,Todays Date\n"
    write(f"{tmp_dir}/a_compensation.csv", head + "1,Monthly,100,01/01/2023,31/01/2024\n1,Monthly,200,01/06/2023,31/01/2024\n"
          "2,Monthly,0,01/01/2023,31/01/2024\n3,Annual,900,01/01/2023,31/01/2024\n4,Monthly,50,,31/01/2024\n"
          "4,Monthly,60,01/01/2023,31/01/2024\n")
    pay = SJ.latest_monthly_pay(spark, f"{tmp_dir}/*compensation.csv")
    got = sorted((r["persno"], r["total_monthly_basic"], r["eom"]) for r in pay.collect())
    assert got == [("1", 200.0, d(2024, 1, 31)), ("4", 50.0, d(2024, 1, 31))]
    assert SJ.pay_duplicates(pay).count() == 0


def test_market_pay_long_and_summary(spark):
    cols = SJ.MARKET_IDS + [c for g in SJ.MARKET_GROUPS.values() for c in g]
    row1 = ["SG", "Accounting - Manager", "T", "FIN.ACC.M3", "P"] + [str(10 * i) for i in range(12)]
    row2 = ["SG", "Audit", "T", "FIN.AUD.P1", "P"] + ["n/a"] + [str(i) for i in range(11)]
    market = spark.createDataFrame([row1, row2], ", ".join(f"{c} string" for c in cols))
    long = SJ.market_pay_long(market)
    assert long.count() == 24
    r = long.filter((F.col("job_code") == "FIN.ACC.M3") & (F.col("var") == "base_salary_perc25_iw")).first()
    assert (r["position"], r["job_level"], r["job_level_code"], r["job_family_code"], r["measure"], r["value"]) == \
        ("Accounting", "Manager", "M3", "FIN.ACC", "c1", 0.0)
    assert long.filter(F.col("value").isNull()).count() == 1
    summary = {r["measure"]: r for r in SJ.market_pay_summary(long).collect()}
    assert summary["c1"]["n"] == 5 and summary["c4"]["max"] == 110.0


def test_salary_ranges_outer(spark):
    m = spark.createDataFrame([("a", "bu1", "r1"), ("b", "bu2", "r9")], "business string, business_unit string, salary_range string")
    r = spark.createDataFrame([("R1", 1.0), ("R2", 2.0)], "salary_range string, low double")
    got = sorted(SJ.salary_ranges(m, r).collect(), key=lambda x: x["salary_range"])
    assert [(x["salary_range"], x["business"], x["low"]) for x in got] == [("R1", "A", 1.0), ("R2", None, 2.0), ("R9", "B", None)]


def test_monthly_listing(spark):
    cols = "file string, sheet string, row_no long, persno string, personnel_number string, orgunit string, " \
           "company_code string, personnel_subarea string, date_joined string, birth_date string, date_left string, " \
           "unnamed_1 string, start_date string, hourly_rate string"
    rows = [
        ("2024-01 monthly.xlsx", "Names Jan", 0, "1.0", "P1", None, "C1", " grade a ", "01/02/2020", "", None, "x", None, None),
        ("2024-01 monthly.xlsx", "Names Jan", 1, "1", "P1", None, "C1", "grade b", "", "", None, "y", None, None),
        ("2024-01 monthly.xlsx", "Departure", 0, "2", "P2", "12.0", "C2", None, "01/01/2019", "", None, None, None, None),
        ("2024-01 monthly.xlsx", "Departure", 1, None, "P3", None, "C2", None, None, None, None, None, None, None),
        ("2024-02 monthly.xlsx", "Names Feb", 0, None, "P4", None, "C1", "staff", "03/03/2021", "", None, None, None, None),
        ("2024-02 monthly.xlsx", "Names Feb", 1, "1", "P1", None, "C1", "grade b", "05/05/2022", "", None, None, None, None),
        ("2024-02 monthly.xlsx", "Promotions", 0, "1", "P1", None, None, None, None, None, None, None, "01/02/2024", "5"),
        ("2024-02 monthly.xlsx", "Promotions", 1, "1", "P1", None, None, None, None, None, None, None, "01/02/2024", "6"),
        ("2024-02 monthly.xlsx", "Departures old", 0, "9", "P9", None, None, None, None, None, None, None, None, None)]
    out = SJ.monthly_listing(spark.createDataFrame(rows, cols))
    listing = {(r["persno"], r["eom"]): r for r in out["listing"].collect()}
    assert set(listing) == {("1", d(2024, 1, 31)), ("2", d(2024, 1, 31)), ("P4", d(2024, 2, 29)), ("1", d(2024, 2, 29))}
    jan = listing[("1", d(2024, 1, 31))]
    assert jan["personnel_subarea"] == "GRADE B" and jan["orgunit"] == "C1" and jan["_fyear"] == "2324"
    assert jan["date_joined"] == d(2022, 5, 5)  # latest join date put on every row
    lv = listing[("2", d(2024, 1, 31))]
    assert lv["active"] is False and lv["date_left"] == d(2024, 1, 1) and lv["_dateleft_fy"] == "2324"
    assert "unnamed_1" not in out["listing"].columns
    promo = out["promotions"]
    assert promo.count() == 1 and "hourly_rate" not in promo.columns


def test_travel_fees(spark):
    trips = spark.createDataFrame([("I1", "SIN/HKG/SIN", "SIN", 10.0, None), ("I2", "SIN/NRT", "SIN", None, 3.0)],
                                  "invoice_no string, itinerary string, sector string, air_amount double, visa_fee double")
    long = SJ.travel_fees_long(trips, ["invoice_no"], ["air_amount", "visa_fee"])
    assert long.count() == 4 and long.agg(F.sum("fee_amount")).first()[0] == 13.0
    flags = {r["invoice_no"]: (r["origin"], r["itinerary_last3"], r["one_way"]) for r in long.collect()}
    assert flags == {"I1": ("SIN", "SIN", True), "I2": ("SIN", "NRT", False)}
    ref = spark.createDataFrame([("Air Amount",), ("Visa-Fee",)], "name string")
    assert sorted(r[0] for r in SJ.fee_reference(ref).collect()) == ["air_amount", "visa_fee"]


def test_reference_dimensions(spark):
    org = spark.createDataFrame([("bu x", "ou1", "Org One", "cc1", "Cost 1", None, "A")],
                                "bu string, orgunit string, orgunit_name string, costcenter_externalcode string, "
                                "costcenter_label string, parent_department string, effectivestatus string")
    company = spark.createDataFrame([(" c1 ",)], "company_id string")
    grade = spark.createDataFrame([("m1", None), ("s1", 2)], "personnel_subarea string, estab_grade_sort int")
    bu = spark.createDataFrame([("ou1", "old bu", None, "Old"), ("OU2", "bu2", None, "Two")],
                               "orgunit string, business_unit string, parent_department string, organizational_unit string")
    job = spark.createDataFrame([(" eng ",)], "job string")
    attr = spark.createDataFrame([("resigned",)], "attrition_reason string")
    out = SJ.reference_dimensions(org, company, grade, bu, job, attr)
    b = {r["orgunit"]: r for r in out["bu"].collect()}
    assert b["OU1"]["business_unit"] == "BU X" and b["OU1"]["costcenter"] == "CC1" and b["OU1"]["parent_department"] == "BU X"
    assert b["OU2"]["parent_department"] == "BU2" and b["OU2"]["costcenter"] is None
    assert out["company"].first()["company_code"] == "C1"
    assert sorted(r["estab_grade_sort"] for r in out["grade"].collect()) == [0, 2]
    assert out["jobgroup"].first()[0] == "ENG" and out["attrition"].first()[0] == "RESIGNED"


def test_job_maps_and_credit_notes(spark):
    from staffwise.plans import sheet_jobs as SH

    sheet = spark.createDataFrame([(" A1 ", "x", None), (None, "", None)], "`Job Code` string, `Job (Title)` string, empty string")
    maps = SH.job_maps(sheet, sheet)
    assert [tuple(r) for r in maps["jobmap"].collect()] == [("A1", "x")] and maps["jobfammap"].columns == ["job_code", "job_title"]
    notes = spark.createDataFrame([("f1.xlsx", " 12 ", None), ("f2.xlsx", None, None)], "file string, `Credit Note No.` string, Void string")
    got = SH.credit_notes(notes)
    assert got.columns == ["filename", "credit_note_no"] and [tuple(r) for r in got.collect()] == [("f1.xlsx", "12")]
