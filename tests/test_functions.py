import datetime as dt

from pyspark.sql import functions as F

from staffwise.functions import dates as D
from staffwise.functions import flags as FL
from staffwise.functions import text as TX
from staffwise.functions.ids import canonical_id
from staffwise.functions.names import dedupe_names, normalise_name, normalise_value


def one_col(spark, values, t="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {t}")


def test_canonical_id_edge_rows(spark):
    vals = ["12.0", "00123", "12.5", "13.5", " 7 ", "1e3", "abc", None, "inf", "NaN"]
    got = [r[0] for r in one_col(spark, vals).select(canonical_id("x")).collect()]
    assert got == ["12", "123", "12", "14", "7", "1000", "abc", None, "inf", "NaN"]


def test_normalise_name_rules():
    assert normalise_name(" Date Joined (DD.MM)") == "date_joined_ddmm"
    assert normalise_name("Pers.No.") == "persno"
    assert normalise_name("Line\nTwo - x") == "line_two_x"
    assert normalise_name("Café/Bar") == "cafe_bar"
    assert normalise_name("a  b") == "a_b"


def test_dedupe_and_find_duplicate_names():
    assert dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    assert dedupe_names(["a", "a_1", "a"]) == ["a", "a_1", "a_2"]


def test_normalise_value_matches_name_rule(spark):
    raw = [" Date Joined (DD.MM)", "Pers.No.", "Line\nTwo - x", "a  b", "Café Fee", "CAFÉ", "Air Fee\n", "\t\x0b Air\u3000", "Ǟ ø ß İ ﬁ ½ 漢", "\xa0x\x85",
           "", " ", "a\tb", "e\u0301te", *[f"a{chr(c)}b{chr(c)}" for c in range(1, 0x250)]]
    assert normalise_name("Café Fee") == "cafe_fee" and normalise_name("Air Fee\n") == "air_fee"
    got = [r[0] for r in one_col(spark, raw).select(normalise_value("x")).collect()]
    assert got == [normalise_name(v) for v in raw]


def test_fiscal_labels_parity_and_padded(spark):
    rows = [(3, 2023), (4, 2023), (3, 2009), (5, 1999), (2, 2000), (None, 2020), (12, 2000)]
    df = spark.createDataFrame(rows, "m int, y int")
    got = [r[0] for r in df.select(D.fiscal_label("m", "y")).collect()]
    assert got == ["2223", "2324", "89", "99100", "-10", None, "01"]
    padded = [r[0] for r in df.select(D.fiscal_label("m", "y", padded=True)).collect()]
    assert padded == ["2223", "2324", "0809", "9900", "9900", None, "0001"]
    cal = df.select(D.calendar_year_from_fiscal(D.fiscal_label("m", "y", padded=True), "m")).collect()
    assert [r[0] for r in cal][:2] == ["2023", "2023"]


def test_parse_dates_edge_rows(spark):
    vals = ["31/12/2023", "2023-12-31", "31/02/2023", "", "29/02/2024", "text", None]
    df = one_col(spark, vals)
    strict = [r[0] for r in df.select(D.parse_date("x", [D.DAY_FIRST])).collect()]
    either = [r[0] for r in df.select(D.parse_date("x")).collect()]
    d = dt.date
    assert strict == [d(2023, 12, 31), None, None, None, d(2024, 2, 29), None, None]
    assert either == [d(2023, 12, 31), d(2023, 12, 31), None, None, d(2024, 2, 29), None, None]


def test_epoch_text(spark):
    df = one_col(spark, ["/Date(1704067200000)/", "/Date(-86400000)/", None, "junk"])
    got = [r[0] for r in df.select(D.epoch_text_to_timestamp("x")).collect()]
    assert got == [dt.datetime(2024, 1, 1), dt.datetime(1969, 12, 31), None, None]


def test_age_tenure_and_eom(spark):
    df = spark.createDataFrame([(dt.date(1990, 6, 15), dt.date(2020, 6, 14), None),
                                (None, dt.date(2020, 1, 31), dt.date(2021, 3, 3))],
                               "b date, eom date, left_d date")
    asof = D.as_of("left_d", "eom")
    got = df.select(D.age_years("b", asof), D.tenure_years("b", asof), D.end_of_month("left_d")).collect()
    assert got[0][0] == 29 and got[0][1] == 30.0
    assert got[1][0] == 0 and got[1][1] is None and got[1][2] == dt.date(2021, 3, 31)


def test_fill_month_start(spark):
    df = spark.createDataFrame([(None, 2023, 2), (dt.date(2023, 5, 9), 2023, 2), (None, 2023, 13)], "d date, y int, m int")
    got = [r[0] for r in df.select(D.fill_month_start("d", "y", "m")).collect()]
    assert got == [dt.date(2023, 2, 1), dt.date(2023, 5, 9), None]


def test_load_stamp_is_zone_wall_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59),)], "t timestamp_ntz")
    got = df.select(D.load_stamp(F.col("t"), "Asia/Singapore")).first()[0]
    assert got == dt.datetime(2024, 1, 2, 7, 59)


def test_text_functions(spark):
    df = one_col(spark, ["héllo wörld ✓ 你好", "a,b;c!", "no-sep", "x.y.z", "tab\tnew\nline"])
    ascii_ = [r[0] for r in df.select(TX.ascii_only("x")).collect()]
    assert ascii_[0] == "hllo wrld  "
    punct = [r[0] for r in df.select(TX.strip_punctuation("x")).collect()]
    assert punct[1] == "abc" and punct[4] == "tab\tnew\nline"
    head, rest = TX.split_first("x", ".")
    got = df.select(head, rest, TX.last_part("x", "."), TX.first_parts_joined("x", ".", 2)).collect()
    assert tuple(got[3]) == ("x", "y.z", "z", "x.y")
    assert tuple(got[2]) == ("no-sep", None, "no-sep", "no-sep")


def test_flags(spark):
    df = spark.createDataFrame([("MANAGERIAL GRADE 1", "H5"), ("MANAGERIAL GRADE 1", "Def for NA"),
                                ("MANAGERIAL GRADE 1", None), ("OTHER", "H5")], "sub string, pay string")
    got = [r[0] for r in df.select(FL.override_when_contains("sub", "pay", "MANAGERIAL GRADE",
                                                             ["Def for NA", "OTHERS"])).collect()]
    assert got == ["H5", "MANAGERIAL GRADE 1", "MANAGERIAL GRADE 1", "OTHER"]
    df2 = one_col(spark, ["A", None, "B"])
    assert [r[0] for r in df2.select(FL.present_and_not("x", "A")).collect()] == [False, False, True]
    assert [r[0] for r in df2.select(FL.in_list("x", ["A"])).collect()] == [True, False, False]
    assert [r[0] for r in one_col(spark, ["12.5", "bad", None]).select(FL.to_number("x")).collect()] == [12.5, None, None]
    assert [r[0] for r in one_col(spark, ["March", "sept", "Smarch"]).select(FL.month_number("x")).collect()] == [3, 9, None]
