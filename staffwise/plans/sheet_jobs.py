"""Jobs whose inputs arrive as spreadsheets.

They take the sheets as DataFrames: either from
:func:`staffwise.sources.workbook.read_sheets` + ``cells_to_columns`` on a
cluster with a workbook parser, or from any other reader.  Column names are
the normalised headers (:func:`staffwise.operators.clean.normalise_columns`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import flags as FL
from ..functions import text as TX
from ..functions.ids import canonical_id
from ..functions.names import normalise_value
from ..operators import agg as A
from ..operators import clean as C
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from ..operators.contract import DateSpec, apply_contract
from ..operators.ordering import By
from ..sources import files as S

# ----------------------------------------------------------------- B3 compensation


def latest_monthly_pay(spark: SparkSession, pattern: str) -> DataFrame:
    """Compensation extracts: monthly, non-zero basic pay; per file the record
    with the latest effective date per person (a null effective date counts as
    latest); month end of the extract date."""
    raw = C.trim_strings(S.read_delimited(spark, pattern, title_line=True))
    typed = apply_contract(raw, {"effective_start_date": DateSpec([D.DAY_FIRST]),
                                 "todays_date": DateSpec(D.DEFAULT_FORMATS), "total_monthly_basic": "double"})
    pay = typed.filter(F.col("total_monthly_basic").isNotNull() & (F.col("total_monthly_basic") != 0)
                       & (F.col("frequency_name") == "Monthly"))
    latest = W.latest_per_key(pay, ["_file", "persno"], "effective_start_date", null_date_wins=True, tie_break=["_row"])
    return latest.withColumn("eom", D.end_of_month("todays_date"))


def pay_duplicates(pay: DataFrame) -> DataFrame:
    """Every pay row whose (person, extract date) occurs more than once (F8)."""
    return W.duplicates_only(pay, ["persno", "todays_date"])


# Market-pay measure groups (label -> percentile columns) and id columns.
MARKET_GROUPS = {
    "c1": ["base_salary_perc25_iw", "base_salary_median_iw", "base_salary_perc75_iw"],
    "c2": ["total_guaranteed_cash_comp_perc25_iw", "total_guaranteed_cash_comp_median_iw",
           "total_guaranteed_cash_comp_perc75_iw"],
    "c3": ["total_cash_target_perc25_iw", "total_cash_target_median_iw", "total_cash_target_perc75_iw"],
    "c4": ["tdc_target_b_s_perc25_iw", "tdc_target_b_s_median_iw", "tdc_target_b_s_perc75_iw"],
}
MARKET_IDS = ["market_view", "job_title", "job_type", "job_code", "position_class"]


def market_pay_long(market: DataFrame, groups: Mapping[str, Sequence[str]] = MARKET_GROUPS) -> DataFrame:
    """Market survey rows: job title split into position and level on the first
    ``' - '``, level code = last ``.`` part of the job code, family code = first
    two parts; the four percentile groups melted in one pass with their label in
    ``measure``; values coerced to numbers."""
    cols = MARKET_IDS + [c for g in groups.values() for c in g]
    m = C.select_present(market, cols)
    position, level = TX.split_first("job_title", " - ")
    m = m.withColumns({"position": position, "job_level": level,
                       "job_level_code": TX.last_part("job_code", "."),
                       "job_family_code": TX.first_parts_joined("job_code", ".", 2)})
    present = {g: [c for c in cs if c in m.columns] for g, cs in groups.items()}
    m = m.withColumns({c: FL.to_number(F.col(c).cast("string")) for cs in present.values() for c in cs})
    ids = [c for c in MARKET_IDS if c in m.columns] + ["position", "job_level", "job_level_code", "job_family_code"]
    return R.melt_groups(m, ids, present, "var", "value", "measure")


def market_pay_summary(long: DataFrame) -> DataFrame:
    """Five-number summary of each measure group (the box plot as a table, A12)."""
    return A.five_number_summary(long, "value", ["measure"])


def salary_ranges(range_map: DataFrame, ranges: DataFrame) -> DataFrame:
    """Salary-range map and ranges, upper-cased keys, full outer merge on the range."""
    rm = C.upper_strings(range_map, [c for c in ("business", "business_unit", "salary_range") if c in range_map.columns])
    rg = C.upper_strings(ranges, ["salary_range"])
    return J.outer_merge(rm, rg, "salary_range")


def job_maps(jobs: DataFrame, families: DataFrame) -> dict[str, DataFrame]:
    """The grade workbook's job map and job-family map: names cleaned, text
    trimmed, empty rows and columns dropped."""
    return {name: C.drop_null_columns(C.drop_empty_rows(C.null_tokens_to_null(C.trim_strings(C.normalise_columns(sheet)))))
            for name, sheet in (("jobmap", jobs), ("jobfammap", families))}


# ----------------------------------------------------------------- B4 monthly non-system listing

# Sheet-name patterns (case-insensitive) of the monthly workbooks.
LEAVER_SHEETS = r"(?i)^departure$"
HEADCOUNT_SHEETS = r"(?i)^name"
PROMOTION_SHEETS = r"(?i)^prom"
NONSF_DATES = ("date_joined", "birth_date", "date_left")


def _monthly_common(df: DataFrame) -> DataFrame:
    df = C.drop_matching(df, "unnamed")
    df = C.fill(df, {"orgunit": "", "personnel_subarea": "N/A"})
    df = C.fill_from(df, "persno", "personnel_number")
    df = df.withColumns({c: canonical_id(c) for c in ("orgunit", "personnel_subarea", "persno") if c in df.columns})
    return df.withColumn("personnel_subarea", F.upper(C.strip_ws("personnel_subarea")))


def monthly_listing(sheets: DataFrame, file_col: str = "file", sheet_col: str = "sheet",
                    row_col: str = "row_no") -> dict[str, DataFrame]:
    """Leaver, headcount and promotion sheets of monthly workbooks named
    ``YYYY?MM...``.  Returns ``listing`` (headcount + leavers) and ``promotions``."""
    s = C.null_tokens_to_null(C.trim_strings(sheets), ["", " "])
    s = C.canonicalise_ids(s, ["persno", "personnel_number"])  # "12.0" and "12" are one person before deduping
    s = S.year_month_from_name(s, file_col, "_cyear", "_mth_no")
    s = apply_contract(s, {c: DateSpec([D.DAY_FIRST, D.ISO]) for c in NONSF_DATES + ("start_date",)})
    order = [By(file_col), By(sheet_col), By(row_col)]

    lv = s.filter(F.col(sheet_col).rlike(LEAVER_SHEETS))
    lv = lv.withColumn("date_left", D.fill_month_start("date_left", "_cyear", "_mth_no"))
    lv = lv.filter(F.col("persno").isNotNull())
    lv = W.dedupe(lv, ["persno", "personnel_number", "date_left"], order, keep="first")
    lv = _monthly_common(lv).withColumn("active", F.lit(False))

    hc = s.filter(F.col(sheet_col).rlike(HEADCOUNT_SHEETS))
    hc = W.dedupe(hc, [file_col, sheet_col, "persno", "personnel_number"], order, keep="last")
    hc = _monthly_common(C.drop_empty_rows(hc)).withColumn("active", F.lit(True))

    both = R.union_by_name(hc, lv).withColumn("source", F.lit("Non-SF ETL"))
    if "company_code" in both.columns:
        both = both.withColumn("orgunit", F.col("company_code"))  # the org unit is the company code here
    both = both.withColumns({"_fyear": D.fiscal_label("_mth_no", "_cyear"),
                             "eom": D.end_of_month(D.fill_month_start(F.lit(None), "_cyear", "_mth_no"))})
    both = W.latest_attribute(both, "persno", "date_joined", [By("eom"), By(file_col), By(row_col)])
    for c, tag in (("date_left", "_dateleft"), ("date_joined", "_datejoined")):
        both = both.withColumns({f"{tag}_month": F.month(c), f"{tag}_year": F.year(c).cast("string")})
        both = both.withColumn(f"{tag}_fy", D.fiscal_label(f"{tag}_month", f"{tag}_year"))

    pr = s.filter(F.col(sheet_col).rlike(PROMOTION_SHEETS))
    pr = C.drop_matching(C.drop_empty_rows(pr), "unnamed|retirement|hourly")
    pr = W.dedupe(pr, ["persno", "personnel_number", "start_date"], order, keep="first")
    return {"listing": both, "promotions": pr}


# ----------------------------------------------------------------- B5 travel fees


def travel_fees_long(trips: DataFrame, id_cols: Sequence[str], fee_cols: Sequence[str]) -> DataFrame:
    """Itinerary origin and last leg, one-way flag (last leg equals the
    sector; null when either is null), fees melted to long with nulls as 0."""
    t = trips.withColumns({"itinerary_last3": TX.last_part("itinerary", "/"),
                           "origin": TX.first_part("itinerary", "/")})
    t = t.withColumn("one_way", FL.equal_flag("itinerary_last3", "sector"))
    ids = [c for c in id_cols if c in t.columns] + ["itinerary_last3", "origin", "one_way"]
    long = R.melt(t, ids, [c for c in fee_cols if c in t.columns], "fees", "fee_amount")
    return C.fill(long, {"fee_amount": 0.0})


def fee_reference(ref: DataFrame, name_col: str = "name") -> DataFrame:
    """Fee names normalised the way column names are, so they join to the
    melted ``fees`` values (P20)."""
    return ref.select(normalise_value(name_col).alias("fees"))


def credit_notes(notes: DataFrame, file_col: str = "file") -> DataFrame:
    """Credit-note sheets of all files: names cleaned, text trimmed, empty rows
    and columns dropped, with the name of the file they came from."""
    n = C.null_tokens_to_null(C.trim_strings(C.normalise_columns(notes)))
    data = [c for c in n.columns if c != file_col]
    n = n.filter(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in data]).isNotNull())
    return C.drop_null_columns(n).withColumnRenamed(file_col, "filename")


# ----------------------------------------------------------------- B8 reference dimensions

# Organisation-structure column renames.
ORG_RENAMES = {"bu": "business_unit", "orgunit_name": "organizational_unit", "costcenter_externalcode": "costcenter",
               "costcenter_label": "costcenter_name", "parentdepartment_label": "parent_department"}
ORG_COLUMNS = ["bu", "orgunit", "orgunit_name", "costcenter_externalcode", "costcenter_label", "parent_department",
               "effectivestatus"]


def reference_dimensions(org: DataFrame, company: DataFrame, grade: DataFrame, bu: DataFrame, jobgroup: DataFrame,
                         attrition: DataFrame) -> dict[str, DataFrame]:
    """Reference tables standardised (upper case, renames, fills,
    placeholders) and the business-unit table overlaid with the current
    organisation structure (J10)."""
    o = C.rename(C.select_present(org, ORG_COLUMNS), ORG_RENAMES)
    o = C.upper_strings(C.fill_from(o, "parent_department", "business_unit"))
    comp = C.upper_strings(C.rename(company, {"company_id": "company_code"}))
    b = C.upper_strings(bu)
    b = C.fill_from(b, "parent_department", "business_unit")
    b = C.add_placeholders(b, {"costcenter": "string", "costcenter_name": "string", "effectivestatus": "string"})
    b = J.overlay_update(b, o, "orgunit")
    g = C.upper_strings(grade)
    if "estab_grade_sort" in g.columns:
        g = g.withColumn("estab_grade_sort", F.coalesce(F.col("estab_grade_sort"), F.lit(0).cast(g.schema["estab_grade_sort"].dataType)))
    return {"company": comp, "grade": g, "bu": b,
            "jobgroup": C.upper_strings(jobgroup, ["job"]),
            "attrition": C.upper_strings(attrition, ["attrition_reason"])}
