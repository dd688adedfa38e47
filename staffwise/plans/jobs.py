"""Batch jobs composed from the operators.

Each job is a function from input paths/DataFrames to output DataFrames; the
caller writes them with :func:`staffwise.sources.sinks.write_table`.  Column
names follow the normalised extract headers (see FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import flags as FL
from ..functions.text import ascii_only
from ..operators import agg as A
from ..operators import clean as C
from ..operators import joins as J
from ..operators import ml as ML
from ..operators import reshape as R
from ..operators import rules as Q
from ..operators import windows as W
from ..operators.contract import DateSpec, apply_contract
from ..operators.diff import aligned_diff
from ..operators.hierarchy import layer_depth
from ..operators.ordering import By
from ..session import cut_lineage
from ..sources import files as S
from ..sources import json as SJ

# Typed columns of the people extracts.
LISTING_DATES = ("date_joined", "birth_date", "service_date", "position_entry_date", "confirmation_date",
                 "probation_end_date", "probation_extension_end_date", "contract_end_date", "leave_eligibility_start_date",
                 "date_left")
ID_COLUMNS = ("persno", "reporting_officer")
GROUP_IDS = ("orgunit", "personnel_subarea", "persno", "reporting_officer", "zip_code")
NO_MANAGER = "NO_MANAGER"
OFFICE_SCHEDULE = "Office Work Schedule"


def _typed_listing(df: DataFrame) -> DataFrame:
    contract = {c: DateSpec([D.DAY_FIRST]) for c in LISTING_DATES}
    contract["todays_date"] = DateSpec(D.DEFAULT_FORMATS)
    return apply_contract(df, contract)


def _group_cleaning(df: DataFrame) -> DataFrame:
    """Ids canonical; subarea trimmed and upper-cased, then managerial grades
    replaced by the pay-scale group; no manager as null; missing fund type as
    ``NA``; shift flag.  Columns the extract does not have are left out."""
    have = set(df.columns)
    df = C.canonicalise_ids(df, GROUP_IDS)
    if "personnel_subarea" in have:
        df = df.withColumn("personnel_subarea", F.upper(C.strip_ws("personnel_subarea")))
        if "pay_scale_group" in have:
            df = df.withColumn("personnel_subarea", FL.override_when_contains(
                "personnel_subarea", "pay_scale_group", "MANAGERIAL GRADE", ["Def for NA", "OTHERS"]))
    if "reporting_officer" in have:
        df = df.withColumn("reporting_officer", FL.sentinel_to_null("reporting_officer", NO_MANAGER))
    if "fund_type" in have:
        df = C.fill(df, {"fund_type": "NA"})
    if "work_schedule" in have:
        df = df.withColumn("on_shift", FL.present_and_not("work_schedule", OFFICE_SCHEDULE))
    return df


def _date_parts(df: DataFrame) -> DataFrame:
    """Month, year (as text) and fiscal label of the joining and leaving dates."""
    for c, tag in (("date_joined", "_datejoined"), ("date_left", "_dateleft")):
        if c in df.columns:
            df = df.withColumns({f"{tag}_month": F.month(c), f"{tag}_year": F.year(c).cast("string"),
                                 f"{tag}_fy": D.fiscal_label(F.month(c), F.year(c))})
    return df


def daily_listing(spark: SparkSession, headcount: str, leavers: str, ref_geo: DataFrame | None = None,
                  root_id: str | None = None, exclude: Sequence[str] = ("ml_pipeline",)) -> DataFrame:
    """B1: daily headcount files (title line + header) unioned with the latest
    leavers file; span of control and layer depth per snapshot file; latest
    join date put on every row; cleaned groups; date parts; month end; geo
    look-up by zip code.  Every listing row stays: a person listed twice in a
    file (two org units) keeps both rows, with one layer."""
    hc = C.trim_strings(S.read_delimited(spark, headcount, title_line=True, exclude=exclude))
    hc = C.null_tokens_to_null(hc)
    hc = C.canonicalise_ids(hc, ID_COLUMNS)
    hc = W.dedupe(hc, ["_file", "persno", "personnel_number", "orgunit"], [By("_row")], keep="first")
    hc = A.span_of_control(hc, "persno", "reporting_officer", by=["_file"])
    if root_id is not None:
        # the last edge of a person in a file wins; its layer goes to all of the person's rows
        edges = W.dedupe(hc.select("_file", "persno", "reporting_officer", "_row"), ["_file", "persno"], [By("_row")], keep="last")
        layer = layer_depth(edges, "persno", "reporting_officer", root_id, by=["_file"]).select(
            F.col("_file").alias("__f"), F.col("persno").alias("__p"), "layer")
        hc = hc.join(layer, hc["_file"].eqNullSafe(layer["__f"]) & hc["persno"].eqNullSafe(layer["__p"]), "left").drop("__f", "__p")
    hc = _typed_listing(hc)
    hc = W.latest_attribute(hc, "persno", "date_joined", [By("todays_date"), By("_file"), By("_row")])
    hc = hc.withColumn("active", F.lit(True))

    latest = S.latest_file(spark, leavers)
    lv = C.null_tokens_to_null(C.trim_strings(S.read_delimited(spark, latest, title_line=True)))
    lv = lv.filter(F.col("date_left").isNotNull())
    lv = W.dedupe(C.canonicalise_ids(lv, ID_COLUMNS), ["persno", "personnel_number", "date_left"], [By("_row")])
    lv = _typed_listing(lv).withColumn("active", F.lit(False))

    out = _date_parts(_group_cleaning(R.union_by_name(hc, lv)))
    out = out.withColumn("source", F.lit("SF Direct")).withColumn("eom", D.end_of_month("todays_date"))
    if ref_geo is not None:
        out = J.lookup(out, ref_geo, "zip_code", null_safe=False)
    return out


def daily_promotions(spark: SparkSession, pattern: str) -> DataFrame:
    """B1: the latest promotions file, dates typed, ids canonical, the first
    row of each (person, personnel number, start date)."""
    p = C.null_tokens_to_null(C.trim_strings(S.read_delimited(spark, S.latest_file(spark, pattern), title_line=True)))
    p = apply_contract(p, {"start_date": DateSpec(D.DEFAULT_FORMATS), "todays_date": DateSpec(D.DEFAULT_FORMATS)})
    return W.dedupe(C.canonicalise_ids(p, ["persno"]), ["persno", "personnel_number", "start_date"], [By("_row")], keep="first")


def timeoff_days(timeoff: DataFrame, key: str = "persno") -> DataFrame:
    """B2: leave records deduplicated, exploded to one row per day, with the
    gap to the previous leave day and the consecutive-day streak.

    A record with a reversed or missing range stays as one row without a day:
    no gap, streak 0."""
    t = _typed_listing(timeoff) if "startdate" not in timeoff.columns else apply_contract(
        timeoff, {"startdate": DateSpec(), "enddate": DateSpec(), "todays_date": DateSpec()})
    subset = [c for c in (key, "leave_type_code", "startdate", "enddate") if c in t.columns]
    t = W.dedupe(t, subset, [By(c) for c in t.columns if c not in subset] or [By(key)])
    days = R.explode_days(t, "startdate", "enddate", "leave_day")
    runs = W.day_runs(days.filter(F.col("leave_day").isNotNull()), key, "leave_day")
    types = {f.name: f.dataType for f in runs.schema}
    none = days.filter(F.col("leave_day").isNull()).select(
        "*", F.lit(None).cast(types["gap_days"]).alias("gap_days"), F.lit(False).alias("gap"),
        F.lit(None).cast(types["run_id"]).alias("run_id"), F.lit(0).cast(types["streak"]).alias("streak"))
    return runs.unionByName(none)


def timeoff_records(days: DataFrame, key: str = "persno") -> DataFrame:
    """B2: the last day of each leave record (person, leave type, range,
    duration) with its gap and streak."""
    subset = [c for c in (key, "leave_type_code", "startdate", "enddate", "duration_days") if c in days.columns]
    return W.dedupe(days, subset, [By("leave_day", True, False), By("streak")], keep="last")


def dependants(spark: SparkSession, pattern: str, asof: F.Column | None = None) -> DataFrame:
    """B2: the latest dependants file: rows with a relationship, first of each
    (person, relationship, first name, birth date), age in years as of a date
    (today)."""
    t = C.null_tokens_to_null(C.trim_strings(S.read_delimited(spark, S.latest_file(spark, pattern), title_line=True)))
    t = C.drop_rows_with_nulls(t, ["relationship"])
    t = apply_contract(t, {"dependent_date_of_birth": DateSpec(D.DEFAULT_FORMATS)})
    t = W.dedupe(t, ["persno", "relationship", "dependent_first_name", "dependent_date_of_birth"], [By("_row")], keep="first")
    day = asof if asof is not None else F.current_date()
    return t.withColumn("todays_date", day).withColumn("d_age", D.age_years("dependent_date_of_birth", day))


def education(spark: SparkSession, pattern: str) -> DataFrame:
    """B2: the latest education file: rows with a qualification; ``latest_qual``
    marks those attained on the person's latest date (ties all)."""
    t = C.null_tokens_to_null(C.trim_strings(S.read_delimited(spark, S.latest_file(spark, pattern), title_line=True)))
    t = apply_contract(t, {"date_attained": DateSpec(D.DEFAULT_FORMATS), "end_date": DateSpec(D.DEFAULT_FORMATS)})
    return W.equals_group_max(C.drop_rows_with_nulls(t, ["qualification"]), "persno", "date_attained", "latest_qual")


def work_passes(spark: SparkSession, pattern: str) -> DataFrame:
    """B2: the latest work-pass file: each person's pass with the latest issue date."""
    t = C.null_tokens_to_null(C.trim_strings(S.read_delimited(spark, S.latest_file(spark, pattern), title_line=True)))
    t = apply_contract(t, {c: DateSpec(D.DEFAULT_FORMATS) for c in ("expiry_date", "issue_date", "todays_date")})
    return W.latest_per_key(t, "persno", "issue_date", tie_break=["_row"])


def claims_long(spark: SparkSession, paths, id_cols: Sequence[str], groups: Mapping[str, Sequence[str]],
                date_cols: Sequence[str] = (), eom_of: str | None = None) -> DataFrame:
    """Pipe-delimited claims, dates parsed, amounts coerced to numbers and
    melted group-wise in one pass, month end of a chosen date."""
    raw = C.trim_strings(S.read_delimited(spark, paths, sep="|"))
    contract = {c: DateSpec(D.DEFAULT_FORMATS + ("dd-MM-yyyy",)) for c in date_cols}
    contract.update({c: "double" for g in groups.values() for c in g})
    typed = apply_contract(raw, contract)
    long = R.melt_groups(typed, list(id_cols) + list(date_cols), groups, "claim_item", "amount", "claim_group")
    if eom_of:
        long = long.withColumn("eom", D.end_of_month(eom_of))
    return long


# The recruitment tracker rule set:
# (label, columns that must not be blank, condition as (column, values) or None).
RECRUITMENT_RULES = (
    ("Cat A error", ("candidate_name", "date_of_application_received", "nationality", "bu", "job_grade",
                     "parent_department", "position", "source", "shortlisted_for_interview", "employment_type"), None),
    ("Cat B error", ("date_of_interview", "final_interview_outcome"), ("shortlisted_for_interview", ("YES",))),
    ("Cat C error", ("reason_why_application_is_not_shortlisted_for_interview",), ("shortlisted_for_interview", ("NO",))),
    ("Cat D error", ("date_of_interview_outcome_communication", "offer_outcome"), ("final_interview_outcome", ("SELECTED",))),
    ("Cat E error", ("reason_for_rejecting_candidate",), ("final_interview_outcome", ("REJECTED",))),
    ("Cat F error", ("date_of_candidates_acceptance_rejection", "final_status"), ("offer_outcome", ("ACCEPTED",))),
    ("Cat G error", ("date_of_candidates_acceptance_rejection", "reason_why_offer_is_rejected_by_candidate"),
     ("offer_outcome", ("REJECTED",))),
    ("Cat H error", ("join_date",), ("final_status", ("JOINED", "ACCEPTED OFFER AND PENDING TO JOIN",
                                                      "ACCEPTED OFFER AND PENDING FOR IPA/ENTRY APPROVAL",
                                                      "NO SHOW ON FIRST DAY"))),
)


def recruitment_checks(tracker: DataFrame, stamp: F.Column | None = None, zone: str = "Asia/Singapore",
                       report_by: Sequence[str] = ("tracker_source", "filename")) -> dict[str, DataFrame]:
    """Tracker text cleaned (ASCII, upper-cased), rules A-H applied, the
    error report and error list, and a load stamp.  A tracker that lacks a
    column of a rule raises: its rows could not be judged."""
    needed = {c for _, cols, cond in RECRUITMENT_RULES for c in (*cols, *([cond[0]] if cond else []))}
    if missing := sorted(needed - set(tracker.columns)):
        raise ValueError(f"the tracker lacks columns that rules need: {', '.join(missing)}")
    text = C.string_columns(tracker)
    t = tracker.select([F.upper(C.strip_ws(ascii_only(c))).alias(c) if c in text and c != "filename" else F.col(c)
                        for c in tracker.columns])
    present = set(t.columns)
    rules = [Q.Rule(label, list(cols), F.col(cond[0]).isin(list(cond[1])) if cond else None) for label, cols, cond in RECRUITMENT_RULES]
    checked = Q.apply_rules(t, rules)
    instant = stamp if stamp is not None else D.utc_now()
    checked = checked.withColumn("load_stamp", D.load_stamp(instant, zone))
    by = [c for c in report_by if c in present]
    return {
        "tracker": checked,
        "report": Q.error_report(checked, by),
        "errors": Q.error_list(checked, [c for c in ("candidate_name", "tracker_source", "filename") if c in present]),
    }


def consolidation_current(current: DataFrame, refs: Sequence[tuple[DataFrame, str, str | None]],
                          date_col: str = "todays_date", today: str | None = None) -> DataFrame:
    """Month-end snapshot of the daily listing, standardised text, chained
    reference look-ups (``(ref, left_key, right_key)``), missing gender as
    ``M``, age and tenure as of the leaving date or month end, joiner mark
    (one row of each person and joining date, whatever ties)."""
    snap = W.month_end_snapshot(current, date_col)
    snap = C.upper_strings(snap)
    for ref, lk, rk in refs:
        snap = J.lookup(snap, ref, lk, rk)
    if "gender_key" in snap.columns:
        snap = C.fill(snap, {"gender_key": "M"})
    if "eom" not in snap.columns:
        snap = snap.withColumn("eom", D.end_of_month(date_col))
    asof = F.lit(today).cast("date") if today else D.as_of("date_left", "eom")
    snap = snap.withColumn("age", D.age_years("birth_date", asof)).withColumn("tenure", D.tenure_years("date_joined", asof))
    order = [By(c) for c in ("persno", "eom", "active", "_file", "_row") if c in snap.columns]
    return W.first_occurrence_flag(snap, ["persno", "date_joined"], order, out="joiner_mark")


def consolidation_promotions(old: DataFrame, monthly: DataFrame, daily: DataFrame, date_col: str = "todays_date") -> DataFrame:
    """All promotions: the old list, tagged, the monthly ones, and the
    daily ones as listed on the last day of each month."""
    return R.union_by_name(C.tag(old, source="Old"), monthly, W.month_end_snapshot(daily, date_col))


def history_diff(history: DataFrame, current: DataFrame, flexi_values: Sequence[str] = (),
                 fields: Sequence[str] = ("orgunit", "job")) -> dict[str, DataFrame]:
    """Full history = history + current (by name), flexi flag, and the
    month-to-month change list of active staff, whole rows paired one to one
    where a person repeats, with every column of the listing as
    ``<column>_old`` and ``<column>_new``."""
    full = C.upper_strings(R.union_by_name(history, current))
    if "employee_group" in full.columns:
        full = full.withColumn("flexi", FL.in_list("employee_group", flexi_values))
    active = full.filter(F.col("active"))
    return {"listing": full, "diff": aligned_diff(active, "persno", "eom", list(fields), carry=full.columns)}


# The market rows that are compared with.
BENCHMARK_INDUSTRIES = ("food, beverages and tobacco", "air transport and supporting services", "total")


def benchmark_rates(spark: SparkSession, paths, records: str = "result.records",
                    industries: Sequence[str] = BENCHMARK_INDUSTRIES) -> DataFrame:
    """Labour-market rates from landed JSON: records flattened, columns
    with any null dropped, all occupations of the chosen industries, quarter
    split into year and quarter number, both rates as numbers and the
    resignation rate as a fraction; latest quarter first."""
    recs = C.drop_null_columns(SJ.read_records(spark, paths, records), how="any")
    out = recs.filter((F.col("occupation1") == "total") & F.col("industry3").isin(list(industries)))
    part = F.split("quarter", "-Q", 2)
    out = out.withColumns({"year": F.get(part, F.lit(0)).try_cast("int"), "q": F.get(part, F.lit(1)).try_cast("int")})
    out = out.withColumns({c: FL.to_number(c) for c in ("recruitment_rate", "resignation_rate")})
    return out.withColumn("resignation_rate", FL.scale("resignation_rate", 0.01)).orderBy(F.col("year").desc(), F.col("q").desc())


def geo_enrich(listing: DataFrame, resolver: Callable, zip_col: str = "zip_code", store: str | None = None, calls: int = 10) -> DataFrame:
    """Each distinct zip code resolved once on the executors, joined back;
    unresolved codes dropped.  With ``store``, ``resolver`` takes one code and
    its answers are kept there (:func:`staffwise.operators.joins.resolve_keys`),
    with at most ``calls`` calls at a time; a later run asks new codes only."""
    if store:
        schema = T.StructType([T.StructField(c, t) for c, t in (("lat", T.DoubleType()), ("long", T.DoubleType()),
                                                                 ("road_name", T.StringType()), ("address", T.StringType()))])
        answers = J.resolve_keys(listing, zip_col, resolver, schema, store, calls=calls)
        return listing.join(answers.filter("status = 'found'").select(F.col("key").alias(zip_col), *schema.names), zip_col)
    return J.enrich_distinct(listing, zip_col, resolver,
                             f"{zip_col} string, lat double, long double, road_name string, address string")


def attrition_models(listing: DataFrame, model_path: str | None = None, left_since: str = "2022-01-01", source: str = "SF Direct",
                     clusters: int = 4, tune: bool = True, id_col: str = "persno") -> dict[str, DataFrame]:
    """The attrition set of a listing; classifiers compared on it, the best
    one tuned, its importances, and the model saved under ``model_path`` with a
    signature (see :func:`staffwise.operators.ml.score_saved`); and the set's
    rows in ``clusters`` groups by numbers and categories, with their sizes."""
    data = cut_lineage(ML.attrition_set(listing, left_since, source, id_col), "attrition-set")
    compared, model = ML.choose_classifier(data, id_col, "active", ML.ATTRITION_CATEGORICAL, ML.ATTRITION_NUMERIC, tune=tune)
    inputs = data.select(*ML.ATTRITION_CATEGORICAL, *ML.ATTRITION_NUMERIC)
    if model_path:
        ML.save_model(model, model_path, inputs)
    grouped, centres = ML.k_prototypes(data, ML.CLUSTER_CATEGORICAL, [*ML.ATTRITION_NUMERIC, "active"], clusters)
    sizes = listing.sparkSession.createDataFrame([(c["cluster"], c["size"], float(c["cost"])) for c in centres], "cluster int, n_rows long, cost double")
    return {"set": data, "comparison": compared, "importances": ML.feature_importances(model, model.transform(data)),
            "clustered": grouped, "clusters": sizes}


def employment_pages(spark: SparkSession, paths) -> DataFrame:
    """Landed employment API pages to one flat table, ``/Date(ms)/`` parsed."""
    rows = SJ.read_pages(spark, paths)
    for c in ("startDate", "endDate"):
        if c in rows.columns:
            rows = rows.withColumn(c, D.epoch_text_to_timestamp(c))
    return rows
