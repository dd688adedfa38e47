"""Driver queries: each operator of the inventory applied to the driver's
star-schema tables.  Every function takes ``(spark, sf_dir)`` and returns a
lazy DataFrame over the whole tables; the SQL twin of each lives in
:mod:`staffwise.plans.oracle_sql` under the same name.

Mapping used throughout: an order is a person-snapshot row (person =
``o_custkey``, snapshot date = ``o_orderdate``); customers form the
reporting tree (manager = ``c_custkey // 3``).  Null values are injected
by value rules (never by dropping rows) where an operator needs them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import flags as FL
from ..functions import text as TX
from ..functions.ids import canonical_id
from ..functions.names import normalise_name, normalise_value
from ..operators import agg as A
from ..operators import clean as C
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import rules as Q
from ..operators import windows as W
from ..operators.contract import DateSpec, all_strings, apply_contract, inferred_types
from ..operators.diff import aligned_diff, snapshot_diff
from ..operators.hierarchy import layer_depth
from ..operators.ordering import By
from ..session import scratch_path
from ..sources.delimited import load_delimited
from ..sources.json import page_chains, read_pages, read_records
from ..sources.tables import parquet_table


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return parquet_table(spark, sf, name)


def _orders(spark, sf):
    return _t(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


# ---------------------------------------------------------------- snapshots


def month_end_snapshot(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return W.month_end_snapshot(o, "o_orderdate")


def headcount_by_month(spark, sf):
    o = _orders(spark, sf).select("o_custkey", D.end_of_month("o_orderdate").alias("eom"), "o_orderstatus")
    return A.headcount(o, "o_custkey", ["eom", "o_orderstatus"])


def snapshot_consolidation(spark, sf):
    """Flagship slice: month-end snapshots, closed and open slices tagged by
    source (the open slice carries no price), standardised text, chained
    reference look-ups, tenure since the first order, joiner mark, headcount
    by month x region x source.

    Both slices come from one table, so they are one projection of one scan
    (the union-by-name of different extracts is ``union_by_name_missing``).
    The joiner mark uses the skew-safe aggregate form: month-end keeps every row
    on a month's last date, so a customer's rows are not bounded by the number
    of snapshots, and a window would put a hot customer in one task.
    """
    orders = _orders(spark, sf)
    snap = W.month_end_snapshot(
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"),
        "o_orderdate")
    closed = F.col("o_orderstatus") == "F"
    listing = snap.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
                          F.when(closed, F.col("o_totalprice")).alias("o_totalprice"),
                          F.when(closed, F.lit("closed")).otherwise(F.lit("open")).alias("src"))
    listing = C.upper_strings(listing, ["o_orderpriority"]).withColumn("eom", D.end_of_month("o_orderdate"))
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _t(spark, sf, "region").select("r_regionkey", "r_name")
    x = J.lookup(listing, cust, "o_custkey", "c_custkey")  # grows with the data: the planner decides
    x = J.lookup(x, nation, "c_nationkey", "n_nationkey", broadcast=True)  # fixed-size dimensions
    x = J.lookup(x, region, "n_regionkey", "r_regionkey", broadcast=True)
    x = J.lookup(x, first, "o_custkey", null_safe=False)
    x = x.withColumn("tenure", D.tenure_years("first_date", F.col("eom")))
    x = W.first_occurrence_flag(x, ["o_custkey"], [By("eom"), By("o_orderkey")], out="joiner_mark", unique_order=True)
    return (x.groupBy("eom", "r_name", "src")
            .agg(F.count_distinct("o_custkey").alias("headcount"),
                 F.sum(F.col("joiner_mark").cast("int")).alias("joiners"),
                 F.round(F.avg("tenure"), 4).alias("avg_tenure")))


def current_snapshot(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    return W.current_snapshot(o, "o_orderdate")


def first_snapshot_rows(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    return J.first_snapshot_rows(o, "o_custkey", "o_orderdate")


def latest_two_slices(spark, sf):
    o = _orders(spark, sf)
    cur = W.current_snapshot(o, "o_orderdate").select("o_custkey", "o_orderstatus")
    mx = o.select(F.max("o_orderdate")).scalar()
    recent = (o.filter((F.col("o_orderdate") >= F.date_sub(mx, 90)) & (F.col("o_orderstatus") == "F"))
              .select("o_custkey", "o_orderstatus"))
    return R.union_distinct(cur, recent)


# ---------------------------------------------------------------- aggregates


def distinct_all_columns(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                       "o_orderpriority")
    return A.distinct_counts(o, by=["o_orderpriority"])


def value_counts_desc(spark, sf):
    return A.value_counts(_t(spark, sf, "part"), "p_brand", out="n")


def five_number_summary(spark, sf):
    s = A.five_number_summary(_t(spark, sf, "lineitem"), "l_extendedprice", by=["l_returnflag"])
    return s.select("l_returnflag", "n", *[F.round(c, 4).alias(c) for c in ("min", "q1", "median", "q3", "max")])


def _nulled_customer(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.nullif(F.col("c_name"), F.lit("")).alias("c_name"),
        F.when(F.col("c_nationkey") != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("c_mktsegment"),
    )


def null_profile(spark, sf):
    return A.null_profile(_nulled_customer(spark, sf))


def scalar_aggs(spark, sf):
    o = _orders(spark, sf)
    f = o.filter(F.col("o_orderdate").between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date")))
    return f.agg(
        F.count_distinct("o_custkey").alias("n_customers"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.round(F.avg("o_totalprice"), 4).alias("mean_total"),
        F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("n_closed"),
        F.max("o_orderdate").alias("last_date"),
        F.min("o_orderdate").alias("first_date"),
    )


def grouped_aggs(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("ship", F.when(F.col("l_linenumber") != 2, F.to_date("l_shipdate")))
    return li.groupBy("l_returnflag").agg(
        F.count("ship").alias("n_shipped"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.min("ship").alias("first_ship"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
    )


def distinct_pairs(spark, sf):
    return _t(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


def top_n_sorted(spark, sf):
    return (_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10))


def sample_rows(spark, sf):
    """A random sample of 200 orders, summed up: its size, distinct orders, and
    how many of them are orders of the table."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    s = A.sample_n(o, 200)
    known = s.join(o.withColumnRenamed("o_custkey", "k_custkey"), "o_orderkey").filter(F.col("o_custkey").eqNullSafe(F.col("k_custkey")))
    return (s.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"))
            .crossJoin(known.agg(F.count(F.lit(1)).alias("n_known"))))  # one row each


# ---------------------------------------------------------------- scalar functions


def canonical_ids(spark, sf):
    p = _t(spark, sf, "part")
    k = F.col("p_partkey").cast("string")
    raw = (F.when(F.col("p_partkey") % 5 == 0, F.lpad(k, 6, "0"))
           .when(F.col("p_partkey") % 5 == 1, F.concat(k, F.lit(".0")))
           .when(F.col("p_partkey") % 5 == 2, F.concat(k, F.lit(".5")))
           .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit(" "), k, F.lit(" ")))
           .when(F.col("p_partkey") % 25 == 4, F.concat((F.lit(2**53 + 1) + F.col("p_partkey")).cast("string"), F.lit(".0")))
           .otherwise(F.col("p_name")))
    return p.select("p_partkey", raw.alias("raw")).withColumn("canonical", canonical_id("raw"))


def fiscal_label(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", D.fiscal_label(F.month("o_orderdate"), F.year("o_orderdate")).alias("fy"))


def fiscal_label_padded(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey",
                    D.fiscal_label(F.month("o_orderdate"), F.year("o_orderdate"), padded=True).alias("fy"))


def calendar_from_fiscal(spark, sf):
    o = _orders(spark, sf)
    m = F.month("o_orderdate")
    fy = D.fiscal_label(m, F.year("o_orderdate"), padded=True)
    return o.select("o_orderkey", fy.alias("fy"), D.calendar_year_from_fiscal(fy, m).alias("cal_year"))


def age_tenure(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _orders(spark, sf).select("o_orderkey", "o_orderdate")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    left = F.when(F.col("l_linenumber") != 1, F.to_date("l_shipdate"))
    asof = D.as_of(left, F.lit("2002-12-31").cast("date"))
    return x.select("l_orderkey", "l_linenumber",
                    D.age_years("o_orderdate", asof).alias("age"),
                    D.tenure_years("o_orderdate", asof).alias("tenure"))


def eom_makedate_fill(spark, sf):
    o = _orders(spark, sf)
    d = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate"))
    filled = D.fill_month_start(d, F.year("o_orderdate"), F.month("o_orderdate"))
    return o.select("o_orderkey", filled.alias("filled"), D.end_of_month(filled).alias("eom"))


def _date_texts(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey") % 4
    raw = (F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
           .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(k == 2, F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
           .otherwise(F.lit("not a date")))
    return o.select("o_orderkey", raw.alias("raw"))


def parse_dates_multi(spark, sf):
    t = _date_texts(spark, sf)
    return t.select("o_orderkey", "raw",
                    D.parse_date("raw", [D.DAY_FIRST]).alias("strict"),
                    D.parse_date("raw").alias("either"))


def epoch_text_parse(spark, sf):
    e = _t(spark, sf, "events").select("event_id")
    ms = F.lit(946684800000) + F.col("event_id") * F.lit(3600123)
    raw = F.concat(F.lit("/Date("), ms.cast("string"), F.lit(")/"))
    return e.select("event_id", raw.alias("raw")).withColumn("parsed", D.epoch_text_to_timestamp("raw"))


def date_parts(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", F.month("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"),
                    D.month_start("o_orderdate").alias("month_start"),
                    D.day_diff(D.end_of_month("o_orderdate"), "o_orderdate").alias("days_to_eom"))


def load_stamp(spark, sf):
    o = _t(spark, sf, "orders")
    instant = F.timestamp_add("SECOND", F.col("o_orderkey") * 37, F.col("o_orderdate"))
    return o.select("o_orderkey", D.load_stamp(instant, "Asia/Singapore").alias("stamp"))


def ascii_strip(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", TX.ascii_only("text").alias("t"))
    return d.select("doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("md5"))


def punct_strip(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", TX.strip_punctuation("text").alias("t"))
    return d.select("doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("md5"))


def split_parts(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", "url")
    head, query = TX.split_first("url", "?")
    host = F.get(F.split("url", "/"), 2)
    return p.select(
        "page_id", head.alias("head"), query.alias("query"),
        TX.last_part("url", "/").alias("last_seg"),
        TX.first_parts_joined(host, ".", 2).alias("host2"),
        *TX.split_to_columns(host, ".", ["h1", "h2", "h3", "h4"]),
    )


def text_extract(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.substring("c_name", 1, 8).alias("prefix8"),
        F.col("c_name").contains("#00000").alias("has_zeros"),
        F.regexp_extract("c_name", r"#0*(\d+)", 1).alias("num"),
        F.regexp_replace("c_name", "#", "-").alias("dashed"),
        TX.append_text(F.col("c_name"), F.concat(F.lit("/"), F.col("c_mktsegment"))).alias("appended"),
    )


def name_normaliser(spark, sf):
    p = _t(spark, sf, "part")
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(").Type-"), F.col("p_brand"))
    return p.select("p_partkey", normalise_value(raw).alias("norm"))


def conditional_grade(spark, sf):
    p = _t(spark, sf, "part")
    return p.select(
        "p_partkey",
        FL.override_when_contains("p_name", "p_brand", "ring", unusable=["Brand#1"]).alias("grade"),
        FL.present_and_not("p_size", 10).alias("on_shift"),
        FL.in_list("p_type", ["ECONOMY", "SMALL"]).alias("flexi"),
        FL.in_list("p_brand", ["Brand#2", "Brand#4"]).alias("local_flag"),
        FL.sentinel_to_null("p_size", 1).alias("size_or_null"),
    )


def percent_numeric_coerce(spark, sf):
    li = _t(spark, sf, "lineitem")
    raw = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    x = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return x.withColumn("frac", F.round(FL.scale(FL.to_number("raw"), 0.01), 4))


def derived_flags(spark, sf):
    li = _t(spark, sf, "lineitem")
    ship = F.when(F.col("l_linenumber") != 1, F.col("l_shipdate"))
    rf = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return li.select("l_orderkey", "l_linenumber",
                     FL.is_present(ship).alias("left_flag"),
                     FL.equal_flag(rf, F.col("l_linestatus")).alias("one_way"),
                     FL.bool_to_int(F.col("l_linestatus") == "F").alias("is_f"))


def dict_mapping(spark, sf):
    o = _orders(spark, sf)
    name = F.when(F.col("o_orderstatus") == "P", F.lit("Smarch")).otherwise(F.date_format("o_orderdate", "MMMM"))
    return o.select("o_orderkey", name.alias("month_name")).withColumn("month_no", FL.month_number("month_name"))


def contract_typing(spark, sf):
    li = _t(spark, sf, "lineitem")
    raw = all_strings(li.select(
        "l_orderkey",
        F.when(F.col("l_linenumber") == 4, F.lit("x")).otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("qty"),
        F.when(F.col("l_linenumber") == 5, F.lit("31/02/1999")).otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("ship"),
        F.when(F.col("l_linenumber") == 6, F.lit("yes")).otherwise(F.lit("FALSE")).alias("flag"),
        "l_linenumber",
        F.when(F.col("l_linenumber") == 3, F.lit("12.7")).otherwise(F.concat((F.lit(2**53 + 1) + F.col("l_orderkey")).cast("string"), F.lit(".00"))).alias("big"),
    ))
    typed = apply_contract(raw, {"l_orderkey": "bigint", "qty": "double", "big": "bigint", "ship": DateSpec(["dd/MM/yyyy"]),
                                 "flag": "boolean", "l_linenumber": "int", "missing_col": "string"})
    return typed.withColumn("half_qty", F.bround(F.col("qty") / 2, 0))


def filter_mix(spark, sf):
    o = _orders(spark, sf)
    cond = ((F.col("o_orderstatus") != "P")
            & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
            & F.col("o_orderdate").between(F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
            & F.col("o_totalprice").isNotNull()) | (F.col("o_orderpriority").like("%SPECIFIED") & (F.col("o_totalprice") > 400000))
    return o.filter(cond).select("o_orderkey", "o_orderstatus", "o_orderpriority")


# ---------------------------------------------------------------- joins


def left_lookup_chain(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"),
                                         F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("nk"))
    n = _t(spark, sf, "nation").select(F.when(F.col("n_nationkey") != 24, F.col("n_nationkey")).alias("nk"),
                                       F.col("n_name").alias("name"), "n_regionkey")
    r = _t(spark, sf, "region")
    x = J.lookup(c, n, "nk", on_duplicate="error")
    return J.lookup(x, r, "n_regionkey", "r_regionkey")


def outer_merge(spark, sf):
    s = _t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_sup"))
    n = _t(spark, sf, "nation").select((F.col("n_nationkey") + 10).alias("k"), "n_name")
    return J.outer_merge(s, n, "k")


def overlay_update(spark, sf):
    """Updates of parts, some moved to other keys; beyond a million parts a moved
    update meets one of the part there, and both apply, a row each."""
    p = _t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    upd = _t(spark, sf, "part").filter(F.col("p_size") > 45).select(
        F.when(F.col("p_size") == 50, F.col("p_partkey") + 1000000).otherwise(F.col("p_partkey")).alias("p_partkey"),
        F.concat(F.lit("Brand#X"), F.col("p_size").cast("string")).alias("p_brand"),
        F.lit(None).cast("double").alias("p_retailprice"),
        F.lit("ignored").alias("extra"))
    return J.overlay_update(p, upd, "p_partkey", on_duplicate="expand")


def two_key_left_join(spark, sf):
    o = _orders(spark, sf).withColumn("eom", D.end_of_month("o_orderdate"))
    pay = o.groupBy("o_custkey", "eom").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    listing = o.filter(F.col("o_orderstatus") == "F").select("o_custkey", "eom").distinct()
    return listing.join(pay, ["o_custkey", "eom"], "left")


def detail_left_fanout(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left").select("o_orderkey", "l_linenumber", "o_totalprice")


def _zone_resolver(pdf):
    """Stand-in resolver: nation key -> zone label; keys divisible by 5 are unresolved."""
    import pandas as pd

    k = pdf["c_nationkey"]
    zone = ("zone-" + (k % 7).astype(str)).where(k % 5 != 0, None)
    return pd.DataFrame({"c_nationkey": k, "zone": zone})


def distinct_key_enrich(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.enrich_distinct(c, "c_nationkey", _zone_resolver, "c_nationkey int, zone string")


# ---------------------------------------------------------------- windows


def _nulled_priority_orders(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                    F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("prio"))


def latest_attribute(spark, sf):
    o = _nulled_priority_orders(spark, sf)
    x = W.latest_attribute(o, "o_custkey", "prio", [By("o_orderdate"), By("o_orderkey")], out="latest_prio")
    return x.select("o_orderkey", "o_custkey", "latest_prio")


def dedupe_first(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return W.dedupe(o, ["o_custkey", "o_orderstatus"], [By("o_orderdate"), By("o_orderkey")], keep="first")


def dedupe_last(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return W.dedupe(o, ["o_custkey", "o_orderstatus"], [By("o_orderdate"), By("o_orderkey")], keep="last")


def duplicates_only(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    return W.duplicates_only(o, ["o_custkey", "o_orderdate"])


def latest_per_key_nulls(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 2, F.to_date("l_shipdate")).alias("d"))
    pass_ = W.latest_per_key(li, "l_orderkey", "d", null_date_wins=False, tie_break=["l_linenumber"])
    pay = W.latest_per_key(li, "l_orderkey", "d", null_date_wins=True, tie_break=["l_linenumber"])
    return C.tag(pass_, variant="pass").unionByName(C.tag(pay, variant="pay"))


VALUE_HEADERS = ["Café Fee", "Prämie (Netto)", "Año - Salario", "Date Joined: DD.MM", "Employee's Grade", "Überstunden/Std"]


def value_name_join(spark, sf):
    """Values written like headers (case, blanks, tabs and line ends vary) join
    to the cleaned names of those headers."""
    header = F.element_at(F.array(*[F.lit(h) for h in VALUE_HEADERS]), (F.col("c_custkey") % len(VALUE_HEADERS) + 1).cast("int"))
    raw = (F.when(F.col("c_custkey") % 4 == 0, F.upper(header)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("\t "), header))
           .when(F.col("c_custkey") % 4 == 2, F.concat(header, F.lit(" \r\n"))).otherwise(header))
    names = spark.createDataFrame([(normalise_name(h), i) for i, h in enumerate(VALUE_HEADERS)], "name string, header_no int")
    values = _t(spark, sf, "customer").select("c_custkey", normalise_value(raw).alias("name"))
    return values.join(F.broadcast(names), "name").groupBy("name", "header_no").agg(F.count(F.lit(1)).alias("n"))


def joiner_mark(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    x = W.first_occurrence_flag(o, ["o_custkey", "o_orderpriority"], [By("o_orderdate"), By("o_orderkey")],
                                out="joiner_mark", unique_order=True)
    return x.select("o_orderkey", "joiner_mark")


def joiner_mark_ties(spark, sf):
    """Marks per group where the order ties: all orders of a month do."""
    o = _orders(spark, sf).select("o_orderstatus", D.end_of_month("o_orderdate").alias("eom"))
    x = W.first_occurrence_flag(o, ["o_orderstatus"], [By("eom")], out="mark")
    return x.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("mark").cast("long")).alias("n_marks"),
                                          F.min(F.when(F.col("mark"), F.col("eom"))).alias("marked_month"))


def equals_group_max(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return W.equals_group_max(o, "o_custkey", "o_totalprice", "is_max").select("o_orderkey", "is_max")


def dayrange_explode(spark, sf):
    o = _orders(spark, sf)
    x = o.select("o_orderkey", F.col("o_orderdate").alias("s"),
                 F.date_add("o_orderdate", (F.col("o_orderkey") % 5 - 1).cast("int")).alias("e"))
    return R.explode_days(x, "s", "e", "day").select("o_orderkey", "day")


def gaps_islands(spark, sf):
    e = _t(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    return W.distinct_day_runs(e, "user_id", "day")


def timeoff_runs(spark, sf):
    """The time-off job (B2) on leave records derived from orders: person =
    customer, leave type = priority, leave from the order date for
    ``o_orderkey % 4`` more days.  Dedupe, day explosion, gaps, islands, streaks."""
    from .jobs import timeoff_days

    o = _orders(spark, sf)
    leave = o.select(F.col("o_custkey").alias("persno"), F.col("o_orderpriority").alias("leave_type_code"),
                     F.col("o_orderdate").alias("startdate"),
                     F.date_add("o_orderdate", (F.col("o_orderkey") % 4).cast("int")).alias("enddate"))
    return timeoff_days(leave)


# ---------------------------------------------------------------- reshape


_MONEY = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]


def unpivot_single(spark, sf):
    li = _t(spark, sf, "lineitem")
    return R.melt(li, ["l_orderkey", "l_linenumber"], _MONEY, "measure", "amount")


def unpivot_groups(spark, sf):
    """Grouped melt; the melted names are normalised once per name (the value
    set of ``measure`` is the column list), not once per row."""
    li = _t(spark, sf, "lineitem")
    groups = {"price": ["l_extendedprice"], "rates": ["l_discount", "l_tax"], "volume": ["l_quantity"]}
    long = R.melt_groups(li, ["l_orderkey", "l_linenumber"], groups, "measure", "amount", "grp")
    names = {c: normalise_name(re.sub(r"^l_", "L ", c)) for cs in groups.values() for c in cs}
    return long.withColumn("measure", FL.map_values("measure", names))


def union_by_name_missing(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                         F.col("c_nationkey").alias("nation"))
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                         F.col("s_acctbal").alias("bal"))
    return R.union_by_name(c, s)


# ---------------------------------------------------------------- hierarchy / diff


# The two customer keys made to manage each other (a cycle).
CYCLE = (100, 101)


def _tree(spark, sf):
    """Reporting tree over all customers: manager = key // 3, root 0, orphans
    (manager outside the table) for nation 7 BUILDING customers, and a cycle."""
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    mgr = (F.when(k == 0, F.lit(None))
           .when((F.col("c_nationkey") == 7) & (F.col("c_mktsegment") == "BUILDING"), k + 1000000)
           .when(k == CYCLE[0], F.lit(CYCLE[1]).cast("bigint"))
           .when(k == CYCLE[1], F.lit(CYCLE[0]).cast("bigint"))
           .otherwise(F.floor(k / 3).cast("bigint")))
    return c.select("c_custkey", mgr.alias("mgr"))


def span_of_control(spark, sf):
    t = _tree(spark, sf)
    return A.span_of_control(t, "c_custkey", "mgr").select("c_custkey", "span")


def layer_depth_q(spark, sf):
    t = _tree(spark, sf)
    return layer_depth(t, "c_custkey", "mgr", root=0).select("c_custkey", "layer")


def snapshot_diff_q(spark, sf):
    o = _orders(spark, sf).withColumn("eom", D.end_of_month("o_orderdate"))
    per_month = W.dedupe(o.select("o_custkey", "eom", "o_orderkey", "o_orderpriority", "o_orderstatus"),
                         ["o_custkey", "eom"], [By("o_orderkey")], keep="last")
    return snapshot_diff(per_month, "o_custkey", "eom", ["o_orderpriority", "o_orderstatus"], carry=["o_orderkey"])


def snapshot_diff_repeated(spark, sf):
    """Orders as they are: a customer repeats within a month."""
    o = _orders(spark, sf).withColumn("eom", D.end_of_month("o_orderdate"))
    return snapshot_diff(o, "o_custkey", "eom", ["o_orderpriority", "o_orderstatus"])


# ---------------------------------------------------------------- rules


def _dq_frame(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio"),
        F.when(F.col("o_totalprice") < 50000, F.lit("")).otherwise(F.lit("ok")).alias("note"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("odate"),
    )


DQ_RULES = [
    Q.Rule("Cat A error", ["prio", "note"]),
    Q.Rule("Cat B error", ["note", "odate"], "o_orderstatus = 'F'"),
    Q.Rule("Cat C error", ["prio"], "o_orderstatus = 'O'"),
]


def dq_rules(spark, sf):
    return Q.apply_rules(_dq_frame(spark, sf), DQ_RULES).select("o_orderkey", "error")


def dq_report(spark, sf):
    return Q.error_report(Q.apply_rules(_dq_frame(spark, sf), DQ_RULES), ["o_orderstatus"])


def dq_list(spark, sf):
    return Q.error_list(Q.apply_rules(_dq_frame(spark, sf), DQ_RULES), ["o_orderkey", "prio", "note"])


def validation_table(spark, sf):
    o = _orders(spark, sf)
    in_fy = F.col("o_orderdate").between(F.lit("1997-04-01").cast("date"), F.lit("1998-03-31").cast("date"))
    firsts = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    x = o.join(firsts, "o_custkey")
    checks = {
        "headcount": F.count_distinct("o_custkey"),
        "leavers_fy": F.count_distinct(F.when(in_fy & (F.col("o_orderstatus") == "F"), F.col("o_custkey"))),
        "orders_fy": F.sum(in_fy.cast("int")),
        "joiners_by_first_date": F.count_distinct(F.when(in_fy & (F.col("o_orderdate") == F.col("first_date")), F.col("o_custkey"))),
        "joiners_by_first_in_fy": F.count_distinct(F.when(F.col("first_date").between(
            F.lit("1997-04-01").cast("date"), F.lit("1998-03-31").cast("date")), F.col("o_custkey"))),
    }
    return Q.validation_table(x, checks)


# ---------------------------------------------------------------- cleaning


def drop_null_rows(spark, sf):
    c = _t(spark, sf, "customer")
    proj = c.select(F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("seg"),
                    F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
                    F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("nat"))
    x = C.drop_empty_rows(proj)
    x = C.drop_rows_with_nulls(x, ["nat"])
    x = C.fill(x, {"bal": 0.0})
    x = C.fill_from(x, "seg", "nat")
    return x


def _wide_customer(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.lit(None).cast("string").alias("empty"),
                    F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("part_null"),
                    F.col("c_acctbal").alias("tmp_bal"))


def drop_null_columns(spark, sf):
    x = C.drop_null_columns(_wide_customer(spark, sf), how="all")
    x = C.drop_matching(x, r"^tmp_")
    return C.add_placeholders(x, {"note": "string"})


def drop_any_null_columns(spark, sf):
    return C.drop_null_columns(_wide_customer(spark, sf), how="any")


def trim_upper_all(spark, sf):
    c = _t(spark, sf, "customer")
    raw = c.select("c_custkey", F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("name"),
                   F.concat(F.lower("c_mktsegment"), F.lit("\t")).alias("seg"))
    x = C.trim_strings(raw)
    x = C.upper_strings(x, ["name"])
    x = C.rename(x, {"seg": "segment"})
    x = C.select_present(x, ["c_custkey", "name", "segment", "not_there"])
    return C.tag(x, source="SF")


def snapshot_diff_aligned(spark, sf):
    """Orders as they are: the rows of a repeated customer are paired, the order key comes along."""
    o = _orders(spark, sf).withColumn("eom", D.end_of_month("o_orderdate"))
    return aligned_diff(o, "o_custkey", "eom", ["o_orderpriority", "o_orderstatus"], carry=["o_orderkey"])


def _as_text(spark, sf):
    """Orders as text columns of several kinds."""
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("plain_id"), F.lpad(k.cast("string"), 12, "0").alias("zero_id"),
        F.when(k % 3 == 0, F.lit(" ")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day_first"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"), F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("FALSE")).alias("flag"),
        F.concat(F.floor(F.col("o_totalprice")).cast("string"), F.lit(".5")).alias("price"),
        F.when(k % 1000 == 1, F.lit("n/a")).otherwise(k.cast("string")).alias("mixed"), F.lit(None).cast("string").alias("nothing"),
        (k + F.lit(2**53)).cast("string").alias("big"), "o_orderkey")


def type_inference(spark, sf):
    return inferred_types(_as_text(spark, sf))


def _dated_files(spark, sf):
    """Order dates as text, with a format of its own in each of three files."""
    o = _orders(spark, sf)
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    text = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(F.col("o_orderstatus") == "O", day).otherwise(F.date_format("o_orderdate", "d-MMM-yy")))
    return o.filter("o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL").select(
        "o_orderkey", F.col("o_orderstatus").alias("_file"), text.alias("text"), F.when(F.col("o_orderkey") % 10 == 0, F.lit("soon")).otherwise(day).alias("due"))


def date_votes(spark, sf):
    return D.format_votes(_dated_files(spark, sf), ["text", "due"])


def voted_dates(spark, sf):
    return D.parse_by_vote(_dated_files(spark, sf), ["text", "due"])


def page_chain(spark, sf):
    """Chains of customers with orders, fifty numbers each, with gaps, forks and circles."""
    k = F.col("o_custkey")
    p = _orders(spark, sf).select("o_custkey").filter("o_custkey IS NOT NULL").distinct()
    last = F.when((F.floor(k / 50) % 3 == 0), k - 49)
    nxt = F.when(k % 50 == 49, last).when(k % 50 == 7, k + 2).otherwise(k + 1)
    return page_chains(p.select(k.alias("page"), nxt.alias("next")))


def _zone_of(key):
    """Stand-in service: a zone label for a nation; none for every fifth key, and an error for every seventh."""
    if key % 7 == 0:
        raise ValueError(f"no service for {key}")
    return {"zone": f"zone-{key % 4}"} if key % 5 else None


def kept_answers(spark, sf):
    """The second run of a look-up asks only what the first did not: its store holds one row per key."""
    keys = _t(spark, sf, "customer").select("c_nationkey")
    schema, store = T.StructType([T.StructField("zone", T.StringType())]), scratch_path(spark, "answers")
    J.resolve_keys(keys.filter("c_nationkey < 12"), "c_nationkey", _zone_of, schema, store, pause=0.0)
    out = J.resolve_keys(keys, "c_nationkey", _zone_of, schema, store, pause=0.0)
    return out.join(spark.read.parquet(store).groupBy("key").agg(F.count(F.lit(1)).alias("asked")), "key").select(
        "key", "zone", "status", "tries", "error", "asked")


def delimited_rows(spark, sf):
    """Order notes with quotes, separators and newlines, written as delimited files and loaded back."""
    o = _orders(spark, sf)
    note = F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\nthen '), F.col("o_orderstatus"), F.lit("\n\n"), F.col("o_orderkey").cast("string"))
    path = scratch_path(spark, "notes")
    o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, note).otherwise(F.col("o_orderpriority")).alias("note")).write.option(
        "header", True).option("escape", '"').csv(path)
    load = load_delimited(spark, f"{path}/*.csv", normalise=False)
    return load.rows.select("o_orderkey", "note")


def sketch_rollup_q(spark, sf):
    """Customers with orders by year and by status, from sketches stored by month and status, within 3 % of the exact counts."""
    o = _orders(spark, sf).filter("o_orderdate IS NOT NULL")
    path = scratch_path(spark, "sketches")
    A.distinct_sketches(o.withColumn("month", F.trunc("o_orderdate", "month")), ["o_custkey"], ["month", "o_orderstatus"]).write.parquet(path)
    stored = spark.read.parquet(path)
    out = None
    for name, key in (("year", F.year("month").cast("string")), ("status", F.col("o_orderstatus"))):
        exact = key if name == "status" else F.year("o_orderdate").cast("string")
        rolled = A.sketch_rollup(stored.withColumn("value", key), ["value"])
        known = o.groupBy(exact.alias("value")).agg(F.count_distinct("o_custkey").alias("n_exact"))
        part = rolled.join(known, "value").select(F.lit(name).alias("level"), "value", "rows", "n_exact",
                                                  (F.abs(F.col("n_o_custkey") - F.col("n_exact")) <= F.greatest(F.lit(2.0), 0.03 * F.col("n_exact"))).alias("close"))
        out = part if out is None else out.unionByName(part)
    return out


def json_records(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "props")
    parsed = e.select("event_id", F.from_json("props", "k bigint").alias("j"))
    return parsed.select("event_id", F.col("j.k").alias("k"))


def _landed(spark, pages, name):
    """JSON documents derived from a table, landed one per line."""
    path = scratch_path(spark, name)
    pages.select(F.to_json(F.struct("*"))).write.text(path)
    return path


def json_record_arrays(spark, sf):
    """Landed payloads with a record array each, read back to one row per record."""
    o = _orders(spark, sf)
    rec = F.struct("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("info"))
    docs = o.groupBy("o_custkey").agg(F.struct(F.collect_list(rec).alias("records")).alias("result"))
    return read_records(spark, _landed(spark, docs, "payloads"), "result.records", multi_line=False)


def json_pages(spark, sf):
    """Landed pages with a next link each, read back to one row per result."""
    o = _orders(spark, sf)
    pages = o.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", F.struct("o_orderstatus").alias("meta"))).alias("results"))
    pages = pages.select(F.struct("results", F.concat(F.lit("page-"), F.col("o_custkey") + 1).alias("__next")).alias("d"))
    return read_pages(spark, _landed(spark, pages, "pages"), multi_line=False).select("o_orderkey", "meta_o_orderstatus", F.col("_next").alias("next_page"))


# ---------------------------------------------------------------- ML


def attrition_features(spark, sf):
    from ..operators.ml import attrition_features as feats

    return feats(_orders(spark, sf), _t(spark, sf, "customer"))


def _listing(spark, sf):
    """A consolidated listing of the orders: a row is a person (the customer) in the month of an order."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    key = F.col("o_custkey")
    left = F.col("o_orderstatus") == "F"
    return _orders(spark, sf).join(c, key == F.col("c_custkey")).select(
        key.alias("persno"), D.end_of_month("o_orderdate").alias("eom"), (~left).alias("active"), F.when(left, F.col("o_orderdate")).alias("date_left"),
        F.when(key % 5 == 0, "Other").when(key % 5 == 1, "SF DIRECT ").otherwise("SF Direct").alias("source"),
        (F.col("o_orderpriority") == "5-LOW").alias("flexi"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Central Provident Fund ").when(F.col("c_mktsegment") == "MACHINERY", "SCHEME FOR PERMANENT RESIDENT")
        .when(F.col("c_mktsegment") != "HOUSEHOLD", "NA").alias("fund_type"),
        (key % 45 + 20).cast("int").alias("age"), F.col("c_mktsegment").alias("industry"), (F.col("c_nationkey") % 4).cast("string").alias("business"),
        (F.col("c_nationkey") % 9).cast("string").alias("business_unit"), F.concat(F.lit(" D"), F.col("c_nationkey")).alias("parent_department"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 2500).cast("string")).alias("grade"), (key % 6).cast("string").alias("job_grade"),
        (key % 2 == 0).alias("on_shift"), F.when(key % 3 > 0, (key % 3).cast("string")).alias("marital_status"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender_key"), F.col("c_nationkey").cast("string").alias("nationality"),
        F.col("o_orderstatus").alias("employee_group"), F.col("o_orderpriority").alias("job"))


def attrition_set(spark, sf):
    from ..operators.ml import attrition_set as rows

    return rows(_listing(spark, sf), left_since="1997-01-01")


def attrition_clusters(spark, sf):
    """The attrition set in four groups by its numbers and categories."""
    from ..operators import ml

    return ml.k_prototypes(attrition_set(spark, sf), ml.CLUSTER_CATEGORICAL, [*ml.ATTRITION_NUMERIC, "active"], 4)[0]


def model_sets(spark, sf):
    """Sizes and class weights of the training and test parts."""
    from ..operators.ml import model_sets as sets

    parts = sets(attrition_features(spark, sf), "c_custkey", "active")
    return parts.groupBy("part", "active").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 9).alias("weight"))


def classify_compare(spark, sf):
    from ..operators.ml import classify_compare as cc

    return cc(attrition_features(spark, sf))


def attrition_importances(spark, sf):
    from ..operators.ml import attrition_importances as imp

    return imp(attrition_features(spark, sf))


def kmeans_pick(spark, sf):
    from ..operators.ml import kmeans_pick as kp

    return kp(attrition_features(spark, sf))


QUERIES = {
    "snapshot_consolidation": snapshot_consolidation,
    "month_end_snapshot": month_end_snapshot,
    "headcount_by_month": headcount_by_month,
    "current_snapshot": current_snapshot,
    "first_snapshot_rows": first_snapshot_rows,
    "latest_two_slices": latest_two_slices,
    "distinct_all_columns": distinct_all_columns,
    "value_counts_desc": value_counts_desc,
    "five_number_summary": five_number_summary,
    "null_profile": null_profile,
    "scalar_aggs": scalar_aggs,
    "grouped_aggs": grouped_aggs,
    "distinct_pairs": distinct_pairs,
    "top_n_sorted": top_n_sorted,
    "sample_rows": sample_rows,
    "canonical_id": canonical_ids,
    "snapshot_diff_aligned": snapshot_diff_aligned,
    "type_inference": type_inference,
    "date_votes": date_votes,
    "voted_dates": voted_dates,
    "page_chain": page_chain,
    "kept_answers": kept_answers,
    "delimited_rows": delimited_rows,
    "sketch_rollup": sketch_rollup_q,
    "fiscal_label": fiscal_label,
    "fiscal_label_padded": fiscal_label_padded,
    "calendar_from_fiscal": calendar_from_fiscal,
    "age_tenure": age_tenure,
    "eom_makedate_fill": eom_makedate_fill,
    "parse_dates_multi": parse_dates_multi,
    "epoch_text_parse": epoch_text_parse,
    "date_parts": date_parts,
    "load_stamp": load_stamp,
    "ascii_strip": ascii_strip,
    "punct_strip": punct_strip,
    "split_parts": split_parts,
    "text_extract": text_extract,
    "name_normaliser": name_normaliser,
    "conditional_grade": conditional_grade,
    "percent_numeric_coerce": percent_numeric_coerce,
    "derived_flags": derived_flags,
    "dict_mapping": dict_mapping,
    "contract_typing": contract_typing,
    "filter_mix": filter_mix,
    "left_lookup_chain": left_lookup_chain,
    "outer_merge": outer_merge,
    "overlay_update": overlay_update,
    "two_key_left_join": two_key_left_join,
    "detail_left_fanout": detail_left_fanout,
    "distinct_key_enrich": distinct_key_enrich,
    "latest_attribute": latest_attribute,
    "dedupe_first": dedupe_first,
    "dedupe_last": dedupe_last,
    "duplicates_only": duplicates_only,
    "latest_per_key_nulls": latest_per_key_nulls,
    "joiner_mark": joiner_mark,
    "joiner_mark_ties": joiner_mark_ties,
    "value_name_join": value_name_join,
    "equals_group_max": equals_group_max,
    "dayrange_explode": dayrange_explode,
    "gaps_islands": gaps_islands,
    "timeoff_runs": timeoff_runs,
    "unpivot_single": unpivot_single,
    "unpivot_groups": unpivot_groups,
    "union_by_name_missing": union_by_name_missing,
    "span_of_control": span_of_control,
    "layer_depth": layer_depth_q,
    "snapshot_diff": snapshot_diff_q,
    "snapshot_diff_repeated": snapshot_diff_repeated,
    "dq_rules": dq_rules,
    "dq_report": dq_report,
    "dq_list": dq_list,
    "validation_table": validation_table,
    "drop_null_rows": drop_null_rows,
    "drop_null_columns": drop_null_columns,
    "drop_any_null_columns": drop_any_null_columns,
    "trim_upper_all": trim_upper_all,
    "json_records": json_records,
    "json_record_arrays": json_record_arrays,
    "json_pages": json_pages,
    "attrition_features": attrition_features,
    "attrition_set": attrition_set,
    "attrition_clusters": attrition_clusters,
    "model_sets": model_sets,
    "classify_compare": classify_compare,
    "attrition_importances": attrition_importances,
    "kmeans_pick": kmeans_pick,
}
