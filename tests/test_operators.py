import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staffwise.operators import agg as A
from staffwise.operators import clean as C
from staffwise.operators import joins as J
from staffwise.operators import reshape as R
from staffwise.operators import rules as Q
from staffwise.operators import windows as W
from staffwise.operators.contract import DateSpec, apply_contract
from staffwise.operators.diff import snapshot_diff
from staffwise.operators.hierarchy import layer_depth
from staffwise.operators.ordering import By

d = dt.date


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_month_end_snapshot_ties_and_null_dates(spark):
    df = spark.createDataFrame([
        (1, d(2024, 1, 10)), (1, d(2024, 1, 31)), (2, d(2024, 1, 31)),  # tie on last day
        (1, d(2024, 2, 3)), (3, None), (4, None)], "p int, dt date")
    got = rows(W.month_end_snapshot(df, "dt"), "p", "dt")
    assert got == sorted([(1, d(2024, 1, 31)), (2, d(2024, 1, 31)), (1, d(2024, 2, 3)), (3, None), (4, None)], key=repr)


def test_dedupe_first_last_with_nulls_and_ties(spark):
    df = spark.createDataFrame([
        ("a", d(2024, 1, 1), 1), ("a", d(2024, 3, 1), 2), ("a", None, 3),
        (None, d(2024, 1, 1), 4), (None, d(2024, 2, 1), 5)], "k string, dt date, row int")
    first = rows(W.dedupe(df, ["k"], [By("dt"), By("row")], "first"), "k", "row")
    last = rows(W.dedupe(df, ["k"], [By("dt"), By("row")], "last"), "k", "row")
    assert first == sorted([("a", 1), (None, 4)], key=repr)
    # ascending with nulls last, keep last: the null date wins
    assert last == sorted([("a", 3), (None, 5)], key=repr)
    mixed = rows(W.dedupe(df, ["k"], [By("dt", False), By("row", True)], "first"), "k", "row")
    assert mixed == sorted([("a", 2), (None, 5)], key=repr)


def test_latest_per_key_both_null_placements(spark):
    df = spark.createDataFrame([(1, d(2024, 1, 1), 1), (1, None, 2), (1, d(2024, 5, 1), 3)], "k int, dt date, r int")
    assert rows(W.latest_per_key(df, "k", "dt"), "r") == [(3,)]
    assert rows(W.latest_per_key(df, "k", "dt", null_date_wins=True), "r") == [(2,)]


def test_latest_attribute_backfill(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, None), (2, 1, None)], "p int, t int, v string")
    got = rows(W.latest_attribute(df, "p", "v", [By("t")], out="v_last"), "p", "t", "v_last")
    assert got == [(1, 1, "y"), (1, 2, "y"), (1, 3, "y"), (2, 1, None)]


def test_first_occurrence_and_group_max(spark):
    df = spark.createDataFrame([(1, "A", 1, 5.0), (1, "A", 2, 7.0), (1, "B", 3, 7.0), (2, None, 4, None)],
                               "p int, j string, t int, v double")
    marks = rows(W.first_occurrence_flag(df, ["p", "j"], [By("t")], out="m"), "t", "m")
    assert marks == [(1, True), (2, False), (3, True), (4, True)]
    mx = rows(W.equals_group_max(df, "p", "v", "is_max"), "t", "is_max")
    assert mx == [(1, False), (2, True), (3, True), (4, False)]
    dup = rows(W.duplicates_only(df, ["p", "j"]), "t")
    assert dup == [(1,), (2,)]


def test_explode_days_edge_intervals(spark):
    df = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 1, 1)), (2, d(2024, 1, 1), d(2024, 1, 3)),
                                (3, d(2024, 1, 5), d(2024, 1, 4)), (4, None, d(2024, 1, 4))], "k int, s date, e date")
    out = R.explode_days(df, "s", "e")
    got = rows(out, "k", "day")
    assert got == sorted([(1, d(2024, 1, 1)), (2, d(2024, 1, 1)), (2, d(2024, 1, 2)), (2, d(2024, 1, 3)),
                          (3, None), (4, None)], key=repr)
    # invariant: exploded days = sum(datediff + 1) over valid ranges (+1 null row per invalid)
    assert out.filter("day is not null").count() == 1 + 3


def test_day_runs_gaps_overlaps_and_streaks(spark):
    days = [(1, d(2024, 1, 1)), (1, d(2024, 1, 2)), (1, d(2024, 1, 2)), (1, d(2024, 1, 4)), (1, d(2024, 1, 6)),
            (1, d(2024, 1, 7)), (2, d(2024, 1, 2)), (2, d(2024, 1, 3))]
    df = spark.createDataFrame(days, "p int, day date")
    got = rows(W.day_runs(df, "p", "day"), "p", "day", "gap_days", "gap", "streak")
    assert got == sorted([
        (1, d(2024, 1, 1), None, False, 0), (1, d(2024, 1, 2), 1, False, 1), (1, d(2024, 1, 2), 0, False, 2),
        (1, d(2024, 1, 4), 2, True, 0), (1, d(2024, 1, 6), 2, True, 0), (1, d(2024, 1, 7), 1, False, 1),
        (2, d(2024, 1, 2), None, False, 0), (2, d(2024, 1, 3), 1, False, 1)], key=repr)


def test_day_runs_many_copies(spark):
    rows = [(1, d(2024, 1, 1), "x")] * 50 + [(1, d(2024, 1, 1), "y")] * 2 + [(1, d(2024, 1, 2), "x")]
    out = W.day_runs(spark.createDataFrame(rows, "p int, day date, t string"), "p", "day")
    streaks = sorted(r["streak"] for r in out.collect())
    assert streaks == list(range(53))
    assert sorted(r["gap_days"] for r in out.collect() if r["gap_days"] is not None) == [0] * 51 + [1]


def test_layer_depth_chains_cycles_orphans(spark):
    edges = [("root", None)]
    prev = "root"
    for i in range(200):  # chain of 200
        edges.append((f"c{i}", prev))
        prev = f"c{i}"
    edges += [("o1", "ghost"), ("o2", "o1"), ("s", "s"), ("x", "y"), ("y", "x"), ("z", "x"), ("leaf", "root")]
    df = spark.createDataFrame(edges, "p string, m string")
    got = dict(layer_depth(df, "p", "m", "root").select("p", "layer").collect())
    assert got["root"] == 0 and got["leaf"] == 1 and got["c0"] == 1 and got["c199"] == 200
    for k in ("o1", "o2", "s", "x", "y", "z"):
        assert got[k] is None


def test_layer_depth_per_snapshot(spark):
    df = spark.createDataFrame([(1, "r", None), (1, "a", "r"), (1, "b", "a"), (2, "r", None), (2, "b", "r")],
                               "snap int, p string, m string")
    got = rows(layer_depth(df, "p", "m", "r", by=["snap"]), "snap", "p", "layer")
    assert got == [(1, "a", 1), (1, "b", 2), (1, "r", 0), (2, "b", 1), (2, "r", 0)]


def test_span_of_control(spark):
    df = spark.createDataFrame([("r", None), ("a", "r"), ("b", "r"), ("b", "r"), ("c", "a")], "p string, m string")
    got = dict(A.span_of_control(df, "p", "m").select("p", "span").collect())
    assert got == {"r": 2, "a": 1, "b": None, "c": None}


def test_snapshot_diff_cases(spark):
    m1, m2, m3 = d(2024, 1, 31), d(2024, 2, 29), d(2024, 4, 30)
    df = spark.createDataFrame([
        (1, m1, None, "x"), (1, m2, "A", "x"),      # added
        (2, m1, "A", "x"), (2, m2, None, "x"),      # deleted
        (3, m1, "A", "x"), (3, m2, "B", "y"),       # modified twice
        (4, m1, "A", "x"), (4, m2, "A", "x"),       # unchanged
        (5, m1, "A", "x"),                          # leaves
        (6, m2, "A", "x"), (6, m3, "C", "x"),       # m3 follows m2 (no March snapshot)
        (7, None, "Z", "z")], "k int, eom date, f string, g string")
    got = rows(snapshot_diff(df, "k", "eom", ["f", "g"]), "k", "eom", "field", "change")
    assert got == sorted([(1, m2, "f", "added"), (2, m2, "f", "deleted"), (3, m2, "f", "modified"),
                          (3, m2, "g", "modified"), (6, m3, "f", "modified")], key=repr)


def test_snapshot_diff_copies_are_counted_not_multiplied(spark):
    m1, m2 = d(2024, 1, 31), d(2024, 2, 29)
    rows = [(1, m1, "A")] * 3 + [(1, m1, "B")] + [(1, m2, "C")] * 2
    out = snapshot_diff(spark.createDataFrame(rows, "k int, eom date, f string"), "k", "eom", ["f"])
    got = sorted((r["change"], r["f_old"], r["f_new"], r["n_old"], r["n_new"]) for r in out.collect())
    assert got == [("value_added", None, "C", 0, 2), ("value_removed", "A", None, 3, 0), ("value_removed", "B", None, 1, 0)]


@pytest.mark.parametrize("n", [2, 8, 9, 40])
def test_snapshot_diff_repeated_keys_give_one_kind_of_rows(spark, n):
    m1, m2 = d(2024, 1, 31), d(2024, 2, 29)
    rows = [(1, m1, f"a{i}", i) for i in range(n)] + [(1, m2, f"b{i}", i) for i in range(n)] + [(2, m1, "x", 5), (2, m2, "y", 6)]
    out = snapshot_diff(spark.createDataFrame(rows, "k int, eom date, f string, pay int"), "k", "eom", ["f"], carry=["pay", "k"]).collect()
    assert Counter((r["k"], r["change"]) for r in out) == {(1, "value_removed"): n, (1, "value_added"): n, (2, "modified"): 1}
    assert [(r["pay_old"], r["pay_new"]) for r in out if r["k"] == 2] == [(5, 6)]


def test_snapshot_diff_by_timestamp(spark):
    rows = [(k, dt.datetime(2024, 1, 1, h), f"v{h // 3}") for k in (1, 2) for h in range(9) if (k, h) != (2, 4)]
    df = spark.createDataFrame(rows, "k int, at timestamp, f string")
    got = sorted((r["k"], r["at"].hour, r["f_old"], r["f_new"]) for r in snapshot_diff(df, "k", "at", ["f"]).collect())
    assert got == [(1, 3, "v0", "v1"), (1, 6, "v1", "v2"), (2, 3, "v0", "v1"), (2, 6, "v1", "v2")]


def test_lookup_null_safe_suffix_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "zz", "w")], "id int, k string, name string")
    ref = spark.createDataFrame([("a", "A"), (None, "N")], "k string, name string")
    out = J.lookup(df, ref, "k")
    assert out.columns == ["id", "k", "name", "name_ref"]
    assert rows(out, "id", "name_ref") == [(1, "A"), (2, "N"), (3, None)]
    dup = spark.createDataFrame([("a", "A"), ("a", "B")], "k string, name string")
    with pytest.raises(ValueError):
        J.lookup(df, dup, "k", on_duplicate="error")
    assert J.lookup(df, dup, "k").count() == 4  # pandas-style fan-out
    assert J.lookup(df, ref, "k", null_safe=False).filter("name_ref is not null").count() == 1


def test_overlay_and_outer_merge(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    upd = spark.createDataFrame([(1, None, 9.0, "x"), (5, "q", 1.0, "y")], "k int, s string, v double, extra string")
    assert rows(J.overlay_update(base, upd, "k"), "k", "s", "v") == [(1, "a", 9.0), (2, "b", 2.0)]
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(J.outer_merge(a, b, "k"), "k", "a", "b") == [(1, "x", None), (2, None, "y")]


def test_overlay_with_repeated_update_keys(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    upd = spark.createDataFrame([(1, "x", None), (1, "y", 9.0), (5, "q", 1.0), (5, "r", 1.0)], "k int, s string, v double")
    with pytest.raises(ValueError, match="repeat"):
        J.overlay_update(base, upd, "k")
    assert rows(J.overlay_update(base, upd, "k", on_duplicate="expand"), "k", "s", "v") == [(1, "x", 1.0), (1, "y", 9.0), (2, "b", 2.0)]


def test_overlay_query_beyond_a_million_parts(spark, tmp_dir):
    import duckdb

    from staffwise.plans.driver_queries import QUERIES
    from staffwise.plans.oracle_sql import ORACLE_SQL

    parts = [(5, "p", "B", 50, 1.0), (1000005, "q", "B", 47, 2.0), (6, "r", "B", 50, 3.0), (1000006, "s", "B", 1, 4.0), (7, "t", "B", 46, 5.0)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double").write.parquet(f"{tmp_dir}/part.parquet")
    got = rows(QUERIES["overlay_update"](spark, tmp_dir), "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_dir}/part.parquet/*.parquet'")
    assert got == sorted(con.execute(ORACLE_SQL["overlay_update"]).fetchall(), key=repr) and len(got) == 6


def test_enrich_distinct_drops_unresolved(spark):
    import pandas as pd

    def resolver(pdf):
        return pd.DataFrame({"zip": pdf["zip"], "lat": pdf["zip"].map({"100": 1.5}).astype("float64")})

    df = spark.createDataFrame([(1, "100"), (2, "100"), (3, "999"), (4, None)], "id int, zip string")
    got = rows(J.enrich_distinct(df, "zip", resolver, "zip string, lat double"), "id", "lat")
    assert got == [(1, 1.5), (2, 1.5)]


def test_melt_keeps_nulls_and_sums(spark):
    df = spark.createDataFrame([(1, 1, 2.5, None), (2, 0, 0.0, 3.0)], "id int, a int, b double, c double")
    long = R.melt(df, ["id"], ["a", "b", "c"], "var", "val")
    assert long.count() == 6
    assert long.agg(F.sum("val")).first()[0] == 1 + 2.5 + 3.0
    grp = R.melt_groups(df, ["id"], {"g1": ["a"], "g2": ["b", "c"]}, "var", "val", "grp")
    assert rows(grp.filter("id = 1"), "var", "grp") == [("a", "g1"), ("b", "g2"), ("c", "g2")]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 2.0)], "k int, b double")
    u = R.union_by_name(a, b, a)
    assert u.columns == ["k", "a", "b"] and u.count() == 3


def test_rules_fire_alone_together_and_blank(spark):
    df = spark.createDataFrame([
        ("YES", None, "x"), ("YES", "", ""), ("NO", "ok", "ok"), ("no", "ok", None)], "s string, a string, b string")
    rules = [Q.Rule("Cat A error", ["a"]), Q.Rule("Cat B error", ["b"], "upper(s) = 'YES'")]
    got = [r[0] for r in Q.apply_rules(df, rules).select("error").collect()]
    assert got == ["Cat A error; ", "Cat A error; Cat B error; ", None, None]
    joined = [r[0] for r in Q.apply_rules(df, rules, trailing_sep=False).select("error").collect()]
    assert joined[1] == "Cat A error; Cat B error"
    rep = Q.error_report(Q.apply_rules(df, rules), ["s"])
    assert rep.count() == 2


def test_clean_helpers(spark):
    df = spark.createDataFrame([(" a ", None, None), (None, None, None), ("b\t", 1, None)], "s string, n int, e string")
    assert C.drop_empty_rows(df).count() == 2
    assert C.drop_null_columns(df).columns == ["s", "n"]
    assert C.drop_null_columns(df, how="any").columns == []
    assert [r[0] for r in C.trim_strings(df).collect()] == ["a", None, "b"]
    raw = spark.createDataFrame([(1, 2)], ["Pers. No", "Date-Joined (x)"])
    assert C.normalise_columns(raw).columns == ["pers_no", "date_joined_x"]
    assert C.normalise_columns(spark.createDataFrame([(1, 2)], ["A", "a"])).columns == ["a", "a_1"]


def test_contract_typing(spark):
    df = spark.createDataFrame([("12.0", "31/12/2023", "yes", "x"), ("bad", "2023-12-31", "0", "y")],
                               "n string, dt string, b string, keep string")
    out = apply_contract(df, {"n": "bigint", "dt": DateSpec(), "b": "boolean", "absent": "int"})
    assert out.collect() == [(12, d(2023, 12, 31), True, "x"), (None, d(2023, 12, 31), False, "y")]


def test_aggregates(spark):
    df = spark.createDataFrame([("m1", 1, 10.0), ("m1", 1, 20.0), ("m1", 2, None), (None, 3, 1.0)], "g string, p int, v double")
    assert rows(A.headcount(df, "p", ["g"]), "g", "headcount") == [("m1", 2)]
    s = A.five_number_summary(df, "v", ["g"]).filter("g = 'm1'").first()
    assert (s["min"], s["median"], s["max"], s["n"]) == (10.0, 15.0, 20.0, 2)
    prof = {r["column"]: r["nulls"] for r in A.null_profile(df).collect()}
    assert prof == {"g": 1, "p": 0, "v": 1}


def test_layer_depth_repeated_person_does_not_fan_out(spark):
    df = spark.createDataFrame([("r", None), ("a", "r"), ("a", "r"), ("b", "a"), ("b", "a")], "p string, m string")
    out = layer_depth(df, "p", "m", "r")
    assert out.count() == 5
    assert sorted({(r["p"], r["layer"]) for r in out.collect()}) == [("a", 1), ("b", 2), ("r", 0)]


def test_layer_depth_writes_only_active_rows_each_round(spark, monkeypatch):
    from staffwise.operators import hierarchy

    n, wide = 40, 300  # one long chain and many people right under the root
    rows = [("0", None)] + [(str(i), str(i - 1)) for i in range(1, n)] + [(f"w{i}", "0") for i in range(wide)]
    df = spark.createDataFrame(rows, "p string, m string")
    sizes, real = [], hierarchy.cut_lineage

    def counted(frame, *args):
        out = real(frame, *args)
        sizes.append(out[0].count())
        return out

    monkeypatch.setattr(hierarchy, "cut_lineage", counted)
    got = {r["p"]: r["layer"] for r in layer_depth(df, "p", "m", root="0").collect()}
    assert got == {"0": 0, **{str(i): i for i in range(1, n)}, **{f"w{i}": 1 for i in range(wide)}}
    assert sizes[0] == len(rows) and sizes[1] == n - 2  # the root and its direct reports settle at once
    assert all(a > b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 8


def test_layer_depth_raises_at_the_round_limit(spark):
    df = spark.createDataFrame([("0", None)] + [(str(i), str(i - 1)) for i in range(1, 30)], "p string, m string")
    with pytest.raises(RuntimeError, match="no layer"):
        layer_depth(df, "p", "m", root="0", max_rounds=2)
