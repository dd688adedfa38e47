"""Type inference, date votes, page chains, kept answers, versioned folders, aligned changes."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffwise.functions import dates as D
from staffwise.functions.ids import canonical_id
from staffwise.operators import joins as J
from staffwise.operators.contract import DateSpec, apply_contract, infer_contract, inferred_types
from staffwise.operators.diff import aligned_diff, snapshot_diff
from staffwise.sources import json as SJ
from staffwise.sources import sinks


def test_exact_integers_and_ids(spark):
    vals = ["9007199254740993", "9007199254740993.0", "12.7", "1e3", "123456789012345678901234567890", " -5 ", "x", None, "99999999999999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in apply_contract(df, {"x": "bigint"}).collect()]
    assert got == [9007199254740993, 9007199254740993, None, 1000, None, -5, None, None, None]
    ids = [r[0] for r in df.select(canonical_id("x")).collect()]
    assert ids == ["9007199254740993", "9007199254740993", "13", "1000", "123456789012345678901234567890", "-5", "x", None, "99999999999999999999"]


def test_types_that_every_value_fits(spark):
    rows = [("1", "007", "1.5", "31/01/2024", "true", "2024-01-31", "01/02/2024", None, "1"), ("-2", "12", "2", "01/02/2024", "FALSE", " ", "2024-02-01", " ", "x"),
            (None, "", "1e-3", None, "True", "2024-02-29", "", None, "2")]
    df = spark.createDataFrame(rows, "n string, id string, x string, day string, flag string, iso string, mixed string, none string, t string")
    assert infer_contract(df) == {"n": "bigint", "id": "string", "x": "double", "day": DateSpec([D.DAY_FIRST]), "flag": "boolean", "iso": DateSpec([D.ISO]),
                                  "mixed": "string", "none": "string", "t": "string"}
    typed = apply_contract(df, infer_contract(df))
    assert [f.dataType.simpleString() for f in typed.schema][:6] == ["bigint", "string", "double", "date", "boolean", "date"]
    assert {r["type"] for r in inferred_types(df.limit(0)).collect()} == {"string"}


def test_votes_read_each_column_by_one_format(spark):
    rows = [("a", "1-Feb-23", "02/13/2023"), ("a", "28-Dec-22", "01/02/2023"), ("a", None, "2023-01-01"),
            ("b", "13/02/2023", "03/04/2023"), ("b", "01/02/2023", "05/06/2023"), (None, "x", "")]
    df = spark.createDataFrame(rows, "_file string, d string, e string")
    votes = {(r["_file"], r["column"], r["format"]): r for r in D.format_votes(df, ["d", "e"]).collect()}
    assert votes["a", "d", "d-MMM-yy"]["chosen"] and votes["a", "e", "MM/dd/yyyy"]["chosen"] and votes["b", "d", D.DAY_FIRST]["chosen"]
    assert votes["b", "e", D.DAY_FIRST]["tie"] and votes["b", "e", "MM/dd/yyyy"]["tie"] and not votes["b", "e", "MM/dd/yyyy"]["chosen"]
    got = [(r["d"], r["e"]) for r in D.parse_by_vote(df, ["d", "e"]).collect()]
    day = dt.date
    assert sorted(got, key=repr) == sorted([(day(2023, 2, 1), day(2023, 2, 13)), (day(2022, 12, 28), day(2023, 1, 2)), (None, None),
                                            (day(2023, 2, 13), day(2023, 4, 3)), (day(2023, 2, 1), day(2023, 6, 5)), (None, None)], key=repr)


def test_page_chains_gaps_forks_loops(spark):
    links = {f"a{i}": f"a{i + 1}" for i in range(37)} | {"a37": None, "g0": "g1", "g1": "lost", "x": "y", "z": "y", "y": None,
                                                       "l0": "l1", "l1": "l2", "l2": "l0", "alone": None, "self": "self"}
    df = spark.createDataFrame([*links.items(), (None, "a3"), ("a0", "a1")], "page string, next string")
    got = {r["page"]: (r["chain"], r["position"], r["problem"]) for r in SJ.page_chains(df).collect()}
    want = {f"a{i}": ("a0", i, None) for i in range(38)} | {
        "g0": ("g0", 0, None), "g1": ("g0", 1, "gap"), "x": ("x", 0, None), "z": ("z", 0, None), "y": ("y", 0, "fork"),
        "l0": (None, None, "loop"), "l1": (None, None, "loop"), "l2": (None, None, "loop"), "alone": ("alone", 0, None), "self": (None, None, "loop")}
    assert got == want
    assert SJ.page_chains(df.limit(0)).count() == 0


def test_flatten_numbers_repeated_names_and_next_links_are_looked_up_by_path(spark, tmp_dir):
    df = spark.createDataFrame([(1, (2, 3))], "a_b int, a struct<b:int,c:int>")
    assert len(set(SJ.flatten(df).columns)) == 3
    with open(f"{tmp_dir}/p.json", "w") as f:
        f.write('{"d": {"results": [{"id": 1, "__next": "inner"}]}}')
    row = SJ.read_pages(spark, tmp_dir).first()
    assert row["_next"] is None and row["id"] == 1


def test_answers_are_kept_and_failures_tried_again(spark, tmp_dir):
    log = os.path.join(tmp_dir, "calls")
    os.makedirs(log)

    def resolver(key):
        with open(os.path.join(log, f"{key}-{os.urandom(6).hex()}"), "w"):
            pass
        if key == "bad":
            raise ValueError("down")
        return None if key == "none" else {"lat": float(len(key))}

    calls = lambda: Counter(n.rsplit("-", 1)[0] for n in os.listdir(log))
    schema, store = T.StructType([T.StructField("lat", T.DoubleType())]), f"{tmp_dir}/store"
    keys = spark.createDataFrame([("a",), ("bb",), ("bad",), ("none",), ("a",), (None,)], "zip string")
    first = {r["key"]: (r["lat"], r["status"], r["tries"]) for r in J.resolve_keys(keys, "zip", resolver, schema, store, pause=0.0, calls=2).collect()}
    assert first == {"a": (1.0, "found", 1), "bb": (2.0, "found", 1), "bad": (None, "failed", 3), "none": (None, "none", 1)}
    assert calls() == {"a": 1, "bb": 1, "bad": 3, "none": 1}
    again = J.resolve_keys(keys.unionByName(spark.createDataFrame([("ccc",)], "zip string")), "zip", resolver, schema, store, pause=0.0)
    assert again.count() == 5 and calls() == {"a": 1, "bb": 1, "bad": 3, "none": 1, "ccc": 1}
    J.resolve_keys(keys, "zip", resolver, schema, store, pause=0.0, again=["failed"])
    assert calls()["bad"] == 6 and calls()["a"] == 1


def test_versions_are_swapped_whole(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    old = sinks.write_version(spark.range(5), path)
    reader = sinks.read_version(spark, path)
    broken = spark.range(10).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.write_version(broken, path)
    assert sinks.current_version(spark, path) == old and sinks.read_version(spark, path).count() == 5
    sinks.write_version(spark.range(7), path, keep=2)
    assert reader.count() == 5 and sinks.read_version(spark, path).count() == 7 and sinks.read_version(spark, path, old).count() == 5
    for n in range(3):
        sinks.write_version(spark.range(n), path, keep=1)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 2


def test_carry_never_changes_the_form(spark):
    m1, m2 = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    rows = [(1, m1, "a", 1, "s"), (1, m1, "a", 2, "s"), (1, m2, "b", 3, "t")]
    df = spark.createDataFrame(rows, "k int, eom date, org string, row int, same string")
    got = [(r["change"], r["row_old"], r["row_new"], r["same_old"], r["n_old"]) for r in snapshot_diff(df, "k", "eom", ["org"], carry=["row", "same"]).collect()]
    assert got == [("modified", None, 3, "s", 2)]


@pytest.mark.parametrize("n", [1, 8, 9])
def test_aligned_rows(spark, n):
    m1, m2 = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    rows = [(1, m1, f"a{i}", i) for i in range(n)] + [(1, m2, f"b{i}", i + 100) for i in range(n)] + [(1, m, "same", 7) for m in (m1, m1, m2)] + [(2, m1, "x", 0)]
    df = spark.createDataFrame(rows, "k int, eom date, org string, row int").repartition(3)
    got = sorted((r["change"], r["field"], r["org_old"], r["org_new"], r["row_old"], r["row_new"]) for r in aligned_diff(df, "k", "eom", ["org"], carry=["row"]).collect())
    assert [g for g in got if g[0] == "modified"] == [("modified", "org", f"a{i}", f"b{i}", i, i + 100) for i in range(n)]
    assert [g for g in got if g[0] != "modified"] == [("row_removed", None, "same", None, 7, None)]


def test_aligned_diff_against_a_loop(spark):
    rng = random.Random(7)
    days = [dt.date(2024, m, 28) for m in (1, 2, 4)]
    rows = [(rng.randint(1, 4), rng.choice(days), rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.randint(0, 9)) for _ in range(60)]
    df = spark.createDataFrame(rows, "k int, eom date, f string, g int, c int")
    want = Counter()
    low = lambda v: (v is not None, v if v is not None else 0)
    for k in range(1, 5):
        for a, b in zip(days, days[1:]):
            old, new = ([r[2:] for r in rows if r[0] == k and r[1] == x] for x in (a, b))
            if not old or not new:
                continue
            sides = []
            for mine, other in ((old, new), (new, old)):
                left, both = [], Counter(x[:2] for x in mine) & Counter(x[:2] for x in other)
                for x in sorted(mine, key=lambda x: x[2]):
                    if both[x[:2]]:
                        both[x[:2]] -= 1
                    else:
                        left.append(x)
                sides.append(sorted(left, key=lambda x: (low(x[0]) if x[0] is None else (True, x[0]), low(x[1]), x[2])))
            for i in range(max(map(len, sides))):
                o, n = (s[i] if i < len(s) else None for s in sides)
                if o is None or n is None:
                    want[k, b, None, "row_added" if o is None else "row_removed"] += 1
                    continue
                for j, name in enumerate("fg"):
                    if o[j] != n[j]:
                        want[k, b, name, "added" if o[j] is None else "deleted" if n[j] is None else "modified"] += 1
    got = Counter((r["k"], r["eom"], r["field"], r["change"]) for r in aligned_diff(df, "k", "eom", ["f", "g"], carry=["c"]).collect())
    assert got == want and len(want) > 10


def test_stored_sketches_roll_up(spark):
    from staffwise.operators import agg as A
    rows = [(f"p{i % 700}", "a" if i % 3 else "b", i % 4) for i in range(6000)] + [(None, "c", 1)]
    stored = A.distinct_sketches(spark.createDataFrame(rows, "p string, g string, m int"), ["p"], ["g", "m"])
    one = A.sketch_rollup(stored).first()
    assert one["rows"] == 6001 and abs(one["n_p"] - 700) <= 21
    by = {r["g"]: (r["rows"], r["n_p"]) for r in A.sketch_rollup(stored, ["g"]).collect()}
    assert by["c"] == (1, 0) and abs(by["a"][1] - 700) <= 21


def test_aligned_diff_spreads_a_hot_key(spark):
    m1, m2 = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    rows = [(1, m, f"{m.month}-{i:05d}") for m in (m1, m2) for i in range(5000)] + [(k, m1, "x") for k in range(2, 200)]
    out = aligned_diff(spark.createDataFrame(rows, "k int, eom date, f string"), "k", "eom", ["f"])
    assert out.count() == 5000 and out.filter("substr(f_old, 3) = substr(f_new, 3)").count() == 5000
