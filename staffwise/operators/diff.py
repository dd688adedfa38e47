"""Snapshot-to-snapshot change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .agg import prefix_counts


def snapshot_pairs(df: DataFrame, date_col: str) -> DataFrame:
    """``(date, __next)``: each existing snapshot date and the next one.

    A ``date`` column is bounded by the calendar (at most 3,652,059 dates in
    years 1-9999), so its distinct values are ranked in one window and the
    pairs broadcast: under 60 MB at the bound, one row per snapshot in
    practice.  Any other type is unbounded: its distinct values get their
    positions from range-partitioned prefix counts, and each is joined to the
    following position.
    """
    snaps = df.select(date_col).filter(F.col(date_col).isNotNull()).distinct()
    if isinstance(df.schema[date_col].dataType, T.DateType):
        nxt = snaps.withColumn("__next", F.lead(date_col).over(Window.orderBy(date_col)))
        return F.broadcast(nxt.filter(F.col("__next").isNotNull()))
    placed = prefix_counts(snaps.withColumn("__one", F.lit(1)), [], [date_col], "__one", "snapshots")
    a = placed.select(date_col, (F.col("__start") + 1).alias("__at"))
    b = placed.select(F.col(date_col).alias("__next"), F.col("__start").alias("__at"))
    return a.join(b, "__at").select(date_col, "__next")


def _key_eq(a, b, null_safe: bool):
    return a.eqNullSafe(b) if null_safe else a == b


def snapshot_diff(df: DataFrame, key: str, date_col: str, fields: Sequence[str], null_safe: bool = False,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Field changes between adjacent existing snapshots for keys present in both.

    Output: ``key, <date>_old, <date>, field, change``, ``<c>_old, <c>_new``
    for each field and each ``carry`` column, then ``n_old, n_new``.  Keys
    that enter or leave give no row; unchanged fields give no row.

    * A key with one distinct row in each of the two snapshots (the data
      model): the rows are compared field by field; ``change`` is ``added``
      (null -> value), ``deleted`` (value -> null) or ``modified``.  A
      ``carry`` column comes along where the row's copies agree on it (else it
      is null).  ``n_old`` / ``n_new`` are the rows' copies.  Rows are
      distinct by ``key``, the date and ``fields`` only.
    * A key that repeats in either snapshot, however often: pairing its rows
      would be quadratic, so each field's values are compared as multisets.
      One row per distinct value whose count differs: ``value_added``,
      ``value_removed`` or ``value_count``, the value in ``<f>_old`` (if
      ``n_old > 0``) and ``<f>_new`` (if ``n_new > 0``).  Every pair count
      follows from these counts.  ``carry`` columns are null, since a value
      has no one row.

    Plan: the distinct rows are written once (shared checkpoint folder), with
    their copies; one partial aggregate per (key, snapshot) counts them and
    keeps one; one join of each such row to the key's next-snapshot row (never
    more than one partner) gives the first form.  Only when some key repeats
    within a snapshot (checked by one small job), one join of the rows to
    their (key, snapshot) group and one aggregate per value give the second.
    """
    fields, carry = list(fields), [c for c in carry if c not in (key, date_col, *fields)]
    shown = fields + carry
    d = df.filter(F.col(date_col).isNotNull())
    if not null_safe:
        d = d.filter(F.col(key).isNotNull())
    # a carried column never changes the form: it comes along where all rows with these fields agree on it
    agreed = [F.when(F.min(c).eqNullSafe(F.max(c)) & F.count(c).isin(F.lit(0), F.count(F.lit(1))), F.max(c)).alias(c) for c in carry]
    d = cut_lineage(d.groupBy(key, date_col, *fields).agg(F.count(F.lit(1)).alias("__copies"), *agreed), "diff-rows")
    row = F.struct(*[F.col(c) for c in shown], F.col("__copies"))
    per = d.groupBy(key, date_col).agg(F.count(F.lit(1)).alias("__nd"), F.min(row).alias("__row"))
    pairs = snapshot_pairs(per, date_col)
    po = per.join(pairs, on=date_col).select(
        F.col(key).alias("__k"), F.col(date_col).alias(f"{date_col}_old"), F.col("__next"),
        F.col("__nd").alias("__ndo"), F.col("__row").alias("__ro"))
    pn = per.select(F.col(key).alias("__nk"), F.col(date_col), F.col("__nd").alias("__ndn"),
                    F.col("__row").alias("__rn"))
    g = po.join(pn, _key_eq(po["__k"], pn["__nk"], null_safe) & (po["__next"] == pn[date_col]), "inner")
    single = (F.col("__ndo") == 1) & (F.col("__ndn") == 1)

    changes = []
    for f in fields:
        o, n = F.col(f"__ro.{f}"), F.col(f"__rn.{f}")
        kind = (F.when(o.isNull() & n.isNotNull(), F.lit("added"))
                .when(o.isNotNull() & n.isNull(), F.lit("deleted"))
                .when(o.isNotNull() & n.isNotNull() & (o != n), F.lit("modified")))
        changes.append(F.struct(F.lit(f).alias("field"), kind.alias("change")))
    out = (g.filter(single).select("*", F.explode(F.array(*changes)).alias("__c"))
           .filter(F.col("__c.change").isNotNull())
           .select(F.col("__k").alias(key), f"{date_col}_old", date_col,
                   F.col("__c.field").alias("field"), F.col("__c.change").alias("change"),
                   *[x for c in shown for x in (F.col(f"__ro.{c}").alias(f"{c}_old"), F.col(f"__rn.{c}").alias(f"{c}_new"))],
                   F.col("__ro.__copies").alias("n_old"), F.col("__rn.__copies").alias("n_new")))
    # does any (key, snapshot) hold several distinct rows?  If not, the result is complete here
    if not per.filter(F.col("__nd") > 1).limit(1).count():
        return out

    # repeated keys: tag every row of such a group with its role (old / new side)
    roles = g.filter(~single).select(
        "__k", F.col(f"{date_col}_old").alias("__do"), F.col(date_col).alias("__dn")).select("*", F.explode(F.array(
            F.struct(F.lit("old").alias("role"), F.col("__do").alias("at")),
            F.struct(F.lit("new").alias("role"), F.col("__dn").alias("at")))).alias("__r"))
    tagged = d.join(roles, _key_eq(d[key], roles["__k"], null_safe) & (d[date_col] == roles["__r.at"]), "inner").select(
        "__k", "__do", "__dn", F.col("__r.role").alias("__role"), "__copies", *fields)
    # per field, distinct values counted on each side (one aggregate)
    types = {c: d.schema[c].dataType for c in shown}
    per_field = F.array(*[F.struct(
        F.lit(f).alias("field"), F.to_json(F.struct(F.col(f).alias("v"))).alias("vk"),
        *[(F.col(h) if h == f else F.lit(None).cast(types[h])).alias(h) for h in fields]) for f in fields])
    long = tagged.select("__k", "__do", "__dn", "__role", "__copies", F.explode(per_field).alias("__v"))
    is_old = F.col("__role") == "old"
    counted = long.groupBy("__k", "__do", "__dn", F.col("__v.field").alias("field"), F.col("__v.vk").alias("__vk")).agg(
        F.sum(F.when(is_old, F.col("__copies")).otherwise(F.lit(0))).alias("n_old"),
        F.sum(F.when(~is_old, F.col("__copies")).otherwise(F.lit(0))).alias("n_new"),
        *[F.first(F.col(f"__v.{f}"), ignorenulls=True).alias(f"__val_{f}") for f in fields])
    value = {f: F.col(f"__val_{f}") for f in fields} | {c: F.lit(None).cast(types[c]) for c in carry}
    values = counted.filter(F.col("n_old") != F.col("n_new")).select(
        F.col("__k").alias(key), F.col("__do").alias(f"{date_col}_old"), F.col("__dn").alias(date_col), "field",
        F.when(F.col("n_old") == 0, F.lit("value_added")).when(F.col("n_new") == 0, F.lit("value_removed"))
        .otherwise(F.lit("value_count")).alias("change"),
        *[x for c in shown for x in (F.when(F.col("n_old") > 0, value[c]).alias(f"{c}_old"),
                                     F.when(F.col("n_new") > 0, value[c]).alias(f"{c}_new"))],
        "n_old", "n_new")
    return out.unionByName(values)


def aligned_diff(df: DataFrame, key: str, date_col: str, fields: Sequence[str], carry: Sequence[str] = (), order: Sequence[str] = (),
                 null_safe: bool = False) -> DataFrame:
    """Field changes between adjacent existing snapshots, with the rows of a
    repeated key paired one to one.

    Rows of a key that are equal in ``fields`` on both sides are taken away
    first, copy by copy (in the order of ``carry``).  The others are ranked
    inside (key, snapshot) by ``order``, then ``fields``, then ``carry``, and
    joined rank to rank.  Output: ``key, <date>_old, <date>, field, change,
    <c>_old, <c>_new`` for each field and carried column: ``added``,
    ``deleted`` or ``modified`` for every differing field of a pair, and one
    row with a null field, ``row_removed`` or ``row_added``, for a row without
    a partner.  Keys that enter or leave give no row.

    Linear in the rows whatever the size of a group: positions come from
    range-partitioned prefix counts, so a key that holds most rows is spread
    over tasks, and the join is on (key, snapshots, rank).
    """
    fields = list(fields)
    carry = [c for c in carry if c not in (key, date_col, *fields)]
    shown = fields + carry
    by = ["__k", "__do", "__dn", "__role"]
    d = df.filter(F.col(date_col).isNotNull())
    if not null_safe:
        d = d.filter(F.col(key).isNotNull())
    d = cut_lineage(d.groupBy(key, date_col, *shown).agg(F.count(F.lit(1)).alias("__copies")), "diff-rows")
    per = d.select(F.col(key).alias("__k"), F.col(date_col).alias("__at")).distinct()
    old = per.join(snapshot_pairs(per.withColumnRenamed("__at", date_col), date_col).withColumnRenamed(date_col, "__at"), "__at")
    new = per.toDF("__k2", "__at2")
    both = old.join(new, _key_eq(F.col("__k"), F.col("__k2"), null_safe) & (F.col("__next") == F.col("__at2"))).select(
        "__k", F.col("__at").alias("__do"), F.col("__next").alias("__dn"))
    role = F.explode(F.array(F.struct(F.lit(0).alias("role"), F.col("__do").alias("at")), F.struct(F.lit(1).alias("role"), F.col("__dn").alias("at"))))
    sides = both.select("*", role.alias("__r")).select("__k", "__do", "__dn", F.col("__r.role").alias("__role"), F.col("__r.at").alias("__at"))
    rows = (d.join(sides, _key_eq(d[key], F.col("__k"), null_safe) & (d[date_col] == F.col("__at")))
            .select(*by, *shown, "__copies", F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})).alias("__same")))
    # take equal rows away: as many as both sides have, the first ones of each side
    rows = prefix_counts(rows, [*by, "__same"], carry or ["__copies"], "__copies", "diff-equal").drop("__n")
    side = lambda r: F.sum(F.when(F.col("__role") == r, F.col("__copies")).otherwise(0))
    common = (rows.groupBy("__k", "__do", "__dn", "__same").agg(F.least(side(0), side(1)).alias("__common"))
              .toDF("__ck", "__cdo", "__cdn", "__csame", "__common"))
    on = (F.col("__k").eqNullSafe(F.col("__ck")) & (F.col("__do") == F.col("__cdo")) & (F.col("__dn") == F.col("__cdn")) & (F.col("__same") == F.col("__csame")))
    gone = F.least(F.col("__copies"), F.greatest(F.lit(0), F.col("__common") - F.col("__start")))
    rest = (rows.join(common, on).withColumn("__left", F.col("__copies") - gone).filter("__left > 0").select(*by, *shown, "__left"))
    ranked = prefix_counts(rest, by, [*order, *[c for c in shown if c not in order]], "__left", "diff-ranks")
    ranked = ranked.select("*", F.explode(F.sequence(F.col("__start"), F.col("__start") + F.col("__left") - 1)).alias("__rank"))
    row = F.struct(*[F.col(c) for c in shown])
    a = ranked.filter("__role = 0").select("__k", "__do", "__dn", "__rank", row.alias("__ro"))
    b = ranked.filter("__role = 1").select(F.col("__k").alias("__k2"), F.col("__do").alias("__do2"), F.col("__dn").alias("__dn2"), F.col("__rank").alias("__rank2"), row.alias("__rn"))
    pair = a.join(b, F.col("__k").eqNullSafe(F.col("__k2")) & (F.col("__do") == F.col("__do2")) & (F.col("__dn") == F.col("__dn2"))
                  & (F.col("__rank") == F.col("__rank2")), "full")
    changes = []
    for f in fields:
        o, n = F.col(f"__ro.`{f}`"), F.col(f"__rn.`{f}`")
        kind = F.when(o.isNull() & n.isNotNull(), F.lit("added")).when(o.isNotNull() & n.isNull(), F.lit("deleted")).when(o != n, F.lit("modified"))
        changes.append(F.struct(F.lit(f).alias("field"), kind.alias("change")))
    alone = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.when(F.col("__rn").isNull(), F.lit("row_removed")).otherwise(F.lit("row_added")).alias("change")))
    paired = F.col("__ro").isNotNull() & F.col("__rn").isNotNull()
    return (pair.select("*", F.explode(F.when(paired, F.array(*changes)).otherwise(alone)).alias("__c")).filter("__c.change IS NOT NULL")
            .select(F.coalesce("__k", "__k2").alias(key), F.coalesce("__do", "__do2").alias(f"{date_col}_old"), F.coalesce("__dn", "__dn2").alias(date_col),
                    F.col("__c.field").alias("field"), F.col("__c.change").alias("change"),
                    *[x for c in shown for x in (F.col(f"__ro.`{c}`").alias(f"{c}_old"), F.col(f"__rn.`{c}`").alias(f"{c}_new"))]))
