import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staffwise.operators import ml
from staffwise.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_views_and_query_text(spark):
    T.register_views(spark, SF, ["orders", "customer"])
    n = T.catalog_query(spark, "SELECT count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey").first()[0]
    assert n == T.parquet_table(spark, SF, "orders").count()
    assert T.catalog_table(spark, "customer").columns[0] == "c_custkey"


def test_attrition_features(spark):
    o = T.parquet_table(spark, SF, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    f = ml.attrition_features(o, T.parquet_table(spark, SF, "customer"))
    assert f.count() > 0
    assert set(r[0] for r in f.select("active").distinct().collect()) <= {0, 1}


def test_attrition_features_send_no_customers_to_the_driver(spark, capsys, tmp_dir):
    o = spark.createDataFrame([(1, 10.0, "1-URGENT", "1997-01-01"), (2, 5.0, "5-LOW", "1995-01-01")],
                              "o_custkey long, o_totalprice double, o_orderpriority string, d string").withColumn("o_orderdate", F.to_date("d"))
    c = spark.createDataFrame([(1, 2, "BUILDING", 1.0), (2, 7, "MACHINERY", 2.0), (3, 7, "MACHINERY", 2.0)],
                              "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double")
    c.write.parquet(f"{tmp_dir}/c")  # (of a size that the planner knows)
    f = ml.attrition_features(o, spark.read.parquet(f"{tmp_dir}/c"))
    f.explain()
    assert "BroadcastExchange" not in capsys.readouterr().out
    assert sorted((r["c_custkey"], r["n_urgent"], r["active"]) for r in f.collect()) == [(1, 1, 1), (2, 0, 0)]


def features(spark):
    o = T.parquet_table(spark, SF, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return ml.attrition_features(o, T.parquet_table(spark, SF, "customer"))


def listing(spark):
    """Persons of a consolidated listing: odd ones first, then enough to fit models on."""
    base = {"eom": "2024-05-31", "active": True, "date_left": None, "source": "SF DIRECT", "flexi": False, "fund_type": "Central Provident Fund", "age": 30,
            "industry": "air", "business": "b1", "business_unit": "u1", "parent_department": "d1", "grade": "G1", "job_grade": "J1", "on_shift": False,
            "marital_status": "S", "gender_key": "F", "nationality": "n1", "employee_group": "Perm", "job": "x", "_file": "a.csv", "_row": 1}
    gone = {"active": False, "eom": "2022-02-28"}
    odd = [{}, {"_row": 2}, {"eom": "2024-04-30"}, {**gone, "date_left": "2022-01-01"}, {**gone, "date_left": "2021-12-31"}, {**gone},
           {"source": " sf direct"}, {"source": "Agency"}, {"source": None}, {"flexi": True}, {"flexi": None}, {"active": None},
           {"fund_type": "SCHEME FOR PERMANENT RESIDENT "}, {"fund_type": None}, {"marital_status": None}, {"grade": None}, {"on_shift": True, "job": " y "}]
    rng = random.Random(4)
    rows = [{**base, **o, "persno": str(1 if i < 2 else i)} for i, o in enumerate(odd)]
    for i in range(240):
        old = rng.random() < 0.5
        rows.append({**base, "persno": str(1000 + i), "age": rng.randint(50, 64) if old else rng.randint(20, 40), "grade": rng.choice(["G1", "G2"]),
                     "marital_status": rng.choice(["S", "M", None]), **({"active": False, "date_left": "2023-03-03"} if old == (rng.random() < 0.9) else {})})
    types = {"active": "boolean", "flexi": "boolean", "on_shift": "boolean", "age": "int", "_row": "long"}
    names = ["persno", *base]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"{c} {types.get(c, 'string')}" for c in names)).repartition(3)


def test_attrition_set(spark):
    got = {r["persno"]: r for r in ml.attrition_set(listing(spark).filter("int(persno) < 1000")).collect()}
    assert set(got) == {"1", "3", "6", "12", "13", "14", "16"}
    assert ml.attrition_set(listing(spark).filter("persno = '1'")).count() == 1  # equal but for the lineage columns
    assert tuple(got["1"].__fields__) == ("persno", *ml.ATTRITION_COLUMNS)
    assert [got[p]["active"] for p in ("1", "3")] == [1, 0]
    assert [got[p]["local"] for p in ("1", "12", "13")] == [1, 1, 0]
    assert got["14"]["marital_status"] == "" and got["16"]["on_shift"] == 1 and got["16"]["job"] == "y"
    assert ml.attrition_set(listing(spark).limit(0)).count() == 0


def test_attrition_models(spark, tmp_dir):
    from staffwise.plans.jobs import attrition_models

    out = attrition_models(listing(spark), f"{tmp_dir}/m", clusters=3, tune=False)
    chosen = [r for r in out["comparison"].collect() if r["chosen"]]
    assert len(chosen) == 1 and chosen[0]["test_auc"] > 0.7
    assert out["importances"].first()["feature"] == "age" or chosen[0]["model"] == "logistic"
    scored = ml.score_saved(out["set"], f"{tmp_dir}/m").collect()
    assert len(scored) == out["set"].count()
    mean = lambda a: sum(r["score"] for r in scored if r["active"] == a) / sum(r["active"] == a for r in scored)
    assert mean(1) > mean(0)
    with pytest.raises(ValueError, match="job_grade"):
        ml.score_saved(out["set"].drop("job_grade"), f"{tmp_dir}/m")
    sizes = {r["cluster"]: r["n"] for r in out["clustered"].groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    assert sizes == {r["cluster"]: r["n_rows"] for r in out["clusters"].collect() if r["n_rows"]}


def test_models(spark):
    rows = ml.classify_compare(features(spark)).collect()
    assert {"logistic", "random_forest", "gbt"} <= {r["model"] for r in rows} and any(r["model"].endswith("_tuned") for r in rows)
    chosen = [r for r in rows if r["chosen"]]
    assert len(chosen) == 1 and chosen[0]["cv_auc"] == max(r["cv_auc"] for r in rows)
    assert all((r["test_auc"] is not None) == r["chosen"] for r in rows)  # the test rows are used once
    assert rows[0]["n_train"] + rows[0]["n_test"] == features(spark).count()
    km = ml.kmeans_pick(features(spark), ks=(2, 3)).collect()
    assert [(r["k"], r["n_rows"]) for r in km] == [(2, features(spark).count()), (3, features(spark).count())]


def test_fits_run_over_few_partitions(spark, monkeypatch):
    """The partitions that a fit scans follow the rows, not the shuffle that made them."""
    from pyspark.ml.tuning import CrossValidator

    class Seen(Exception):
        pass

    def fit(self, dataset, *_):
        raise Seen(dataset.select("label").rdd.getNumPartitions())

    monkeypatch.setattr(CrossValidator, "fit", fit)
    data = spark.range(200).select("id", (F.col("id") % 2).alias("label"), F.rand(1).alias("x")).repartition(40, "id")
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        with pytest.raises(Seen) as seen:
            ml.classify_compare(data, "id", "label", [], ["x"])
        assert seen.value.args == (1,)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert ml.sized(data, 200, 5).rdd.getNumPartitions() == 40  # more rows, more tasks


def test_class_weights_for_any_number_of_classes(spark):
    df = spark.createDataFrame([(i, i % 3 if i < 9 else 0) for i in range(12)], "id int, label int")
    w = {r["label"]: r["weight"] for r in ml.with_class_weights(df).collect()}
    assert w == {0: 12 / (3 * 6), 1: 12 / (3 * 3), 2: 12 / (3 * 3)}


def test_importances_read_their_input_once(spark):
    """The work behind the features (joins, broadcasts to the driver) runs once, not for every scan of the fit."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    data = spark.range(300).select("id", (F.col("id") % 2).alias("label"), (F.col("id") % 7).cast("double").alias("x"))
    imp = ml.attrition_importances(data.mapInArrow(count, data.schema), "id", "label", [], ["x"]).collect()
    assert [r["feature"] for r in imp] == ["x"] and seen.value == 300


def test_importances_and_save(spark, tmp_dir):
    from pyspark.ml import Pipeline, PipelineModel

    data = features(spark)
    imp = ml.attrition_importances(data).collect()
    segments = {r[0] for r in data.select("segment").distinct().collect()}
    names = {r["feature"] for r in imp}
    assert {f"segment_vec_{s}" for s in segments} | set(ml.NUMERIC) <= names
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-6
    sets = ml.model_sets(data.withColumn("active", F.col("active").cast("double")), "c_custkey", "active")
    model = Pipeline(stages=[*ml.classification_stages(ml.CATEGORICAL, ml.NUMERIC), ml._models("active", 1)["logistic"]]).fit(sets)
    assert ml.feature_importances(model, model.transform(sets)).count() == len(names)
    ml.save_model(model, f"{tmp_dir}/model", sets.select("c_custkey", *ml.CATEGORICAL, *ml.NUMERIC))
    assert PipelineModel.load(f"{tmp_dir}/model/model").transform(sets).count() == sets.count()
    scored = {r["c_custkey"]: r["score"] for r in ml.score_saved(data, f"{tmp_dir}/model").collect()}
    assert scored == {r["c_custkey"]: r["probability"][1] for r in model.transform(sets).collect()}
    with pytest.raises(ValueError, match=ml.NUMERIC[0]):
        ml.score_saved(data.drop(ml.NUMERIC[0]), f"{tmp_dir}/model")
    with pytest.raises(ValueError, match="not string"):
        ml.score_saved(data.withColumn(ml.NUMERIC[0], F.lit("x")), f"{tmp_dir}/model")


def test_k_prototypes_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(c * 4, 1), None if i == 3 else rng.choice("ab" if c else "bcd"), rng.choice(["u", "v", None]), c) for i in range(90) for c in [i % 3]]
    df = spark.createDataFrame(rows, "id int, x double, g string, h string, c int").repartition(3)
    out, info = ml.k_prototypes(df, ["g", "h"], ["x"], 3, gamma=0.7)
    mean = sum(r[1] for r in rows) / 90
    dev = (sum((r[1] - mean) ** 2 for r in rows) / 90) ** 0.5
    got = {r["id"]: r["cluster"] for r in out.collect()}
    of = lambda r, m: ((r[1] - m["x"]) / dev) ** 2 + 0.7 * ((r[2] != m["g"]) + (r[3] != m["h"]))
    for r in rows:  # every row is with its nearest centre, and every centre is its rows' mean and mode
        costs = [of(r, m) for m in info]
        assert abs(costs[got[r[0]]] - min(costs)) < 1e-9
    for m in info:
        mine = [r for r in rows if got[r[0]] == m["cluster"]]
        assert m["size"] == len(mine) and abs(m["x"] - sum(r[1] for r in mine) / len(mine)) < 1e-6
        for j, c in ((2, "g"), (3, "h")):
            n = Counter(r[j] for r in mine)
            assert n[m[c]] == max(n.values())
    assert ml.k_prototypes(df.limit(0), ["g"], ["x"], 2)[0].count() == 0


def test_logistic_after_layer_depth(spark):
    # layer depth's per-round counts must leave the session usable for models that
    # keep a training summary (an Observation would make the session unserializable)
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from staffwise.operators.hierarchy import layer_depth

    edges = spark.createDataFrame([("1", None), ("2", "1"), ("3", "2"), ("4", "3")], "p string, m string")
    assert sorted(r["layer"] for r in layer_depth(edges, "p", "m", root="1").collect()) == [0, 1, 2, 3]
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, label double"))
    model = LogisticRegression(maxIter=5).fit(data)
    assert len(model.transform(data).select("prediction", "probability").collect()) == 20
