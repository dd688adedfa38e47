"""Attrition-style modelling with ``pyspark.ml`` (ML1-ML7).

Feature building is plain DataFrame work; model fitting is distributed by
``pyspark.ml``.  The only driver loops are over a fixed, small list of model
kinds / cluster counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import bool_to_int, in_list
from ..session import cut_lineage
from .clean import drop_rows_with_nulls, fill, strip_ws, trim_strings

# The columns of the attrition set, and the fund types of local staff.
ATTRITION_COLUMNS = ("active", "age", "local", "industry", "business", "business_unit", "parent_department", "grade", "job_grade", "on_shift",
                     "marital_status", "gender_key", "nationality", "employee_group", "job")
ATTRITION_CATEGORICAL = ("industry", "business", "business_unit", "parent_department", "grade", "job_grade", "marital_status", "gender_key",
                         "nationality", "employee_group", "job")
LOCAL_FUNDS = ("Central Provident Fund", "Scheme for Permanent Resident")
ATTRITION_NUMERIC = ("age", "local", "on_shift")
CLUSTER_CATEGORICAL = ("business_unit", "parent_department", "grade", "job_grade", "marital_status", "gender_key", "nationality")

# Nation keys treated as "local" for the local flag.
LOCAL_NATIONS = (1, 2)
# The columns of :func:`attrition_features` that models use.
CATEGORICAL = ("segment", "nation")
NUMERIC = ("n_orders", "total_spend", "avg_price", "n_urgent", "local", "acctbal")
TASK_ROWS = 20_000  # training rows of a task: fitting runs hundreds of short jobs over them


def attrition_features(orders: DataFrame, customer: DataFrame, horizon_days: int = 365) -> DataFrame:
    """One row per customer with activity features and the ``active`` label (ML1).

    ``active`` = 1 when the customer ordered within ``horizon_days`` of the
    latest order date in the data; flags are 0/1; rows with any null dropped.
    """
    last = orders.select(F.max("o_orderdate")).scalar()
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    per = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        (F.sum(cents) / 100).alias("total_spend"),
        (F.round(F.sum(cents) / F.count(F.lit(1))) / 100).alias("avg_price"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("n_urgent"),
        F.max("o_orderdate").alias("last_order"),
    )
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    x = per.withColumn("__last", last)
    # both sides have a row per customer: joined in the tasks that hold the totals, never sent through the driver
    x = x.join(cust.hint("shuffle_hash"), x["o_custkey"] == cust["c_custkey"], "inner")
    out = x.select(
        F.col("c_custkey"),
        "n_orders", "total_spend", "avg_price", "n_urgent",
        F.coalesce(F.col("c_nationkey").isin(list(LOCAL_NATIONS)), F.lit(False)).cast("int").alias("local"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("seg_building"),
        F.round(F.col("c_acctbal"), 2).alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"),
        (F.datediff("__last", "last_order") <= horizon_days).cast("int").alias("active"),
    )
    return out.dropna(how="any")


def attrition_set(listing: DataFrame, left_since: str = "2022-01-01", source: str = "SF Direct", id_col: str = "persno") -> DataFrame:
    """The attrition set of a consolidated listing (ML1): ``id_col``, then
    ``ATTRITION_COLUMNS``, with ``active``, ``local`` and ``on_shift`` as 0 or 1.

    Rows: the active staff of the latest ``eom`` of the whole listing, and those
    who left on or after ``left_since``, of one ``source`` and without flexi
    contracts; rows equal in every column (lineage columns aside) count once.
    Text is trimmed; ``source`` and fund types are compared without regard to
    case, since consolidation upper-cases text.  A missing marital status is an
    empty text; a row with another of the columns null is dropped, and so is one
    whose ``active`` or ``flexi`` is null.

    One scan finds the month, one takes both slices; only the slices are shuffled.
    """
    last = listing.select(F.max(F.to_date("eom"))).scalar()
    current = F.col("active") & (F.to_date("eom") == last)
    left = ~F.col("active") & (F.to_date("date_left") >= F.lit(left_since).cast("date"))
    mine = F.upper(strip_ws("source")) == source.upper()
    rows = listing.drop("_file", "_row").filter((current | left) & mine & ~F.col("flexi")).distinct()
    rows = trim_strings(rows).withColumn("local", in_list(F.upper("fund_type"), [f.upper() for f in LOCAL_FUNDS]))
    rows = rows.withColumns({c: bool_to_int(c) for c in ("active", "local", "on_shift")})
    return drop_rows_with_nulls(fill(rows, {"marital_status": ""}), ATTRITION_COLUMNS).select(id_col, *ATTRITION_COLUMNS)


def hash_share(id_col: str, parts: int, salt: str = "") -> F.Column:
    """A number from 0 to ``parts - 1`` fixed by the id: the first 8 hex digits
    of the md5 of its text (and a salt).  A split by it stays the same however
    often and wherever the input is recomputed."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(salt)).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(parts))


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight", by: Sequence[str] = ()) -> DataFrame:
    """Inverse-frequency weights so each class carries equal total weight (ML2),
    within each ``by`` group."""
    n = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("__n"))
    if by:
        total = n.groupBy(*by).agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__classes"))
        n = n.join(total, list(by))
    else:
        n = n.withColumns({"__all": df.select(F.count(F.lit(1))).scalar(), "__classes": df.select(F.count_distinct(label)).scalar()})
    w = n.select(*by, label, (F.col("__all") / (F.col("__classes") * F.col("__n"))).alias(out))
    return df.join(F.broadcast(w), [*by, label])  # a row per class


def model_sets(data: DataFrame, id_col: str, label: str, test_of: int = 4) -> DataFrame:
    """``data`` with ``part`` (``test`` for one in ``test_of`` ids, else
    ``train``), ``fold`` (0-2) and the class weights of its part."""
    part = F.when(hash_share(id_col, test_of) == 0, F.lit("test")).otherwise(F.lit("train"))
    marked = data.withColumns({"part": part, "fold": hash_share(id_col, 3, "fold").cast("int")})
    return with_class_weights(marked, label, by=["part"])


def kept_sets(data: DataFrame, id_col: str, label: str) -> tuple[DataFrame, dict[str, int]]:
    """:func:`model_sets` with a numeric label, written once, and the number of rows of each part.

    Fitting scans them again and again; the work behind ``data`` (its joins and
    broadcasts) and the weights run once, however many scans follow."""
    rows = cut_lineage(data.withColumn(label, F.col(label).cast("double")), "model-rows")
    return cut_lineage(model_sets(rows, id_col, label), "model-sets",
                       {p: F.count_if(F.col("part") == p) for p in ("train", "test")})


def sized(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` of so many rows in a number of partitions that follows them, not the shuffle that made them."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def classification_stages(categorical: Sequence[str], numeric: Sequence[str]):
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    # (a slot needs a name, so an empty text becomes one)
    texts = ", ".join(f"CASE WHEN `{c}` = '' THEN '(empty)' ELSE `{c}` END AS `{c}_text`" for c in categorical)
    named = SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__")
    idx = [StringIndexer(inputCol=f"{c}_text", outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_vec" for c in categorical], handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_vec" for c in categorical] + list(numeric), outputCol="features")
    return [named, *idx, enc, asm] if categorical else [asm]


def _models(label: str, seed: int) -> dict:
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

    return {
        "logistic": LogisticRegression(labelCol=label, weightCol="weight", maxIter=30),
        "random_forest": RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=20, seed=seed),
        "gbt": GBTClassifier(labelCol=label, weightCol="weight", maxIter=8, maxDepth=4, seed=seed),
    }


def _grid(name: str, est):
    from pyspark.ml.tuning import ParamGridBuilder

    grid = ParamGridBuilder()
    return (grid.addGrid(est.regParam, [0.01, 0.1]) if name == "logistic" else grid.addGrid(est.maxDepth, [3, 6])).build()


def classify_compare(data: DataFrame, id_col: str = "c_custkey", label: str = "active", categorical: Sequence[str] = CATEGORICAL,
                     numeric: Sequence[str] = NUMERIC, seed: int = 7, tune: bool = True) -> DataFrame:
    """The table of :func:`choose_classifier` (ML2-ML4)."""
    return choose_classifier(data, id_col, label, categorical, numeric, seed, tune)[0]


def choose_classifier(data: DataFrame, id_col: str = "c_custkey", label: str = "active", categorical: Sequence[str] = CATEGORICAL,
                      numeric: Sequence[str] = NUMERIC, seed: int = 7, tune: bool = True):
    """Compare classifiers on a feature table (ML2-ML4): one row per model,
    ``model, cv_auc, chosen, test_auc, n_train, n_test``; and the chosen
    model, as one fitted pipeline from the columns of ``data`` to predictions.

    The training rows alone choose: every model, and then the tuned settings
    of the best one, are judged by three-fold cross-validation, and a tuned
    model is chosen only if its cross-validated AUC is higher.  The test rows
    are used once, for the chosen model; ``test_auc`` is null for the others.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    spark = data.sparkSession
    sets, size = kept_sets(data, id_col, label)
    train, test = (sized(sets.filter(F.col("part") == p), size[p]) for p in ("train", "test"))
    # indexing and encoding look at no label: fitted once on the training rows, whose vectors all folds share
    prepare = Pipeline(stages=classification_stages(categorical, numeric)).fit(train)
    vectors = prepare.transform(train).select("features", label, "weight", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")

    def validated(name, grid):
        est = _models(label, seed)[name]
        return CrossValidator(estimator=est, evaluator=ev, estimatorParamMaps=grid(est), numFolds=3, foldCol="fold", parallelism=2).fit(vectors)

    # the fixed list of model kinds is judged concurrently: each fit is its own set of Spark jobs
    names = list(_models(label, seed))
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        fitted = dict(zip(names, pool.map(lambda n: validated(n, lambda est: ParamGridBuilder().build()), names)))
    auc = {n: float(m.avgMetrics[0]) for n, m in fitted.items()}
    best = max(auc, key=lambda n: (auc[n], n))
    model = fitted[best].bestModel
    if tune:
        tuned = validated(best, lambda est: _grid(best, est))
        auc[f"{best}_tuned"] = float(max(tuned.avgMetrics))
        if auc[f"{best}_tuned"] > auc[best]:
            best, model = f"{best}_tuned", tuned.bestModel
    test_auc = float(ev.evaluate(model.transform(prepare.transform(test))))
    vectors.unpersist()
    rows = [(n, a, n == best, test_auc if n == best else None, size["train"], size["test"]) for n, a in auc.items()]
    table = spark.createDataFrame(rows, "model string, cv_auc double, chosen boolean, test_auc double, n_train long, n_test long")
    return table, PipelineModel(stages=[*prepare.stages, model])


def feature_names(transformed: DataFrame, features: str = "features") -> list[str]:
    """The name of every slot of a feature vector, one-hot slots included."""
    groups = transformed.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for g in groups.values() for a in g)
    assert [i for i, _ in slots] == list(range(len(slots)))
    return [n for _, n in slots]


def feature_importances(model, transformed: DataFrame) -> DataFrame:
    """``(feature, importance)`` for every slot of a fitted pipeline's last
    stage (ML5): a tree model's importances, a linear one's absolute weights."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    names = feature_names(transformed)
    if len(names) != len(values):
        raise ValueError(f"{len(values)} importances for {len(names)} features")
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return transformed.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def attrition_importances(data: DataFrame, id_col: str = "c_custkey", label: str = "active", categorical: Sequence[str] = CATEGORICAL,
                          numeric: Sequence[str] = NUMERIC, seed: int = 7) -> DataFrame:
    """Importances of a random forest fitted on the training rows (ML5)."""
    from pyspark.ml import Pipeline

    sets, size = kept_sets(data, id_col, label)
    train = sized(sets.filter("part = 'train'"), size["train"])
    model = Pipeline(stages=[*classification_stages(categorical, numeric), _models(label, seed)["random_forest"]]).fit(train)
    return feature_importances(model, model.transform(train))


def save_model(model, path: str, inputs: DataFrame | None = None) -> None:
    """Persist a fitted pipeline (ML6); ``path`` should be on shared storage.

    ``inputs`` (the table it was fitted on, or the columns to ask for) adds a
    signature, the names and types that :func:`score_saved` checks."""
    model.write().overwrite().save(f"{path}/model")
    if inputs is not None:
        rows = [(f.name, f.dataType.simpleString()) for f in inputs.schema.fields]
        inputs.sparkSession.createDataFrame(rows, "name string, type string").coalesce(1).write.mode("overwrite").json(f"{path}/signature")


def load_model(spark, path: str):
    """The pipeline that :func:`save_model` wrote, and its signature ({name: type}, or None)."""
    from pyspark.ml import PipelineModel

    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/signature")
    known = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    signature = {r["name"]: r["type"] for r in spark.read.schema("name string, type string").json(f"{path}/signature").collect()} if known else None
    return PipelineModel.load(f"{path}/model"), signature


def score_saved(df: DataFrame, path: str, out: str = "score") -> DataFrame:
    """``df`` with ``out``, the saved model's probability of class 1 (ML6).

    A column of the signature that ``df`` lacks, or has in another type than a
    number for a number or text for text, raises with its name before any job runs.
    """
    from pyspark.ml.functions import vector_to_array

    model, signature = load_model(df.sparkSession, path)
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kind = lambda t: "number" if t.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal") else t
    for name, t in (signature or {}).items():
        if name not in have:
            raise ValueError(f"the model needs the column {name} ({t})")
        if kind(have[name]) != kind(t):
            raise ValueError(f"the model needs the column {name} as {t}, not {have[name]}")
    scored = model.transform(df).withColumn(out, F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*[c for c in df.columns if c != out], out)


def k_prototypes(data: DataFrame, categorical: Sequence[str], numeric: Sequence[str], k: int, gamma: float = 0.5, max_rounds: int = 30,
                 seed: int = 7) -> tuple[DataFrame, list[dict]]:
    """Clusters of rows with numbers and categories (ML7): ``data`` with
    ``cluster``, and one dict per cluster: its ``size``, ``cost`` and centre.

    The distance of a row to a centre is the squared difference of its
    standardised numbers plus ``gamma`` for every category that differs;
    centres are means and most frequent categories (ties: the first in
    order).  No category becomes a vector.  The rows are written once; each
    round is one scan of them: rows take the nearest centre (ties: the first),
    and counts per cluster, column and value, made before the shuffle, give
    the next centres; only those reach the driver.  The first
    centres are the ``k`` distinct rows with the smallest seeded hash.  Stops
    when the centres stay, or after ``max_rounds``.  Null numbers count as the
    mean, null categories as a category of their own; a cluster that loses
    its last row keeps its centre.
    """
    stats = data.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = [stats[f"m{i}"] or 0.0 for i in range(len(numeric))]
    scale = [stats[f"s{i}"] or 1.0 for i in range(len(numeric))]
    x = [F.coalesce((F.col(c).cast("double") - m) / s, F.lit(0.0)).alias(f"__x{i}") for i, (c, m, s) in enumerate(zip(numeric, mean, scale))]
    g = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"__g{i}") for i, c in enumerate(categorical)]
    names = [f"__x{i}" for i in range(len(x))] + [f"__g{i}" for i in range(len(g))]
    rows = cut_lineage(data.select("*", *x, *g), "k-prototypes")
    first = rows.select(*names).distinct().orderBy(F.xxhash64(F.lit(seed), *names), *names).limit(k).collect()
    centres = [tuple(r) for r in first]

    def cost(centre):
        num = [(F.col(n) - F.lit(v)) * (F.col(n) - F.lit(v)) for n, v in zip(names[:len(x)], centre)]
        cat = [F.when(F.col(n) != v, F.lit(gamma)).otherwise(F.lit(0.0)) for n, v in zip(names[len(x):], centre[len(x):])]
        return sum([*num, *cat], F.lit(0.0))

    def nearest(df):
        costs = F.array(*[cost(c) for c in centres])
        return df.withColumn("__costs", costs).withColumns({"__cost": F.array_min("__costs"), "cluster": (F.array_position("__costs", F.array_min("__costs")) - 1).cast("int")})

    sizes: dict[int, tuple] = {}
    for _ in range(max_rounds):
        if not centres:
            break
        # slot -1 is the row itself, the others its categories
        slots = F.array(F.struct(F.lit(-1).alias("i"), F.lit("").alias("v")),
                        *[F.struct(F.lit(i).alias("i"), F.col(n).alias("v")) for i, n in enumerate(names[len(x):])])
        own = lambda n: F.sum(F.when(F.col("slot.i") == -1, F.col(n))).alias(n)
        values = (nearest(rows).select("cluster", "__cost", *names[:len(x)], F.explode(slots).alias("slot"))
                  .groupBy("cluster", F.col("slot.i").alias("i"), F.col("slot.v").alias("v"))
                  .agg(F.count(F.lit(1)).alias("n"), *[own(n) for n in ["__cost", *names[:len(x)]]]))
        found = values.groupBy("cluster", "i").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v"), F.sum("n").alias("n"),
                                                   *[F.sum(n).alias(n) for n in ["__cost", *names[:len(x)]]]).collect()
        new = [list(c) for c in centres]
        sizes = {}
        for r in found:
            if r["i"] < 0:
                sizes[r["cluster"]] = (r["n"], r["__cost"])
                new[r["cluster"]][:len(x)] = [r[n] / r["n"] for n in names[:len(x)]]
            else:
                new[r["cluster"]][len(x) + r["i"]] = r["v"]
        new = [tuple(c) for c in new]
        if all(p[len(x):] == q[len(x):] and all(abs(a - b) < 1e-9 for a, b in zip(p[:len(x)], q[:len(x)])) for p, q in zip(centres, new)):
            break
        centres = new
    out = nearest(rows).select(*data.columns, "cluster") if centres else data.withColumn("cluster", F.lit(None).cast("int"))
    info = [{"cluster": i, "size": sizes.get(i, (0, 0.0))[0], "cost": sizes.get(i, (0, 0.0))[1],
             **{c: v * s + m for c, v, s, m in zip(numeric, centre, scale, mean)},
             **{c: None if v == "\0" else v for c, v in zip(categorical, centre[len(x):])}} for i, centre in enumerate(centres)]
    return out, info


def kmeans_pick(data: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC,
                ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = 7) -> DataFrame:
    """One-hot and standardise the features of all rows, fit k-means for each
    k, report silhouette and row count (ML7)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import StandardScaler

    # (k-means is the same without the means taken off, and one-hot slots stay sparse)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=False)
    prepared = Pipeline(stages=[*classification_stages(categorical, numeric), scaler]).fit(data).transform(data).select("scaled").cache()

    def fit_and_score(k):
        model = KMeans(k=k, seed=seed, featuresCol="scaled").fit(prepared)
        return int(k), float(ClusteringEvaluator(featuresCol="scaled").evaluate(model.transform(prepared))), model.summary.trainingCost

    # the fixed list of cluster counts is fitted concurrently over the cached vectors
    with ThreadPoolExecutor(max_workers=min(len(ks), 4)) as pool:
        rows = [(k, s, float(c)) for k, s, c in pool.map(fit_and_score, ks)]
    n = prepared.count()
    prepared.unpersist()
    return data.sparkSession.createDataFrame([(k, s, c, n) for k, s, c in rows], "k int, silhouette double, cost double, n_rows long")
