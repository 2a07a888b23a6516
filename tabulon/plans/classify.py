"""Classification: parsing, priors, evaluation measures, trees and forests
(fixtures F-labeled, F-mixed)."""

from __future__ import annotations

from functools import partial

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.rng import duck_uniform_sql
from tabulon.functions.vectors import as_double_array
from tabulon.operators import evaluate as EV
from tabulon.operators import ml as ML
from tabulon.operators.sampling import random_split
from tabulon.plans import duck
from tabulon.plans import fixtures as fx
from tabulon.session import at_once, cut, submitted

SPLIT_SEED = 31
WEIGHTS = [0.8, 0.1, 0.1]
CATEGORICALS = ["l_returnflag", "l_linestatus", "p_brand"]
# Deep trees: each row keeps its nodes instead of each task all trees. A task
# holds the statistics of the nodes of one pass: 256 MB for one tree, whose
# splits don't depend on the passes; a forest draws the features of its nodes
# in their order
PASSES = {"maxMemoryInMB": 256, "cacheNodeIds": True, "checkpointInterval": 10}
FOREST_PASSES = PASSES | {"maxMemoryInMB": 1024}
FITS_AT_ONCE = 2  # trees grown together, whose nodes the driver holds


def numeric_csv_lines(spark, sf_dir) -> DataFrame:
    """Headerless CSV: 64 numeric fields then the label + 1 (labels 1..K)."""
    d = fx.labeled(spark, sf_dir)
    fields = F.transform(as_double_array("embedding"), lambda x: x.cast("string"))
    return d.select(F.concat_ws(",", F.col("vec_id").cast("string"), F.array_join(fields, ","),
                                (F.col("label") + 1).cast("string")).alias("value"))


def parse_numeric_csv(lines: DataFrame) -> DataFrame:
    """All-double CSV lines: first field an id, last the label minus one."""
    f = F.transform(F.split("value", ","), lambda x: x.try_cast("double"))
    n = F.size(f)
    return lines.select(F.element_at(f, 1).cast("bigint").alias("vec_id"),
                        (F.element_at(f, -1) - 1.0).alias("label"),
                        F.slice(f, 2, n - 2).alias("features"))


def splits(spark, sf_dir) -> DataFrame:
    return random_split(fx.labeled(spark, sf_dir), WEIGHTS, SPLIT_SEED, ["vec_id"])


def label_centres(df: DataFrame) -> list[list[float]]:
    """Mean vector per label, in label order (10 x 64 numbers: model state)."""
    e = df.select("label", F.posexplode(as_double_array("embedding")).alias("pos", "x"))
    m = e.groupBy("label", "pos").agg(F.avg("x").alias("m"))
    rows = m.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("c")).orderBy("label").collect()
    return [[float(s["m"]) for s in r["c"]] for r in rows], [float(r["label"]) for r in rows]


def nearest_mean_predictions(spark, sf_dir) -> DataFrame:
    """(vec_id, label, prediction) on the test part: label of the nearest
    training label-mean (a fixed rule with an exact SQL statement)."""
    s = splits(spark, sf_dir).withColumn("x", as_double_array("embedding"))
    centres, labels = label_centres(s.where("part = 0"))
    a = ML.cluster_assign(s.where("part = 2"), "x", centres)
    lab = F.array(*[F.lit(v) for v in labels])
    return a.select("vec_id", "label", F.element_at(lab, F.col("cluster") + 1).alias("prediction"))


def q_scan_numeric_csv(spark, sf_dir):
    p = parse_numeric_csv(numeric_csv_lines(spark, sf_dir))
    return p.select("vec_id", "label", F.transform("features", lambda x: F.round(x, 6)).alias("features"))


def q_union_all(spark, sf_dir):
    s = splits(spark, sf_dir)
    return s.where("part = 0").unionByName(s.where("part = 1")).select("vec_id", "label")


def q_class_priors(spark, sf_dir):
    t = splits(spark, sf_dir).where("part = 0")
    return EV.class_priors(t).select("label", F.round("prior", 6).alias("prior"))


def q_random_guess_accuracy(spark, sf_dir):
    s = splits(spark, sf_dir)
    r = EV.random_guess_accuracy(s.where("part = 0"), s.where("part = 1"))
    return r.select(F.round("accuracy", 6).alias("accuracy"))


def q_predictions_with_labels(spark, sf_dir):
    return nearest_mean_predictions(spark, sf_dir)


def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(nearest_mean_predictions(spark, sf_dir))


def q_accuracy(spark, sf_dir):
    a = EV.accuracy(nearest_mean_predictions(spark, sf_dir))
    return a.select(F.round("accuracy", 6).alias("accuracy"), "n")


def q_precision_recall_by_class(spark, sf_dir):
    p = EV.precision_recall_by_class(nearest_mean_predictions(spark, sf_dir))
    return p.select("cls", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
                    "tp", "predicted", "actual")


def mixed_features(spark, sf_dir):
    m = fx.mixed(spark, sf_dir)
    return ML.one_hot_features(m, ["l_quantity"], CATEGORICALS, ["l_extendedprice", "l_discount", "l_tax"])


def q_one_hot(spark, sf_dir):
    f, _cats = mixed_features(spark, sf_dir)
    return f.select("l_orderkey", "l_linenumber", F.transform("features", lambda x: F.round(x, 6)).alias("features"))


def q_un_one_hot(spark, sf_dir):
    f, cats = mixed_features(spark, sf_dir)
    n_flag, n_status, n_brand = (len(cats[c]) for c in CATEGORICALS)
    return f.select("l_orderkey", "l_linenumber",
                    ML.un_one_hot("features", 1, n_flag).alias("flag_idx"),
                    ML.un_one_hot("features", 1 + n_flag + n_status, n_brand).alias("brand_idx"))


def q_drop_columns(spark, sf_dir):
    return fx.mixed(spark, sf_dir).drop(*CATEGORICALS)


def q_project_fields(spark, sf_dir):
    m = fx.mixed(spark, sf_dir)
    return m.select("l_orderkey", F.col("l_quantity").cast("int").alias("qty"), F.col("label").alias("kind"))


def _vec(df):
    return df.withColumn("features", array_to_vector(as_double_array("embedding")))


def q_tree_fit(spark, sf_dir):
    s = _vec(splits(spark, sf_dir))
    m = DecisionTreeClassifier(impurity="gini", maxDepth=4, maxBins=100).fit(s.where("part = 0"))
    pred = m.transform(s.where("part = 1"))
    return EV.confusion_matrix(pred)


def in_order(spark, train: DataFrame, jobs: list) -> list:
    """The rows of the functions ``jobs``, in their order. The fits of a table
    that lies in few tasks share the cores; the last jobs, which grow the
    deepest trees, begin first."""
    found = submitted(spark, jobs[::-1], min(FITS_AT_ONCE, at_once(train)))
    return [row for rows in found[::-1] for row in rows]


def q_tree_grid(spark, sf_dir):
    s = cut(_vec(splits(spark, sf_dir)))
    train, cv, test = (s.where(f"part = {i}") for i in range(3))
    both = train.unionByName(cv)

    def scored(imp, depth, bins):
        m = DecisionTreeClassifier(impurity=imp, maxDepth=depth, maxBins=bins, **PASSES).fit(train)
        return [(imp, depth, bins, float(EV.accuracy(m.transform(cv)).first()["accuracy"]))]

    def final():
        m = DecisionTreeClassifier(impurity="entropy", maxDepth=20, maxBins=300, **PASSES).fit(both)
        return [(name, 20, 300, float(EV.accuracy(m.transform(d)).first()["accuracy"]))
                for name, d in (("final-test", test), ("final-train", both))]

    grid = [(imp, depth, bins) for imp in ("gini", "entropy") for depth in (1, 20) for bins in (10, 300)]
    rows = in_order(spark, train, [partial(scored, *p) for p in grid] + [final])
    return spark.createDataFrame(rows, "impurity STRING, depth INT, bins INT, accuracy DOUBLE").orderBy(F.desc("accuracy"))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def nominal_rows(spark, sf_dir):
    """Flag and brand as category numbers out of their one-hot blocks, the
    numeric columns, and the label as a number: (rows, categories of each
    nominal column, labels)."""
    f, cats = mixed_features(spark, sf_dir)
    n_flag, n_status, n_brand = (len(cats[c]) for c in CATEGORICALS)
    d = f.select(ML.un_one_hot("features", 1, n_flag).cast("double").alias("flag"),
                 ML.un_one_hot("features", 1 + n_flag + n_status, n_brand).cast("double").alias("brand"),
                 *NUMERIC, "label", "l_orderkey", "l_linenumber")
    from pyspark.ml.feature import StringIndexer
    indexer = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(d)
    return indexer.transform(d), {"flag": n_flag, "brand": n_brand}, list(indexer.labels)


def q_tree_grid_categorical(spark, sf_dir):
    d, nominal, _ = nominal_rows(spark, sf_dir)
    n_brand = nominal["brand"]
    d = random_split(ML.nominal_vector(d, nominal, NUMERIC), WEIGHTS, SPLIT_SEED, ["l_orderkey", "l_linenumber"])
    d = ML.mark_nominal(cut(d), nominal, NUMERIC)
    train, cv, test = (d.where(f"part = {i}") for i in range(3))
    both = train.unionByName(cv)

    def scored(name, fitted, on, imp, depth, bins):
        m = DecisionTreeClassifier(impurity=imp, maxDepth=depth, maxBins=max(bins, n_brand), labelCol="y", **PASSES).fit(fitted)
        return [(name, depth, bins, *(float(EV.accuracy(m.transform(x), "y").first()["accuracy"]) for x in (fitted, on)))]

    grid = [(imp, depth, bins) for imp in ("gini", "entropy") for depth in (10, 20, 30) for bins in (40, 300)]
    jobs = [partial(scored, p[0], train, cv, *p) for p in grid]
    # the fixed refit on both parts, scored on the held-out test part
    jobs.append(partial(scored, "final-test", both, test, "entropy", 30, 300))
    rows = in_order(spark, train, jobs)
    return spark.createDataFrame(rows, "impurity STRING, depth INT, bins INT, train_accuracy DOUBLE, cv_accuracy DOUBLE") \
                .orderBy(F.desc("cv_accuracy"))


def q_forest_fit_predict(spark, sf_dir):
    """A forest of 20 trees on nominal and numeric features, trained on 0.9
    and judged on 0.1 of the rows beside random guessing by the priors, and
    the class of one given vector (the smallest row's features)."""
    d, nominal, labels = nominal_rows(spark, sf_dir)
    d = random_split(ML.nominal_vector(d, nominal, NUMERIC), [0.9, 0.1], SPLIT_SEED, ["l_orderkey", "l_linenumber"])
    d = ML.mark_nominal(cut(d), nominal, NUMERIC)
    train, held = d.where("part = 0"), d.where("part = 1")
    forest = RandomForestClassifier(numTrees=20, impurity="entropy", maxDepth=30, maxBins=max(300, nominal["brand"]), seed=7,
                                    labelCol="y", **FOREST_PASSES).fit(train)
    accuracy = EV.accuracy(forest.transform(held), "y").first()["accuracy"]
    guess = EV.random_guess_accuracy(train, held, "y").first()[0]
    given = d.orderBy("l_orderkey", "l_linenumber").select("features").first()["features"]
    scored = ML.score_vector(forest, given.toArray().tolist())
    rows = [("held-out accuracy", float(accuracy), None), ("random guess", float(guess), None),
            ("given vector", scored["share"], labels[int(scored["prediction"])])]
    return spark.createDataFrame(rows, "kind STRING, value DOUBLE, label STRING")


QUERIES = {
    "scan_numeric_csv": q_scan_numeric_csv,
    "union_all": q_union_all,
    "class_priors": q_class_priors,
    "random_guess_accuracy": q_random_guess_accuracy,
    "predictions_with_labels": q_predictions_with_labels,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "precision_recall_by_class": q_precision_recall_by_class,
    "one_hot": q_one_hot,
    "un_one_hot": q_un_one_hot,
    "drop_columns": q_drop_columns,
    "project_fields": q_project_fields,
    "tree_fit": q_tree_fit,
    "tree_grid": q_tree_grid,
    "tree_grid_categorical": q_tree_grid_categorical,
    "forest_fit_predict": q_forest_fit_predict,
}

# ---------------------------------------------------------------- oracle SQL
_U = duck_uniform_sql(SPLIT_SEED, "vec_id")


def _ctes(**more):
    c = dict(
        lab=duck.F_LABELED,
        sp=f"SELECT *, CASE WHEN {_U} < 0.8 THEN 0 WHEN {_U} < 0.9 THEN 1 ELSE 2 END AS part FROM lab",
        cen="SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, AVG(x) AS m FROM (SELECT label, "
            "unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(generate_series(1, len(embedding))) AS pos FROM sp "
            "WHERE part = 0) e GROUP BY label, pos) g GROUP BY label",
        d="SELECT s.vec_id, s.label, c.label AS cl, list_distance(CAST(s.embedding AS DOUBLE[]), c.c) AS dist "
          "FROM sp s, cen c WHERE s.part = 2",
        pred="SELECT vec_id, label, arg_min(cl, struct_pack(d := dist, c := cl)) AS prediction FROM d GROUP BY vec_id, label",
    )
    c.update(more)
    return c


def _q(body, **more):
    return duck.with_ctes(body, **_ctes(**more))


_PRIORS = ("SELECT label, COUNT(*) / (SELECT COUNT(*) FROM sp WHERE part = {p}) AS prior FROM sp WHERE part = {p} "
           "GROUP BY label")


def _mixed_ctes():
    cats = {c: f"(SELECT list(DISTINCT {c} ORDER BY {c}) FROM m)" for c in CATEGORICALS}
    return dict(m=duck.F_MIXED, **{f"cat_{c}": f"SELECT {cats[c]} AS v" for c in CATEGORICALS})


def _oh_expr():
    blocks = [f"list_transform((SELECT v FROM cat_{c}), lambda x: CASE WHEN x = m.{c} THEN 1.0 ELSE 0.0 END)"
              for c in CATEGORICALS]
    return ("list_transform(list_concat([CAST(m.l_quantity AS DOUBLE)], " + ", ".join(blocks)
            + ", [m.l_extendedprice, m.l_discount, m.l_tax]), lambda x: ROUND(x, 6))")


def oracle() -> dict:
    return {
        "scan_numeric_csv": duck.with_ctes(
            "SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: ROUND(x, 6)) AS features FROM lab",
            lab=duck.F_LABELED),
        "union_all": _q("SELECT vec_id, label FROM sp WHERE part IN (0, 1)"),
        "class_priors": _q("SELECT label, ROUND(prior, 6) AS prior FROM (" + _PRIORS.format(p=0) + ") x"),
        "random_guess_accuracy": _q("SELECT ROUND(SUM(a.prior * b.prior), 6) AS accuracy FROM (" + _PRIORS.format(p=0)
                                    + ") a JOIN (" + _PRIORS.format(p=1) + ") b ON a.label = b.label"),
        "predictions_with_labels": _q("SELECT vec_id, label, prediction FROM pred"),
        "confusion_matrix": _q("SELECT label, prediction, COUNT(*) AS n FROM pred GROUP BY label, prediction"),
        "accuracy": _q("SELECT ROUND(AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, "
                       "COUNT(*) AS n FROM pred"),
        "precision_recall_by_class": _q(
            "SELECT cls, ROUND(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END, 6) AS precision, "
            "ROUND(CASE WHEN actual > 0 THEN tp / actual ELSE 0.0 END, 6) AS recall, tp, predicted, actual FROM ("
            "SELECT c.cls, COALESCE(a.n, 0) AS actual, COALESCE(p.n, 0) AS predicted, COALESCE(t.n, 0) AS tp FROM "
            "(SELECT label AS cls FROM pred UNION SELECT prediction FROM pred) c "
            "LEFT JOIN (SELECT label AS cls, COUNT(*) AS n FROM pred GROUP BY 1) a ON a.cls = c.cls "
            "LEFT JOIN (SELECT prediction AS cls, COUNT(*) AS n FROM pred GROUP BY 1) p ON p.cls = c.cls "
            "LEFT JOIN (SELECT label AS cls, COUNT(*) AS n FROM pred WHERE label = prediction GROUP BY 1) t ON t.cls = c.cls) z"),
        "one_hot": duck.with_ctes("SELECT m.l_orderkey, m.l_linenumber, " + _oh_expr() + " AS features FROM m",
                                  **_mixed_ctes()),
        "un_one_hot": duck.with_ctes(
            "SELECT m.l_orderkey, m.l_linenumber, CAST(list_position((SELECT v FROM cat_l_returnflag), m.l_returnflag) - 1 "
            "AS INTEGER) AS flag_idx, CAST(list_position((SELECT v FROM cat_p_brand), m.p_brand) - 1 AS INTEGER) AS brand_idx "
            "FROM m", **_mixed_ctes()),
        "drop_columns": duck.with_ctes("SELECT * EXCLUDE (l_returnflag, l_linestatus, p_brand) FROM m", m=duck.F_MIXED),
        "project_fields": duck.with_ctes("SELECT l_orderkey, CAST(FLOOR(l_quantity) AS INTEGER) AS qty, label AS kind FROM m",
                                         m=duck.F_MIXED),
    }
