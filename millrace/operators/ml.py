"""Model building on ``pyspark.ml``: estimators, metrics, search, ranking."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import labels as L
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.split import _cut_hashes, fit_split, key_hash

SEED = 42
MAX_CLASSES = 1_000
CLASSIFIERS = ["logistic", "forest", "gbt", "tree", "naive_bayes", "svc", "mlp"]
REGRESSORS = ["linear", "ridge", "lasso", "elasticnet", "forest", "gbt", "tree"]

# What to look at next, from how the Spark estimator works.
TIPS = {
    "logistic": "one pass per iteration; raise regParam if coefficients grow without bound",
    "forest": "trees are grown level by level together; maxBins must reach the largest category count",
    "gbt": "trees follow one another, so the time grows with maxIter; a smaller stepSize needs more of them",
    "tree": "compare the train score: a gap calls for a smaller maxDepth or a larger minInstancesPerNode",
    "naive_bayes": "one aggregation per class; correlated columns make its probabilities extreme",
    "svc": "hinge loss without probabilities; its threshold is on the raw margin",
    "mlp": "the last layer equals the class count; blockSize sets how many rows share one gradient step",
    "linear": "exact by normal equations up to 4096 columns, iterative beyond",
    "ridge": "regParam applies to standardised columns unless standardization is off",
    "lasso": "raise regParam until the list of non-zero coefficients is short enough",
    "elasticnet": "elasticNetParam 0 is ridge and 1 is lasso; search it together with regParam",
}

# Small grids searched by ``grid_search``: parameter name to values.
GRIDS = {
    "logistic": {"regParam": [0.1, 0.01, 0.0]},
    "tree": {"maxDepth": [3, 5, 10]},
    "forest": {"numTrees": [20, 50], "maxDepth": [5, 10]},
    "gbt": {"maxIter": [10, 20], "maxDepth": [3, 5]},
    "ridge": {"regParam": [0.1, 1.0, 10.0]},
    "lasso": {"regParam": [0.1, 1.0, 10.0]},
    "elasticnet": {"regParam": [0.1, 1.0], "elasticNetParam": [0.2, 0.5, 0.8]},
}


def make_estimator(name: str, task: str, n_classes: int = 2, n_features: int = 0, **params):
    """An unfitted estimator on (features, label).  Boosting and the linear SVC
    take two classes in Spark; more are handled one-vs-rest."""
    cols = {"featuresCol": "features", "labelCol": "label"}
    if task == "classification":
        made = {
            "logistic": lambda: C.LogisticRegression(maxIter=500, **cols),
            "tree": lambda: C.DecisionTreeClassifier(seed=SEED, **cols),
            "forest": lambda: C.RandomForestClassifier(numTrees=100, seed=SEED, **cols),
            "gbt": lambda: C.GBTClassifier(maxIter=10, seed=SEED, **cols),
            "naive_bayes": lambda: C.NaiveBayes(modelType="gaussian", **cols),
            "svc": lambda: C.LinearSVC(maxIter=20, **cols),
            "mlp": lambda: C.MultilayerPerceptronClassifier(
                layers=[n_features, 16, n_classes], maxIter=50, seed=SEED, **cols
            ),
        }.get(name)
    else:
        made = {
            "linear": lambda: R.LinearRegression(**cols),
            "ridge": lambda: R.LinearRegression(regParam=1.0, elasticNetParam=0.0, **cols),
            "lasso": lambda: R.LinearRegression(regParam=0.01, elasticNetParam=1.0, **cols),
            "elasticnet": lambda: R.LinearRegression(regParam=0.01, elasticNetParam=0.5, **cols),
            "tree": lambda: R.DecisionTreeRegressor(seed=SEED, **cols),
            "forest": lambda: R.RandomForestRegressor(numTrees=100, seed=SEED, **cols),
            "gbt": lambda: R.GBTRegressor(maxIter=10, seed=SEED, **cols),
        }.get(name)
    if made is None:
        raise ValueError(f"no {task} model named {name!r}")
    est = made()
    for p, v in params.items():
        est = est._set(**{p: v})
    if name in ("gbt", "svc") and task == "classification" and n_classes > 2:
        return C.OneVsRest(classifier=est, parallelism=2, **cols)
    return est


def assemble(df: DataFrame, features, target: str | None = None, keep: list[str] = ()) -> DataFrame:
    """features vector (nulls as 0), label, and the columns to keep."""
    if isinstance(features, str):
        from pyspark.ml.functions import array_to_vector

        vec = array_to_vector(F.transform(col(features), lambda x: x.cast("double")))
        out = df.withColumn("features", vec)
    else:
        named = [f"__f{i}" for i, _ in enumerate(features)]
        filled = df.withColumns({n: F.coalesce(dbl(c), F.lit(0.0)) for n, c in zip(named, features)})
        out = VectorAssembler(inputCols=named, outputCol="features").transform(filled).drop(*named)
    wanted = [col(k) for k in keep] + ["features"]
    if target:
        kind = df.schema[target].dataType
        label = dbl(target) if isinstance(kind, (T.NumericType, T.BooleanType)) else col(target)
        return out.select(*wanted, label.alias("label")).where("label is not null")
    return out.select(*wanted)


def index_label(df: DataFrame):
    """Labels as 0..k-1 in ascending order of value, and their names."""
    raw = df.withColumn("__raw", F.col("label").cast("string"))
    if isinstance(df.schema["label"].dataType, T.NumericType):
        found = [r[0] for r in df.select("label").distinct().limit(MAX_CLASSES + 1).collect()]
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        values = sorted(float(v) for v in found)
        # by value: the text of a double differs between Python and Spark
        at = F.array_position(F.array(*[F.lit(v) for v in values]), F.col("label").cast("double")) - 1
        return df.withColumn("label", at.cast("double")), [str(v) for v in values]
    else:
        if len(df.select("label").distinct().limit(MAX_CLASSES + 1).collect()) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        model = StringIndexer(inputCol="__raw", outputCol="__ix", stringOrderType="alphabetAsc").fit(raw)
        names = list(model.labels)
    out = model.transform(raw).withColumn("label", F.col("__ix")).drop("__raw", "__ix")
    return out, names


# ---- metrics ------------------------------------------------------------------

def confusion_matrix(pred: DataFrame) -> DataFrame:
    return pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, average: str = "macro") -> DataFrame:
    """accuracy, precision, recall, f1 from the (label, prediction) counts.

    average: macro (plain mean over classes) or weighted (by class size).
    """
    cm = confusion_matrix(pred)
    sides = cm.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("real"), F.lit(0).cast("bigint").alias("said"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("real"), F.col("n").alias("said"), F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("c").agg(F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(F.col("hit"), F.col("said")), ratio(F.col("hit"), F.col("real"))
    per = per.withColumns({"p": p, "r": r}).withColumn("f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    w = F.col("real").cast("double") if average == "weighted" else F.lit(1.0)
    mean = lambda c: ratio(F.sum(F.col(c) * w), F.sum(w))
    return per.agg(
        ratio(F.sum("hit"), F.sum("real")).alias("accuracy"),
        mean("p").alias("precision"), mean("r").alias("recall"), mean("f").alias("f1"),
        F.sum("real").alias("n"),
    )


def regression_metrics(pred: DataFrame) -> DataFrame:
    """mae, mse, rmse, r2 in one aggregation."""
    y, e = F.col("label"), F.col("label") - F.col("prediction")
    out = pred.agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("v"), F.count(y).alias("n")
    )
    return out.select(
        "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("v"))).alias("r2"), "n"
    )


def roc_auc(pred: DataFrame, raw: str = "rawPrediction") -> float | None:
    if raw not in pred.columns:
        return None
    return BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol="label").evaluate(pred)


def overfit_table(scores: DataFrame, regression: bool = False) -> DataFrame:
    gap = F.col("train_score") - F.col("test_score")
    return scores.withColumns(
        {"overfit_gap": gap, "overfit_risk": L.overfit_risk(F.col("train_score"), F.col("test_score"), regression)}
    )


# ---- validation ---------------------------------------------------------------

def with_folds(df: DataFrame, keys: list[str], k: int = 5, stratify: str | None = None, seed: int = SEED) -> DataFrame:
    """Column ``fold`` (0..k-1) of equal sizes, per class when stratified."""
    group = col(stratify).cast("string") if stratify else F.lit("")
    sizes = {r[0]: r[1] for r in df.groupBy(group.alias("g")).count().collect()}
    wanted = {g: [n * i // k for i in range(1, k)] for g, n in sizes.items()}
    cuts = _cut_hashes(df, key_hash(keys, seed), group, wanted)
    table = F.create_map(
        *[x for g, c in cuts.items() for x in (F.lit(g or ""), F.array(*[F.lit(v) for v in c]))]
    )
    h = key_hash(keys, seed)
    above = F.filter(F.try_element_at(table, F.coalesce(group, F.lit(""))), lambda c: h > c)
    return df.withColumn("fold", F.size(above).cast("int"))


def _evaluator(task: str):
    if task == "classification":
        return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return RegressionEvaluator(labelCol="label", metricName="r2")


def cross_validate(data: DataFrame, estimator, task: str, folds: int = 5) -> dict:
    """Mean, deviation and per-fold scores; ``data`` has features, label, fold."""
    ev = _evaluator(task)
    scores = []
    for i in range(folds):
        model = estimator.fit(data.where(F.col("fold") != i))
        scores.append(ev.evaluate(model.transform(data.where(F.col("fold") == i))))
    mean = sum(scores) / len(scores)
    sd = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    return {"cv_mean": mean, "cv_std": sd, "cv_scores": scores}


def grid_search(data: DataFrame, name: str, task: str, n_classes: int = 2, n_features: int = 0, folds: int = 3, grid: dict | None = None, parallelism: int = 4):
    """CrossValidator over a small grid; returns (best model, table of scores)."""
    est = make_estimator(name, task, n_classes, n_features)
    builder = ParamGridBuilder()
    grid = GRIDS.get(name, {}) if grid is None else grid
    for p, values in grid.items():
        builder = builder.addGrid(est.getParam(p), values)
    maps = builder.build()
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=maps, evaluator=_evaluator(task), numFolds=folds, seed=SEED,
        parallelism=parallelism,
        **({"foldCol": "fold"} if "fold" in data.columns else {}),
    )
    model = cv.fit(data)
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in m.items()), float(a), float(s))
        for i, (m, a, s) in enumerate(zip(maps, model.avgMetrics, model.stdMetrics))
    ]
    table = data.sparkSession.createDataFrame(rows, "grid_id int, params string, cv_mean double, cv_std double")
    return model.bestModel, table


# ---- automatic run ------------------------------------------------------------

@dataclass
class AutoResult:
    task: str
    leaderboard: DataFrame
    models: dict = field(default_factory=dict)
    best: str | None = None
    labels: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=list)
    confusion: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, keep: list[str], model: str | None = None) -> DataFrame:
        """Best (or named) model on new rows, with the original label text."""
        out = self.models[model or self.best].transform(assemble(df, self.features, keep=keep))
        if self.labels:
            out = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=self.labels).transform(out)
        return out


BOARD = (
    "rank int, name string, status string, score double, train_score double, precision double, recall double, "
    "f1 double, roc_auc double, mae double, rmse double, cv_mean double, cv_std double, overfit_risk string, "
    "training_time double, tip string, error string"
)


def detect_task(df: DataFrame, target: str, limit: int = 20) -> str:
    if not isinstance(df.schema[target].dataType, T.NumericType):
        return "classification"
    return "classification" if df.select(col(target)).distinct().limit(limit + 1).count() <= limit else "regression"


def automl_run(df: DataFrame, target: str, keys: list[str], features=None, models: list[str] | None = None, max_models: int = 8, time_limit: float = 300.0, folds: int = 0, test: float = 0.2, task: str | None = None, split: str | None = None) -> AutoResult:
    """Split, train up to ``max_models`` models within the limit, rank them.

    ``split`` names the column of a split made before (train, val, test): models learn
    from its train rows and are scored on its test rows, and none is made here.
    The assembled train and test parts are cached once and shared by all fits;
    a model that fails stays on the board with its error, one that is not trained as
    ``skipped`` with the limit that was met.
    """
    spark = df.sparkSession
    task = task or detect_task(df, target)
    if features is None:
        features = [c for c in S.numeric_columns(df) if c not in (target, split) and c not in keys]
    data = assemble(df, features, target, keep=[*keys, *([split] if split else [])])
    names: list[str] = []
    if task == "classification":
        data, names = index_label(data)
    if split:
        data = data.withColumnRenamed(split, "split")
    else:
        step = fit_split(data, keys, test, stratify="label" if task == "classification" else None)
        data = step.transform(data)
    if folds:
        data = with_folds(data, keys, folds, "label" if task == "classification" else None)
    width = len(features) if not isinstance(features, str) else len(data.select("features").head()[0])
    train = data.where("split = 'train'").persist(StorageLevel.MEMORY_AND_DISK)
    held = data.where("split = 'test'").persist(StorageLevel.MEMORY_AND_DISK)
    chosen = models or (CLASSIFIERS if task == "classification" else REGRESSORS)
    rows, fitted, confusion = [], {}, {}
    ev = _evaluator(task)
    started = time.time()
    try:
        for place, name in enumerate(chosen):
            t0 = time.time()
            row = dict.fromkeys([f.split()[0] for f in BOARD.split(", ")])
            row.update(name=name, tip=TIPS.get(name), status="success")
            if place >= max_models or t0 - started > time_limit:
                row.update(status="skipped", error=f"max_models={max_models}" if place >= max_models else f"time_limit={time_limit:g}s")
                rows.append(row)
                continue
            try:
                est = make_estimator(name, task, max(len(names), 2), width)
                model = est.fit(train)
                row["training_time"] = time.time() - t0
                pred = model.transform(held)
                row["train_score"] = ev.evaluate(model.transform(train))
                if task == "classification":
                    m = classification_metrics(pred).head()
                    row.update(score=m["accuracy"], precision=m["precision"], recall=m["recall"], f1=m["f1"])
                    row["roc_auc"] = roc_auc(pred) if len(names) == 2 else None
                    confusion[name] = confusion_matrix(pred)
                else:
                    m = regression_metrics(pred).head()
                    row.update(score=m["r2"], mae=m["mae"], rmse=m["rmse"])
                if folds:
                    cv = cross_validate(train, est, task, folds)
                    row.update(cv_mean=cv["cv_mean"], cv_std=cv["cv_std"])
                fitted[name] = model
            except Exception as e:  # kept on the board
                row.update(status="failed", error=str(e)[:500])
            rows.append(row)
    finally:
        train.unpersist()
        held.unpersist()
    rows.sort(key=lambda r: (-(r["score"] if r["score"] is not None else float("-inf")), r["name"]))
    limits = (0.20, 0.10) if task == "regression" else (0.15, 0.05)
    for i, r in enumerate(rows):
        r["rank"] = i + 1
        if r["status"] == "success":
            gap = (r["train_score"] or 0.0) - (r["score"] or 0.0)
            r["overfit_risk"] = "high" if gap > limits[0] else "medium" if gap > limits[1] else "low"
    fields = [f.split()[0] for f in BOARD.split(", ")]
    board = spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], BOARD)
    ranked = [r["name"] for r in rows if r["status"] == "success"]
    return AutoResult(task, board, fitted, ranked[0] if ranked else None, names, features, confusion)


def ensemble_predict(result: AutoResult, df: DataFrame, keep: list[str], top: int = 3) -> DataFrame:
    """Vote (or mean) of the best models.  The models are chained on one frame,
    so no join of predictions is needed."""
    order = [r["name"] for r in result.leaderboard.where("status = 'success'").orderBy("rank").limit(top).collect()]
    out = assemble(df, result.features, keep=keep)
    for i, name in enumerate(order):
        drop = [c for c in ("rawPrediction", "probability")]
        out = result.models[name].transform(out).withColumnRenamed("prediction", f"p{i}").drop(*drop)
    votes = [F.col(f"p{i}") for i in range(len(order))]
    if result.task == "regression":
        final = sum(votes[1:], votes[0]) / len(votes)
    else:
        # most votes win; ties go to the better ranked model
        arr = F.array(*votes)
        ballots = F.transform(
            arr, lambda v, i: F.struct(-F.size(F.filter(arr, lambda x: x == v)), i.alias("i"), v.alias("v"))
        )
        final = F.array_min(ballots)["v"]
    return out.withColumn("prediction", final).select(*[col(k) for k in keep], "prediction")


# ---- single models ------------------------------------------------------------

def fit_pipeline(df: DataFrame, target: str, features: list[str], name: str, task: str, n_classes: int = 2, **params) -> PipelineModel:
    """Assembly and estimator as one saveable PipelineModel."""
    filled = ", ".join(f"coalesce(cast(`{c}` as double), 0.0) as `__f{i}`" for i, c in enumerate(features))
    stages = [
        SQLTransformer(statement=f"select *, {filled} from __THIS__"),
        VectorAssembler(inputCols=[f"__f{i}" for i in range(len(features))], outputCol="features"),
        make_estimator(name, task, n_classes, len(features), **params),
    ]
    return Pipeline(stages=stages).fit(df.withColumn("label", dbl(target)).where("label is not null"))


def forest_importance(df: DataFrame, target: str, features: list[str], task: str = "regression", trees: int = 50) -> DataFrame:
    """(feature, importance) of a forest, largest first."""
    data = assemble(df, features, target)
    if task == "classification":
        data, _ = index_label(data)
    model = make_estimator("forest", task, numTrees=trees).fit(data)
    rows = sorted(zip(features, (float(x) for x in model.featureImportances.toArray())), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def coefficient_importance(model, features: list[str], spark, top: int = 20) -> DataFrame:
    """Absolute coefficients of a linear model, the largest ``top``."""
    weights = model.coefficients if hasattr(model, "coefficients") else None
    rows = sorted(((f, abs(float(w))) for f, w in zip(features, weights)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")
