"""Models, metrics, neighbours, automatic runs."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy
from millrace.operators import knn, ml
from millrace.plans import run as runs
from millrace.plans.config import PrepConfig, starter_config

ORDER_FEATURES = ["o_totalprice", "o_custkey", "o_month"]


def _orders(spark, sf):
    """Orders with a learnable three-class and a two-class target."""
    o = load(spark, sf, "orders").withColumn("o_month", F.month("o_orderdate"))
    tier = F.when(F.col("o_totalprice") < 100000, "low").when(F.col("o_totalprice") < 300000, "mid").otherwise("high")
    return o.select(
        "o_orderkey", *ORDER_FEATURES, tier.alias("tier"), (F.col("o_totalprice") > 200000).cast("int").alias("big"),
        (F.col("o_totalprice") / 1000 + F.col("o_month") * 3).alias("amount"),
    )


def _scores(spark, sf, name, target, task, n_classes=2):
    """Metrics of one model on a held-out fifth."""
    df = _orders(spark, sf)
    data = ml.assemble(df, ORDER_FEATURES, target, keep=["o_orderkey"])
    if task == "classification":
        data, _ = ml.index_label(data)
    data = ml.fit_split(data, ["o_orderkey"], 0.2).transform(data)
    est = ml.make_estimator(name, task, n_classes, len(ORDER_FEATURES))
    pred = est.fit(data.where("split = 'train'")).transform(data.where("split = 'test'"))
    out = ml.classification_metrics(pred) if task == "classification" else ml.regression_metrics(pred)
    return tidy(out.withColumn("model", F.lit(name)))


for _key, _name, _target, _k in [
    ("ml_logistic", "logistic", "tier", 3), ("ml_tree_cls", "tree", "tier", 3), ("ml_forest_cls", "forest", "tier", 3),
    ("ml_gbt_cls", "gbt", "big", 2), ("ml_svc", "svc", "big", 2), ("ml_mlp", "mlp", "tier", 3),
]:
    query(_key)(lambda spark, sf, n=_name, t=_target, k=_k: _scores(spark, sf, n, t, "classification", k))

for _key, _name in [
    ("ml_ridge", "ridge"), ("ml_lasso", "lasso"), ("ml_elasticnet", "elasticnet"),
    ("ml_tree_reg", "tree"), ("ml_forest_reg", "forest"), ("ml_gbt_reg", "gbt"),
]:
    query(_key)(lambda spark, sf, n=_name: _scores(spark, sf, n, "amount", "regression"))


@query(
    "ml_linear",
    r("""select regr_slope(y, x) * 1000 as slope, regr_intercept(y, x) as intercept, regr_r2(y, x) as r2, count(*) as n
       from (select o_totalprice as x, o_totalprice / 1000 + month(o_orderdate) * 3 as y from orders)""", "slope, intercept, r2"),
)
def ml_linear(spark, sf):
    """Least squares of one feature, checked by its closed form."""
    df = _orders(spark, sf)
    model = ml.make_estimator("linear", "regression").fit(ml.assemble(df, ["o_totalprice"], "amount"))
    pred = model.transform(ml.assemble(df, ["o_totalprice"], "amount"))
    out = ml.regression_metrics(pred).select(
        F.lit(float(model.coefficients[0]) * 1000).alias("slope"), F.lit(float(model.intercept)).alias("intercept"), "r2", "n"
    )
    return tidy(out)


@query(
    "ml_naive_bayes",
    r("""select tier as class, unnest(['o_totalprice', 'o_custkey', 'o_month']) as feature, unnest([a, b, c]) as mean, n / sum(n) over () as prior from (
       select case when o_totalprice < 100000 then 'low' when o_totalprice < 300000 then 'mid' else 'high' end as tier, avg(o_totalprice) as a, avg(o_custkey) as b, avg(month(o_orderdate)) as c, count(*) as n from orders group by 1)""", "mean, prior", 3),
)
def ml_naive_bayes(spark, sf):
    """Class priors and means of the fitted Gaussian model."""
    data, names = ml.index_label(ml.assemble(_orders(spark, sf), ORDER_FEATURES, "tier"))
    model = ml.make_estimator("naive_bayes", "classification", len(names)).fit(data)
    prior = [float(x) for x in model.pi.toArray()]
    rows = [
        (c, f, float(model.theta[i, j]), math.exp(prior[i]))
        for i, c in enumerate(names) for j, f in enumerate(ORDER_FEATURES)
    ]
    return tidy(spark.createDataFrame(rows, "class string, feature string, mean double, prior double"), 3)


# ---- nearest neighbours -------------------------------------------------------

_NEAR = """(select a.vec_id as query_id, b.vec_id as id, b.label, round(list_distance(a.embedding::double[], b.embedding::double[]), 9) as d,
  row_number() over (partition by a.vec_id order by round(list_distance(a.embedding::double[], b.embedding::double[]), 9), b.vec_id) as rank
  from embeddings a, embeddings b where a.vec_id <> b.vec_id qualify rank <= 5)"""


@query("knn_neighbours", r(f"select query_id, id, d as distance, rank::int as rank from {_NEAR}", "distance"))
def knn_neighbours(spark, sf):
    df = load(spark, sf, "embeddings")
    return tidy(knn.neighbours(df, df, "vec_id", "embedding", 5, exclude_self=True, block_rows=200))


@query("ml_knn", f"select query_id, label as prediction from (select query_id, label, row_number() over (partition by query_id order by count(*) desc, label) as p from {_NEAR} group by 1, 2) where p = 1")
def ml_knn(spark, sf):
    df = load(spark, sf, "embeddings")
    return knn.knn_predict(df, df, "vec_id", "embedding", "label", 5, exclude_self=True)


@query("ml_knn_reg", r(f"select query_id, avg(label) as prediction from {_NEAR} group by 1", "prediction"))
def ml_knn_reg(spark, sf):
    df = load(spark, sf, "embeddings")
    return tidy(knn.knn_predict(df, df, "vec_id", "embedding", "label", 5, regression=True, exclude_self=True))


# ---- metrics from given predictions -------------------------------------------

_PRED = "(select case o_orderstatus when 'F' then 0.0 when 'O' then 1.0 else 2.0 end as label, (o_custkey % 7 % 3)::double as prediction from orders)"


def _pred(spark, sf):
    label = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0).otherwise(2.0)
    return load(spark, sf, "orders").select(label.alias("label"), (F.col("o_custkey") % 7 % 3).cast("double").alias("prediction"))


def _metrics_sql(weight):
    return r(
        f"""select sum(hit) / any_value(n)::double as accuracy, sum(p * w) / sum(w) as precision, sum(rc * w) / sum(w) as recall,
        sum(case when p + rc > 0 then 2 * p * rc / (p + rc) else 0 end * w) / sum(w) as f1, any_value(n)::bigint as n from (
        select c, hit, n, {weight} as w, coalesce(hit / nullif(said, 0)::double, 0) as p, coalesce(hit / nullif(act, 0)::double, 0) as rc from (
        select c, (select count(*) from {_PRED} where label = c and prediction = c) as hit, (select count(*) from {_PRED} where prediction = c) as said,
        (select count(*) from {_PRED} where label = c) as act, (select count(*) from orders) as n from (select distinct label as c from {_PRED} union select distinct prediction from {_PRED})))""",
        "accuracy, precision, recall, f1",
    )


@query("ml_metrics_cls", _metrics_sql("1.0::double"))
def ml_metrics_cls(spark, sf):
    return tidy(ml.classification_metrics(_pred(spark, sf)))


@query("ml_metrics_cls_weighted", _metrics_sql("act::double"))
def ml_metrics_cls_weighted(spark, sf):
    return tidy(ml.classification_metrics(_pred(spark, sf), "weighted"))


@query("ml_confusion_matrix", f"select label, prediction, count(*) as n from {_PRED} group by 1, 2")
def ml_confusion_matrix(spark, sf):
    return ml.confusion_matrix(_pred(spark, sf))


@query(
    "ml_metrics_reg",
    r("select avg(abs(e)) as mae, avg(e * e) as mse, sqrt(avg(e * e)) as rmse, 1 - avg(e * e) / var_pop(y) as r2, count(*) as n from (select l_quantity as y, l_quantity - l_extendedprice / 2000 as e from lineitem)", "mae, mse, rmse, r2"),
)
def ml_metrics_reg(spark, sf):
    df = load(spark, sf, "lineitem").select(F.col("l_quantity").alias("label"), (F.col("l_extendedprice") / 2000).alias("prediction"))
    return tidy(ml.regression_metrics(df))


@query(
    "ml_overfit_risk",
    r("""select *, train_score - test_score as overfit_gap, case when train_score - test_score > 0.15 then 'high' when train_score - test_score > 0.05 then 'medium' else 'low' end as overfit_risk
       from (select o_orderpriority as name, 0.9::double as train_score, 0.7 + count(*) % 23 / 100.0::double as test_score from orders group by 1)""", "train_score, test_score, overfit_gap"),
)
def ml_overfit_risk(spark, sf):
    scores = load(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(
        F.lit(0.9).alias("train_score"), (F.lit(0.7) + F.count(F.lit(1)) % 23 / F.lit(100.0)).alias("test_score")
    )
    return tidy(ml.overfit_table(scores))


# ---- search, validation, automatic runs ---------------------------------------


def _train(spark, sf, target, folds=3):
    data = ml.assemble(_orders(spark, sf), ORDER_FEATURES, target, keep=["o_orderkey"])
    data, names = ml.index_label(data)
    return ml.with_folds(data, ["o_orderkey"], folds, "label"), names


@query(
    "ml_folds",
    """select o_orderkey, fold::int as fold from (select o_orderkey, (case when rn > n * 1 // 3 then 1 else 0 end + case when rn > n * 2 // 3 then 1 else 0 end) as fold from (
       select o_orderkey, row_number() over (partition by o_totalprice > 200000 order by md5(concat_ws(':', cast(o_orderkey as varchar), '42'))) as rn, count(*) over (partition by o_totalprice > 200000) as n from orders))""",
)
def ml_folds(spark, sf):
    """Stratified folds of equal size."""
    return _train(spark, sf, "big")[0].select("o_orderkey", "fold")


@query("ml_grid_search")
def ml_grid_search(spark, sf):
    data, names = _train(spark, sf, "tier")
    _, table = ml.grid_search(data, "tree", "classification", len(names), len(ORDER_FEATURES))
    return tidy(table)


@query("ml_cross_validate")
def ml_cross_validate(spark, sf):
    data, names = _train(spark, sf, "tier")
    cv = ml.cross_validate(data, ml.make_estimator("tree", "classification", len(names), 3), "classification", 3)
    rows = [(i, float(s), cv["cv_mean"], cv["cv_std"]) for i, s in enumerate(cv["cv_scores"])]
    return tidy(spark.createDataFrame(rows, "fold int, score double, cv_mean double, cv_std double"))


def _auto(spark, sf, target="tier", models=("tree", "naive_bayes", "logistic")):
    return ml.automl_run(_orders(spark, sf), target, ["o_orderkey"], ORDER_FEATURES, list(models))


@query("automl_run")
def automl_run(spark, sf):
    return tidy(_auto(spark, sf).leaderboard.drop("training_time"))


@query("leaderboard")
def leaderboard(spark, sf):
    board = _auto(spark, sf, "amount", ("linear", "ridge", "tree")).leaderboard
    return tidy(board.select("rank", "name", "score", "overfit_risk", "tip"))


@query("ml_predict")
def ml_predict(spark, sf):
    result = _auto(spark, sf, models=("tree",))
    return result.predict(_orders(spark, sf), ["o_orderkey"]).select("o_orderkey", "predicted_label")


@query("ml_ensemble_top3")
def ml_ensemble_top3(spark, sf):
    return ml.ensemble_predict(_auto(spark, sf), _orders(spark, sf), ["o_orderkey"])


@query("feature_importance")
def feature_importance(spark, sf):
    return tidy(ml.forest_importance(_orders(spark, sf), "amount", ORDER_FEATURES), 3)


@query("save_load_model", "select count(*) as n from orders")
def save_load_model(spark, sf):
    """A fitted pipeline written, read back and applied."""
    from pyspark.ml import PipelineModel

    from millrace.session import scratch_dir

    df = _orders(spark, sf)
    path = scratch_dir(spark, "model")
    ml.fit_pipeline(df, "amount", ORDER_FEATURES, "linear", "regression").write().save(path)
    return PipelineModel.load(path).transform(df).agg(F.count("prediction").alias("n"))


# ---- whole runs ---------------------------------------------------------------

_RO = dsql("rough_orders")


@query("preprocess_only", r(f"select o_orderkey, coalesce(price, (select avg(price) from {_RO})) as price, case when trim(flag) = 'Yes' then 1.0::double else 0.0 end as flag from {_RO}", "price, flag", 3))
def preprocess_only(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price", "flag", "konst", "sparse")
    out = runs.preprocess_only(df, PrepConfig(keys=["o_orderkey"])).df
    return tidy(out.withColumn("flag", F.col("flag").cast("double")), 3)


@query("full_run")
def full_run(spark, sf):
    """Load to leaderboard in one call."""
    df = derived(spark, sf, "rough_orders").withColumn("big", (F.col("spiky") > 200000).cast("int")).drop("numtext")
    cfg = PrepConfig(target="big", keys=["o_orderkey"], models=["tree", "logistic"])
    return tidy(runs.full_run(spark, df, cfg).models.leaderboard.select("rank", "name", "status", "score"))


@query("build_models_only")
def build_models_only(spark, sf):
    cfg = PrepConfig(target="big", keys=["o_orderkey"], models=["tree"])
    return tidy(runs.build_models_only(_orders(spark, sf).drop("tier", "amount"), cfg).leaderboard.select("rank", "name", "score"))


@query("config_roundtrip", "select count(*) as n_rows, true as same, true as valid from orders")
def config_roundtrip(spark, sf):
    """A starter config for the table survives JSON and validates."""
    df = load(spark, sf, "orders")
    cfg = starter_config(df.columns, "o_orderstatus")
    with tempfile.NamedTemporaryFile("w", suffix=".json") as f:
        cfg.save(f.name)
        same = PrepConfig.load(f.name) == cfg
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(same).alias("same"), F.lit(not cfg.problems()).alias("valid"))
