"""Edge cases on tiny frames, properties, and closed forms."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import pvalues, text
from millrace.operators import (
    chartdata, clean, encode, features, impute, kendall, knn, ml, outliers, quantiles, relate, select, skew, split, stats,
)
from millrace.operators import schema as S
from millrace.operators import typing as ty
from millrace.plans.config import PrepConfig
from millrace.plans.fitted import FittedPlan, Step


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def col_of(df, c):
    return [r[0] for r in df.select(c).collect()]


# ---- p values -----------------------------------------------------------------


def test_t_closed_forms():
    for t in (0.0, 0.3, 1.0, 2.5, 30.0):
        assert pvalues.t_two_sided(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-12)
        assert pvalues.t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)


def test_chi2_closed_forms():
    for x in (0.0, 0.5, 3.84, 40.0):
        assert pvalues.chi2_upper(x, 2) == pytest.approx(math.exp(-x / 2), abs=1e-12)
        assert pvalues.chi2_upper(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), abs=1e-12)
        assert pvalues.chi2_upper(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), abs=1e-12)


def test_f_closed_forms():
    for f in (0.1, 1.0, 7.0):
        assert pvalues.f_upper(f, 2, 9) == pytest.approx((1 + 2 * f / 9) ** -4.5, abs=1e-12)
        assert pvalues.f_upper(f, 1, 7) == pytest.approx(pvalues.t_two_sided(math.sqrt(f), 7), abs=1e-12)


# ---- quantiles ----------------------------------------------------------------


@pytest.mark.parametrize("kind", ["spread", "binary_with_middle", "constant", "tiny"])
def test_quantile_brackets_match_numpy(spark, kind):
    rng = np.random.default_rng(1)
    x = {
        "spread": rng.lognormal(0, 3, 4000),
        "binary_with_middle": np.concatenate([np.zeros(1500), np.ones(1500), rng.random(400)]),
        "constant": np.full(500, 7.0),
        "tiny": np.array([3.0, 1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": x[::-1] * -1})).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.441, 0.5, 0.75, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, ["x", "y"], probs, exact_cells=0, bracket_rows=20)
    assert got["x"] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)
    assert got["y"] == pytest.approx(np.quantile(-x, probs).tolist(), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = frame(spark, [(None,)], "x double")
    for cells in (0, 100):
        assert quantiles.exact_quantiles(df, ["x"], [0.5], exact_cells=cells) == {"x": [None]}


# ---- statistics ---------------------------------------------------------------


def test_profile_of_edges(spark):
    df = frame(spark, [(1.0, None, 2.0), (1.0, None, float("nan")), (1.0, None, 4.0)], "c double, e double, n double")
    got = {r["column"]: r for r in stats.full_profile(df, ["c", "e", "n"]).collect()}
    assert got["c"]["skewness"] == 0.0 and got["c"]["distribution"] == "binary"
    assert got["e"]["n_null"] == 3 and got["e"]["mean"] is None and got["e"]["distribution"] == "unknown"
    assert got["n"]["n_null"] == 1 and got["n"]["mean"] == 3.0


def test_constant_column_has_no_correlation(spark):
    df = frame(spark, [(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert col_of(relate.corr_pairs(df, ["a", "b"]), "r") == [None]
    pairs = list(itertools.combinations(["a", "b"], 2))
    assert col_of(relate._corr_gram(df, ["a", "b"], pairs), "r") == [None]


def test_mode_ties_take_smallest(spark):
    df = frame(spark, [(2.0,), (1.0,), (2.0,), (1.0,), (9.0,)], "x double")
    assert quantiles.modes(df, ["x"], "double").head()["mode"] == 1.0


def test_empty_frame(spark):
    df = frame(spark, [], "a double, t string")
    assert stats.overview(df).head()["n_rows"] == 0
    assert clean.validate(df).where("issue = 'empty'").count() == 1
    assert stats.describe_numeric(df, ["a"]).head()["count"] == 0


def test_yates_two_by_two(spark):
    rows = [("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 7 + [("b", "y")] * 9
    got = relate.chi_square(frame(spark, rows, "p string, q string"), [("p", "q")]).head()
    o = np.array([[12, 5], [7, 9]], float)
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert got["chi2"] == pytest.approx((((np.abs(o - e) - 0.5) ** 2) / e).sum())
    assert got["dof"] == 1


def test_empty_contingency_cell(spark):
    rows = [("a", "x")] * 4 + [("b", "y")] * 3 + [("c", "x")] * 2 + [("c", "y")]
    got = relate.chi_square(frame(spark, rows, "p string, q string"), [("p", "q")]).head()
    o = np.array([[4, 0], [0, 3], [2, 1]], float)
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert got["chi2"] == pytest.approx(((o - e) ** 2 / e).sum())


def test_anova_skips_single_row_group(spark):
    rows = [(1.0, "a"), (2.0, "a"), (4.0, "b"), (6.0, "b"), (9.0, "c")]
    got = relate.anova(frame(spark, rows, "v double, g string"), [("v", "g")]).head()
    assert got["n_groups"] == 2 and got["n"] == 4
    assert got["f_stat"] == pytest.approx(12.25 / (2.5 / 2))
    g = 22 / 5
    between = 2 * (1.5 - g) ** 2 + 2 * (5 - g) ** 2
    assert got["eta_squared"] == pytest.approx(between / (between + 2.5))


def test_gram_route_with_nulls(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (300, 4)), columns=list("abcd"))
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    df = spark.createDataFrame(pdf).repartition(3)
    pairs = list(itertools.combinations("abcd", 2))
    want = pdf.corr()
    for r in relate._corr_gram(df, list("abcd"), pairs).collect():
        assert r["r"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-8)


def test_kendall_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 40, 700).astype(float), rng.normal(size=700).round(1)
    x[:260] = 7.0  # one value holds more than a third of the rows
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    s, p0 = (sx * sy).sum() / 2, 700 * 699 / 2
    want = s / math.sqrt((p0 - ((sx == 0).sum() - 700) / 2) * (p0 - ((sy == 0).sum() - 700) / 2))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    for cells in (30, 10_000):
        assert kendall.kendall_pair(df, "x", "y", cells).head()["r"] == pytest.approx(want, abs=1e-12)


def test_mutual_info_of_copy_is_entropy(spark):
    df = frame(spark, [("a", "a"), ("b", "b"), ("b", "b"), ("c", "c")], "p string, q string")
    mi = relate.mutual_info(df, ["p", "q"]).head()["mi"]
    assert mi == pytest.approx(stats.entropy(df, "p", math.e).head()[0])


# ---- order, skew --------------------------------------------------------------


def skewed_series(spark):
    """One key holds most of the rows; values have gaps."""
    rng = np.random.default_rng(2)
    n = 3000
    key = np.where(rng.random(n) < 0.6, "hot", [f"k{i % 40}" for i in range(n)])
    v = np.where(rng.random(n) < 0.4, rng.random(n), np.nan)
    return pd.DataFrame({"k": key, "t": rng.permutation(n), "name": [f"n{i:05d}" for i in rng.permutation(n)], "v": v})


@pytest.mark.parametrize("order", [["t"], ["name"]])
def test_fills_across_chunks_of_a_hot_key(spark, order):
    pdf = skewed_series(spark)
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    got = impute.ffill(df, ["v"], order, ["k"], head=False).toPandas()
    want = pdf.sort_values(order).assign(v=lambda d: d.groupby("k")["v"].ffill())
    m = got.merge(want, on=["k", "t", "name"], suffixes=("", "_want"))
    assert np.allclose(m["v"], m["v_want"], equal_nan=True)
    back = impute.bfill(df, ["v"], order, [], tail=False).toPandas()
    want = pdf.sort_values(order).assign(v=lambda d: d["v"].bfill())
    m = back.merge(want, on=["k", "t", "name"], suffixes=("", "_want"))
    assert np.allclose(m["v"], m["v_want"], equal_nan=True)


def test_row_numbers_with_heavy_order_ties(spark):
    pdf = pd.DataFrame({"a": [1] * 900 + list(range(2, 102)), "b": np.random.default_rng(0).permutation(1000)})
    got = skew.with_row_number(spark.createDataFrame(pdf), ["a", "b"]).toPandas()
    want = pdf.sort_values(["a", "b"]).reset_index(drop=True).assign(w=lambda d: d.index + 1)
    m = got.merge(want, on=["a", "b"])
    assert (m["row_number"] == m["w"]).all()


def test_window_is_chunked_for_a_hot_key(spark):
    df = spark.createDataFrame(skewed_series(spark))
    out, cut = skew.chunked(df, ["t"], ["k"])
    sizes = out.groupBy("__k", "__ch").count().agg(F.max("count")).head()[0]
    assert cut and sizes < 0.6 * 3000 / 4


def test_zoneless_order_survives_daylight_saving(spark):
    texts = ["2024-03-10 01:59:59.999999", "2024-03-10 02:30:00.000001", "2024-03-10 03:10:00", "2024-11-03 01:30:00", "2024-11-03 02:00:00"]
    df = frame(spark, [(t,) for t in texts], "s string").select("s", F.col("s").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select("s", skew.order_number(df, "t").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["s"] for r in sorted(got, key=lambda r: r["n"])] == texts
    assert got[0]["n"] == pd.Timestamp(texts[0]).value / 1000 and len({r["n"] for r in got}) == 5


def test_interpolate_edges(spark):
    df = frame(spark, [(1, None), (2, 1.0), (3, None), (4, None), (5, 4.0), (6, None)], "t int, v double")
    got = {r["t"]: r["v"] for r in impute.interpolate(df, ["v"], ["t"]).collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: 3.0, 5: 4.0, 6: 4.0}


def test_hot_key_lookup_equals_plain(spark):
    left = spark.createDataFrame([("hot",)] * 500 + [(f"k{i}",) for i in range(50)] + [(None,)] * 20, "k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i + 2) for i in range(50)], "k string, code int")
    a = skew.lookup(left, right, ["k"], broadcast_rows=0)
    assert sorted(a.collect(), key=str) == sorted(left.join(right, "k", "left").collect(), key=str)


def test_ranks_share_ties(spark):
    x = [5.0, 1.0, 5.0, None, 3.0] + [2.0] * 40
    df = frame(spark, [(i, v) for i, v in enumerate(x)], "i int, x double")
    want = pd.Series(x).rank().tolist()
    for few in (0, 1000):
        got = [r["r"] for r in features.with_avg_rank(df, "x", "r", few).orderBy("i").collect()]
        assert [g if g is not None else math.nan for g in got] == pytest.approx(want, nan_ok=True)


# ---- cleaning and types -------------------------------------------------------


def test_names():
    messy = [" Total Price (USD) ", "total__price usd", "", "A.b"]
    assert S.names_ml(messy) == ["total_price_usd", "total_price_usd_1", "column", "a_b"]
    assert S.names_snake([" Two  Words "]) == ["two_words"]
    assert S.names_dedup(["a", "a", "a"]) == ["a", "a_dup", "a_dup_dup"]


def test_columns_with_odd_names(spark):
    df = frame(spark, [(1.0, 2.0), (3.0, 5.0)], "`a.b` double, `c d` double")
    assert relate.corr_pairs(df, ["a.b", "c d"]).head()["r"] == pytest.approx(1.0)
    assert features.fit_scale(df, ["a.b"], "minmax").transform(df).agg(F.max(F.col("`a.b`"))).head()[0] == 1.0


def test_infinities(spark):
    df = frame(spark, [(float("inf"),), (-float("inf"),), (3.0,), (5.0,)], "x double")
    assert sorted(col_of(clean.fit_replace_inf(df, "median").transform(df), "x")) == [3.0, 4.0, 4.0, 5.0]
    assert clean.validation_gate(df).where("`check` = 'infinite'").head()["count"] == 2


def test_bool_words_and_unicode(spark):
    df = frame(spark, [(" YES",), ("off",), ("é",), (None,)], "x string")
    assert col_of(ty.bool_to_int(df, ["x"]), "x") == [1, 0, None, None]
    assert not ty.is_bool_like(df, ["x"]).head()["is_bool_like"]
    assert encode.fit_onehot(df.where("x is not null"), "x").params["values"] == [" YES", "off", "é"]


def test_coercion_counts_nulls_as_failures(spark):
    df = frame(spark, [("1",), ("2",), ("3",), (None,)], "x string")
    assert ty.fit_coerce_numeric(df, 0.80).params["columns"] == []
    assert ty.fit_coerce_numeric(df, 0.75).params["columns"] == ["x"]


def test_number_format_rounds_like_binary(spark):
    rows = [(186065.0,), (2.5,), (0.125,), (1234567.0,), (-1500.0,)]
    got = col_of(frame(spark, rows, "x double").select(text.format_number(F.col("x")).alias("t")), "t")
    fmt = lambda v: f"{v / 1e6:.2f}M" if abs(v) >= 1e6 else f"{v / 1e3:.2f}K" if abs(v) >= 1e3 else f"{v:.2f}"
    assert got == [fmt(r[0]) for r in rows]


# ---- encoding, scaling, outliers ----------------------------------------------


def test_one_hot_rows_sum_to_one(spark):
    df = frame(spark, [("a",), ("b",), ("c",), ("a",)], "x string")
    wide = encode.fit_onehot(df, "x").transform(df)
    assert [sum(r) for r in wide.collect()] == [1] * 4
    assert wide.columns == ["x_a", "x_b", "x_c"]


def test_one_hot_refuses_instead_of_cutting(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError):
        encode.fit_onehot(df, "x", cap=10)


def test_multihot_trims_tags(spark):
    df = frame(spark, [("a, b,,c",), ("b",), (None,)], "t string")
    got = encode.fit_multihot(df, "t").transform(df)
    assert got.columns == ["t_a", "t_b", "t_c"]
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1), (0, 1, 0), (0, 0, 0)]


def test_label_codes_are_dense_and_unseen_is_default(spark):
    df = frame(spark, [("z",), ("a",), ("m",), (None,)], "x string")
    step = encode.fit_label(df, "x")
    assert col_of(step.transform(df), "x") == [2, 0, 1, -1]
    assert col_of(step.transform(frame(spark, [("new",)], "x string")), "x") == [-1]


def test_scaling_bounds_and_constants(spark):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    got = features.fit_scale(df, ["a", "k"], "minmax").transform(df).collect()
    assert min(r["a"] for r in got) == 0.0 and max(r["a"] for r in got) == 1.0
    assert {r["k"] for r in got} == {0.0}


def test_clip_is_idempotent_and_keeps_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)] + [(1e6,), (None,)], "x double")
    step = outliers.fit_outliers(df, ["x"], "iqr", "clip")
    once = step.transform(df)
    assert once.exceptAll(step.transform(once)).count() == 0
    assert once.where("x is null").count() == 1


def test_zscore_without_spread_flags_nothing(spark):
    df = spark.createDataFrame([(2.0,)] * 20, "x double")
    step = outliers.fit_outliers(df, ["x"], "zscore", "flag")
    assert outliers.outlier_report(df, step).head()["count"] == 0


def test_unknown_choices_raise(spark):
    df = frame(spark, [(1.0, "a")] * 12, "x double, t string")
    with pytest.raises(ValueError):
        outliers.fit_outliers(df, ["x"], "isolation_forest")
    with pytest.raises(ValueError):
        impute.fit_impute(df, {"x": "knn"})
    with pytest.raises(ValueError):
        encode.fit_encode(df, {"t": "hash"})


def test_bins_keep_nulls(spark):
    df = frame(spark, [(0.0,), (1.0,), (10.0,), (None,)], "x double")
    got = features.add_features(df, [{"type": "bin", "col": "x", "n_bins": 5}])
    assert col_of(got, "x_bin") == [0, 0, 4, None]
    assert chartdata.histogram(df, ["x"], 5).agg(F.sum("count")).head()[0] == 3


def test_greedy_filter_prefers_target_relevance():
    r = {("a", "b"): 0.95, ("a", "c"): 0.2, ("b", "c"): 0.96}
    assert select.greedy_drop(list("abc"), r, {"a": 0.1, "b": 0.5, "c": 0.4}, 0.9) == [("a", "b", 0.95), ("c", "b", 0.96)]
    assert select.greedy_drop(list("abc"), r, {}, 0.9) == [("b", "a", 0.95)]


# ---- splits -------------------------------------------------------------------


def test_split_parts_are_disjoint_and_complete(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 3)
    out = split.split_stratified(df, ["id"], "y", 0.2, 0.1)
    assert out.count() == 1000
    for r in out.groupBy("y", "split").count().collect():
        n = 334 if r["y"] == 0 else 333
        want = {"test": round(n * 0.2), "val": round(n * 0.3) - round(n * 0.2)}
        want["train"] = n - sum(want.values())
        assert r["count"] == want[r["split"]]


def test_split_refinement_is_exact(spark, monkeypatch):
    df = spark.range(5000)
    want = split.split_random(df, ["id"], 0.37)
    monkeypatch.setattr(split, "CELL_ROWS", 1)
    assert want.exceptAll(split.split_random(df, ["id"], 0.37)).count() == 0
    assert want.where("split = 'test'").count() == 1850


def test_split_guard(spark):
    with pytest.raises(ValueError):
        split.split_train_val_test(spark.range(10), ["id"], 0.6, 0.4)


def test_null_class_is_a_class(spark):
    df = spark.range(100).withColumn("y", F.when(F.col("id") < 60, "a"))
    got = {(r["y"], r["split"]): r["count"] for r in split.split_stratified(df, ["id"], "y", 0.25).groupBy("y", "split").count().collect()}
    assert got == {("a", "test"): 15, ("a", "train"): 45, (None, "test"): 10, (None, "train"): 30}


# ---- models -------------------------------------------------------------------


def test_classification_metrics_by_hand(spark):
    df = frame(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    m = ml.classification_metrics(df).head()
    assert m["accuracy"] == 0.5 and m["recall"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert m["precision"] == pytest.approx((1 + 1 / 3 + 0) / 3)


def test_knn_blocks_do_not_change_the_answer(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(300), "a": rng.random(300), "b": rng.random(300), "y": rng.integers(0, 2, 300)})
    df = spark.createDataFrame(pdf)
    one = knn.neighbours(df, df, "id", ["a", "b"], 3, exclude_self=True, block_rows=1000)
    many = knn.neighbours(df, df, "id", ["a", "b"], 3, exclude_self=True, block_rows=40)
    key = lambda d: sorted((r["query_id"], r["rank"], r["id"]) for r in d.collect())
    assert key(one) == key(many)
    d = np.sqrt(((pdf[["a", "b"]].to_numpy()[:, None] - pdf[["a", "b"]].to_numpy()[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert key(many) == sorted((i, k + 1, j) for i in range(300) for k, j in enumerate(np.argsort(d[i])[:3]))


def test_failed_model_stays_on_the_board(spark):
    df = spark.range(200).selectExpr("id", "cast(id % 7 as double) as a", "id % 3 as y")
    board = ml.automl_run(df, "y", ["id"], ["a"], ["tree", "no_such_model"]).leaderboard.collect()
    assert [(r["name"], r["status"]) for r in board] == [("tree", "success"), ("no_such_model", "failed")]


def test_ensemble_majority(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 10 as double) as a", "case when id % 10 < 5 then 'lo' else 'hi' end as y")
    result = ml.automl_run(df, "y", ["id"], ["a"], ["tree", "naive_bayes", "logistic"])
    got = ml.ensemble_predict(result, df, ["id"])
    label = F.when(F.col("id") % 10 < 5, 1.0).otherwise(0.0)
    assert got.where(F.col("prediction") == label).count() >= 295


# ---- plans --------------------------------------------------------------------


def test_config_round_trip_and_problems():
    cfg = PrepConfig(target="y", keys=["id"], scaling="robust", feature_rules=[{"type": "square", "col": "a"}])
    assert PrepConfig.from_json(cfg.to_json()) == cfg and not cfg.problems()
    assert PrepConfig(stages=["nope"], test_size=0.9, val_size=0.2).problems()


def test_plan_json_round_trip(spark, tmp_path):
    df = frame(spark, [(1.0, "a"), (None, "b"), (5.0, None)], "x double, t string")
    plan = FittedPlan([impute.fit_impute(df, {"x": "mean", "t": "mode"}), encode.fit_label(df, "t")])
    plan.save(spark, str(tmp_path / "plan"))
    again = FittedPlan.load(spark, str(tmp_path / "plan"))
    assert again.transform(df).collect() == plan.transform(df).collect()


def test_safe_mode_goes_on(spark):
    from millrace.plans.run import preprocess_only

    df = spark.range(30).selectExpr("id", "cast(id as double) as x", "cast(id % 4 as string) as c")
    bad = PrepConfig(keys=["id"], impute_columns={"x": "no_such_strategy"})
    with pytest.raises(ValueError):
        preprocess_only(df, bad)
    bad.safe_mode = True
    out = preprocess_only(df, bad, {"double_it": lambda d: d.withColumn("x2", F.col("x") * 2)})
    assert ("missing", "failed") in {(s, i) for s, i, _ in out.summary} and "x2" in out.df.columns


def test_prepared_plan_replays_on_new_rows(spark):
    from millrace.plans.run import preprocess_only

    df = spark.range(200).selectExpr(
        "id", "case when id % 5 = 0 then null else cast(id as double) end as x", "concat('c', id % 4) as c", "case when id % 2 = 0 then 'yes' else 'no' end as f"
    )
    out = preprocess_only(df, PrepConfig(keys=["id"], drop_duplicates=False))
    again = out.plan.transform(df)
    assert again.columns == out.df.columns
    assert again.exceptAll(out.df).count() == 0


def test_step_on_missing_columns_is_a_no_op(spark):
    df = spark.range(3)
    step = Step("onehot", {"column": "gone", "values": ["a"]})
    assert step.transform(df).columns == ["id"]


def test_family_rule_fills_dates(spark):
    rows = [(1, "a", None, None), (2, "a", 3.0, "2020-01-02"), (3, "a", None, None), (1, "b", 5.0, None), (2, "b", 9.0, "2021-05-05")]
    df = spark.createDataFrame(rows, "t int, k string, x double, d string").withColumn("d", F.col("d").cast("date"))
    got = {(r["k"], r["t"]): (r["x"], str(r["d"])) for r in impute.fill_by_family(df, ["t"], ["k"]).collect()}
    assert got == {
        ("a", 1): (5.0, "2020-01-02"), ("a", 2): (3.0, "2020-01-02"), ("a", 3): (5.0, "2020-01-02"),
        ("b", 1): (5.0, "2021-05-05"), ("b", 2): (9.0, "2021-05-05"),
    }


def _near_by_force(t, q, k, exclude_self=False):
    out = []
    for qid, v in q:
        found = sorted((round(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), 9), i) for i, w in t if not (exclude_self and i == qid))
        out += [(qid, rank, i) for rank, (_, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k, block_rows, exclude_self", [(3, 20, True), (4, 50, False), (50, 30, True), (900, 100, False)])
def test_knn_by_cells_is_exact(spark, k, block_rows, exclude_self):
    """Clusters, a third of all rows at one point, ties on a grid, and k beyond the table."""
    rng = np.random.default_rng(3)
    points = [*rng.normal(0, 1, (120, 3)).tolist(), *rng.normal(40, 1, (120, 3)).tolist(), *[[5.0, 5.0, 5.0]] * 180]
    points += [[float(x), float(y), 0.0] for x in range(10) for y in range(10)]
    t = list(enumerate(points))
    train = spark.createDataFrame(t, "id long, v array<double>")
    q = t[::9]
    got = knn.neighbours(train, spark.createDataFrame(q, "id long, v array<double>"), "id", "v", k, exclude_self, block_rows)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got.collect()) == _near_by_force(t, q, k, exclude_self)


def test_knn_visits_few_blocks(spark):
    """A query meets the cells that can hold a neighbour: fewer rows than rows times blocks."""
    rng = np.random.default_rng(5)
    centres = rng.uniform(-1000, 1000, (30, 4))
    rows = [(i, (centres[i % 30] + rng.normal(0, 1, 4)).tolist()) for i in range(3000)]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    cells = knn.fit_cells(v, 3000, 100)
    assert cells.rows.sum() == 3000 and len(cells.rows) >= 30
    placed = knn._placed(v, cells)
    first = knn._visits(v, cells, 6, False)
    reach = knn._kept(knn._compare(placed, first, cells, 6, 100), 6).groupBy("query_id").agg(F.max("distance").alias("radius"))
    then = knn._visits(v.join(reach.withColumnRenamed("query_id", "id"), "id"), cells, 6, True)
    assert first.count() + then.count() < 3000 * len(cells.rows) / 5


def test_knn_sends_a_query_once_where_bounds_rule_nothing_out(spark):
    """In many dimensions nearly all rings are visited: a query's vector leaves the visit step once and
    a task's rows are bounded, where it was sent once per ring before."""
    rng = np.random.default_rng(11)
    points = rng.normal(0, 1, (900, 32))
    points /= np.linalg.norm(points, axis=1)[:, None]
    t = [(i, p) for i, p in enumerate(points.tolist())]
    v = spark.createDataFrame(t, "id long, v array<double>")
    cells = knn.fit_cells(v, 900, 10)
    then = knn._visits(v.withColumn("radius", F.lit(1.5)), cells, 6, True)
    assert len(cells.rows) > 50 and then.count() <= 900
    got = knn.neighbours(v, v, "id", "v", 5, True, 10)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got.collect()) == _near_by_force(t, t, 5, True)


def test_knn_of_nothing(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    some = spark.createDataFrame([(1, [0.0, 1.0])], "id long, v array<double>")
    assert knn.neighbours(none, some, "id", "v", 2).count() == 0
    assert knn.neighbours(some, none, "id", "v", 2).count() == 0


def _jobs(spark, work):
    """Spark jobs that ``work`` starts."""
    group = f"count-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_encoders_count_all_columns_in_one_pass(spark, monkeypatch):
    """As many jobs for 60 columns as for 3, with tables and inlined values, and equal codes."""
    monkeypatch.setattr(encode, "INLINE", 5)
    hows = ["label", "frequency", "target"]
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({f"c{i}": rng.choice([f"v{j}" for j in range(8)] + [None], 400) for i in range(60)} | {"y": rng.normal(0, 1, 400)})
    df = spark.createDataFrame(pdf).cache()
    choice = {f"c{i}": hows[i % 3] for i in range(60)}
    few = {c: choice[c] for c in ("c0", "c1", "c2")}
    # one more where a stage is planned anew for its size
    assert _jobs(spark, lambda: encode.fit_encode(df, choice, "y")) <= _jobs(spark, lambda: encode.fit_encode(df, few, "y")) + 1
    steps = encode.fit_encode(df, choice, "y")
    assert all("table" in s.params for s in steps)
    out = steps[3].transform(steps[1].transform(steps[2].transform(df))).toPandas()
    values = sorted(v for v in pdf["c3"].unique() if v is not None)
    assert sorted(out["c3"]) == sorted(values.index(v) if v is not None else -1 for v in pdf["c3"])
    shares = pdf["c1"].value_counts(normalize=True)
    assert sorted(out["c1"].round(9)) == sorted(round(shares.get(v, 0.0), 9) for v in pdf["c1"])
    means = pdf.groupby("c2")["y"].mean()
    assert sorted(out["c2"].round(6)) == sorted(round(means.get(v, pdf["y"].mean()), 6) for v in pdf["c2"])


def test_wide_values_are_not_broadcast(spark, monkeypatch):
    """The broadcast bound counts bytes: few long values weigh as many short ones."""
    monkeypatch.setattr(encode, "INLINE", 2)
    df = spark.createDataFrame([("x" * 6400 + str(i % 3),) for i in range(30)], "t string")
    step = encode.fit_label(df, "t")
    assert step.params["rows"] >= 300


@pytest.mark.parametrize("bracket_rows", [None, 100])
def test_quantiles_of_200_columns(spark, bracket_rows):
    """Continuous, tied, constant, infinite and empty columns; seven quantiles each, exactly."""
    rng = np.random.default_rng(11)
    n, probs = 2500, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    made = {
        0: lambda: rng.normal(0, 1e6, n), 1: lambda: rng.integers(0, 3, n).astype(float), 2: lambda: np.full(n, 7.0),
        3: lambda: np.where(rng.random(n) < 0.4, np.nan, rng.random(n)), 4: lambda: np.full(n, np.nan),
    }
    pdf = pd.DataFrame({f"c{i}": made[i % 5]() for i in range(200)})
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), list(pdf), probs, exact_cells=0, bracket_rows=bracket_rows)
    for c in pdf:
        known = pdf[c].dropna()
        if known.empty:
            assert got[c] == [None] * len(probs)
        else:
            assert got[c] == pytest.approx(list(known.quantile(probs)), rel=1e-12)


def test_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    """Order statistics outside every interval are looked for between them."""
    df = spark.range(1000).select((F.col("id") * 1.5).alias("x"))
    monkeypatch.setattr(quantiles, "_spans", lambda *a: ([1000], [[(30.0, 40.0), (900.0, 901.0)]]))
    probs = [0.0, 0.02, 0.5, 1.0]
    assert quantiles.exact_quantiles(df, ["x"], probs, exact_cells=0)["x"] == pytest.approx([1.5 * 999 * p for p in probs])
