"""Queries that fit, score, explain and compare models, in batches and on streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import anomaly as D
from ..operators import autoencoder as N
from ..operators import columns as C
from ..operators import features as X
from ..operators import trees as M
from ..operators.ordered import train_test_split
from ..session import scratch, scratch_path, store
from ..sources import writers as W
from ..streaming import latest_rows, score_stream, sync_latest, write_stream
from .fixtures import CALLS_CTE, FEATURES, calls, calls_from, clean_calls, labelled_cte
from .gate import GateParams, train_gate
from .registry import query, table

# boosted trees learn the quality score of a call from what the network measured
LABEL = "mos"
SPECS = [
    X.pass_through(LABEL), X.standard_scaler("packet_loss", "loss"), X.robust_scaler("jitter", "shake"),
    X.min_max_scaler("duration", "seconds"), X.max_abs_scaler("carrier_id", "carrier"),
    X.date_features("start_time", "start"), X.label_encoder("data_center", "center"),
]
INPUTS = ["call_id", LABEL, "packet_loss", "jitter", "duration", "carrier_id", "start_time", "data_center"]


def _scored_calls(spark, sf):
    """Calls with a known score, derived once for the passes of a fit."""
    return store(C.drop_null_rows(C.canonical_columns(calls(spark, sf)).select(*INPUTS)))


def _trees(rows, **options):
    settings = {"track_history": False, **options}  # only the training log reads it
    return M.fit_boosted_tree_regressor(rows, LABEL, X.FeatureTransform(SPECS), **settings)


# The rows that the boosted trees of these queries read, as SQL.
SCORED = f"""with {CALLS_CTE}, scored as (
  select call_id, mos, packet_loss, jitter, duration_seconds as duration, carrier_id, start_time, data_center from calls
  where call_id is not null and mos is not null and packet_loss is not null and jitter is not null
    and duration_seconds is not null and carrier_id is not null and start_time is not null and data_center is not null)
"""
STEPS = {0: 1.5, 1: 4.25, 2: 2.0, 3: 3.5, 4: 0.75, 5: 5.0, 6: 2.75}


def _stepped(rows):
    """The scored calls with a label that a tree can learn without error: a value per carrier."""
    value = F.create_map([x for k, v in STEPS.items() for x in (F.lit(k), F.lit(v))])[F.col("carrier_id")]
    return rows.withColumn(LABEL, value)


_STEP_SQL = "case carrier_id " + " ".join(f"when {k} then {v}::double" for k, v in STEPS.items()) + " end"


def _held_out(rows):
    """(train, test) of the scored calls by their key."""
    return train_test_split(rows, 0.8, "call_id", "held out")


def _labelled(spark, sf):
    clean = store(clean_calls(spark, sf).select("call_id", *FEATURES))
    known = C.label_calls(clean, keep_unlabelled=False)
    return known.select("call_id", *FEATURES, (F.col("label") == "anomaly").alias("is_anomaly"))


def _autoencoder(rows, **options):
    return N.fit_autoencoder(rows, FEATURES, **options)


# boosted trees
@query("fit_boosted_tree_regressor", SCORED + "select 'mos' as label, true as beats_the_mean, true as beats_one_tree")
def fit_boosted_tree_regressor(spark, sf):
    """Two averaged boosters, measured on held-out calls against the mean and against a single tree."""
    train, test = _held_out(_scored_calls(spark, sf))
    many = D.evaluate(_trees(train, num_parallel_tree=2), test).select(F.col("mean_squared_error").alias("m"), "r2_score")
    one = D.evaluate(_trees(train, max_iter=1), test).select(F.col("mean_squared_error").alias("o"))
    return many.crossJoin(one).select(  # one row each
        F.lit(LABEL).alias("label"), (F.col("r2_score") > 0).alias("beats_the_mean"), (F.col("m") < F.col("o")).alias("beats_one_tree")
    )


@query("predict", SCORED + f"select call_id, carrier_id, {_STEP_SQL} as predicted_mos from scored")
def predict(spark, sf):
    rows = _stepped(_scored_calls(spark, sf))
    return M.predict(_trees(rows), rows).select("call_id", "carrier_id", F.round(f"predicted_{LABEL}", 6).alias(f"predicted_{LABEL}"))


@query("training_info", "select cast(i as int) as iteration, true as measured, true as not_worse from range(1, 21) t(i)")
def training_info(spark, sf):
    log = N.training_info(_trees(_scored_calls(spark, sf), track_history=True, early_stop=False))
    first = log.filter("iteration = 1").select(F.col("loss").alias("first"))
    return log.crossJoin(first).select(  # at most one row per iteration
        "iteration", (F.col("loss").isNotNull() & F.col("eval_loss").isNotNull()).alias("measured"),
        (F.col("loss") <= F.col("first")).alias("not_worse"),
    )


@query("evaluate", """
select 'trees' as model, unnest(['mean_absolute_error', 'mean_squared_error', 'mean_squared_log_error', 'r2_score',
  'root_mean_squared_error']) as metric, unnest([0.0, 0.0, 0.0, 1.0, 0.0]::double[]) as value
""")
def evaluate(spark, sf):
    train, test = _held_out(_stepped(_scored_calls(spark, sf)))
    return D.metric_rows(D.evaluate(_trees(train), test), "trees").withColumn("value", F.round("value", 6))


@query("save_model", SCORED + "select call_id, true as equal from scored")
def save_model(spark, sf):
    """Every call under the fitted model and the reloaded one."""
    rows = _scored_calls(spark, sf)
    path = scratch_path(spark, "trees-model")
    model = _trees(rows)
    W.save_model(model, path)
    first = M.predict(model, rows).withColumnRenamed(f"predicted_{LABEL}", "first")
    again = M.predict(W.load_model(path, M.TreeModel), first)
    return again.select("call_id", (F.col("first") == F.col(f"predicted_{LABEL}")).alias("equal"))


@query("batch_predict", SCORED + "select call_id, true as equal from scored")
def batch_predict(spark, sf):
    """The predictions written as JSON lines against those of the same instances in place."""
    codes = tuple(f"codes-{s.column}" for s in SPECS if s.kind == "label")
    target = scratch_path(spark, "predictions")
    with scratch(spark, keep=codes):
        source = scratch_path(spark, "instances")
        with scratch(spark, keep=codes):
            rows = _scored_calls(spark, sf)
            model = _trees(rows)
            W.write_jsonl(rows, source, compression="gzip")
        M.batch_predict(model, source, target, rows.schema, exclude=[LABEL], compression="gzip")
    written = rows.drop(LABEL).schema.add(f"predicted_{LABEL}", "double")
    found = spark.read.schema(written).json(target).withColumnRenamed(f"predicted_{LABEL}", "written")
    again = M.predict(model, found)
    return again.select("call_id", (F.abs(F.col("written") - F.col(f"predicted_{LABEL}")) < 1e-9).alias("equal"))


@query("feature_importance", """
select unnest(['loss', 'shake', 'seconds', 'carrier', 'center', 'start_year', 'start_week']) as feature,
       true as splits_are_inner_nodes
""")
def feature_importance(spark, sf):
    """Every feature, and whether all splits together are the inner nodes of the trees."""
    model = _trees(_scored_calls(spark, sf))
    nodes = sum((t.numNodes - 1) // 2 for m in model.models for t in m.stages[-1].trees)
    found = M.feature_importance(model)
    total = found.agg(F.sum("importance_weight")).first()[0]
    return found.select("feature", F.lit(total == nodes).alias("splits_are_inner_nodes"))


@query("explain_predict", SCORED + "select call_id, true as adds_up, 7::bigint as attributions from scored")
def explain_predict(spark, sf):
    """Whether the baseline and the attributions of each call add up to its prediction."""
    rows = _scored_calls(spark, sf)
    model = _trees(rows)
    explained = M.explain_predict(model, rows, top_k=len(model.features))
    total = F.aggregate("top_feature_attributions", F.col("baseline"), lambda acc, p: acc + p["attribution"])
    return explained.select(
        "call_id", (F.abs(total - F.col(f"predicted_{LABEL}")) < 1e-6).alias("adds_up"),
        F.size("top_feature_attributions").cast("bigint").alias("attributions"),
    )


@query("global_explain", "select 'carrier' as feature, true as first, true as alone")
def global_explain(spark, sf):
    """Of calls whose label hangs on the carrier alone, the carrier is the only feature that counts."""
    rows = _stepped(_scored_calls(spark, sf))
    found = M.global_explain(_trees(rows), rows).collect()  # one row per feature
    rest = sum(r["attribution"] for r in found[1:])
    return spark.createDataFrame([(found[0]["feature"], found[0]["attribution"] > 0, abs(rest) < 1e-6)], "feature string, first boolean, alone boolean")


@query("fit_multiclass_boosted_tree", "select count(distinct label) as classes, true as is_a_share from embeddings")
def fit_multiclass_boosted_tree(spark, sf):
    dim = table(spark, sf, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    names = [f"x{i}" for i in range(dim)]
    rows = table(spark, sf, "embeddings").select(
        "vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
    )
    train, test = train_test_split(store(rows), 0.8, "vec_id", "held out")
    model = M.fit_multiclass_boosted_tree(train, "label", names)
    error = A.multiclass_error(M.predict(model, test), "label", "predicted_label").first()[0]
    return rows.agg(F.countDistinct("label").alias("classes")).withColumn("is_a_share", F.lit(0 <= error <= 1))


STUMP_L1, STUMP_L2 = 40.0, 25.0


@query("boosted_stump", f"""
with r as (select l_orderkey, l_linenumber, l_partkey, l_quantity as y, (l_returnflag = 'R')::int as x from lineitem),
m as (select avg(y) as mean from r),
g as (select x, sum(y - mean) as s, count(*) as n from r, m group by x)
select l_orderkey, l_linenumber, l_partkey, round(mean + sign(s) * greatest(abs(s) - {STUMP_L1}, 0) / (n + {STUMP_L2}), 6) as predicted
from r join g using (x), m
""")
def boosted_stump(spark, sf):
    """One tree of one split under both penalties, whose leaves SQL can state."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("y"), (F.col("l_returnflag") == "R").cast("double").alias("x")
    )
    model = M.fit_boosted_tree_regressor(
        rows.select("x", "y"), "y", X.FittedTransform([X.pass_through("x")]), max_iter=1, max_depth=1, learn_rate=1.0, subsample=1.0,
        early_stop=False, train_fraction=1.0, l1_reg=STUMP_L1, l2_reg=STUMP_L2, track_history=False,
    )
    return M.predict(model, rows).select("l_orderkey", "l_linenumber", "l_partkey", F.round("predicted_y", 6).alias("predicted"))


# autoencoder
LABELLED = f"with {CALLS_CTE}, {labelled_cte()} "
_NO_ERROR = ", ".join(f"0.0::double as {e}" for e in D.ERRORS)


@query("fit_autoencoder", "select cast(i as int) as iteration, true as measured from range(1, 11) t(i)")
def fit_autoencoder(spark, sf):
    log = N.training_info(_autoencoder(_labelled(spark, sf), early_stop=False))
    return log.select("iteration", (F.col("loss").isNotNull() & F.col("eval_loss").isNotNull()).alias("measured"))


def _no_error(df):
    return df.withColumns({e: F.abs(F.round(e, 6)) for e in D.ERRORS})


@query("fit_pca_reconstructor", f"select {_NO_ERROR}")
def fit_pca_reconstructor(spark, sf):
    """As many components as columns give every row back."""
    rows = _labelled(spark, sf)
    return _no_error(D.evaluate(N.fit_pca_reconstructor(rows, FEATURES, len(FEATURES)), rows)).select(*D.ERRORS)


@query("reconstruction_loss", LABELLED + f"select call_id, {_NO_ERROR} from labelled where label = 'normal'")
def reconstruction_loss(spark, sf):
    rows = _labelled(spark, sf)
    scored = D.reconstruction_loss(N.fit_pca_reconstructor(rows, FEATURES, len(FEATURES)), rows)
    return _no_error(C.filter_predicate(scored, "not is_anomaly and mean_squared_log_error < 1")).select("call_id", *D.ERRORS)


@query("detect_anomalies", LABELLED + "select call_id, true as agrees from labelled where label <> 'none'")
def detect_anomalies(spark, sf):
    """The flags of the fitted network against the cut that Spark's own exact percentile gives."""
    rows = _labelled(spark, sf)
    found = D.detect_anomalies(_autoencoder(rows), rows, 0.04).drop(*FEATURES)
    cut = found.agg(F.percentile("mean_squared_error", 0.96).alias("cut"))
    above = F.col("mean_squared_error") > F.col("cut") * (1 + 1e-9)
    below = F.col("mean_squared_error") < F.col("cut") * (1 - 1e-9)
    agrees = F.when(above, F.col("is_anomaly")).when(below, ~F.col("is_anomaly")).otherwise(True)
    return found.crossJoin(cut).select("call_id", agrees.alias("agrees"))  # the cut is one row


def _search(rows):
    grid = {"activation": ["relu", "sigmoid"], "optimizer": ["adam", "sgd"]}
    return N.hyperparameter_search(rows, FEATURES, grid, num_trials=4)


@query("hyperparameter_search", """
select 'best trial' as model, unnest(['mean_absolute_error', 'mean_squared_error', 'mean_squared_log_error', 'root_mean_squared_error']) as metric,
       true as measured, true as best
""")
def hyperparameter_search(spark, sf):
    """The metrics of the best trial, whose held-out loss no other trial beats."""
    rows = _labelled(spark, sf)
    search = _search(rows)
    losses = [t["loss"] for t in search.trials if t["loss"] is not None]
    best = next(t["loss"] for t in search.trials if t["is_best"]) == min(losses)
    found = D.metric_rows(D.evaluate(search.model(), rows), "best trial")
    return found.select("model", "metric", (F.col("value") >= 0).alias("measured"), F.lit(best).alias("best"))


@query("trial_info", """
select cast(row_number() over () as int) as trial_id, hyperparameters, 'SUCCEEDED' as status, true as measured, true as one_is_best from (
  select '{"activation": "' || a || '", "optimizer": "' || o || '"}' as hyperparameters
  from (values (1, 'relu'), (2, 'sigmoid')) x(i, a), (values (1, 'adam'), (2, 'sgd')) y(j, o) order by i, j)
""")
def trial_info(spark, sf):
    path = scratch_path(spark, "search")
    _search(_labelled(spark, sf)).save(path)
    trials = N.trial_info(N.Search.load(path))
    best = trials.filter("is_best").count()
    return trials.select("trial_id", "hyperparameters", "status", F.col("loss").isNotNull().alias("measured"), F.lit(best == 1).alias("one_is_best"))


@query("train_gate", "select 'mean_squared_error' as metric, true as known_model, true as follows_the_threshold")
def gate(spark, sf):
    rows = _labelled(spark, sf)
    blessed = N.fit_pca_reconstructor(rows, FEATURES, 2)
    params = GateParams(FEATURES, model_path=scratch_path(spark, "gate"))
    decision, _ = train_gate(rows.filter("is_anomaly"), rows.filter("not is_anomaly"), params, blessed)
    return decision.select(
        "metric", F.col("best_model").isin("challenger", "blessed").alias("known_model"),
        (F.col("deploy") == (F.col("value") < params.threshold)).alias("follows_the_threshold"),
    )


@query("validate_scored_rows", f"select unnest([true, false]) as is_anomaly, {_NO_ERROR}")
def validate_scored_rows(spark, sf):
    rows = _labelled(spark, sf)
    model = N.fit_pca_reconstructor(rows, FEATURES, len(FEATURES))
    probe = rows.groupBy("is_anomaly").agg(*[F.avg(c).alias(c) for c in FEATURES])
    return _no_error(D.validate_scored_rows(model, probe)).select("is_anomaly", *D.ERRORS)


# flags, agreement and choice that need no fitted network
@query("detect_by_contamination", """
select o_orderkey, o_totalprice > (select quantile_cont(o_totalprice, 0.96) from orders) as is_anomaly from orders
""")
def detect_by_contamination(spark, sf):
    return D.flag_by_contamination(table(spark, sf, "orders"), "o_totalprice", 0.04).select("o_orderkey", "is_anomaly")


@query("detect_by_sigma", """
select o_orderkey, o_totalprice > (select avg(o_totalprice) + stddev_pop(o_totalprice) from orders) as is_anomaly from orders
""")
def detect_by_sigma(spark, sf):
    return D.detect_by_sigma(table(spark, sf, "orders"), "o_totalprice", 1).select("o_orderkey", "is_anomaly")


@query("error_arithmetic", """
select l_orderkey, l_linenumber, l_partkey, round(abs(l_quantity - 25), 6) as absolute, round(pow(l_quantity - 25, 2), 6) as squared,
       round(pow(ln(1 + l_quantity) - ln(26), 2), 6) as squared_log from lineitem
""")
def error_arithmetic(spark, sf):
    """Errors of the constant reconstruction 25, through a network whose output layer is only a bias."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    identity = X.FittedTransform([X.standard_scaler("l_quantity")], {"l_quantity": {"mean": 0.0, "std": 1.0}})
    constant = N.AutoencoderModel(["l_quantity"], N.Network((1, 1), "linear"), N.np.array([0.0, 25.0]), identity)
    scored = D.reconstruction_loss(constant, rows)
    names = zip(("absolute", "squared", "squared_log"), D.ERRORS)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(e, 6).alias(n) for n, e in names])


FLAGGED = f"""
with {CALLS_CTE}, {labelled_cte()},
p as (select from_number, to_number, mos < 3 as f from clean),
a as (select from_number, to_number, label = 'anomaly' as f from labelled where label <> 'none')
"""


def _flagged(spark, sf):
    keys = ["from_number", "to_number"]
    clean = store(clean_calls(spark, sf).select(*keys, *FEATURES))
    pred = C.flag_rows(clean, F.col("mos") < 3).select(*keys, "is_anomaly")
    known = C.label_calls(clean, keep_unlabelled=False)
    return pred, known.select(*keys, (F.col("label") == "anomaly").alias("is_anomaly")), keys


@query("anomaly_agreement", FLAGGED + """
select p.f as predicted, a.f as actual, count(*) as rows from a join p using (from_number, to_number) group by all
""")
def anomaly_agreement(spark, sf):
    return D.anomaly_agreement(*_flagged(spark, sf))


@query("agreeing_rows", FLAGGED + """
select from_number, to_number, p.f as predicted, a.f as actual, count(*) as rows
from a left join p using (from_number, to_number) where p.f = a.f group by all
""")
def agreeing_rows(spark, sf):
    return D.agreeing_rows(*_flagged(spark, sf))


@query("compare_models", """
with m as (select 'flat' as model, avg(pow(l_extendedprice - 1500 * l_quantity, 2)) as v from lineitem
           union all select 'steep', avg(pow(l_extendedprice - 2000 * l_quantity, 2)) from lineitem)
select arg_min(model, v) as best_model, 'mean_squared_error' as metric, round(min(v), 2) as value, min(v) < 1e9 as deploy from m
""")
def compare_models(spark, sf):
    line = table(spark, sf, "lineitem")
    parts = []
    for name, slope in (("flat", 1500.0), ("steep", 2000.0)):
        scored = line.withColumn("guess", F.col("l_quantity") * slope)
        parts.append(D.metric_rows(A.regression_metrics(scored, "l_extendedprice", "guess"), name))
    chosen = D.compare_models(C.union_all(*parts), "mean_squared_error", 1e9)
    return chosen.withColumn("value", F.round("value", 2))


# streams
@query("score_stream", SCORED + "select call_id, true as equal from scored")
def score_stream_query(spark, sf):
    model = _trees(_scored_calls(spark, sf))
    stream = spark.readStream.schema(table(spark, sf, "lineitem").schema).option(
        "pathGlobFilter", "lineitem.parquet"
    ).parquet(sf)
    arriving = C.drop_null_rows(C.canonical_columns(calls_from(stream)).select(*INPUTS))
    target = scratch_path(spark, "scored")
    scored = score_stream(arriving, model).withColumnRenamed(f"predicted_{LABEL}", "arrived")
    write_stream(scored, target, scratch_path(spark, "scored-state"))
    batch = M.predict(model, spark.read.schema(scored.schema).parquet(target))
    return batch.select("call_id", (F.col("arrived") == F.col(f"predicted_{LABEL}")).alias("equal"))


@query("sync_latest", """
select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1
""")
def sync_latest_query(spark, sf):
    stream = spark.readStream.schema(table(spark, sf, "events").schema).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(sf)
    target = scratch_path(spark, "serving")
    run = sync_latest(stream, "user_id", ["ts", "event_id"], target, scratch_path(spark, "serving-state"))
    run.awaitTermination()
    return latest_rows(spark, target, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")
