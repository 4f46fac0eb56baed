"""Queries over tables: joins, statistics, ordering, scalar functions, feature transforms."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import functions as S
from ..operators import aggregates as A
from ..operators import columns as C
from ..operators import features as X
from ..operators import joins as J
from ..operators import ordered as O
from ..sources import readers as R
from .fixtures import CALLS_CTE, FEATURES, clean_calls, labelled_cte
from .registry import query, table

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _hash_sql(key: str, seed: str) -> str:
    return f"(cast('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 8) as bigint) / 4294967296.0::double)"


def _normal_sql(key: str, seed: str, mean: float = 0.0, sd: float = 1.0) -> str:
    u1, u2 = _hash_sql(key, f"{seed}.1"), _hash_sql(key, f"{seed}.2")
    return f"({mean}::double + {sd}::double * sqrt(-2.0::double * ln(greatest({u1}, 1e-12::double))) * cos({2 * math.pi!r}::double * {u2}))"


# joins
@query("join_using", """
select n_name, count(*) as customers, round(sum(c_acctbal), 2) as balance
from customer join nation on c_nationkey = n_nationkey group by n_name
""")
def join_using(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    joined = J.join_using(table(spark, sf, "customer"), nation, "c_nationkey")
    return joined.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("join_chain_by_position", f"""
select o_orderkey, round({_normal_sql('o_orderkey', 'flour', 500, 10)}, 6) as flour,
       cast(round(8 + 4 * {_hash_sql('o_orderkey', 'salt')}) as bigint) as salt,
       round({_normal_sql('o_orderkey', 'water', 330, 20)}, 6) as water
from orders
""")
def join_chain_by_position(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    return J.join_by_position(rows, {
        "flour": F.round(S.box_muller("o_orderkey", "flour", 500, 10), 6),
        "salt": S.round_to_int(8 + 4 * S.hash_uniform("o_orderkey", "salt")),
        "water": F.round(S.box_muller("o_orderkey", "water", 330, 20), 6),
    })


@query("cross_join", """
select r_name, count(*) as pairs, round(sum(s_acctbal), 2) as balance from supplier, region group by r_name
""")
def cross_join(spark, sf):
    pairs = J.cross_join(table(spark, sf, "supplier"), table(spark, sf, "region"))
    return pairs.groupBy("r_name").agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.sum("s_acctbal"), 2).alias("balance")
    )


@query("join_left_multi_key", """
select l_returnflag, count(*) as rows, count(o.l_orderkey) as matched
from lineitem l left join (select distinct l_orderkey, l_linenumber from lineitem where l_quantity > 25) o
  on l.l_orderkey = o.l_orderkey and l.l_linenumber = o.l_linenumber
group by l_returnflag
""")
def join_left_multi_key(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    large = line.filter("l_quantity > 25").groupBy("l_orderkey", "l_linenumber").agg(F.lit(True).alias("large"))
    joined = J.join_left_multi_key(line, large, ["l_orderkey", "l_linenumber"])
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.count("large").alias("matched")
    )


@query("join_unnest", """
select label, pos, count(*) as rows, round(avg(x), 5) as mean
from (select label, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as x from embeddings)
group by label, pos
""")
def join_unnest(spark, sf):
    rows = J.join_unnest(table(spark, sf, "embeddings"), "embedding", "x", position="pos")
    return rows.groupBy("label", F.col("pos").cast("bigint").alias("pos")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("x"), 5).alias("mean")
    )


@query("lookup_label", """
select s_suppkey, coalesce(n_name, 'unknown') as n_name from supplier left join nation on s_nationkey = n_nationkey
""")
def lookup_label(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    named = J.lookup_label(table(spark, sf, "supplier"), nation, "s_nationkey", "n_name")
    return named.select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("n_name"))


@query("fetch_by_key", """
select c_custkey, c_name, c_acctbal from customer
where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')
""")
def fetch_by_key(spark, sf):
    keys = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.fetch_by_key(table(spark, sf, "customer"), keys, "c_custkey").select("c_custkey", "c_name", "c_acctbal")


# statistics
def _stats_sql(source: str, cols, by: str = "") -> str:
    group, lead = (f" group by {by}", f"{by}, ") if by else ("", "")
    return " union all ".join(
        f"select {lead}'{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean,"
        f" round(coalesce(stddev_samp({c}), 0), 6) as std, min({c})::double as min, round(quantile_cont({c}, 0.25), 6) as q25,"
        f" round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75,"
        f" max({c})::double as max from {source}{group}"
        for c in cols
    )


def _rounded(df, by=()):
    std = F.coalesce("std", F.lit(0.0))
    return df.select(
        *by, "column", "count", F.round("mean", 6).alias("mean"), F.round(std, 6).alias("std"), "min",
        *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")], "max",
    )


@query("column_stats", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as count, count(*) - count({c}) as nulls, min({c}) as min, max({c}) as max,"
    f" max(abs({c})) as max_abs, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,"
    f" round(stddev_pop({c}), 6) as std_pop, round(quantile_cont({c}, 0.25), 6) as q25,"
    f" round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75 from lineitem"
    for c in LINE_COLS
))
def column_stats(spark, sf):
    stats = A.column_stats(table(spark, sf, "lineitem"), LINE_COLS)
    rounded = ("mean", "std", "std_pop", "q25", "q50", "q75")
    return stats.withColumns({c: F.round(c, 6) for c in rounded})


@query("quantile_approx", " union all ".join(
    f"select '{c}' as \"column\", {p}::double as prob, quantile_disc({c}, {p}) as value from lineitem"
    for c in ("l_quantity", "l_discount", "l_tax") for p in (0.25, 0.4, 0.75)
))
def quantile_approx(spark, sf):
    return A.quantile_approx(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], [0.25, 0.4, 0.75])


@query("quantile_exact", " union all ".join(
    f"select '{c}' as \"column\", {p}::double as prob, round(quantile_cont({c}, {p}), 6) as value from {t}"
    for t, c in (("orders", "o_totalprice"),) for p in (0.0, 0.01, 0.25, 0.5, 0.95, 1.0)
))
def quantile_exact(spark, sf):
    quantiles = A.quantile_exact(table(spark, sf, "orders"), "o_totalprice", [0.0, 0.01, 0.25, 0.5, 0.95, 1.0])
    return quantiles.withColumn("value", F.round("value", 6))


# the paths that large tables take, whatever the size of these
@query("quantile_exact_bracketed", " union all ".join(
    f"select '{c}' as \"column\", {p}::double as prob, round(quantile_cont({c}, {p}), 6) as value from lineitem"
    for c in ("l_extendedprice", "l_discount") for p in (0.0, 0.05, 0.5, 0.96, 1.0)
))
def quantile_exact_bracketed(spark, sf):
    quantiles = A.quantile_exact(
        table(spark, sf, "lineitem"), ["l_extendedprice", "l_discount"], [0.0, 0.05, 0.5, 0.96, 1.0], distinct_rows=0
    )
    return quantiles.withColumn("value", F.round("value", 6))


@query("quantile_exact_by_ranges", """
select l_returnflag, 'l_extendedprice' as "column", 0.5::double as prob, round(quantile_cont(l_extendedprice, 0.5), 6) as value
from lineitem group by 1
""")
def quantile_exact_by_ranges(spark, sf):
    quantiles = A.quantile_exact(table(spark, sf, "lineitem"), "l_extendedprice", [0.5], by=["l_returnflag"], distinct_rows=0)
    return quantiles.withColumn("value", F.round("value", 6))


@query("describe", _stats_sql("orders", ["o_totalprice", "o_custkey"]))
def describe(spark, sf):
    return _rounded(A.describe(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"]))


@query("describe_by", _stats_sql("lineitem", ["l_extendedprice", "l_discount"], "l_returnflag"))
def describe_by(spark, sf):
    stats = A.describe_by(table(spark, sf, "lineitem"), "l_returnflag", ["l_extendedprice", "l_discount"])
    return _rounded(stats, ["l_returnflag"])


_CROWD = "case when l_linenumber <= 2 then -1 else cast(l_orderkey % 10000 as bigint) end"


@query("describe_many_groups", _stats_sql(f"(select {_CROWD} as crowd, l_extendedprice, l_discount from lineitem)", ["l_extendedprice", "l_discount"], "crowd"))
def describe_many_groups(spark, sf):
    """Up to 10,000 groups, one of which holds about half of all rows, by the path of large tables."""
    rows = table(spark, sf, "lineitem").select(F.expr(_CROWD).alias("crowd"), "l_extendedprice", "l_discount")
    return _rounded(A.describe_by(rows, "crowd", ["l_extendedprice", "l_discount"], distinct_rows=0), ["crowd"])


@query("group_mean", "select event_type, round(avg(value), 6) as value, round(avg(user_id), 6) as user_id from events group by 1")
def group_mean(spark, sf):
    means = A.group_mean(table(spark, sf, "events"), "event_type", ["value", "user_id"])
    return means.withColumns({c: F.round(c, 6) for c in ("value", "user_id")})


@query("value_counts", "select o_orderpriority, count(*) as count from orders group by 1")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("null_counts", "with " + CALLS_CTE + " select 'mos' as \"column\", count(*) - count(mos) as nulls from calls"
       + "".join(f" union all select '{c}', count(*) - count({c}) from calls" for c in ("from_number", "jitter", "duration_seconds")))
def null_counts(spark, sf):
    from .fixtures import calls

    return A.null_counts(calls(spark, sf).select("mos", "from_number", "jitter", "duration_seconds"))


@query("string_agg", """
with placed as (
  select o_custkey, o_orderkey, concat(cast(o_orderkey as varchar), ',', o_orderstatus) as piece,
         sum(length(concat(cast(o_orderkey as varchar), ',', o_orderstatus)) + 1)
           over (partition by o_custkey order by o_orderkey) as upto
  from orders)
select o_custkey, cast(floor((upto - length(piece) - 1) / 60) as bigint) as chunk,
       string_agg(piece, ';' order by o_orderkey) as text
from placed group by all
""")
def string_agg(spark, sf):
    piece = S.concat_text(F.col("o_orderkey").cast("string"), F.lit(","), "o_orderstatus")
    return A.string_agg(table(spark, sf, "orders"), piece, ";", ["o_orderkey"], by=["o_custkey"], max_chars=60)


@query("contamination", f"""
with {CALLS_CTE}, {labelled_cte()}
select round(avg(case label when 'anomaly' then 1.0::double when 'normal' then 0.0::double end), 6) as contamination from labelled
""")
def contamination(spark, sf):
    labelled = C.label_calls(clean_calls(spark, sf))
    flag = F.when(F.col("label") == "anomaly", True).when(F.col("label") == "normal", False)
    return A.contamination(labelled.withColumn("is_anomaly", flag), "is_anomaly").select(
        F.round("contamination", 6).alias("contamination")
    )


@query("sigma_thresholds", " union all ".join(
    f"select {k} as k, round(avg(o_totalprice) + {k} * stddev_pop(o_totalprice), 4) as threshold,"
    f" round({S.normal_confidence(k)!r}::double, 9) as confidence from orders"
    for k in (1, 2, 3, 4, 5)
))
def sigma_thresholds(spark, sf):
    rows = A.sigma_thresholds(table(spark, sf, "orders"), "o_totalprice")
    return rows.select("k", F.round("threshold", 4).alias("threshold"), F.round("confidence", 9).alias("confidence"))


@query("length_budget", """
select count(text) as rows, max(length(text)) as max_chars, round(avg(length(text)), 6) as mean_chars,
       cast(ceil(max(length(text)) / 4.0) as bigint) as token_budget from documents
""")
def length_budget(spark, sf):
    one = A.length_budget(table(spark, sf, "documents"), "text")
    return one.select("rows", "max_chars", F.round("mean_chars", 6).alias("mean_chars"), "token_budget")


# a deterministic "prediction" for metric queries: price from quantity and part size class
PREDICTED = "select *, l_quantity * 1500.0::double as predicted from lineitem"


def _predicted(spark, sf):
    return table(spark, sf, "lineitem").withColumn("predicted", F.col("l_quantity") * 1500.0)


@query("regression_metrics", f"""
select round(avg(abs(e)), 4) as mean_absolute_error, round(avg(e * e), 2) as mean_squared_error,
       round(avg(pow(ln(1 + l_extendedprice) - ln(1 + predicted), 2)), 6) as mean_squared_log_error,
       round(1 - avg(e * e) / var_pop(l_extendedprice), 6) as r2_score,
       round(sqrt(avg(e * e)), 4) as root_mean_squared_error
from (select *, l_extendedprice - predicted as e from ({PREDICTED}))
""")
def regression_metrics(spark, sf):
    one = A.regression_metrics(_predicted(spark, sf), "l_extendedprice", "predicted")
    digits = {"mean_absolute_error": 4, "mean_squared_error": 2, "mean_squared_log_error": 6, "r2_score": 6,
              "root_mean_squared_error": 4}
    return one.select(*[F.round(c, d).alias(c) for c, d in digits.items()])


@query("compute_error", f"select l_orderkey, l_linenumber, round(l_extendedprice - predicted, 4) as error from ({PREDICTED})")
def compute_error(spark, sf):
    rows = C.compute_error(_predicted(spark, sf), "l_extendedprice", "predicted")
    return rows.select("l_orderkey", "l_linenumber", F.round("error", 4).alias("error"))


@query("relative_change", """
with b as (select avg(l_extendedprice) as v from lineitem where l_linestatus = 'F'),
     a as (select avg(l_extendedprice) as v from lineitem where l_linestatus = 'O')
select round(b.v, 4) as before, round(a.v, 4) as after, round((a.v - b.v) / b.v * 100, 2) as percent_change from a, b
""")
def relative_change(spark, sf):
    line = table(spark, sf, "lineitem")
    one = A.relative_change(line.filter("l_linestatus = 'F'"), line.filter("l_linestatus = 'O'"), "l_extendedprice")
    return one.select(F.round("before", 4).alias("before"), F.round("after", 4).alias("after"), "percent_change")


JUDGED = """(select o_orderstatus = 'P' as actual, o_totalprice > 250000 as predicted,
 case when o_totalprice < 150000 then 'F' when o_totalprice < 300000 then 'O' else 'P' end as guess, o_orderstatus from orders)"""


def _judged(spark, sf):
    price = F.col("o_totalprice")
    guess = F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P")
    return table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "P").alias("actual"), (price > 250000).alias("predicted"), guess.alias("guess"),
        "o_orderstatus",
    )


@query("label_confusion", f"""
select count(*) filter (predicted and actual) as true_positive, count(*) filter (predicted and not actual) as false_positive,
       count(*) filter (not predicted and actual) as false_negative,
       count(*) filter (not predicted and not actual) as true_negative,
       round(count(*) filter (predicted and actual)::double / count(*) filter (predicted), 6) as precision,
       round(count(*) filter (predicted and actual)::double / count(*) filter (actual), 6) as recall
from {JUDGED}
""")
def label_confusion(spark, sf):
    one = A.label_confusion(_judged(spark, sf), "actual", "predicted")
    return one.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query("multiclass_error", f"select round(avg((guess <> o_orderstatus)::int), 6) as multiclass_error from {JUDGED}")
def multiclass_error(spark, sf):
    return A.multiclass_error(_judged(spark, sf), "o_orderstatus", "guess").select(
        F.round("multiclass_error", 6).alias("multiclass_error")
    )


@query("f1_scores", f"""
with j as {JUDGED}, classes as (select distinct o_orderstatus as class from j union select distinct guess from j),
counts as (
  select class, count(*) filter (guess = class and o_orderstatus = class)::double as tp,
         count(*) filter (guess = class and o_orderstatus <> class)::double as fp,
         count(*) filter (guess <> class and o_orderstatus = class)::double as fn
  from classes, j group by class)
select 'class' as kind, class, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from counts
union all select 'average', 'macro', round(avg(2 * tp / (2 * tp + fp + fn)), 6) from counts
union all select 'average', 'micro', round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) from counts
""")
def f1_scores(spark, sf):
    return A.f1_scores(_judged(spark, sf), "o_orderstatus", "guess").withColumn("f1", F.round("f1", 6))


# order
@query("row_number", "select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as position from orders")
def row_number(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.row_number(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "position").drop("o_totalprice")


@query("running_sum", """
select event_id, user_id, round(sum(value) over (partition by event_type order by user_id), 4) as running, event_type
from events
""")
def running_sum(spark, sf):
    rows = O.running_sum(table(spark, sf, "events"), "value", "user_id", by=["event_type"], name="running")
    return rows.select("event_id", "user_id", F.round("running", 4).alias("running"), "event_type")


@query("running_sum_all", """
select o_orderkey, round(sum(o_totalprice) over (order by o_orderdate), 2) as running from orders
""")
def running_sum_all(spark, sf):
    rows = O.running_sum(table(spark, sf, "orders"), "o_totalprice", "o_orderdate", name="running")
    return rows.select("o_orderkey", F.round("running", 2).alias("running"))


@query("analytic_over_all", """
select event_id, round((value - avg(value) over ()) / stddev_samp(value) over (), 6) as standard,
       round((value - min(value) over ()) / (max(value) over () - min(value) over ()), 6) as min_max
from events
""")
def analytic_over_all(spark, sf):
    specs = [X.standard_scaler("value", "standard"), X.min_max_scaler("value", "min_max")]
    rows = X.scale_over_all(table(spark, sf, "events"), specs)
    return rows.select("event_id", F.round("standard", 6).alias("standard"), F.round("min_max", 6).alias("min_max"))


@query("sample_per_group", f"""
select event_id, event_type from (
  select *, row_number() over (partition by event_type order by {_hash_sql('event_id', '7')}, event_id) as rn from events)
where rn <= 150
""")
def sample_per_group(spark, sf):
    return O.sample_per_group(table(spark, sf, "events"), "event_type", 150, "event_id", 7).select("event_id", "event_type")


@query("order_by", "select o_orderkey, o_custkey, o_totalprice from orders")
def order_by(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return O.order_by(orders, [F.asc("o_custkey"), F.desc("o_totalprice")])


@query("limit_n", "select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 50")
def limit_n(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return O.limit_n(line, 50, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"])


@query("top_k_per_group", """
select o_custkey, o_orderkey, rank::int as rank from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders)
where rank <= 3
""")
def top_k_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = O.top_k_per_group(orders, "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], 3, rank="rank")
    return best.drop("o_totalprice")


@query("sample_n", f"select o_orderkey from orders order by {_hash_sql('o_orderkey', '11')}, o_orderkey limit 1000")
def sample_n(spark, sf):
    return O.sample_n(table(spark, sf, "orders").select("o_orderkey"), 1000, "o_orderkey", 11)


@query("train_test_split", f"select o_orderkey, case when {_hash_sql('o_orderkey', '123')} < 0.8 then 'train' else 'test' end as part from orders")
def train_test_split(spark, sf):
    train, test = O.train_test_split(table(spark, sf, "orders").select("o_orderkey"), 0.8, "o_orderkey", 123)
    return C.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


# scalar functions
@query("generate_rows", f"""
select pos::bigint as pos, round({_hash_sql('pos', 'u')}, 9) as u, round({_normal_sql('pos', 'z')}, 6) as z
from range(1, (select count(*) from customer) + 1) t(pos)
""")
def generate_rows(spark, sf):
    n = table(spark, sf, "customer").count()
    return R.generate_rows(
        spark, n, u=F.round(S.hash_uniform("pos", "u"), 9), z=F.round(S.box_muller("pos", "z"), 6)
    )


@query("string_funcs", """
select p_partkey, concat(p_brand, '-', p_type) as joined, concat(p_name, ' ', p_type) as described, left(p_name, 4) as lead,
       replace(p_name, 'a', '_') as replaced, length(p_name) as chars,
       case when contains(p_name, 'e') then substr(p_name, strpos(p_name, 'e')) end as tail
from part
""")
def string_funcs(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", S.concat_text("p_brand", F.lit("-"), "p_type").alias("joined"),
        S.name_and_type("p_name", "p_type").alias("described"), S.truncate_text("p_name", 4).alias("lead"),
        F.replace("p_name", F.lit("a"), F.lit("_")).alias("replaced"), F.length("p_name").cast("bigint").alias("chars"),
        S.tail_from("p_name", "e").alias("tail"),
    )


@query("regex_funcs", r"""
select doc_id, md5(regexp_replace(regexp_replace(text, '[0-9A-Za-z_\.-]+@[0-9A-Za-z_\.-]+', '', 'g'), '\([^()]*\)', '', 'g')) as digest,
       length(text) as before from documents
""")
def regex_funcs(spark, sf):
    cleaned = S.strip_parentheses(S.strip_emails("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(cleaned.cast("binary")).alias("digest"), F.length("text").cast("bigint").alias("before")
    )


@query("date_funcs", """
select o_orderkey, cast(cast(o_orderdate as date) - cast((dayofweek(o_orderdate) + 2) % 7 as int) as varchar) as week_start,
       cast(cast(cast(o_orderdate as date) + interval 1 year as date) as varchar) as next_year,
       cast(cast(o_orderdate as date) - 14 as varchar) as two_weeks_before,
       cast(make_date(year(o_orderdate), 6, 1) as varchar) as june
from orders
""")
def date_funcs(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", S.week_starting_friday(day).cast("string").alias("week_start"),
        S.shift_years(day, 1).cast("string").alias("next_year"),
        S.shift_weeks(day, -2).cast("string").alias("two_weeks_before"),
        F.make_date(F.year(day), F.lit(6), F.lit(1)).cast("string").alias("june"),
    )


@query("date_parts", """
select event_id, year(ts)::int as year, weekofyear(ts)::int as week, day(ts)::int as day, hour(ts)::int as hour,
       cast(cast(ts as date) as varchar) as date
from events
""")
def date_parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", F.year(ts).alias("year"), S.iso_week(ts).alias("week"), F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"), ts.cast("date").cast("string").alias("date"),
    )


@query("math_funcs", """
select o_orderkey, round(sqrt(o_totalprice), 6) as root, round(ln(o_totalprice), 6) as log,
       round(sin(o_totalprice) + cos(o_totalprice), 5) as wave, cast(ceil(o_totalprice / 1000) as bigint) as thousands,
       cast(round(o_totalprice / 1000) as bigint) as rounded, abs(o_totalprice - 200000) as gap,
       round(pow(o_totalprice / 100000, 2), 6) as squared, round(2 * acos(-1.0::double), 9) as tau
from orders
""")
def math_funcs(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(F.sqrt(price), 6).alias("root"), F.round(F.log(price), 6).alias("log"),
        F.round(F.sin(price) + F.cos(price), 5).alias("wave"), F.ceil(price / 1000).cast("bigint").alias("thousands"),
        S.round_to_int(price / 1000).alias("rounded"), F.abs(price - 200000).alias("gap"),
        F.round(F.pow(price / 100000, F.lit(2.0)), 6).alias("squared"),
        F.round(2 * F.acos(F.lit(-1.0)), 9).alias("tau"),
    )


@query("box_muller", f"""
select c_mktsegment, count(*) as rows, round(avg(z), 6) as mean, round(stddev_samp(z), 6) as sd
from (select c_mktsegment, {_normal_sql('c_custkey', 'amt', 100, 5)} as z from customer) group by 1
""")
def box_muller(spark, sf):
    rows = table(spark, sf, "customer").withColumn("z", S.box_muller("c_custkey", "amt", 100, 5))
    return rows.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("z"), 6).alias("mean"), F.round(F.stddev_samp("z"), 6).alias("sd")
    )


@query("hash_uniform", f"select event_id, round({_hash_sql('event_id', 'seed')}, 9) as u from events")
def hash_uniform(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(S.hash_uniform("event_id", "seed"), 9).alias("u"))


@query("array_funcs", """
select p_partkey, len(range(1, p_size + 1)) as n, list_sum(range(1, p_size + 1))::bigint as total,
       (p_size * 7) % 5 as at,
       (list_position(list_transform(range(0, 5), lambda i: case when i = (p_size * 7) % 5 then 9 else i end), 9) - 1)::int as arg_max,
       array_to_string(list_transform(list_sort([{'key': p_size % 3, 'value': 'a'}, {'key': 1, 'value': 'b'}, {'key': 2, 'value': 'c'}]),
                                      lambda x: x.value), '') as sorted
from part
""")
def array_funcs(spark, sf):
    series = F.sequence(F.lit(1), F.col("p_size"))
    at = (F.col("p_size") * 7) % 5
    marked = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i == at, 9).otherwise(i))
    keys = F.array(F.col("p_size") % 3, F.lit(1), F.lit(2)).alias("key")
    values = F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("value")
    pairs = S.sort_pairs(keys, values)
    return table(spark, sf, "part").select(
        "p_partkey", F.size(series).cast("bigint").alias("n"),
        F.aggregate(series, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"), at.alias("at"),
        S.arg_max(marked).alias("arg_max"),
        F.array_join(F.transform(pairs, lambda p: p["value"]), "").alias("sorted"),
    )


@query("vector_distance", """
select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: (x::double - 1.0::double) * (x::double - 1.0::double)))), 6) as distance
from embeddings
""")
def vector_distance(spark, sf):
    ones = S.constant_vector(1.0, 64)
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(S.vector_distance("embedding", ones), 6).alias("distance")
    )


@query("json_funcs", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
       '{"id":' || cast(event_id as varchar) || ',"kind":"' || event_type || '"}' as rendered
from events
""")
def json_funcs(spark, sf):
    rendered = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    return table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), rendered.alias("rendered")
    )


@query("conditional_funcs", """
select c_custkey, case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'low' else 'high' end as band,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as segment, c_acctbal >= 0 as solvent
from customer
""")
def conditional_funcs(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("band"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        (balance >= 0).alias("solvent"),
    )


@query("case_piecewise", """
select l_orderkey, l_linenumber, l_partkey, round(p, 6) as penalty,
       case when 100 - p < 0 then 0.0::double when 100 - p > 100 then 100.0::double else round(100 - p) end as score
from (select *, case when l_quantity - 20 > 0 then 3 * (l_quantity - 20) else -0.5::double * (l_quantity - 20) end
              + case when l_discount - 0.05::double > 0 then 400 * (l_discount - 0.05::double)
                     else -100 * (l_discount - 0.05::double) end as p from lineitem)
""")
def case_piecewise(spark, sf):
    penalty = S.case_piecewise("l_quantity", 20, 3, 0.5) + S.case_piecewise("l_discount", 0.05, 400, 100)
    rows = table(spark, sf, "lineitem").withColumn("p", penalty)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("p", 6).alias("penalty"),
        S.clamp_round(100 - F.col("p")).alias("score"),
    )


# feature transforms
def _scale_query(name, spec, sql):
    @query(name, f"select l_orderkey, l_linenumber, round({sql}, 6) as scaled from lineitem")
    def scaled(spark, sf):
        fitted = X.FeatureTransform([spec]).fit(table(spark, sf, "lineitem"))
        rows = fitted.transform(table(spark, sf, "lineitem"), keep=["l_orderkey", "l_linenumber"])
        return rows.withColumn("scaled", F.round("scaled", 6))


_P = "l_extendedprice"
_scale_query("standard_scaler", X.standard_scaler(_P, "scaled"), f"({_P} - avg({_P}) over ()) / stddev_samp({_P}) over ()")
_scale_query("min_max_scaler", X.min_max_scaler(_P, "scaled"), f"({_P} - min({_P}) over ()) / (max({_P}) over () - min({_P}) over ())")
_scale_query("robust_scaler", X.robust_scaler(_P, "scaled"), f"({_P} - quantile_cont({_P}, 0.5) over ()) / (quantile_cont({_P}, 0.75) over () - quantile_cont({_P}, 0.25) over ())")
_scale_query("max_abs_scaler", X.max_abs_scaler(_P, "scaled"), f"{_P} / max(abs({_P})) over ()")


@query("label_encoder", "select p_partkey, dense_rank() over (order by p_type) as code from part")
def label_encoder(spark, sf):
    part = table(spark, sf, "part")
    return X.FeatureTransform([X.label_encoder("p_type", "code")]).fit(part).transform(part, keep=["p_partkey"])


@query("date_features", "select o_orderkey, year(o_orderdate)::int as day_year, weekofyear(o_orderdate)::int as day_week from orders")
def date_features(spark, sf):
    orders = table(spark, sf, "orders")
    fitted = X.FeatureTransform([X.date_features("o_orderdate", "day")]).fit(orders)
    return fitted.transform(orders, keep=["o_orderkey"])


LINE_SPECS = [
    X.pass_through("l_extendedprice", "label"), X.label_encoder("l_returnflag", "flag"),
    X.date_features("l_shipdate", "ship"), X.min_max_scaler("l_quantity", "quantity"),
    X.standard_scaler("l_discount", "discount"), X.robust_scaler("l_tax", "tax"),
    X.max_abs_scaler("l_partkey", "part"),
]


@query("transform_bundle", """
select l_orderkey, l_extendedprice as label, dense_rank() over (order by l_returnflag) as flag, year(l_shipdate)::int as ship_year,
       weekofyear(l_shipdate)::int as ship_week,
       round((l_quantity - min(l_quantity) over ()) / (max(l_quantity) over () - min(l_quantity) over ()), 6) as quantity,
       round((l_discount - avg(l_discount) over ()) / stddev_samp(l_discount) over (), 6) as discount,
       round((l_tax - quantile_cont(l_tax, 0.5) over ()) / (quantile_cont(l_tax, 0.75) over () - quantile_cont(l_tax, 0.25) over ()), 6) as tax,
       round(l_partkey / max(abs(l_partkey)) over (), 6) as part
from lineitem
""")
def transform_bundle(spark, sf):
    line = table(spark, sf, "lineitem")
    rows = X.FeatureTransform(LINE_SPECS).fit(line).transform(line, keep=["l_orderkey"])
    return rows.withColumns({c: F.round(c, 6) for c in ("quantity", "discount", "tax", "part")})


@query("assemble_vector", "select c_custkey, c_nationkey::double as c_nationkey, c_acctbal from customer")
def assemble_vector(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    packed = X.assemble_vector(customer, ["c_nationkey", "c_acctbal"]).select("c_custkey", "features")
    return X.disassemble_vector(packed, "features", ["c_nationkey", "c_acctbal"])


def _info_sql(c: str) -> str:
    return (f"select '{c}' as input, round(min({c})::double, 6) as min, round(max({c})::double, 6) as max, round(avg({c}), 6) as mean, "
            f"round(quantile_cont({c}, 0.5), 6) as median, round(stddev_samp({c}), 6) as stddev, "
            f"0::bigint as category_count, count(*) - count({c}) as null_count from part")


@query("feature_info", f"""
{_info_sql('p_size')} union all {_info_sql('p_retailprice')}
union all select 'p_type', 0, 0, 0, 0, 0, count(distinct p_type), count(*) - count(p_type) from part
""")
def feature_info(spark, sf):
    info = X.feature_info(table(spark, sf, "part"), ["p_size", "p_retailprice", "p_type"])
    numbers = {c: F.coalesce(F.round(c, 6), F.lit(0.0)) for c in ("min", "max", "mean", "median", "stddev")}
    return info.withColumns({**numbers, "category_count": F.coalesce("category_count", F.lit(0).cast("bigint"))})
