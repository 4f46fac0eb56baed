"""Statistics, quantiles, counts, concatenation and metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import divide, normal_confidence
from ..session import cut_lineage, store
from .ordered import is_small, prefix_sum, same_key

# Distinct values (over all columns) up to which one window ranks them.
DISTINCT_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
# The sketch of a group is smaller; brackets of so many groups and bytes go to every task.
GROUP_ACCURACY, GROUPS, GROUP_BYTES = 1_000, 100_000, 64 << 20


def _list(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., column, value): the columns unpivoted."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(*by, F.inline(F.array(*pairs)))


# quantiles
def quantile_exact(
    df: DataFrame, col: Sequence[str] | str, probs: Sequence[float], by: Sequence[str] = (), distinct_rows: int | None = None
) -> DataFrame:
    """Linear-interpolated quantiles: one row (by..., column, prob, value) per column and probability.

    In a large table a mergeable sketch, one per group, first brackets every wanted rank, and only values inside a
    bracket are shuffled. For little data, or more groups than can be sent to every task, all values are counted
    (combined before the shuffle, so a frequent value costs one row) and ranked. No task ever holds all values
    of a column. ``distinct_rows`` is how many values count as little data; the result does not depend on it.
    """
    by, cols, probs = list(by), _list(col), [float(p) for p in probs]
    few = DISTINCT_ROWS if distinct_rows is None else distinct_rows
    if not by:
        return _quantiles_bracketed(df, cols, probs, few)
    if df.count() * len(cols) <= few:
        return _quantiles_ranked(df, cols, probs, by, few)
    return _quantiles_of_groups(df, cols, probs, by, few)


def _ranks(counts: DataFrame, keys: Sequence[str], few: int) -> DataFrame:
    """Stored counts (keys..., value, n) with ``upto``, the number of values up to and including this one."""
    if counts.count() <= few:
        return counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("value")))
    return prefix_sum(counts, F.col("n"), ["value"], keys, out="upto")


def _value_at(rank: Column) -> Column:
    """The value of a 0-based rank."""
    return F.min(F.when(F.col("upto") > rank, F.col("value")))


def _between(low: Column, high: Column, part: Column) -> Column:
    return low + (high - low) * part


def _quantiles_ranked(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], few: int) -> DataFrame:
    keys = [*by, "column"]
    counts = _long(df, cols, by).filter(F.col("value").isNotNull()).groupBy(*keys, "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = cut_lineage(counts)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    pairs = _ranks(counts, keys, few).alias("r").join(totals.alias("t"), same_key("r", "t", keys)).select("r.*", "t.total")
    picks = []
    for i, p in enumerate(probs):
        rank = F.lit(p) * (F.col("total") - 1)
        picks += [_value_at(F.floor(rank)).alias(f"low{i}"), _value_at(F.ceil(rank)).alias(f"high{i}"),
                  F.first(rank - F.floor(rank)).alias(f"part{i}")]
    rows = [
        F.struct(F.lit(p).alias("prob"), _between(F.col(f"low{i}"), F.col(f"high{i}"), F.col(f"part{i}")).alias("value"))
        for i, p in enumerate(probs)
    ]
    return pairs.groupBy(*keys).agg(*picks).select(*keys, F.inline(F.array(*rows)))


def _quantiles_bracketed(df: DataFrame, cols: Sequence[str], probs: Sequence[float], few: int) -> DataFrame:
    margin = 2.0 / SKETCH_ACCURACY  # the sketch errs by half of this
    bounds = [b for p in probs for b in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketched = df.agg(*[
        a for i, c in enumerate(cols) for x in [F.col(c).cast("double")]
        for a in (F.count(x).alias(f"n{i}"), F.percentile_approx(x, bounds, SKETCH_ACCURACY).alias(f"s{i}"))
    ]).first()
    if max(sketched[f"n{i}"] for i in range(len(cols))) <= few:
        return _quantiles_ranked(df, cols, probs, [], few)
    targets = []
    for i, c in enumerate(cols):
        for j, p in enumerate(probs):
            n = sketched[f"n{i}"]
            if n:
                rank = p * (n - 1)
                low = float("-inf") if bounds[2 * j] == 0.0 else sketched[f"s{i}"][2 * j]
                high = float("inf") if bounds[2 * j + 1] == 1.0 else sketched[f"s{i}"][2 * j + 1]
                targets.append((len(targets), c, p, math.floor(rank), math.ceil(rank), rank - math.floor(rank), low, high))
    value = lambda t: F.col(t[1]).cast("double")
    below = df.agg(*[F.count(F.when(value(t) < t[6], 1)).alias(f"b{t[0]}") for t in targets]).first()
    inside = F.array(*[
        F.when((value(t) >= t[6]) & (value(t) <= t[7]), F.struct(F.lit(t[0]).alias("target"), value(t).alias("value")))
        for t in targets
    ])
    counts = df.select(F.inline(F.filter(inside, lambda s: s.isNotNull()))).groupBy("target", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    wanted = df.sparkSession.createDataFrame(
        [(t[0], t[1], t[2], t[3] - below[f"b{t[0]}"], t[4] - below[f"b{t[0]}"], t[5]) for t in targets],
        "target int, column string, prob double, low bigint, high bigint, part double",
    )
    picked = _ranks(cut_lineage(counts), ["target"], few).join(F.broadcast(wanted), "target").groupBy("target", "column", "prob", "part").agg(
        _value_at(F.col("low")).alias("low"), _value_at(F.col("high")).alias("high"), F.min("low").alias("first")
    )
    found = cut_lineage(picked)  # one row per column and probability
    if found.filter("low is null or high is null or first < 0").count() or found.count() < len(targets):
        return _quantiles_ranked(df, cols, probs, [], few)  # a bracket missed its rank: NaN values, or very few rows
    return found.select("column", "prob", _between(F.col("low"), F.col("high"), F.col("part")).alias("value"))


def _quantiles_of_groups(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], few: int) -> DataFrame:
    """Per group a sketch of every column, whose brackets go to the rows; groups that a bracket misses are ranked whole."""
    margin = 2.0 / GROUP_ACCURACY
    bounds = [b for p in probs for b in (max(p - margin, 0.0), min(p + margin, 1.0))]
    value = [F.col(f"`{c}`").cast("double") for c in cols]
    groups = [F.col(f"`{c}`") for c in by]
    sketched = store(df.groupBy(*groups).agg(*[
        a for i, x in enumerate(value) for a in (F.count(x).alias(f"_n{i}"), F.percentile_approx(x, bounds, GROUP_ACCURACY).alias(f"_s{i}"))
    ]), "group-sketches")
    if not is_small(sketched, GROUPS, GROUP_BYTES):
        return _quantiles_ranked(df, cols, probs, by, few)
    targets = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    low = [F.lit(float("-inf")) if bounds[2 * j] == 0.0 else F.get(F.col(f"_s{i}"), F.lit(2 * j)) for i, j in targets]
    high = [F.lit(float("inf")) if bounds[2 * j + 1] == 1.0 else F.get(F.col(f"_s{i}"), F.lit(2 * j + 1)) for i, j in targets]
    brackets = sketched.select(*groups, *[c.alias(f"_{n}{t}") for t in range(len(targets)) for n, c in (("l", low[t]), ("h", high[t]))])
    rows = df.select(*groups, *[x.alias(f"_x{i}") for i, x in enumerate(value)]).alias("d")
    names = [*[f"_x{i}" for i in range(len(cols))], *[f"_{n}{t}" for t in range(len(targets)) for n in "lh"]]
    rows = rows.join(F.broadcast(brackets).alias("b"), same_key("d", "b", by)).select(*[F.col(f"d.`{c}`") for c in by], *names)
    below = rows.groupBy(*groups).agg(*[F.count(F.when(F.col(f"_x{i}") < F.col(f"_l{t}"), 1)).alias(f"_b{t}") for t, (i, _) in enumerate(targets)])
    inside = F.array(*[
        F.when((F.col(f"_x{i}") >= F.col(f"_l{t}")) & (F.col(f"_x{i}") <= F.col(f"_h{t}")), F.struct(F.lit(t).alias("_target"), F.col(f"_x{i}").alias("value")))
        for t, (i, _) in enumerate(targets)
    ])
    keys = [*by, "_target"]
    counts = rows.select(*groups, F.inline(F.array_compact(inside))).groupBy(*groups, "_target", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = _ranks(store(counts, "bracket-values"), keys, few)

    rank = lambda i, j: F.lit(probs[j]) * (F.col(f"s._n{i}") - 1)
    wanted = sketched.alias("s").join(below.alias("w"), same_key("s", "w", by)).select(*[F.col(f"s.`{c}`") for c in by], F.inline(F.array(*[
        F.struct(
            F.lit(t).alias("_target"), F.lit(cols[i]).alias("column"), F.lit(probs[j]).alias("prob"), F.col(f"s._n{i}").alias("_n"),
            (F.floor(rank(i, j)) - F.col(f"_b{t}")).alias("_low"), (F.ceil(rank(i, j)) - F.col(f"_b{t}")).alias("_high"),
            (rank(i, j) - F.floor(rank(i, j))).alias("_part"),
        ) for t, (i, j) in enumerate(targets)
    ]))).filter("_n > 0")
    # One row per group, column and probability; a bracket without values has no ranks.
    both = wanted.alias("w").join(ranked.alias("r"), same_key("w", "r", keys), "left").select("w.*", "r.value", "r.upto")
    picked = store(both.groupBy(*groups, "_target", "column", "prob").agg(
        F.min(F.when(F.col("upto") > F.col("_low"), F.col("value"))).alias("_a"), F.min(F.when(F.col("upto") > F.col("_high"), F.col("value"))).alias("_b"),
        F.min("_low").alias("_low"), F.first("_part").alias("_part"),
    ), "group-quantiles")
    missed = store(picked.filter("_a is null or _b is null or _low < 0 or isnan(_a) or isnan(_b)").select(*groups).distinct(), "missed-groups")
    found = picked.alias("p").join(F.broadcast(missed).alias("m"), same_key("p", "m", by), "left_anti").select(
        *[F.col(f"p.`{c}`") for c in by], "column", "prob", _between(F.col("_a"), F.col("_b"), F.col("_part")).alias("value")
    )
    if missed.isEmpty():
        return found
    again = df.alias("d").join(F.broadcast(missed).alias("m"), same_key("d", "m", by), "left_semi")
    return found.unionByName(_quantiles_ranked(again, cols, probs, by, few).select(*by, "column", "prob", "value"))


def quantile_approx(
    df: DataFrame, col: Sequence[str] | str, probs: Sequence[float], err: float = 1e-4, by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles within rank error ``err`` from one mergeable sketch per column, in one pass."""
    by, cols = list(by), _list(col)
    accuracy = max(1, round(1.0 / err))
    sketch = [F.percentile_approx(F.col(c).cast("double"), [float(p) for p in probs], accuracy).alias(f"_{i}")
              for i, c in enumerate(cols)]
    one = df.groupBy(*by).agg(*sketch)
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.get(F.col(f"_{i}"), F.lit(j)).alias("value"))
        for i, c in enumerate(cols) for j, p in enumerate(probs)
    ]
    return one.select(*by, F.inline(F.array(*rows)))


# column statistics
def column_stats(
    df: DataFrame, cols: Sequence[str], exact: bool = True, by: Sequence[str] = (), quantiles: bool = True,
    distinct_rows: int | None = None,
) -> DataFrame:
    """What the scalers need: one row per column (and group) with count, nulls, min, max, max_abs, mean,
    std (sample), std_pop, q25, q50, q75."""
    by, cols = list(by), list(cols)
    per_column = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        per_column += [
            F.count(x).alias(f"_{i}_count"),
            F.count(F.when(x.isNull(), 1)).alias(f"_{i}_nulls"),
            F.min(x).alias(f"_{i}_min"),
            F.max(x).alias(f"_{i}_max"),
            F.max(F.abs(x)).alias(f"_{i}_max_abs"),
            F.avg(x).alias(f"_{i}_mean"),
            F.stddev_samp(x).alias(f"_{i}_std"),
            F.stddev_pop(x).alias(f"_{i}_std_pop"),
        ]
    names = ["count", "nulls", "min", "max", "max_abs", "mean", "std", "std_pop"]
    wide = df.groupBy(*by).agg(*per_column)
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{n}").alias(n) for n in names]) for i, c in enumerate(cols)
    ]
    stats = wide.select(*by, F.inline(F.array(*rows)))
    if not quantiles:
        return stats
    probs = [0.25, 0.5, 0.75]
    quant = quantile_exact(df, cols, probs, by, distinct_rows) if exact else quantile_approx(df, cols, probs, by=by)
    keys = [*by, "column"]
    flat = quant.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(probs, ["q25", "q50", "q75"])]
    )
    joined = stats.alias("s").join(flat.alias("q"), same_key("s", "q", keys), "left")
    return joined.select("s.*", "q.q25", "q.q50", "q.q75")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    return describe_by(df, (), cols)


def describe_by(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str], distinct_rows: int | None = None) -> DataFrame:
    by = _list(by) if by else []
    stats = column_stats(df, cols, by=by, distinct_rows=distinct_rows)
    return stats.select(*by, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def group_mean(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*_list(by)).agg(*[F.avg(c).alias(c) for c in cols])


def vector_centroid(df: DataFrame, by: str, vec_col: str, out: str = "centroid") -> DataFrame:
    """Element-wise mean of the arrays of each class; partial sums are merged, rows are not multiplied."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(
        by, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_vec")
    )
    means = rows.groupBy(by).agg(Summarizer.mean(F.col("_vec")).alias("_mean"))
    return means.select(by, vector_to_array("_mean").alias(out))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(col))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass; one row per column."""
    wide = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return wide.select(F.inline(F.array(*rows)))


def string_agg(
    df: DataFrame, expr: Column, sep: str, order_by: Sequence[str], by: Sequence[str] = (),
    max_chars: int = 1 << 20, name: str = "text",
) -> DataFrame:
    """Rows concatenated in order, as (by..., chunk, text).

    A group becomes as many chunks as its length asks for: a new one starts whenever the text so far
    passes another ``max_chars``. Chunks in order are the whole text, and no task builds more than one.
    """
    by, order = list(by), list(order_by)
    pieces = df.select(*by, *[c for c in order if c not in by], expr.alias("_piece")).filter(F.col("_piece").isNotNull())
    size = (F.length("_piece") + len(sep)).cast("bigint")
    if not sep:
        size = F.greatest(size, F.lit(1).cast("bigint"))  # a run of empty texts must fill a chunk too
    placed = prefix_sum(pieces, size, order, by, out="_upto")
    chunk = F.floor((F.col("_upto") - size) / max_chars).cast("bigint")
    item = F.struct(*[F.col(c) for c in order], F.col("_piece"))
    grouped = placed.withColumn("chunk", chunk).groupBy(*by, "chunk").agg(F.sort_array(F.collect_list(item)).alias("_i"))
    return grouped.select(*by, "chunk", F.array_join(F.col("_i._piece"), sep).alias(name))


# anomaly shares and thresholds
def contamination(df: DataFrame, flag: str) -> DataFrame:
    """Share of flagged rows among the labelled ones."""
    return df.agg(F.avg(F.when(F.col(flag), 1.0).when(~F.col(flag), 0.0)).alias("contamination"))


def sigma_thresholds(df: DataFrame, score: str, ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """mean + k standard deviations of a score, with the confidence of a normal law."""
    one = df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))
    rows = [
        F.struct(
            F.lit(k).alias("k"), (F.col("mean") + F.lit(float(k)) * F.col("std")).alias("threshold"),
            F.lit(normal_confidence(k)).alias("confidence"),
        )
        for k in ks
    ]
    return one.select(F.inline(F.array(*rows)))


def length_budget(df: DataFrame, text: str, chars_per_token: int = 4) -> DataFrame:
    """Longest and mean text length and the token budget for the longest."""
    n = F.length(text)
    one = df.agg(F.count(n).alias("rows"), F.max(n).alias("max_chars"), F.avg(n).alias("mean_chars"))
    return one.withColumn("token_budget", F.ceil(F.col("max_chars") / chars_per_token).cast("bigint"))


# metrics
def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the usual regression metrics; r2 is NULL for a constant label."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    squared_log = F.pow(F.log1p(F.when(y > -1, y)) - F.log1p(F.when(p > -1, p)), F.lit(2.0))
    one = df.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(squared_log).alias("mean_squared_log_error"),
        F.var_pop(F.when(error.isNotNull(), y)).alias("_var"),
    )
    return one.select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error",
        (F.lit(1.0) - divide(F.col("mean_squared_error"), F.col("_var"))).alias("r2_score"),
        F.sqrt("mean_squared_error").alias("root_mean_squared_error"),
    )


def relative_change(before: DataFrame, after: DataFrame, metric: str) -> DataFrame:
    """Percent change of the mean of a metric, two decimals."""
    a = before.agg(F.avg(metric)).scalar()
    one = after.agg(F.avg(metric).alias("after")).select(a.alias("before"), "after")
    change = divide(F.col("after") - F.col("before"), F.col("before")) * 100
    return one.withColumn("percent_change", F.round(change, 2))


def label_confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: counts of the four cases, precision and recall; rows with a NULL label do not count."""
    a, p = F.col(actual), F.col(predicted)

    def cases(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    one = df.agg(
        cases(p & a).alias("true_positive"), cases(p & ~a).alias("false_positive"),
        cases(~p & a).alias("false_negative"), cases(~p & ~a).alias("true_negative"),
    )
    tp = F.col("true_positive")
    return one.withColumns(
        {
            "precision": divide(tp.cast("double"), tp + F.col("false_positive")),
            "recall": divide(tp.cast("double"), tp + F.col("false_negative")),
        }
    )


def multiclass_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows with the wrong label."""
    return df.agg(F.avg((F.col(label) != F.col(prediction)).cast("double")).alias("multiclass_error"))


def f1_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """F1 per class plus a 'macro' and a 'micro' row; 'micro' of single labels is the share that match.

    Every row adds to at most two classes, so counting is one aggregate over classes.
    """
    a, p = F.col(actual).cast("string"), F.col(predicted).cast("string")
    seen = F.array(
        F.struct(p.alias("class"), (a == p).cast("int").alias("tp"), (a != p).cast("int").alias("fp"), F.lit(0).alias("fn")),
        F.struct(a.alias("class"), F.lit(0).alias("tp"), F.lit(0).alias("fp"), (a != p).cast("int").alias("fn")),
    )
    per_class = (
        df.filter(a.isNotNull() & p.isNotNull()).select(F.inline(seen)).groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )
    f1 = lambda tp, fp, fn: divide(2.0 * tp, 2.0 * tp + fp + fn, otherwise=0.0)
    scored = per_class.select("class", *[F.col(c).cast("double").alias(c) for c in ("tp", "fp", "fn")]).withColumn(
        "f1", f1(F.col("tp"), F.col("fp"), F.col("fn"))
    )
    both = scored.agg(
        F.avg("f1").alias("macro"), f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("micro")
    ).select(
        F.inline(F.array(
            F.struct(F.lit("average").alias("kind"), F.lit("macro").alias("class"), F.col("macro").alias("f1")),
            F.struct(F.lit("average").alias("kind"), F.lit("micro").alias("class"), F.col("micro").alias("f1")),
        ))
    )
    return scored.select(F.lit("class").alias("kind"), "class", "f1").unionByName(both)
