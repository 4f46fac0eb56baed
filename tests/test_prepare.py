"""Cleaning, locating, labelling and normalising of call records."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringspan.operators import aggregates as A
from ringspan.operators import columns as C
from ringspan.operators import features as X
from ringspan.operators import joins as J
from ringspan.plans.fixtures import calls, clean_calls
from ringspan.plans.prepare import PrepareParams, main, prepare_calls, run_prepare
from ringspan.sources import readers as R
from ringspan.sources import writers as W


def test_normalize_three_rows(spark):
    df = spark.createDataFrame([(2, 3), (4, 6), (6, 9)], "num1 int, num2 int")
    assert rows(X.normalize(df, ["num1", "num2"])) == [(-1.0, -1.0), (0.0, 0.0), (1.0, 1.0)]


def test_normalize_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, None)], "a double, b double, c double")
    assert rows(X.normalize(df, ["a", "b", "c"], ddof=0)) == [(-1.0, 0.0, None), (1.0, 0.0, None)]


def test_canonical_columns(spark):
    df = spark.createDataFrame([("1", "2", 3.0, 4)], "e164_from_caller_id string, to_number string, mos double, duration_seconds int")
    assert C.canonical_columns(df).columns == ["from_number", "to_number", "mos", "duration"]
    with pytest.raises(ValueError, match="jitter"):
        C.canonical_columns(df, {"jitter": ("shake",)})


def test_country_longest_prefix_and_zeros(spark):
    numbers = ["12425551234", "14155551234", "0014155551234", "+447911012345", "999000", "", None, "4"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    found = {r["n"]: r["country"] for r in J.country_of_number(df, "n").collect()}
    assert found["12425551234"] == "Bahamas"
    assert found["14155551234"] == found["0014155551234"] == "United States"
    assert found["+447911012345"] == "United Kingdom"
    assert found["999000"] is None and found[""] is None and found[None] is None and found["4"] is None


def test_country_legacy_and_own_prefixes(spark):
    df = spark.createDataFrame([("0044791",), ("5512",)], "n string")
    legacy = {r["n"]: r["country"] for r in J.country_of_number(df, "n", legacy=True).collect()}
    assert legacy["0044791"] == "United States"
    table = spark.createDataFrame([("55", "A"), ("551", "B")], "prefix string, country string")
    assert {r["n"]: r["country"] for r in J.country_of_number(df, "n", table).collect()} == {"0044791": None, "5512": "B"}


def test_calling_codes_are_well_formed():
    codes = J.calling_codes()
    assert all(p.isdigit() and 1 <= len(p) <= 7 and c for p, c in codes.items())
    # Assigned codes that were missing, area codes behind 1, and the same rule with any table of one's own.
    for code in "239 247 262 290 298 500 508 590 594 596 599 670 672 674 680 681 682 683 687 688 689 690 691 692".split():
        assert code in codes
    assert [codes[p] for p in ("1416", "1604", "1809", "1787", "262", "298", "1")] == [
        "Canada", "Canada", "Dominican Republic", "Puerto Rico", "Reunion", "Faroe Islands", "United States"
    ]


def test_country_has_no_python_and_no_shuffle(spark, sf):
    numbers = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("from_number"))
    plan = J.country_of_number(numbers, "from_number")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_ranges_find_the_longest_prefix(spark, seed):
    """Nested prefixes of up to seven digits against trying every length."""
    rng = random.Random(seed)
    prefixes = {"".join(rng.choice("0123") for _ in range(rng.randint(1, 7))): f"c{i}" for i in range(60)}
    numbers = [None, "", "3", "+", "x1", "1é", "\U0010fffe"] + ["".join(rng.choice("0123") for _ in range(rng.randint(1, 12))) for _ in range(300)]
    numbers = [n for n in numbers if n is None or not n.startswith("00")]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    table = spark.createDataFrame([*prefixes.items(), ("1", None), (None, "x")], "prefix string, country string")
    longest = {n: next((prefixes[n[:k]] for k in range(len(n), 0, -1) if n[:k] in prefixes), None) for n in numbers if n is not None}
    for given in (prefixes, table):
        found = J.country_of_number(df, "n", given).collect()
        assert all(r["country"] == (longest[r["n"]] if r["n"] is not None else None) for r in found)
    joined = J._by_length(df.withColumn("d", F.col("n")), table, "d", "country")
    assert all(r["country"] == (longest[r["n"]] if r["n"] is not None else None) for r in joined.collect())
    assert J.country_of_number(df, "n", {}).filter("country is not null").count() == 0


def test_numeric_columns_take_bigint_and_exact_names(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, 4)], "da bigint, y double, s string, day int, hour int")
    assert C.numeric_columns(df, ["day", "hour"]) == (["da", "y"], ["s"])


def test_drop_null_rows_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert rows(C.drop_null_rows(df)) == [(1.0, "a")]
    assert C.drop_null_rows(df, ["s"]).count() == 3


def test_cast_columns_try(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    assert rows(C.cast_columns(df, {"v": "int"})) == [(1,), (None,)]
    with pytest.raises(Exception):
        C.cast_columns(df, {"v": "int"}, try_=False).collect()


def test_labels_at_the_threshold(spark):
    df = spark.createDataFrame(
        [(0.1, 9.0, 1.0, 10), (0.2, 9.0, 1.0, 10), (0.0, 1.0, 4.5, 99), (0.0, 0.5, 4.5, 99)],
        "packet_loss double, jitter double, mos double, duration int",
    )
    cuts = C.Thresholds(5.0, 2.0, 50.0)
    labels = [r["label"] for r in C.label_calls(df, cuts).collect()]
    assert labels == ["none", "anomaly", "normal", "normal"]
    inclusive = [r["label"] for r in C.label_calls(df, cuts, inclusive=True).collect()]
    assert inclusive[0] == "anomaly"


def test_labels_of_empty_frame(spark):
    df = spark.createDataFrame([], "packet_loss double, jitter double, mos double, duration int")
    assert C.label_calls(df).count() == 0 and C.label_anomalies_rule(df).count() == 0


def test_approximate_labels_agree_here(spark, sf):
    clean = clean_calls(spark, sf)
    exact = rows(C.label_calls(clean).groupBy("label").count())
    assert rows(C.label_calls(clean, method="approx").groupBy("label").count()) == exact


def test_run_prepare_writes_every_output(spark, sf, tmp_path):
    raw = calls(spark, sf).withColumnRenamed("mos", "mean_opinion_score")
    W.write_csv(raw, str(tmp_path / "in"))
    names = ("output", "anomaly_output", "normal_output", "anomaly_normalized_output", "normal_normalized_output")
    paths = {n: str(tmp_path / n) for n in names}
    labelled = run_prepare(spark, PrepareParams(str(tmp_path / "in"), **paths))
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    for label in ("anomaly", "normal"):
        plain = R.scan_csv(spark, paths[f"{label}_output"])
        scaled = R.scan_csv(spark, paths[f"{label}_normalized_output"])
        assert plain.count() == scaled.count() == counts[label]
        assert "day" in plain.columns and "from_country" in plain.columns
    both = R.scan_csv(spark, paths["anomaly_normalized_output"]).unionByName(
        R.scan_csv(spark, paths["normal_normalized_output"])
    )
    identifiers = ("call_id", "organization_id", "from_number", "to_number")
    text = spark.read.option("header", True).csv(paths["anomaly_normalized_output"])
    assert set(rows(text.select(*identifiers))) <= set(rows(calls(spark, sf).select(*identifiers)))
    assert text.filter("from_number like '00%'").count() > 0
    stats = {r["column"]: r for r in A.column_stats(both, ["mos", "jitter"], quantiles=False).collect()}
    assert abs(stats["mos"]["mean"]) < 1e-9 and abs(stats["mos"]["std"] - 1) < 1e-9


def test_per_class_scaling(spark, sf):
    from ringspan.plans.prepare import normalize_calls

    scaled = normalize_calls(prepare_calls(calls(spark, sf)), ["mos"], scope="per_class")
    means = [r["m"] for r in scaled.groupBy("label").agg(F.avg("mos").alias("m")).collect()]
    assert len(means) == 2 and all(abs(m) < 1e-9 for m in means)


def test_csv_keeps_zeros_and_corrupt_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(R.CALL_SCHEMA.names) + "\nc1,o,0014155,1212,answered,2020-01-01T00:00:00,x,dc,1,0.0,4.0,1.0\n")
    df = R.scan_csv(spark, str(tmp_path), R.CALL_SCHEMA, corrupt_col="_corrupt").cache()
    row = df.first()
    assert row["from_number"] == "0014155" and row["duration_seconds"] is None and row["_corrupt"].startswith("c1,")


def test_csv_schema_goes_by_header_name(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "1.csv").write_text("b,extra,a\n1,z,2\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert rows(R.scan_csv(spark, str(tmp_path / "x"), schema)) == [(2, 1)]
    with pytest.raises(ValueError):
        R.scan_csv(spark, str(tmp_path / "x"), T.StructType([T.StructField("missing", T.StringType())]))


def test_prepare_job_keeps_zeros_and_counts_what_does_not_fit(spark, tmp_path):
    header = "jitter,mean_opinion_score,packet_loss,carrier_id,data_center,duration_seconds,start_time,status,e164_to_caller_id,e164_from_caller_id,organization_id,call_id"
    line = "{},4.1,0.0,1,dc,60,2020-01-01T00:00:00,answered,{},{},007,{}"
    lines = [line.format("0.5", "0014155550000", "0044791100000", "1"), line.format("0.7", "12125550000", "0155512345", "2"), line.format("bad", "1", "1", "3")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, *lines]) + "\n")
    main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--rejected-output", str(tmp_path / "bad")])
    found = spark.read.parquet(str(tmp_path / "out")).select("call_id", "organization_id", "from_number", "to_number", "from_country", "to_country")
    assert rows(found) == [("1", "007", "0044791100000", "0014155550000", "United Kingdom", "United States")]
    assert [r["value"] for r in spark.read.text(str(tmp_path / "bad")).collect()] == [lines[2]]


def test_file_corpus_holds_every_file_whole(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "large.txt").write_text("x" * ((1 << 20) + 1))
    found = {r["path"]: (r["size"], r["is_text"], len(r["text"])) for r in R.scan_file_corpus(spark, str(tmp_path)).collect()}
    assert found == {"empty.txt": (0, True, 0), "large.txt": ((1 << 20) + 1, True, (1 << 20) + 1)}


def test_file_corpus(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.py").write_text("print('é')\n")
    (tmp_path / "sub" / "b.txt").write_text("b")
    (tmp_path / "sub" / "c.bin").write_bytes(b"\x00\x01")
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    found = {r["path"]: (r["is_text"], r["text"]) for r in R.scan_file_corpus(spark, str(tmp_path)).collect()}
    assert found == {
        "a.py": (True, "print('é')\n"), "sub/b.txt": (True, "b"), "sub/c.bin": (False, None), "bad.txt": (False, None),
    }


def test_pushdown_reaches_the_scan(spark, sf):
    df = C.filter_predicate(R.scan_project(spark, f"{sf}/lineitem.parquet", ["l_quantity", "l_returnflag"]), "l_returnflag = 'R'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan and "l_comment" not in plan and "l_tax" not in plan
