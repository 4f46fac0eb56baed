"""Queries over call records: reading, writing, cleaning, locating, labelling."""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as A
from ..operators import columns as C
from ..operators import features as X
from ..operators import joins as J
from ..session import scratch_path, store
from ..sources import readers as R
from ..sources import writers as W
from .fixtures import CALLS_CTE, CODES_CTE, COUNTRY_CTE, CUTS, FEATURES, calls, clean_calls, labelled_cte
from .prepare import PrepareParams, normalize_calls, prepare_calls, run_prepare
from .registry import query, table

CLEAN = f"with {CALLS_CTE} "
LOCATED = f"with {CALLS_CTE}, {COUNTRY_CTE} "

CALL_SUMMARY = """
select status, count(*) as calls, count(mos) as scored, sum(duration_seconds)::bigint as seconds,
       count(*) filter (from_number like '00%') as zero_prefixed, round(avg(packet_loss), 6) as packet_loss
from calls group by status
"""


def _call_summary(df):
    return df.groupBy("status").agg(
        F.count(F.lit(1)).alias("calls"), F.count("mos").alias("scored"),
        F.sum("duration_seconds").alias("seconds"),
        F.count(F.when(F.col("from_number").startswith("00"), 1)).alias("zero_prefixed"),
        F.round(F.avg("packet_loss"), 6).alias("packet_loss"),
    )


# flagship: how many calls per rule label, and what the thresholds are
@query("label_counts", f"""
with {CALLS_CTE}, {labelled_cte()}
select label, count(*) as calls, round(avg(mos), 6) as mean_mos, round(max(jitter_q50), 6) as jitter_q50,
       round(max(mos_q25), 6) as mos_q25, round(max(duration_q50), 6) as duration_q50
from labelled, cuts group by label
""")
def label_counts(spark, sf):
    clean = store(clean_calls(spark, sf).select(*FEATURES))  # read by the fit and by the labelling
    cuts = C.fit_thresholds(clean)
    counted = C.label_calls(clean, cuts).groupBy("label").agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.avg("mos"), 6).alias("mean_mos")
    )
    return counted.select("*", *[F.round(F.lit(v), 6).alias(c) for c, v in asdict(cuts).items()])


# sources
@query("scan_csv", CLEAN + CALL_SUMMARY)
def scan_csv(spark, sf):
    path = scratch_path(spark, "calls-csv")
    W.write_csv(calls(spark, sf), path)
    return _call_summary(R.scan_csv(spark, path, R.CALL_SCHEMA, corrupt_col="_corrupt").drop("_corrupt"))


@query("scan_external_table", CLEAN + CALL_SUMMARY)
def scan_external_table(spark, sf):
    path = scratch_path(spark, "calls-table")
    W.write_csv(calls(spark, sf), path)
    return _call_summary(R.scan_external_table(spark, f"calls_{uuid.uuid4().hex}", path, R.CALL_SCHEMA))


@query("scan_project", """
select l_returnflag, count(*) as rows, sum(l_quantity) as quantity from lineitem group by l_returnflag
""")
def scan_project(spark, sf):
    df = R.scan_project(spark, f"{sf}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query("scan_jsonl", """
select event_type, count(*) as events, round(sum(value), 4) as value,
       sum(cast(json_extract_string(props, '$.k') as bigint))::bigint as k
from events group by event_type
""")
def scan_jsonl(spark, sf):
    path = scratch_path(spark, "events-json")
    W.write_jsonl(table(spark, sf, "events").select(*EVENT_SCHEMA.names), path)
    df = R.scan_jsonl(spark, path, EVENT_SCHEMA)
    k = F.from_json("props", "k bigint")["k"]
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("value"), F.sum(k).alias("k")
    )


@query("scan_text_corpus", """
select cast(doc_id as varchar) as id, length(text) as chars, md5(replace(replace(text, chr(10), ' '), chr(13), ' ')) as digest
from documents
""")
def scan_text_corpus(spark, sf):
    path = scratch_path(spark, "corpus")
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), F.translate("text", "\n\r", "  "))
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    return R.scan_text_corpus(spark, path).select(
        "id", F.length("text").cast("bigint").alias("chars"), F.md5(F.col("text").cast("binary")).alias("digest")
    )


@query("scan_file_corpus", """
select true as is_text, sum(octet_length(encode(html)) + 1)::bigint as bytes,
       sum(length(html) + 1)::bigint as chars from pages
""")
def scan_file_corpus(spark, sf):
    path = scratch_path(spark, "pages")
    table(spark, sf, "pages").select("html").write.option("maxRecordsPerFile", 100).text(path)
    files = R.scan_file_corpus(spark, path).filter(F.col("path").endswith(".txt"))
    return files.groupBy("is_text").agg(
        F.sum("size").alias("bytes"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )


@query("describe_schema", """
select 1 as ordinal_position, 'event_id' as column_name, 'bigint' as data_type, count(event_id) as filled from events
union all select 2, 'ts', 'timestamp_ntz', count(ts) from events
union all select 3, 'user_id', 'bigint', count(user_id) from events
union all select 4, 'event_type', 'string', count(event_type) from events
union all select 5, 'value', 'double', count(value) from events
union all select 6, 'props', 'string', count(props) from events
""")
def describe_schema(spark, sf):
    events = table(spark, sf, "events")
    total = events.agg(F.count(F.lit(1))).scalar()
    filled = A.null_counts(events).select(F.col("column").alias("column_name"), (total - F.col("nulls")).alias("filled"))
    return R.describe_schema(events).join(filled, "column_name")


@query("inline_rows", """
with names(status, billed) as (values ('answered', true), ('unanswered', false), ('voicemail', true)), """ + CALLS_CTE + """
select billed, count(*) as calls, sum(duration_seconds)::bigint as seconds
from calls join names using (status) group by billed
""")
def inline_rows(spark, sf):
    rows = [("answered", True), ("unanswered", False), ("voicemail", True)]
    names = R.inline_rows(spark, rows, "status string, billed boolean")
    return J.join_using(calls(spark, sf), names, "status").groupBy("billed").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("duration_seconds").alias("seconds")
    )


# sinks
@query("write_csv", CLEAN + "select call_id, from_number, duration, packet_loss, mos, jitter from clean")
def write_csv(spark, sf):
    path = scratch_path(spark, "clean-csv")
    df = clean_calls(spark, sf).select("call_id", "from_number", "duration", "packet_loss", "mos", "jitter")
    W.write_csv(df, path)
    return R.scan_csv(spark, path, df.schema)


@query("write_table", CLEAN + "select organization_id, count(*) as calls, round(avg(mos), 6) as mean_mos from clean group by 1")
def write_table(spark, sf):
    name = f"clean_{uuid.uuid4().hex}"
    stored = W.write_table(clean_calls(spark, sf), name, path=scratch_path(spark, name))
    return stored.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.avg("mos"), 6).alias("mean_mos")
    )


@query("export_csv", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def export_csv(spark, sf):
    name, path = f"customer_{uuid.uuid4().hex}", scratch_path(spark, "customer-csv")
    stored = W.write_table(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), name,
        path=scratch_path(spark, name),
    )
    W.export_csv(spark, name, path)
    return R.scan_csv(spark, path, stored.schema)


@query("write_jsonl", "select event_id, event_type, value from events order by value desc, event_id limit 100")
def write_jsonl(spark, sf):
    path = scratch_path(spark, "top-events")
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    W.write_jsonl(df, path, n=100, order_by=[F.desc("value"), F.asc("event_id")])
    return R.scan_jsonl(spark, path, df.schema)


@query("update_from", """
select o_orderkey, o_custkey, case when n is null then o_orderstatus else 'L' || cast(n as varchar) end as o_orderstatus
from orders left join (select l_orderkey, max(l_linenumber) as n from lineitem where l_returnflag = 'R' group by 1)
  on o_orderkey = l_orderkey
""")
def update_from(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("o_orderkey")
    ).agg(F.max("l_linenumber").alias("n"))
    source = returned.select("o_orderkey", F.concat(F.lit("L"), F.col("n").cast("string")).alias("o_orderstatus"))
    target = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return W.update_from(target, source, ["o_orderkey"], ["o_orderstatus"])


# cleaning and filters
@query("canonical_columns", CLEAN + "select call_id, from_number, to_number, duration_seconds as duration, jitter from calls")
def canonical_columns(spark, sf):
    return C.canonical_columns(calls(spark, sf)).select("call_id", "from_number", "to_number", "duration", "jitter")


@query("drop_columns", CLEAN + "select call_id, organization_id, from_number, to_number, duration_seconds, packet_loss, jitter from calls")
def drop_columns(spark, sf):
    return C.drop_columns(calls(spark, sf), [*C.UNUSED_CALL_COLUMNS, "start_time", "mos"])


@query("drop_null_rows", CLEAN + "select call_id, mos, jitter, packet_loss from clean")
def drop_null_rows(spark, sf):
    return clean_calls(spark, sf).select("call_id", "mos", "jitter", "packet_loss")


@query("cast_columns", CLEAN + """
select call_id, try_cast(from_number as int) as from_number, cast(carrier_id as varchar) as carrier_id,
       cast(cast(start_time as date) as varchar) as start_time, cast(duration_seconds as varchar) as duration_seconds
from calls
""")
def cast_columns(spark, sf):
    typed = C.cast_columns(
        calls(spark, sf),
        {"from_number": "int", "carrier_id": "string", "start_time": "date", "duration_seconds": "string"},
    )
    return C.cast_columns(typed, {"start_time": "string"}).select(
        "call_id", "from_number", "carrier_id", "start_time", "duration_seconds"
    )


@query("numeric_columns", CLEAN + """
select 'duration' as name, round(avg(duration), 6) as mean from clean
union all select 'jitter', round(avg(jitter), 6) from clean
union all select 'mos', round(avg(mos), 6) from clean
union all select 'packet_loss', round(avg(packet_loss), 6) from clean
""")
def numeric_columns(spark, sf):
    clean = clean_calls(spark, sf)
    names, _ = C.numeric_columns(clean, exclude=["day", "hour"])
    return A.column_stats(clean, names, quantiles=False).select(F.col("column").alias("name"), F.round("mean", 6).alias("mean"))


@query("label_anomalies_rule", f"""
with {CALLS_CTE}, {CUTS.format(source='clean')}
select call_id, packet_loss, jitter, mos, true as is_anomaly from clean, cuts
where packet_loss > 0.1 and jitter > jitter_q50 and mos < mos_q25
""")
def label_anomalies_rule(spark, sf):
    marked = C.label_anomalies_rule(clean_calls(spark, sf))
    return marked.select("call_id", "packet_loss", "jitter", "mos", "is_anomaly")


@query("label_normal_rule", f"""
with {CALLS_CTE}, {CUTS.format(source='clean')}
select call_id, duration, mos, false as is_anomaly from clean, cuts
where duration > duration_q50 and mos > 4 and jitter <= 1 and packet_loss <= 0
""")
def label_normal_rule(spark, sf):
    return C.label_normal_rule(clean_calls(spark, sf)).select("call_id", "duration", "mos", "is_anomaly")


@query("country_of_number", LOCATED + """
select from_number, to_number, from_country, coalesce(to_country, 'Invalid') as to_country, count(*) as calls
from (select from_number, to_number, coalesce(from_country, 'Invalid') as from_country, to_country from located)
group by all
""")
def country_of_number(spark, sf):
    df = J.country_of_number(clean_calls(spark, sf), "from_number", out="from_country")
    df = J.country_of_number(df, "to_number", out="to_country").withColumns(
        {c: J.render_invalid(c) for c in ("from_country", "to_country")}
    )
    return df.groupBy("from_number", "to_number", "from_country", "to_country").agg(F.count(F.lit(1)).alias("calls"))


@query("country_of_area_code", """
select country, count(*) as orders, min(o_orderkey) as first_order from (
  select o_orderkey, case o_orderkey % 11 when 0 then 'Canada' when 1 then 'Dominican Republic' when 2 then 'Reunion'
    when 3 then 'Faroe Islands' when 4 then 'Puerto Rico' when 5 then 'United States' when 6 then 'Jamaica'
    when 7 then 'Sao Tome and Principe' when 8 then 'French Polynesia' when 9 then null else 'Canada' end as country from orders)
group by country
""")
def country_of_area_code(spark, sf):
    prefixes = ["1416", "1809", "262262", "298", "001787", "1212", "+1876", "239", "00689", "0155", "00" + "1604"]
    prefix = F.element_at(F.array(*map(F.lit, prefixes)), (F.col("o_orderkey") % len(prefixes) + 1).cast("int"))
    # More digits behind the prefix than any number has: all of them are compared.
    numbers = table(spark, sf, "orders").select("o_orderkey", F.concat(prefix, F.repeat(F.lit("5"), 80)).alias("number"))
    return J.country_of_number(numbers, "number").groupBy("country").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order")
    )


@query("filter_valid_country", LOCATED + """
select from_country, to_country, count(*) as calls, round(avg(mos), 6) as mean_mos
from located where from_country is not null and to_country is not null group by 1, 2
""")
def filter_valid_country(spark, sf):
    df = J.country_of_number(clean_calls(spark, sf), "from_number", out="from_country")
    df = C.filter_valid_country(J.country_of_number(df, "to_number", out="to_country"))
    return df.groupBy("from_country", "to_country").agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.avg("mos"), 6).alias("mean_mos")
    )


@query("filter_predicate", """
select l_orderkey, l_partkey, l_quantity, l_discount from lineitem
where l_discount > 0.05 and l_quantity < 10 and l_returnflag = 'R'
""")
def filter_predicate(spark, sf):
    df = C.filter_predicate(table(spark, sf, "lineitem"), "l_discount > 0.05 and l_quantity < 10 and l_returnflag = 'R'")
    return df.select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query("filter_contains", "select p_partkey, p_name, p_type from part where contains(p_type, 'O')")
def filter_contains(spark, sf):
    return C.filter_contains(table(spark, sf, "part"), "p_type", "O").select("p_partkey", "p_name", "p_type")


@query("select_features", "select packet_loss, mos, jitter, duration_seconds from (" + CLEAN + "select * from calls)")
def select_features(spark, sf):
    scored = C.select_features(calls(spark, sf), exclude=["status", "start_time", "data_center", "carrier_id"])
    return C.select_features(scored, include=["packet_loss", "mos", "jitter", "duration_seconds"])


@query("flag_rows", CLEAN + "select call_id, mos, coalesce(mos < 2, false) as is_anomaly from calls")
def flag_rows(spark, sf):
    return C.flag_rows(calls(spark, sf), F.col("mos") < 2).select("call_id", "mos", "is_anomaly")


@query("table_shape", CLEAN + "select count(*) as rows, 9::bigint as cols from clean")
def table_shape(spark, sf):
    return C.table_shape(clean_calls(spark, sf))


@query("union_all", f"""
with {CALLS_CTE}, {labelled_cte()}
select call_id, label = 'anomaly' as is_anomaly, packet_loss, duration, jitter, mos from labelled where label <> 'none'
""")
def union_all(spark, sf):
    clean = clean_calls(spark, sf)
    cols = ["call_id", "is_anomaly", *FEATURES]
    return C.union_all(C.label_anomalies_rule(clean).select(*cols), C.label_normal_rule(clean).select(*cols))


# the preparation job
@query("prepare_calls", f"""
with {CALLS_CTE}, {COUNTRY_CTE},
valid as (select * from located where from_country is not null and to_country is not null),
{labelled_cte('valid')}
select call_id, from_country, to_country, day(start_time)::int as day, label from labelled
""")
def prepare(spark, sf):
    return prepare_calls(calls(spark, sf)).select("call_id", "from_country", "to_country", "day", "label")


_NORMALIZED = ", ".join(
    f"round((k.{c} - avg(k.{c}) over ()) / stddev_samp(k.{c}) over (), 6) as {c}" for c in FEATURES
)


@query("normalize_calls", f"""
with {CALLS_CTE}, {COUNTRY_CTE},
valid as (select * from located where from_country is not null and to_country is not null),
{labelled_cte('valid')}, k as (select * from labelled where label <> 'none')
select call_id, label, {_NORMALIZED} from k
""")
def normalize_query(spark, sf):
    labelled = prepare_calls(calls(spark, sf)).select("call_id", "label", *FEATURES)
    scaled = normalize_calls(labelled, FEATURES)
    return scaled.select("call_id", "label", *[F.round(c, 6).alias(c) for c in FEATURES])


NORMALIZED_COLUMNS = "call_id,duration,from_country,from_number,jitter,mos,organization_id,packet_loss,start_time,to_country,to_number"


@query("run_prepare", f"""
with {CALLS_CTE}, {COUNTRY_CTE},
valid as (select * from located where from_country is not null and to_country is not null),
{labelled_cte('valid')}, k as (select * from labelled where label <> 'none')
select call_id, label, from_number, to_number, organization_id, from_country, to_country, {_NORMALIZED},
       '{NORMALIZED_COLUMNS}' as columns,
       (select count(*) from calls)::bigint as accepted, 1::bigint as rejected from k
""")
def run_prepare_query(spark, sf):
    """The whole job over written CSV: columns in another order, numbers with leading zeros, a row that does not fit."""
    path, out = scratch_path(spark, "calls-csv"), scratch_path(spark, "prepared")
    unassigned = F.col("from_number").startswith("999000")
    number = F.when(unassigned, F.concat(F.lit("0155"), F.col("from_number"))).otherwise(F.col("from_number"))
    raw = calls(spark, sf).withColumn("from_number", number).withColumnsRenamed({"mos": "mean_opinion_score", "from_number": "e164_from_caller_id"})
    text = raw.select(*[F.col(c).cast("string") for c in reversed(raw.columns)])
    broken = text.limit(1).withColumns({"jitter": F.lit("not a number"), "call_id": F.lit("broken")})
    W.write_csv(text.unionByName(broken), path)
    params = PrepareParams(
        path, f"{out}/labelled", anomaly_normalized_output=f"{out}/anomaly", normal_normalized_output=f"{out}/normal", rejected_output=f"{out}/rejected"
    )
    run_prepare(spark, params)
    found = None
    for label in ("anomaly", "normal"):
        scaled = spark.read.option("header", True).csv(f"{out}/{label}")
        names = ",".join(sorted(set(scaled.columns) - {"day", "hour"}))
        one = scaled.withColumns({"label": F.lit(label), "columns": F.lit(names)})
        found = one if found is None else found.unionByName(one)
    rejected = spark.read.text(f"{out}/rejected").count()
    return found.select(
        "call_id", "label", "from_number", "to_number", "organization_id", "from_country", "to_country",
        *[F.round(F.col(c).cast("double"), 6).alias(c) for c in FEATURES], "columns",
        F.lit(spark.read.option("header", True).csv(path).count() - rejected).alias("accepted"), F.lit(rejected).cast("bigint").alias("rejected"),
    )
