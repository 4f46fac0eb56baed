"""Call records derived from ``lineitem``, as a frame and as SQL text for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import (
    UNUSED_CALL_COLUMNS, canonical_columns, drop_columns, drop_null_rows,
)
from ..sources.readers import spread
from .registry import table

FEATURES = ["packet_loss", "duration", "jitter", "mos"]


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """Raw call records: un-canonical names, some NULL scores, some unassigned prefixes."""
    return calls_from(spread(table(spark, sf, "lineitem")))


def calls_from(lineitem: DataFrame) -> DataFrame:
    """The call records of a batch or stream of ``lineitem`` rows."""
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    part, supp = F.col("l_partkey") % 5, F.col("l_suppkey") % 4
    caller = (
        F.when(part == 0, "1415555").when(part == 1, "4479110").when(part == 2, "3361234")
        .when(part == 3, "0014155").otherwise("999000")
    )
    callee = F.when(supp == 0, "1212555").when(supp == 1, "4915112").when(supp == 2, "9198765").otherwise("4479110")
    four = lambda c: F.lpad((F.col(c) % 10000).cast("string"), 4, "0")
    calm = F.col("l_discount") <= 0.03
    return lineitem.select(
        key.alias("call_id"),
        F.col("l_suppkey").cast("string").alias("organization_id"),
        F.concat(caller, four("l_partkey")).alias("from_number"),
        F.concat(callee, four("l_orderkey")).alias("to_number"),
        F.when(F.col("l_returnflag") == "R", "answered").when(F.col("l_returnflag") == "A", "unanswered")
        .otherwise("voicemail").alias("status"),
        F.col("l_shipdate").alias("start_time"),
        F.floor(F.col("l_quantity") * 12).cast("int").alias("duration_seconds"),
        F.concat(F.lit("dc"), F.col("l_linestatus")).alias("data_center"),
        (F.col("l_suppkey") % 7).cast("int").alias("carrier_id"),
        F.when(calm, 0.0).otherwise(F.round(F.col("l_discount") * 4, 4)).alias("packet_loss"),
        F.when(F.col("l_partkey") % 97 != 0,
               F.round(4.5 - F.col("l_discount") * 20 * F.when(calm, 0.1).otherwise(1.0) - F.col("l_tax") * 5, 4))
        .alias("mos"),
        F.round(F.col("l_tax") * F.when(calm, 10).otherwise(60), 4).alias("jitter"),
    )


def clean_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical names, unused columns gone, rows with a NULL gone."""
    return drop_null_rows(drop_columns(canonical_columns(calls(spark, sf)), UNUSED_CALL_COLUMNS))


CALLS_CTE = """
calls as (
  select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as call_id,
         cast(l_suppkey as varchar) as organization_id,
         concat(case l_partkey % 5 when 0 then '1415555' when 1 then '4479110' when 2 then '3361234'
                  when 3 then '0014155' else '999000' end,
                lpad(cast(l_partkey % 10000 as varchar), 4, '0')) as from_number,
         concat(case l_suppkey % 4 when 0 then '1212555' when 1 then '4915112' when 2 then '9198765'
                  else '4479110' end,
                lpad(cast(l_orderkey % 10000 as varchar), 4, '0')) as to_number,
         case l_returnflag when 'R' then 'answered' when 'A' then 'unanswered' else 'voicemail' end as status,
         l_shipdate as start_time,
         cast(floor(l_quantity * 12) as int) as duration_seconds,
         concat('dc', l_linestatus) as data_center,
         cast(l_suppkey % 7 as int) as carrier_id,
         case when l_discount <= 0.03 then 0.0::double else round(l_discount * 4, 4) end as packet_loss,
         case when l_partkey % 97 = 0 then null
              else round(4.5::double - l_discount * 20 * (case when l_discount <= 0.03 then 0.1::double
                                                               else 1.0::double end) - l_tax * 5, 4) end as mos,
         round(l_tax * (case when l_discount <= 0.03 then 10 else 60 end), 4) as jitter
  from lineitem),
clean as (
  select call_id, organization_id, from_number, to_number, start_time, duration_seconds as duration,
         packet_loss, mos, jitter
  from calls
  where call_id is not null and organization_id is not null and from_number is not null and to_number is not null
    and start_time is not null and duration_seconds is not null and packet_loss is not null and mos is not null
    and jitter is not null)
"""


def _country_sql(number: str) -> str:
    return f"coalesce(p4_{number}.country, p3_{number}.country, p2_{number}.country, p1_{number}.country)"


def _prefix_joins(number: str) -> str:
    digits = f"case when {number} like '00%' then substr({number}, 3) else {number} end"
    return "\n".join(
        f"left join codes p{n}_{number} on length(p{n}_{number}.prefix) = {n} "
        f"and p{n}_{number}.prefix = left({digits}, {n})"
        for n in (1, 2, 3, 4)
    )


# The prefixes that the derived numbers have, written here apart from the operator's own table.
CODES_CTE = """codes(prefix, country) as (values ('1', 'United States'), ('33', 'France'), ('44', 'United Kingdom'),
  ('49', 'Germany'), ('91', 'India'))"""

COUNTRY_CTE = f"""
{CODES_CTE},
located as (
  select clean.*, {_country_sql('from_number')} as from_country, {_country_sql('to_number')} as to_country
  from clean
  {_prefix_joins('from_number')}
  {_prefix_joins('to_number')})
"""

CUTS = """
cuts as (select quantile_cont(jitter, 0.5) as jitter_q50, quantile_cont(mos, 0.25) as mos_q25,
                quantile_cont(duration, 0.5) as duration_q50 from {source})
"""

LABEL = """
case when packet_loss > 0.1 and jitter > jitter_q50 and mos < mos_q25 then 'anomaly'
     when duration > duration_q50 and mos > 4 and jitter <= 1 and packet_loss <= 0 then 'normal'
     else 'none' end
"""


def labelled_cte(source: str = "clean") -> str:
    return f"{CUTS.format(source=source)}, labelled as (select {source}.*, {LABEL} as label from {source}, cuts)"
