"""Queries over embeddings, documents, benchmark texts and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as S
from ..operators import aggregates as A
from ..operators import embeddings as E
from ..operators import joins as J
from ..operators import neighbours as K
from ..operators import text as X
from ..session import cut_lineage, scratch_path
from ..sources import readers as R
from ..sources import writers as W
from .registry import query, table

RADII = [0.94, 0.96, 0.98, 1.0, 1.02, 1.04]

CENTROIDS = """
points as (select vec_id, label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as x from embeddings),
centroids as (select label, pos, avg(x) as c from points group by label, pos),
distances as (select vec_id, p.label, sqrt(sum((x - c) * (x - c))) as distance
              from points p join centroids using (label, pos) group by vec_id, p.label)
"""
# every class centroid against every vector
PAIRS = """
pairs as (select c.label as query, p.vec_id, p.label, sqrt(sum((x - c) * (x - c))) as l2,
                 sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))) as cosine
          from points p join centroids c using (pos) group by c.label, p.vec_id, p.label)
"""


def _documents(spark, sf):
    return R.spread(table(spark, sf, "documents"))


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings")


def _centroids(spark, sf):
    return cut_lineage(A.vector_centroid(_embeddings(spark, sf), "label", "embedding"))


@query("vector_centroid", f"with {CENTROIDS} select label, pos - 1 as pos, round(c, 6) as value from centroids")
def vector_centroid(spark, sf):
    rows = J.join_unnest(_centroids(spark, sf), "centroid", "value", position="pos")
    return rows.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("join_centroid", f"with {CENTROIDS} select vec_id, label, round(distance, 6) as distance from distances")
def join_centroid(spark, sf):
    joined = J.join_centroid(_embeddings(spark, sf), _centroids(spark, sf), "label")
    return joined.select("vec_id", "label", F.round(S.vector_distance("embedding", "centroid"), 6).alias("distance"))


@query("class_outliers", f"with {CENTROIDS} select vec_id, label, round(distance, 6) as distance from distances where distance > 1.0")
def class_outliers(spark, sf):
    rows = E.class_outliers(_embeddings(spark, sf), "label", "embedding", 1.0)
    return rows.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query("radius_sweep", f"with {CENTROIDS} " + " union all ".join(
    f"select {r}::double as radius, count(*) filter (distance > {r}) as outliers from distances" for r in RADII
))
def radius_sweep(spark, sf):
    return E.radius_sweep(_embeddings(spark, sf), "label", "embedding", RADII)


@query("knn_join", f"""
with {CENTROIDS}, {PAIRS}
select query, vec_id, label, round(l2, 6) as score, rank::int as rank from (
  select *, row_number() over (partition by query order by l2, vec_id) as rank from pairs) where rank <= 10
""")
def knn_join(spark, sf):
    found = K.knn_join(
        _embeddings(spark, sf), _centroids(spark, sf), 10, full_row=True, query_id="label", query_vec="centroid"
    )
    return found.select("query", "vec_id", "label", F.round("score", 6).alias("score"), "rank")


@query("knn_exact", f"""
with {CENTROIDS}, {PAIRS},
crowded as (select *, row_number() over (partition by query, label order by cosine desc, vec_id) as place
            from pairs)
select query, vec_id as id, round(cosine, 6) as score, rank::int as rank from (
  select *, row_number() over (partition by query order by cosine desc, vec_id) as rank from crowded where place <= 2)
where rank <= 8
""")
def knn_exact(spark, sf):
    found = K.knn_exact(
        _embeddings(spark, sf), _centroids(spark, sf), 8, metric="cosine", crowd_col="label",
        crowding=2, query_id="label", query_vec="centroid",
    )
    return found.withColumn("score", F.round("score", 6))


NEAREST = f"""
with {CENTROIDS}, {PAIRS}
select query, vec_id as id, round(l2, 6) as score, rank::int as rank from (
  select *, row_number() over (partition by query order by l2, vec_id) as rank from pairs) where rank <= 10
"""


@query("knn_exact_in_blocks", NEAREST)
def knn_exact_in_blocks(spark, sf):
    """Queries and base rows in blocks, without cells."""
    found = K.knn_exact(_embeddings(spark, sf), _centroids(spark, sf), 10, query_id="label", query_vec="centroid", cells=1)
    return found.withColumn("score", F.round("score", 6))


@query("knn_exact_in_cells", NEAREST)
def knn_exact_in_cells(spark, sf):
    """Over several cells, of which a query meets those that its bound allows."""
    found = K.knn_exact(_embeddings(spark, sf), _centroids(spark, sf), 10, query_id="label", query_vec="centroid", cells=16)
    return found.withColumn("score", F.round("score", 6))


@query("knn_approx", NEAREST)
def knn_approx(spark, sf):
    """With as many probes as leaves the index finds what a full search finds."""
    found = K.knn_approx(
        _embeddings(spark, sf), _centroids(spark, sf), 10, leaves=16, probes=16, query_id="label", query_vec="centroid"
    )
    return found.withColumn("score", F.round("score", 6))


@query("project_2d", "select count(*) as n, true as uncorrelated, true as first_axis_is_wider from embeddings")
def project_2d(spark, sf):
    """The axes of the plane carry no common variance, the first one the most."""
    plane = E.project_2d(_embeddings(spark, sf), "embedding")
    return plane.agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
        (F.variance("x") >= F.variance("y")).alias("first_axis_is_wider"),
    )


@query("parse_embeddings", """
select cast(vec_id as varchar) as chunk_id, round(list_sum(embedding::double[]), 4) as total, len(embedding) as size
from embeddings
""")
def parse_embeddings(spark, sf):
    embeddings = _embeddings(spark, sf).select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding")
    values = F.struct(F.struct(F.col("embedding").alias("values")).alias("embeddings"))
    predictions = embeddings.select("chunk_id", F.to_json(F.array(values)).alias("predictions"))
    chunks = embeddings.select("chunk_id", F.lit(None).cast("array<double>").alias("embedding"))
    parsed = E.parse_embeddings(chunks, predictions, "chunk_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return parsed.select(
        "chunk_id", F.round(total, 4).alias("total"), F.size("embedding").cast("bigint").alias("size")
    )


@query("embed_text", """
select doc_id, case when trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' then 0.0::double else 1.0::double end as norm, 64 as size from documents
""")
def embed_text(spark, sf):
    rows = E.embed_text(_documents(spark, sf).select("doc_id", "text"), "text")
    return rows.select("doc_id", F.round(S.vector_norm("embedding"), 6).alias("norm"), F.size("embedding").alias("size"))


# texts
@query("clean_text", r"""
select doc_id, md5(replace(replace(regexp_replace(regexp_replace(text, '[0-9A-Za-z_\.-]+@[0-9A-Za-z_\.-]+', '', 'g'), '\([^()]*\)', '', 'g'),
       'From: ', ''), chr(10) || 'Subject: ', '')) as digest from documents
""")
def clean_text(spark, sf):
    cleaned = X.clean_text(_documents(spark, sf), "text")
    return cleaned.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def _hash_sql(key: str, seed: str) -> str:
    return f"(cast('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 8) as bigint) / 4294967296.0::double)"


@query("labelled_corpus", f"""
select doc_id, quality, name, length(text) as chars from (
  select *, row_number() over (partition by quality order by {_hash_sql('doc_id', '0')}, doc_id) as rn
  from documents join labels using (doc_id) join (values (0, 'low_quality'), (1, 'high_quality')) n(quality, name) using (quality)
  where contains(name, 'quality'))
where rn <= 150
""")
def labelled_corpus(spark, sf):
    texts = J.join_using(_documents(spark, sf), table(spark, sf, "labels"), "doc_id")
    names = R.inline_rows(spark, [(0, "low_quality"), (1, "high_quality")], "quality int, name string")
    rows = X.labelled_corpus(texts, names, "quality", "name", 150, "doc_id", contains="quality", seed=0)
    return rows.select("doc_id", "quality", "name", F.length("text").cast("bigint").alias("chars"))


@query("chunk_text", """
with w as (select doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') as words from documents),
c as (select doc_id, words, unnest(range(0, greatest(cast(ceil((len(words) - 20) / 80.0) as bigint), 1))) as chunk
      from w where len(words) > 0)
select concat(cast(doc_id as varchar), ':', cast(chunk as varchar)) as chunk_id, doc_id, chunk::int as chunk,
       md5(array_to_string(words[chunk * 80 + 1 : chunk * 80 + 100], ' ')) as digest
from c
""")
def chunk_text(spark, sf):
    chunks = X.chunk_text(_documents(spark, sf), "doc_id", "text", 100, 20)
    return chunks.select("chunk_id", "doc_id", "chunk", F.md5(F.col("text").cast("binary")).alias("digest"))


RETRIEVED = r"""
with q as (select distinct item_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) as term from benchmark),
words as (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) as term from documents),
tf as (select doc_id, term, count(*) as tf from words where term <> '' group by all),
idf as (select term, ln((select count(*) from documents) / count(*)) as idf from tf group by term),
scored as (select item_id, doc_id, round(sum((1 + ln(tf)) * idf), 6) as score
           from tf join idf using (term) join q using (term) group by all)
select item_id, doc_id, score, rank::int as rank from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored) where rank <= 10
"""


@query("retrieve_documents", RETRIEVED)
def retrieve_documents(spark, sf):
    # The operator rounds scores to 6 places, so that equal scores rank by document; they are rounded only once.
    return X.retrieve_documents(_documents(spark, sf), table(spark, sf, "benchmark"), 10, "doc_id", "item_id")


@query("retrieve_documents_shuffled", RETRIEVED)
def retrieve_documents_shuffled(spark, sf):
    """The path of questions with more words than are broadcast."""
    return X.retrieve_documents(_documents(spark, sf), table(spark, sf, "benchmark"), 10, "doc_id", "item_id", max_broadcast_terms=0)


@query("build_prompts", """
with lines as (
  select o_orderpriority, o_orderkey, concat(cast(o_orderkey as varchar), ',', cast(o_custkey as varchar), ',', o_orderstatus) as line
  from orders),
placed as (
  select *, sum(length(line) + 1) over (partition by o_orderpriority order by o_orderkey) as upto from lines)
select o_orderpriority, cast(floor((upto - length(line) - 1) / 2000) as bigint) as chunk,
       md5(concat('Summarize these orders.' || chr(10), string_agg(line, chr(10) order by o_orderkey),
                  chr(10) || 'o_orderkey bigint, o_custkey bigint, o_orderstatus string')) as digest
from placed group by all
""")
def build_prompts(spark, sf):
    prompts = X.build_prompts(
        table(spark, sf, "orders"), "Summarize these orders.", ["o_orderkey", "o_custkey", "o_orderstatus"],
        ["o_orderkey"], by=["o_orderpriority"], max_chars=2000,
    )
    return prompts.select("o_orderpriority", "chunk", F.md5(F.col("prompt").cast("binary")).alias("digest"))


def longest_word(prompts, temperature=0.0, max_output_tokens=1, top_p=1.0, top_k=1):
    """Stands in for a hosted text model: answers with the longest word, the first of equals."""
    return [max(p.split(), key=len, default=None) for p in prompts]


@query("apply_text_model", """
with w as (select doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') as words from documents)
select doc_id, list_filter(words, lambda x: length(x) = list_max(list_transform(words, lambda y: length(y))))[1] as response,
       case when len(words) = 0 then 'blocked' else 'none' end as error
from w
""")
def apply_text_model(spark, sf):
    prompts = _documents(spark, sf).select("doc_id", "text")
    answers = X.apply_text_model(
        prompts, "text", longest_word, temperature=0.8, max_output_tokens=1024, top_p=0.95, top_k=40
    )
    return answers.select("doc_id", "response", F.coalesce("error", F.lit("none")).alias("error"))


def _pairs(spark, sf):
    """Each user message with the answer that follows it, with one id per pair."""
    talk = table(spark, sf, "conversations")
    asked = talk.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("target"))
    answers = talk.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prediction"))
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return asked.join(answers, ["conv_id", "turn"]).select(key.alias("id"), "target", "prediction")


PAIRS_SQL = """
pairs as (select concat(cast(a.conv_id as varchar), ':', cast(a.turn as varchar)) as id, q.text as target, a.text as prediction
          from conversations q join conversations a on q.conv_id = a.conv_id and a.turn = q.turn + 1
          where q.role = 'user' and a.role = 'assistant'),
tokens as (select id, list_filter(regexp_split_to_array(lower(target), '[^a-z0-9]+'), lambda x: x <> '') as t,
                  list_filter(regexp_split_to_array(lower(prediction), '[^a-z0-9]+'), lambda x: x <> '') as p from pairs)
"""


def _rouge_sql(n: int) -> str:
    gram = lambda s: f"list_transform(range(1, len({s}) - {n} + 2), lambda i: array_to_string({s}[i : i + {n - 1}], ' '))"
    return f"""
with {PAIRS_SQL},
sizes as (select id, greatest(len(t) - {n} + 1, 0) as nt, greatest(len(p) - {n} + 1, 0) as np from tokens),
tg as (select id, gram, count(*) as c from (select id, unnest({gram('t')}) as gram from tokens) group by all),
pg as (select id, gram, count(*) as c from (select id, unnest({gram('p')}) as gram from tokens) group by all),
shared as (select id, sum(least(tg.c, pg.c)) as overlap from tg join pg using (id, gram) group by id),
scores as (select id, case when np > 0 then coalesce(overlap, 0) / np else 0 end as pr,
                  case when nt > 0 then coalesce(overlap, 0) / nt else 0 end as re from sizes left join shared using (id))
select id, round(pr, 6) as rouge{n}_precision, round(re, 6) as rouge{n}_recall,
       round(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end, 6) as rouge{n}_fmeasure from scores
"""


def _rounded_scores(df):
    return df.select("id", *[F.round(c, 6).alias(c) for c in df.columns if c != "id"])


@query("rouge_1", _rouge_sql(1))
def rouge_1(spark, sf):
    return _rounded_scores(X.rouge_n(_pairs(spark, sf), "id", "target", "prediction", 1))


@query("rouge_2", _rouge_sql(2))
def rouge_2(spark, sf):
    return _rounded_scores(X.rouge_n(_pairs(spark, sf), "id", "target", "prediction", 2))


@query("rouge_l", f"""
with recursive {PAIRS_SQL}, dp(id, i, row) as (
  select id, 0, list_transform(range(0, len(p)), lambda x: 0) from tokens
  union all
  select id, i + 1, list_transform(range(1, len(cand) + 1), lambda j: list_max(cand[1:j])) from (
    select dp.id as id, dp.i as i, list_transform(range(1, len(p) + 1), lambda j: greatest(dp.row[j],
             case when t[dp.i + 1] = p[j] then (case when j > 1 then dp.row[j - 1] else 0 end) + 1 else 0 end)) as cand
    from dp join tokens on dp.id = tokens.id where dp.i < len(t))),
scores as (select id, case when len(p) > 0 then coalesce(list_max(row), 0) / len(p) else 0 end as pr,
                  case when len(t) > 0 then coalesce(list_max(row), 0) / len(t) else 0 end as re from dp join tokens using (id) where i = len(t))
select id, round(pr, 6) as rougeL_precision, round(re, 6) as rougeL_recall,
       round(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end, 6) as rougeL_fmeasure from scores
""")
def rouge_l(spark, sf):
    return _rounded_scores(X.rouge_l(_pairs(spark, sf), "id", "target", "prediction"))


@query("score_report", """
with b as (select * from lineitem where l_linestatus = 'F'), a as (select * from lineitem where l_linestatus = 'O'),
s as (select 'l_extendedprice' as "column", count(l_extendedprice) as n, avg(l_extendedprice) as m, quantile_cont(l_extendedprice, 0.5) as q50, 'b' as side from b
      union all select 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice), quantile_cont(l_extendedprice, 0.5), 'a' from a
      union all select 'l_quantity', count(l_quantity), avg(l_quantity), quantile_cont(l_quantity, 0.5), 'b' from b
      union all select 'l_quantity', count(l_quantity), avg(l_quantity), quantile_cont(l_quantity, 0.5), 'a' from a)
select x."column", x.n as count_before, y.n as count_after, round(x.m, 4) as mean_before, round(y.m, 4) as mean_after,
       round(x.q50, 4) as q50_before, round(y.q50, 4) as q50_after, round((y.m - x.m) / x.m * 100, 2) as percent_change
from s x join s y on x."column" = y."column" and x.side = 'b' and y.side = 'a'
""")
def score_report(spark, sf):
    line = table(spark, sf, "lineitem")
    report = X.score_report(
        line.filter("l_linestatus = 'F'"), line.filter("l_linestatus = 'O'"), ["l_extendedprice", "l_quantity"]
    )
    means = ("mean_before", "mean_after", "q50_before", "q50_after")
    return report.select(
        "column", "count_before", "count_after", *[F.round(c, 4).alias(c) for c in means], "percent_change"
    )


@query("conversation_history", """
select conv_id, string_agg(concat(role, '=', text), chr(10) order by turn) as history, count(*) as messages from (
  select *, row_number() over (partition by conv_id order by turn desc) as rn from conversations) where rn <= 4
group by conv_id
""")
def conversation_history(spark, sf):
    rows = X.conversation_history(table(spark, sf, "conversations"), "conv_id", "turn", 4)
    message = F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["text"]))
    return rows.select(
        "conv_id", F.array_join(message, "\n").alias("history"), F.size("messages").cast("bigint").alias("messages")
    )


@query("session_messages", "select conv_id, turn, role, text from conversations")
def session_messages(spark, sf):
    return X.session_messages(table(spark, sf, "conversations"), "conv_id", "turn")


@query("build_tuning_pairs", """
select q.conv_id, q.turn, '{"messages":[{"role":"user","content":' || to_json(q.text) || '},{"role":"model","content":' || to_json(a.text) || '}]}' as value
from conversations q join conversations a on q.conv_id = a.conv_id and a.turn = q.turn + 1
where q.role = 'user' and a.role = 'assistant'
""")
def build_tuning_pairs(spark, sf):
    return X.build_tuning_pairs(table(spark, sf, "conversations"))


@query("split_tuning_rows", f"""
with p as (select q.conv_id, q.turn, row_number() over (order by {_hash_sql("concat(cast(q.conv_id as varchar), '/', cast(q.turn as varchar))", '0')}, q.conv_id, q.turn) as rn
           from conversations q join conversations a on q.conv_id = a.conv_id and a.turn = q.turn + 1
           where q.role = 'user' and a.role = 'assistant')
select conv_id, turn, case when rn <= 100 then 'validation' else 'train' end as part from p
""")
def split_tuning_rows(spark, sf):
    pairs = X.build_tuning_pairs(table(spark, sf, "conversations"))
    train, held = X.split_tuning_rows(pairs, ["conv_id", "turn"], n=100)
    part = lambda df, name: df.select("conv_id", "turn", F.lit(name).alias("part"))
    return part(train, "train").unionByName(part(held, "validation"))


@query("validate_tuning_rows", """
with p as (select q.text as u, a.text as m from conversations q join conversations a on q.conv_id = a.conv_id and a.turn = q.turn + 1
           where q.role = 'user' and a.role in ('assistant', 'model'))
select 'schema' as rule, 0::bigint as failures union all select 'roles', 0 union all select 'order', 0
union all select 'content', count(*) filter (trim(u) = '' or trim(m) = '') from p
union all select 'size', greatest(1000 - count(*), 0) from p
""")
def validate_tuning_rows(spark, sf):
    return X.validate_tuning_rows(X.build_tuning_pairs(table(spark, sf, "conversations")), "chat")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("corpus_index", f"""
with files as (select lpad(cast(page_id as varchar), 12, '0') as path, html from pages),
bodies as (select path, {_literal(X.FILE_HEAD)} || path || {_literal(X.FILE_NAME_END)} || html || {_literal(X.FILE_END)} as body from files),
placed as (select path, body, (row_number() over (order by path) - 1) * 13 as before_path,
                  sum(length(body)) over (order by path) - length(body) as before_body from bodies)
select 'index' as part, cast(floor(before_path / 20000) as bigint) as chunk, md5(string_agg(path, chr(10) order by path)) as digest
from placed group by all
union all
select 'content', cast(floor(before_body / 20000) as bigint), md5(string_agg(body, '' order by path)) from placed group by all
""")
def corpus_index(spark, sf):
    """Every page as a file named by its number: the list of paths, and all contents under their headings."""
    files = table(spark, sf, "pages").select(
        F.lpad(F.col("page_id").cast("string"), 12, "0").alias("path"), F.lit(True).alias("is_text"), F.col("html").alias("text")
    )
    index = X.corpus_index(files, max_chars=20_000)
    return index.select("part", "chunk", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("corpus_content", """
select 'content' as part, sum(length(html) + 1)::bigint as body_chars from pages
""")
def corpus_content(spark, sf):
    path = scratch_path(spark, "tree")
    table(spark, sf, "pages").select("html").write.option("maxRecordsPerFile", 100).text(path)
    files = R.scan_file_corpus(spark, path).filter(F.col("path").endswith(".txt"))
    # heading and closing line of each file are taken off again, so the sum does not depend on the file layout
    extra = files.agg(F.sum(F.length("path") + len(X.FILE_HEAD + X.FILE_NAME_END + X.FILE_END))).scalar()
    content = X.corpus_index(files).filter("part = 'content'")
    return content.groupBy("part").agg((F.sum(F.length("text")) - F.first(extra)).cast("bigint").alias("body_chars"))
