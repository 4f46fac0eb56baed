"""Texts: cleaning, chunks, prompts, text models, overlap scores, conversations, tuning rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import HEADER_WORDS, hash_uniform, name_and_type, strip_emails, strip_parentheses
from ..session import partitions_for, store
from ..sources.readers import describe_schema
from .aggregates import describe, string_agg
from .joins import lookup_label
from .ordered import is_small, limit_n, same_key, sample_per_group, top_k_per_group

# Blank characters between words, the token pattern of overlap scores, message roles,
# and the number of tuning examples advised per task.
BLANKS = r"[ \t\n\r]+"
NOT_TOKEN = r"[^a-z0-9]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
ROLES = ("user", "model")
ADVISED_EXAMPLES = {"classification": 500, "summarization": 1000, "extractive_qa": 500, "chat": 1000}
MAX_VALIDATION = 250
# The lines around each file of a concatenated corpus.
FILE_HEAD, FILE_NAME_END, FILE_END = "----- File: ", " -----\n", "\n-------------------------\n"


def _split(text: Column | str, pattern: str) -> Column:
    return F.filter(F.split(text, pattern), lambda w: w != "")


def words(text: Column | str) -> Column:
    """The words of a text, parted by blanks."""
    return _split(text, BLANKS)


# corpus
def clean_text(df: DataFrame, col: str, max_chars: int | None = None) -> DataFrame:
    """Text without e-mail addresses, parenthesised parts and header words; cut only when asked to."""
    text = strip_parentheses(strip_emails(col))
    for header in HEADER_WORDS:
        text = F.replace(text, F.lit(header), F.lit(""))
    return df.withColumn(col, text if max_chars is None else F.left(text, F.lit(max_chars)))


def labelled_corpus(
    df: DataFrame, dim: DataFrame, label: str, name: str, n: int | None = None, key: str | None = None,
    contains: str | None = None, seed: str | int = 0,
) -> DataFrame:
    """Texts with the name of their class; the class filter comes first, then n random rows per class."""
    named = lookup_label(df, dim, label, name)
    if contains is not None:
        named = named.filter(F.col(name).contains(contains))
    return named if n is None else sample_per_group(named, label, n, key, seed)


def chunk_text(df: DataFrame, id: str, col: str, words_per_chunk: int, overlap: int = 0) -> DataFrame:
    """(chunk_id, id, chunk, text): windows of n words that share ``overlap`` words with the one before."""
    step = words_per_chunk - overlap
    if step < 1:
        raise ValueError("overlap must be smaller than the chunk")
    rows = df.select(id, words(col).alias("_words"))
    last = F.greatest(F.ceil((F.size("_words") - overlap) / step), F.lit(1)).cast("int") - 1
    numbered = rows.withColumn("chunk", F.explode(F.when(F.size("_words") > 0, F.sequence(F.lit(0), last))))
    text = F.array_join(F.slice("_words", F.col("chunk") * step + 1, words_per_chunk), " ")
    chunk_id = F.concat_ws(":", F.col(id).cast("string"), F.col("chunk").cast("string"))
    return numbered.select(chunk_id.alias("chunk_id"), id, "chunk", text.alias("text"))


def corpus_index(files: DataFrame, max_chars: int = 1 << 20) -> DataFrame:
    """(part, chunk, text): 'index' lists every path, 'content' joins the text files under headings.

    Both are in path order and come in chunks of bounded size.
    """
    index = string_agg(files, F.col("path"), "\n", ["path"], max_chars=max_chars)
    body = F.concat(F.lit(FILE_HEAD), F.col("path"), F.lit(FILE_NAME_END), F.col("text"), F.lit(FILE_END))
    content = string_agg(files.filter("is_text"), body, "", ["path"], max_chars=max_chars)
    return index.select(F.lit("index").alias("part"), "chunk", "text").unionByName(
        content.select(F.lit("content").alias("part"), "chunk", "text")
    )


# prompts and text models
def build_prompts(
    df: DataFrame, instruction: str, cols: Sequence[str], order_by: Sequence[str], by: Sequence[str] = (),
    max_chars: int = 30_000,
) -> DataFrame:
    """Instruction, rows as comma-separated lines and the schema, as prompts that hold ``max_chars`` of rows each."""
    row = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    lines = string_agg(df, row, "\n", order_by, by, max_chars=max_chars, name="rows")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*cols).schema.fields)
    prompt = F.concat(F.lit(instruction + "\n"), F.col("rows"), F.lit("\n" + schema))
    return lines.withColumn("prompt", prompt).drop("rows")


def schema_text(df: DataFrame) -> DataFrame:
    """One row: the columns as "name type, name type"."""
    item = name_and_type("column_name", "data_type")
    return string_agg(describe_schema(df), item, ", ", ["ordinal_position"]).select("text")


def apply_text_model(
    df: DataFrame, prompt: str, fn: Callable[..., list[str | None]], response: str = "response", **options
) -> DataFrame:
    """Adds ``response`` and ``error``. ``fn(prompts, **options)`` is called once per Arrow batch.

    A failed batch is tried row by row; a row that fails or gets no answer keeps its place with the
    reason in ``error``.
    """
    schema = T.StructType([
        *df.schema.fields, T.StructField(response, T.StringType()), T.StructField("error", T.StringType()),
    ])

    def one(text):
        try:
            answer = fn([text], **options)[0]
        except Exception as problem:
            return None, str(problem) or type(problem).__name__
        return answer, None if answer else "blocked"

    def ask(batches):
        for batch in batches:
            texts = batch[prompt].tolist()
            try:
                answers = [(a, None if a else "blocked") for a in fn(texts, **options)]
                if len(answers) != len(texts):
                    raise ValueError("one answer per prompt is needed")
            except Exception:
                answers = [one(text) for text in texts]
            yield batch.assign(**{response: [a for a, _ in answers], "error": [e for _, e in answers]})

    return df.mapInPandas(ask, schema)


# retrieval
def _best_of(batches, terms_of: np.ndarray, starts: np.ndarray, weights: np.ndarray, idf: np.ndarray, questions: int, k: int):
    """(question, document, score): the k best of every question among a partition's documents.

    The questions of a term are ``terms_of[starts[t] : starts[t + 1]]``. A document's bound is what it would score for
    a question that asks for all its words; documents go in the order of their bounds, and end where the bound is
    below the k-th score of every question.
    """
    best: list[list[tuple[float, object]]] = [[] for _ in range(questions)]
    least, schema, largest = np.full(questions, -np.inf), None, weights.max(initial=1.0)
    for batch in batches:
        parts, schema = [], pa.schema([("question", pa.int32()), ("doc", batch.schema.field(0).type), ("score", pa.float64())])
        for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            term, tf = np.unique(ids.values.to_numpy(), return_counts=True)
            part = (1.0 + np.log(tf)) * idf[term]
            parts.append((largest * float(part.sum()), doc, term, part))
        parts.sort(key=lambda p: -p[0])
        for bound, doc, term, part in parts:
            if bound < least.min() - 1e-6:
                break
            size = starts[term + 1] - starts[term]
            at = np.repeat(starts[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            asked, inverse = np.unique(terms_of[at], return_inverse=True)
            scores = np.floor(np.bincount(inverse, np.repeat(part, size) * weights[at]) * 1e6 + 0.5) / 1e6
            for i in np.flatnonzero(scores >= least[asked]):
                found = best[asked[i]]
                found.append((float(scores[i]), doc))
                if len(found) >= 2 * k:
                    _shorten(found, k)
                    least[asked[i]] = found[-1][0]
    rows = []
    for q, found in enumerate(best):
        _shorten(found, k)
        rows += [(q, doc, score) for score, doc in found]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _shorten(found: list, k: int) -> None:
    """The k largest scores, ties by the smaller document, NULL first."""
    found.sort(key=lambda f: (-f[0], f[1] is not None, f[1]))
    del found[k:]


def _retrieve_blocks(docs: DataFrame, postings: DataFrame, k: int, doc_id: str, question_id: str, text: str) -> DataFrame:
    """Documents scored where they lie against all questions at once."""
    spark = docs.sparkSession
    asked = postings.filter(F.col("term").isNotNull()).collect()  # bounded by the caller's check
    terms = {t: i for i, t in enumerate(sorted({r["term"] for r in asked}))}
    known = {q: i for i, q in enumerate(dict.fromkeys(r[question_id] for r in asked))}
    pairs = Counter((terms[r["term"]], known[r[question_id]]) for r in asked)
    rows = sorted(pairs)
    vocabulary = spark.createDataFrame(list(terms.items()), "term string, _term int")
    occurrences = docs.select(doc_id, F.explode(_split(F.lower(text), NOT_WORD)).alias("term")).join(F.broadcast(vocabulary), "term")
    held = store(occurrences.groupBy(doc_id).agg(F.collect_list("_term").alias("_terms")), "retrieval-terms")
    df = {r["t"]: r["n"] for r in held.select(F.explode(F.array_distinct("_terms")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = docs.count()
    idf = np.array([np.log(total / df[t]) if t in df else 0.0 for t in range(len(terms))])
    starts = np.searchsorted([t for t, _ in rows], np.arange(len(terms) + 1))
    index = (np.array([q for _, q in rows], np.int64), starts, np.array([pairs[r] for r in rows], np.float64), idf, len(known))
    shared = spark.sparkContext.broadcast(index)
    kind = docs.schema[doc_id].dataType.simpleString()
    found = held.mapInArrow(lambda batches: _best_of(batches, *shared.value, k), f"question int, doc {kind}, score double")
    names = spark.createDataFrame([(i, q) for q, i in known.items()], T.StructType([
        T.StructField("question", T.IntegerType()), T.StructField(question_id, postings.schema[question_id].dataType)]))
    best = top_k_per_group(found, "question", [F.desc("score"), F.asc("doc")], k, rank="rank")
    return best.join(F.broadcast(names), "question").select(F.col("doc").alias(doc_id), question_id, "score", "rank")


def retrieve_documents(
    docs: DataFrame, questions: DataFrame, k: int = 10, doc_id: str = "doc_id", question_id: str = "question_id",
    text: str = "text", max_broadcast_terms: int = 200_000,
) -> DataFrame:
    """The k best documents per question: sum of (1 + ln tf) * ln(N / df) over the question's words, to 6 places.

    Only words some question holds leave the first stage, and move once, by document. The words of all questions go
    to the tasks if they are at most ``max_broadcast_terms``: each task scores its documents against all of them and
    keeps the k best per question, passing over documents whose bound is too low, so neither rows of documents and
    questions nor groups of a frequent word ever form. More words are joined with the documents' words, for which the
    texts move once, by document.
    """
    lower = F.array_distinct(_split(F.lower(text), NOT_WORD))
    postings = questions.select(question_id, F.explode(lower).alias("term"))
    if is_small(postings, max_broadcast_terms):
        return _retrieve_blocks(docs, postings, k, doc_id, question_id, text)
    # Texts move, not their words: a word is a row of its own, several times the size of its text.
    texts = docs.select(doc_id, text).repartition(partitions_for(docs, 16 << 20), doc_id)
    occurrences = texts.select(doc_id, F.explode(_split(F.lower(text), NOT_WORD)).alias("term"))
    hits = occurrences.join(postings.select("term").distinct(), "term", "left_semi")
    tf = hits.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))
    total = docs.agg(F.count(F.lit(1))).scalar()
    idf = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", F.log(total / F.col("df")).alias("idf"))
    # Stored, so that its size is known: while it can be broadcast, all of a document stays where its text is.
    weights = store(postings.join(idf, "term"), "retrieval-weights")
    scored = tf.join(weights, "term").withColumn("_part", (1 + F.log(F.col("tf"))) * F.col("idf"))
    totals = scored.groupBy(doc_id, question_id).agg(F.round(F.sum("_part"), 6).alias("score"))
    return top_k_per_group(totals, question_id, [F.desc("score"), F.asc(doc_id)], k, rank="rank")


# overlap scores
def _tokens(text: str) -> Column:
    return _split(F.lower(text), NOT_TOKEN)


def _ngrams(tokens: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def _precision_recall_f(overlap: Column, predicted: Column, target: Column) -> dict[str, Column]:
    precision = F.when(predicted > 0, overlap / predicted).otherwise(0.0)
    recall = F.when(target > 0, overlap / target).otherwise(0.0)
    both = precision + recall
    return {"precision": precision, "recall": recall, "fmeasure": F.when(both > 0, 2 * precision * recall / both).otherwise(0.0)}


def rouge_n(df: DataFrame, id: str, target: str, prediction: str, n: int = 1) -> DataFrame:
    """(id, rouge<n>_precision, _recall, _fmeasure): n-gram overlap of two texts per row, without a stemmer.

    Counted inside the row, so nothing moves, and rows that repeat an id are scored each. A NULL text scores 0.
    """

    @F.pandas_udf("double")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float((Counter(x) & Counter(y)).total()) for x, y in zip(a, b)])

    name = f"rouge{n}"
    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    tokens = df.select(id, _tokens(text(target)).alias("_tt"), _tokens(text(prediction)).alias("_tp"))
    grams = tokens.select(id, _ngrams(F.col("_tt"), n).alias("_t"), _ngrams(F.col("_tp"), n).alias("_p"))
    measured = grams.withColumn("_overlap", common("_t", "_p"))
    scores = _precision_recall_f(F.col("_overlap"), F.size("_p"), F.size("_t"))
    return measured.select(id, *[c.alias(f"{name}_{part}") for part, c in scores.items()])


def _common_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence; one big-integer row per word of ``b``."""
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        match = row & places.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def rouge_l(df: DataFrame, id: str, target: str, prediction: str) -> DataFrame:
    """(id, rougeL_precision, _recall, _fmeasure) from the longest common subsequence of tokens. A NULL text scores 0."""

    @F.pandas_udf("double")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float(_common_length(list(x), list(y))) for x, y in zip(a, b)])

    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    rows = df.select(id, _tokens(text(target)).alias("_t"), _tokens(text(prediction)).alias("_p"))
    measured = rows.withColumn("_overlap", common("_t", "_p"))
    scores = _precision_recall_f(F.col("_overlap"), F.size("_p"), F.size("_t"))
    return measured.select(id, *[c.alias(f"rougeL_{part}") for part, c in scores.items()])


def score_report(before: DataFrame, after: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric: count, mean and quartiles before and after, and the percent change of the mean."""
    names = ("count", "mean", "q25", "q50", "q75")

    def side(df: DataFrame, suffix: str) -> DataFrame:
        complete = df.dropna("any", subset=list(metrics))
        return describe(complete, metrics).select("column", *[F.col(n).alias(f"{n}_{suffix}") for n in names])

    both = side(before, "before").join(side(after, "after"), "column")
    change = (F.col("mean_after") - F.col("mean_before")) / F.nullif("mean_before", F.lit(0.0)) * 100
    return both.withColumn("percent_change", F.round(change, 2))


# conversations and tuning rows
def conversation_history(
    df: DataFrame, session: str, order: str, last_n: int, role: str = "role", text: str = "text"
) -> DataFrame:
    """The last n messages of each session, in order, as one array per session."""
    latest = top_k_per_group(df, session, [F.desc(order)], last_n)
    message = F.struct(F.col(order).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return latest.groupBy(session).agg(F.sort_array(F.collect_list(message)).alias("messages"))


def session_messages(df: DataFrame, session: str, order: str) -> DataFrame:
    """All messages, session by session in order, however long a session is."""
    return df.orderBy(session, order)


def build_tuning_pairs(
    conversations: DataFrame, session: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(session, turn, value): each user message with the answer that follows it, as a JSON line.

    An equi-join on (session, turn), so the turns of a long session spread over all tasks.
    """
    asked = conversations.filter(F.col(role) == "user").select(
        session, F.col(order).alias("turn"), (F.col(order) + 1).alias("_next"), F.col(text).alias("_input")
    )
    answered = conversations.filter(F.col(role).isin("assistant", "model")).select(
        session, F.col(order).alias("_next"), F.col(text).alias("_output")
    )
    pairs = asked.join(answered, [session, "_next"])
    user = F.struct(F.lit("user").alias("role"), F.col("_input").alias("content"))
    model = F.struct(F.lit("model").alias("role"), F.col("_output").alias("content"))
    line = F.to_json(F.struct(F.array(user, model).alias("messages")))
    return pairs.select(session, "turn", line.alias("value"))


def split_tuning_rows(rows: DataFrame, keys: Sequence[str], seed: str | int = 0, n: int = MAX_VALIDATION):
    """(train, validation) with at most 250 validation rows; ``keys`` identify a row."""
    if n > MAX_VALIDATION:
        raise ValueError(f"at most {MAX_VALIDATION} validation rows")
    key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    held = limit_n(rows, n, [hash_uniform(key, seed), *keys])
    train = rows.alias("r").join(F.broadcast(held.select(*keys)).alias("h"), same_key("r", "h", keys), "left_anti")  # at most n rows
    return train, held


MESSAGES = T.StructType([T.StructField("messages", T.ArrayType(T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)))])


def validate_tuning_rows(df: DataFrame, task: str = "chat", value: str = "value") -> DataFrame:
    """(rule, failures) over JSON lines: schema, roles, order of roles, empty texts, and advised size.

    For the size rule ``failures`` is the number of examples that are missing.
    """
    parsed = df.select(F.from_json(value, MESSAGES)["messages"].alias("m"))
    valid = F.coalesce(F.size("m") > 0, F.lit(False))
    roles = F.forall("m", lambda m: F.coalesce(m["role"].isin(*ROLES), F.lit(False)))
    filled = F.forall("m", lambda m: F.coalesce(F.trim(m["content"]) != "", F.lit(False)))
    ends = (F.element_at("m", 1)["role"] == "user") & (F.element_at("m", -1)["role"] == "model")
    fails = lambda ok: F.count(F.when(valid & ~F.coalesce(ok, F.lit(False)), 1))
    one = parsed.agg(
        F.count(F.when(~valid, 1)).alias("schema"), fails(roles).alias("roles"), fails(ends).alias("order"),
        fails(filled).alias("content"), F.count(F.lit(1)).alias("_n"),
    )
    missing = F.greatest(F.lit(ADVISED_EXAMPLES[task]) - F.col("_n"), F.lit(0))
    rows = [F.struct(F.lit(r).alias("rule"), F.col(r).alias("failures")) for r in ("schema", "roles", "order", "content")]
    return one.select(F.inline(F.array(*rows, F.struct(F.lit("size").alias("rule"), missing.alias("failures")))))
