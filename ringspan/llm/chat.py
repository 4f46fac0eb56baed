"""Chat formatting by multi-party perspective rotation.

For every participant the dialogue is rendered with that speaker as the assistant and the others as named users;
the mask says which characters the model learns. Turns are numbered by range partitions and dealt by (conversation,
part), so a conversation of any length, even one with a third of all turns, never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import row_number

END = "<|end|>"


def rotate_perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    part_turns: int = 256, fixed: tuple[str, ...] = ("system",), unknown: str = "unknown",
) -> DataFrame:
    """One row per conversation, participant and part of at most ``part_turns`` turns.

    conv_id, speaker, part (from 0), text, mask (``start-end`` of the learnt characters within the part, comma-joined,
    each a turn of the speaker with its end mark), n_turns, n_learnt. The parts of a perspective in order are the whole
    dialogue. Turns are ordered by turn (NULL first), role and text. Roles in ``fixed`` keep their name and take no
    perspective; NULL roles speak as ``unknown``; NULL texts are empty; NULL conversations form one of their own;
    repeated rows are repeated turns; other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(unknown)).alias("role"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    numbered = row_number(rows, ["turn", "role", "text"], "place", by=["conv_id"])
    part = F.floor((F.col("place") - 1) / part_turns).cast("long").alias("part")
    parts = numbered.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    speakers = rows.filter(~F.col("role").isin(*fixed)).select("conv_id", F.col("role").alias("speaker")).distinct()
    each = parts.alias("p").join(speakers.alias("s"), F.col("p.conv_id").eqNullSafe(F.col("s.conv_id"))).select("p.*", "s.speaker")

    own = lambda t: t["role"] == F.col("speaker")
    head = lambda t: (
        F.when(own(t), F.lit("<|assistant|>\n")).when(t["role"].isin(*fixed), F.concat(F.lit("<|"), t["role"], F.lit("|>\n")))
        .otherwise(F.concat(F.lit("<|user|>"), t["role"], F.lit("\n")))
    )
    shown = F.transform("turns", lambda t: F.struct(own(t).alias("own"), head(t).alias("head"), F.concat(t["text"], F.lit(END)).alias("said")))
    each = each.select("conv_id", "speaker", "part", shown.alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["said"]) + 1
    before = lambda i: F.aggregate(F.slice("turns", 1, i), F.lit(0), lambda n, t: n + size(t))
    spans = F.transform(
        "turns", lambda t, i: F.when(t["own"], F.struct((before(i) + F.length(t["head"])).alias("a"), F.length(t["said"]).alias("n")))
    )
    return each.select(
        "conv_id", "speaker", "part",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["said"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.transform(F.array_compact(spans), lambda s: F.concat_ws("-", s["a"], s["a"] + s["n"])), ",").alias("mask"),
        F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("turns", lambda t: t["own"])).cast("long").alias("n_learnt"),
    )
