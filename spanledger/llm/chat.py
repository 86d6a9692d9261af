"""Chat formatting from an event log, in DataFrame functions only.

Events (conv_id, turn, seq, kind, role, text) are dealt by conversation and sorted by sequence. Within a turn a delta
appends its text; an edit or a regeneration drops what stood before and begins anew with its text. The role is the last
one named. Messages are rendered in turn order as <turn>ROLE\\nTEXT</turn>\\n with a loss mask of code-point ranges over
the assistant texts.

Escapes: a backslash becomes \\s, "<" becomes \\l, and in roles a line feed becomes \\n; so no control string can stand
inside a text, and reading back is exact.

Defined cases: null text and role are empty; null conversations are one conversation; a null turn or sequence sorts
first; equal sequences are ordered by kind, role and text; a repeated event is applied again; an empty log gives no
rows; other columns are not used. A conversation is one output row, so its own text must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESETS = ("edit", "regenerate")
OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def messages(events: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: each turn's events folded in order of their sequence."""
    event = F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    folded = events.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(event)).alias("log"))
    resets = F.filter(F.transform("log", lambda e, i: F.when(e["kind"].isin(*RESETS), i + 1)), lambda i: i.isNotNull())
    since = F.coalesce(F.array_max(resets), F.lit(1))
    kept = F.slice("log", since, F.size("log"))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return folded.select("conv_id", "turn", F.coalesce(F.element_at(F.when(F.size(roles) > 0, roles), -1), F.lit("")).alias("role"), F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"))


def render(turns: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans (start, end): one row per conversation."""
    head, body = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = turns.withColumn("at", F.row_number().over(order)).withColumn("head", head).withColumn("body", body)
    pieces = pieces.withColumn("size", F.length("head") + F.length("body") + len(CLOSE))
    pieces = pieces.withColumn("start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") + F.length("head"))
    each = F.struct("at", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.col("role").isin(*learn).alias("learn"), "start", (F.col("start") + F.length("body")).alias("end"))
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("pieces"))
    spans = F.transform(F.filter("pieces", lambda p: p["learn"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    return whole.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with turns (role, text) parsed from the text, and loss_text under the mask, unescaped."""
    parts = F.split("formatted", CLOSE)
    parts = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.substring(p, len(OPEN) + 1, 2**31 - 1))
    turn = lambda p: F.struct(unescape_role(F.substring_index(p, "\n", 1)).alias("role"), unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"))
    lost = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", F.transform(parts, turn)).withColumn("loss_text", F.array_join(lost, ""))


def format_chats(events: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One shuffle: both foldings and the offsets keep the partitioning by conversation."""
    return render(messages(events.repartition("conv_id")), learn=learn)


def events_of(rows: DataFrame) -> DataFrame:
    """The event log of finished messages (conv_id, turn, role, text): one delta for each row, in turn order."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("turn"))
    return numbered.select("conv_id", "turn", F.col("turn").alias("seq"), F.lit("delta").alias("kind"), "role", "text")
