"""Chat formatting from event logs, with DataFrame functions only.

A log holds one row an event: ``open`` (a message of a role begins; its text is a first delta), ``delta`` (streamed text that is
appended), ``edit`` (the message's text is replaced) and ``regenerate`` (the message starts again, empty). Edits and regenerations
also discard every later turn, as chat programs do. One pass over each conversation in sequence order decides which events still
count: an event of turn t does if no later edit or regeneration has a turn of t or less. What is left is folded by message with
ordinary aggregates and rendered. A conversation's text is one value of the result, so its messages do meet in one
row in the end; until then work is spread by message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Breaks up every ``<|``: a backslash goes before the bar, one more where some are there already. Reversible."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, parts) of the messages that are left when ``events`` (conv_id, seq, turn, kind, role, text) are
    replayed. Events of one seq are taken by turn, kind, role and text. A message has the role of its last opening, and '' without
    one. Null text is empty. Rows repeated in full are replayed as often as they occur. Unknown kinds are an error."""
    kinds = "kind in ('open', 'delta', 'edit', 'regenerate')"
    reset = F.col("kind").isin("edit", "regenerate")
    order = [F.col("seq").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("kind"), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    clean = events.select("conv_id", "seq", "turn", F.when(F.expr(kinds), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null"))))).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    by = Window.partitionBy("conv_id").orderBy(*order)
    # Later events, as a running frame of the reversed order: linear, where a frame to the end is computed anew for every row.
    later = Window.partitionBy("conv_id").orderBy(F.col("__n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    played = clean.withColumn("__n", F.row_number().over(by)).withColumn("__cut", F.min(F.when(reset, F.col("turn"))).over(later))
    counts = F.col("__cut").isNull() | (F.col("__cut") > F.col("turn")) | F.col("turn").isNull()
    opened = (F.col("kind") == "open") & F.col("role").isNotNull()
    one = played.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(opened, F.col("__n"))).alias("role"), F.max(counts).alias("left"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(counts, F.struct("__n", "text")))), lambda e: e["text"]), "").alias("text"))
    one = one.where("left")
    return one.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "text")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line break, which would end the role, becomes ``\\n``, and a backslash two."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def render(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss): each conversation as one string, ``<|im_start|>role\\ntext<|im_end|>\\n`` a message in turn order, control
    strings inside roles and texts escaped; ``loss`` lists the stretches (start, length; code points from 0) that a model learns
    from: the texts of the roles ``learn``."""
    said = turns.select("conv_id", "turn", escape_role(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), F.col("role").isin(*learn).alias("learnt"))
    lead = F.concat(F.lit(START), F.col("head"), F.lit("\n"))
    piece = said.select("conv_id", F.struct(
        "turn", F.concat(lead, "body", F.lit(END + "\n")).alias("text"), F.length(lead).alias("skip"), F.length("body").alias("size"), "learnt").alias("m"))
    whole = piece.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    at = F.aggregate("ms", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
                     lambda a, m: F.struct((a["at"] + F.length(m["text"])).alias("at"), F.when(m["learnt"], F.array_append(a["spans"], F.struct(
                         (a["at"] + m["skip"]).alias("start"), m["size"].cast("long").alias("length")))).otherwise(a["spans"]).alias("spans")))
    return whole.select("conv_id", F.array_join(F.transform("ms", lambda m: m["text"]), "").alias("formatted"), at["spans"].alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text), unescaped, of a rendered conversation."""
    parts = F.split(formatted, r"<\|im_start\|>")
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    body = lambda p: F.substring_index(p, END, 1)
    head = lambda p: F.substring_index(body(p), "\n", 1)
    return F.transform(parts, lambda p: F.struct(
        unescape_role(head(p)).alias("role"), unescape(F.substr(body(p), F.length(head(p)) + 2)).alias("text")))


def learnt_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def events_of(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The plain log of a table of turns, streamed in two deltas a message. Turns are numbered by turn, role and text within
    their conversation, so that repeated turn numbers stay apart."""
    number = F.row_number().over(Window.partitionBy(id).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first()))
    rows = turns.select(F.col(id).alias("conv_id"), number.alias("n"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    log = F.array(F.struct(F.lit(0).alias("s"), F.lit("open").alias("kind"), F.lit("").alias("text")),
                  F.struct(F.lit(1).alias("s"), F.lit("delta").alias("kind"), F.substr("text", F.lit(1), half).alias("text")),
                  F.struct(F.lit(2).alias("s"), F.lit("delta").alias("kind"), F.substr("text", half + 1).alias("text")))
    return rows.withColumn("e", F.explode(log)).select(
        "conv_id", (F.col("n") * 3 + F.col("e.s")).cast("long").alias("seq"), F.col("n").cast("long").alias("turn"), F.col("e.kind").alias("kind"),
        F.when(F.col("e.kind") == "open", F.col("role")).alias("role"), F.col("e.text").alias("text"))


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text) AS n FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '') AS loss,
  sum(length('<|im_start|>') + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g')) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS f
  FROM n GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars FROM g
"""
