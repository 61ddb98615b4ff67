"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: ``message`` (a new message), ``delta``
(streamed text appended to it), ``edit`` (replaces its text) and
``regenerate`` (starts its text anew).  The log is dealt out by conversation
once; both groupings below reuse that one shuffle.  Events of a message are
sorted by sequence and folded: the text is that of the last event that is not
a delta, followed by the deltas after it.  Messages are then sorted by the
sequence of their first event and rendered.

The template writes ``### Role: text</turn>`` and a line feed per turn.
Inside texts ``\\`` is doubled and the control strings ``###`` and ``</turn>``
are broken by one backslash, so no control string is left in a text and
``read_back`` restores it exactly.

Only DataFrame functions are used.  Defined results: NULL text is empty; a
NULL role is the empty role; NULL sequence sorts first, a NULL conversation
is one conversation; ties sort by event kind, role, text; repeated rows are
repeated turns; other columns are ignored; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import let, table

#: event kinds in the order in which ties of one sequence number are applied
KINDS = ("message", "regenerate", "edit", "delta")
BEGIN, END = "### ", "</turn>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, r"#(?=##)", r"#\\"), r"<(?=/turn>)", r"<\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def _after_last_reset(part: Column) -> Column:
    """Text of one message: its last event that is not a delta, and the deltas after it."""
    last = F.array_max(F.transform(part, lambda e, i: F.when(e["kind"] < 3, i + 1).otherwise(F.lit(1))))
    tail = let(last, lambda r: F.slice(part, r, F.size(part) - r + 1))
    return F.array_join(F.transform(tail, lambda e: e["text"]), "")


def fold_events(events: DataFrame, conv: str = "conv_id", seq: str = "seq", kind: str = "kind",
                message: str = "message_id", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, an array of
    (seq, role, text) of the final messages in order."""
    code = F.lit(0)
    for i, k in enumerate(KINDS):
        code = F.when(F.col(kind) == k, F.lit(i)).otherwise(code)
    ev = events.select(F.col(conv).alias("conv"), F.col(message).alias("msg"), F.col(seq).alias("seq"),
                       code.alias("kind"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    per_message = (ev.repartition("conv").groupBy("conv", "msg")
                   .agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("events")))

    def messages(e):
        # a message event starts a message; events before the first belong to it as well
        begins = F.filter(F.sequence(F.lit(1), F.size(e)), lambda i: (i == 1) | (e[i - 1]["kind"] == 0))
        return let(begins, lambda b: F.transform(b, lambda begin, k: let(
            F.slice(e, begin, F.coalesce(F.get(b, k + 1), F.size(e) + 1) - begin),
            lambda part: F.struct(part[0]["seq"].alias("seq"), part[0]["role"].alias("role"),
                                  _after_last_reset(part).alias("text")))))

    return (per_message.select("conv", F.explode(let(F.col("events"), messages)).alias("m"))
            .groupBy("conv").agg(F.sort_array(F.collect_list("m")).alias("turns"))
            .withColumnRenamed("conv", "conv_id"))


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and the conversation as one ``formatted`` string."""
    return conversations.select("conv_id", F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(BEGIN), escape_role(t["role"]), F.lit(": "), escape(t["text"]), F.lit(END))), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text, loss) of a formatted conversation, from the string alone.
    ``loss`` marks the turns whose text carries the training loss."""
    blocks = F.split(formatted, END, -1)
    turns = let(blocks, lambda b: F.slice(b, 1, F.size(b) - 1))

    def parse(block):
        head = F.regexp_extract(block, r"(?s)^### ((?:[^\\:]|\\.)*+): ", 1)
        return let(head, lambda h: F.struct(
            unescape(h).alias("role"),
            unescape(F.substring(block, F.length(h) + F.lit(len(BEGIN) + 3), F.length(block))).alias("text"),
            (h == "assistant").alias("loss")))

    return F.transform(turns, parse)


def digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, read back from the output."""
    turns = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
             F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The conversations table as a log: one message event per row."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"),
                                F.col("turn").alias("message_id"), "role", "text")


def query(spark, sf_dir):
    """op8: formats every conversation, and conversation -7 whose texts hold control strings."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(hard).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(render(fold_events(conversation_events(rows))))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
       + coalesce(list_sum(list_transform(regexp_extract_all(text, '###+'), lambda x: length(x) - 2)), 0)
       + len(regexp_extract_all(text, '</turn>')) + 4 + length(role) + 2 + 8 AS chars FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
