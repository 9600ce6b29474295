"""Chat formatting from event logs (operator 10); DataFrame functions only.

A log holds events of conversations: ``start`` (a message's role and first text), ``delta``
(text appended), ``edit`` (the text replaced) and ``regenerate`` (the text discarded; deltas
that follow build it anew). Events are partitioned by conversation and message and sorted
by sequence; a message's text is that of its last edit, regeneration or start and of the
deltas behind it.

Rendering marks each turn as ``<|im_start|>role`` line feed text ``<|im_end|>`` line feed.
Texts are escaped: backslashes are doubled and a backslash is put into every control
string behind its first character, so no control string of the template (or of the other
common templates) survives in a text, and the step can be undone. Roles are
percent-encoded. ``loss_mask`` lists, for each assistant text, the code points at which its
turn, the text and the text's end lie in the formatted string; offsets are running sums
over a conversation's turns.

Edge cases: null text is empty and null roles are the empty role; events without
conversation or message id are left out; deltas of a message without a start get the empty
role; events that tie in sequence are ordered by kind, then text; an empty log gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import table, written

TURN, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
# Strings that common chat templates treat as control strings.
CONTROL = [
    TURN, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text from events (conv_id, seq, event, message, role, text)."""
    log = events.where("conv_id IS NOT NULL AND message IS NOT NULL").select(
        "conv_id",
        "message",
        F.struct("seq", "event", F.coalesce("text", F.lit("")).alias("text"), "role").alias("e"),
    )
    grouped = log.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("e")).alias("log"))
    last = "coalesce(array_max(transform(log, (e, i) -> IF(e.event IN ('start', 'edit', 'regenerate'), i, NULL))), 0)"
    return grouped.withColumn("at", F.expr(last)).selectExpr(
        "conv_id",
        "message",
        "coalesce(try_element_at(filter(log, e -> e.event = 'start'), -1).role, '') AS role",
        "array_join(transform(filter(slice(log, at + 1, size(log)), e -> e.event <> 'regenerate'), e -> e.text), '') AS text",
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask from messages (conv_id, message, role, text)."""
    turns = (
        messages.withColumn("head", F.concat(F.lit(TURN), F.url_encode("role"), F.lit("\n")))
        .withColumn("body", escape(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("turn", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    text = F.col("turn") + F.length("head")
    mask = F.when(
        F.col("role") == LOSS_ROLE,
        F.struct("turn", text.alias("start"), (text + F.length("body")).alias("end")),
    )
    grouped = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("message", "piece", mask.alias("mask")))).alias("turns")
    )
    return grouped.selectExpr(
        "conv_id",
        "array_join(transform(turns, t -> t.piece), '') AS formatted",
        "filter(transform(turns, t -> t.mask), m -> m IS NOT NULL) AS loss_mask",
    )


def parse(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and the texts under the loss mask, from the formatted strings alone."""
    pieces = F.split("formatted", "\\Q" + END + "\n\\E")
    rows = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))

    def turn(p: Column) -> Column:
        inner = F.substr(p, F.lit(len(TURN) + 1))
        name = F.substring_index(inner, "\n", 1)
        text = F.substr(inner, F.length(name) + 2)
        return F.struct(F.url_decode(name).alias("role"), unescape(text).alias("text"), p.alias("piece"))

    rows = rows.withColumn("turns", F.transform("pieces", turn))
    spoken = F.filter("turns", lambda t: t["role"] == LOSS_ROLE)
    under = F.zip_with(
        spoken,
        "loss_mask",
        lambda t, m: unescape(F.substr(t["piece"], (m["start"] - m["turn"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))),
    )
    return rows.select("conv_id", "turns", under.alias("loss_texts"), "formatted")


def format_conversations(events: DataFrame) -> DataFrame:
    """Fold and render a log."""
    return render(fold(events))


def log_of(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log: a message a row (rows that repeat a turn: by role, then text)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order))
    # the role opens a message, its text follows as a delta
    return rows.select(
        "conv_id",
        "message",
        F.explode(
            F.array(
                F.struct((2 * F.col("message")).alias("seq"), F.lit("start").alias("event"), "role", F.lit("").alias("text")),
                F.struct((2 * F.col("message") + 1).alias("seq"), F.lit("delta").alias("event"), F.lit("").alias("role"), "text"),
            )
        ).alias("e"),
    ).select("conv_id", "message", "e.*")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that quotes control strings; digests are read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quote = "</s>[INST] ok [/INST]"
    probe = spark.sql(
        f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{quote}' AS text "
        f"UNION ALL SELECT -1L, 1L, 'assistant', '{quote}'"
    )
    formatted = written(format_conversations(log_of(rows.unionByName(probe))), "chats")
    back = parse(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: Digests of the turns as given; the formatted length follows from the template.
def _sql_escape(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP10_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = '{LOSS_ROLE}' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         sum({len(TURN) + len(END) + 2} + length(url_encode(role)) + length({_sql_escape("text")})) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""
