"""Chat formatting with prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are its context, and only its own text is
trainable. A turn is written as ``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts are broken by
a backslash behind their first character, and backslashes are doubled, so nothing in a text can be taken for the
template and everything can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    """Reversible, and free of control strings."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(<)(/?s>)|(\[)(/?INST\])", r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """``conv_id, example, n_turns, complete, formatted, loss_start, loss_length`` (code points of ``formatted``).

    Turns go in the order of ``turn``, then role, then text; null roles and texts count as empty, null turns come
    first, rows with a null ``conv_id`` form a conversation, repeated rows are turns of their own. A conversation that
    doesn't end with the target role also gives one example of all its turns with nothing trainable
    (``loss_length`` null); ``complete`` marks the one example of a conversation that holds all its turns. An example
    holds its whole context, so a conversation must fit into a row. No rows give no examples.
    """
    empty = F.lit("")
    role = F.coalesce(F.col("role"), empty)
    text = F.coalesce(F.col("text"), empty)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    body = escape(F.col("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_target = F.col("role") == target_role
    marked = rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(head, body, F.lit(CLOSE)).alias("_turn"),
        F.char_length(body).cast("long").alias("_body"),
        is_target.alias("_target"),
    )
    grown = marked.select(
        "conv_id",
        "_target",
        "_body",
        F.row_number().over(in_order).cast("long").alias("n_turns"),
        F.lead(F.lit(1)).over(in_order).isNull().alias("_last"),
        F.sum(F.col("_target").cast("long")).over(so_far).alias("_targets"),
        F.concat_ws("", F.collect_list("_turn").over(so_far)).alias("formatted"),
    ).filter("_target OR _last")
    length = F.char_length("formatted").cast("long")
    return grown.select(
        "conv_id",
        F.when(F.col("_target"), F.col("_targets") - 1).otherwise(F.col("_targets")).alias("example"),
        "n_turns",
        F.col("_last").alias("complete"),
        "formatted",
        F.when(F.col("_target"), length - F.col("_body") - len(CLOSE)).alias("loss_start"),
        F.when(F.col("_target"), F.col("_body")).alias("loss_length"),
    )


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The trainable text of an example, unescaped; empty where there is none."""
    masked = F.substring(formatted, (start + 1).cast("int"), length.cast("int"))
    return F.coalesce(unescape(masked), F.lit(""))


def parse_turns(formatted: Column) -> Column:
    """An array of structs ``role, text`` from a formatted example."""
    turns = F.split(F.substring(formatted, len(OPEN) + 1, 2**31 - 1), r"<s>\[INST\]")

    def read(turn: Column) -> Column:
        head = F.substring_index(turn, MIDDLE, 1)
        start = F.char_length(head) + len(MIDDLE) + 1
        body = F.substring(turn, start, F.char_length(turn) - start + 1 - len(CLOSE))
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, read)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from its examples: its turns and what is trained on.

    Each example is reduced to its own trainable text before the examples of a conversation come together; the turns
    are read from the complete example.
    """
    line_feed = F.lit("\n")
    told = F.concat_ws("", F.transform(parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], line_feed, t["text"], line_feed)))
    small = formatted.select(
        "conv_id",
        "n_turns",
        "example",
        loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("_loss"),
        F.char_length("formatted").cast("long").alias("_chars"),
        F.when(F.col("complete"), F.sha2(F.encode(told, "UTF-8"), 256)).alias("_turns"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("example", "_loss")))
    merged = small.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("_turns").alias("turns_sha256"),
        F.concat_ws("", F.transform(in_order, lambda e: e["_loss"])).alias("_loss"),
        F.sum("_chars").alias("formatted_chars"),
    )
    return merged.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
