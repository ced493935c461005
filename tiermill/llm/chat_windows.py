r"""Chat formatting in budgeted windows, with column functions only.

Each turn becomes ``<s>role[INST]text</s>``. A control string (``<s> </s> [INST] [/INST]``) inside a role or text gets a
backslash behind its first character, and one that has backslashes there gets one more; taking one away restores
the text, so nothing is ever ambiguous or lost.

A prefix sum over the turns of a conversation (tokens of a turn: its words and four for the markup) places every turn.
The budget, less the system turn and the history, is the length of a cell; turns that lie in one cell form a span,
a turn that crosses the end of its cell is a span of its own. So a span is never longer than a cell, unless it is a
single turn that is. A window is the system turn (if the first turn is one), then the last turns of the span before,
up to ``history`` tokens, then the span. The loss mask covers the texts of assistant turns of the span: targets that
are repeated as history are not learned again.

Prefix sums are taken within blocks of turn numbers and then over the blocks, so that a very long conversation is
dealt over many tasks. Turns are ordered by number, role and text (NULL first); repeated rows are turns of their own.
NULL texts and roles are empty, rows without a conversation number form one conversation. Other columns
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
MARKUP_TOKENS = 4
BLOCK = 4096

_CONTROL = r"([<\[])(\\*/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+")).cast("long") + MARKUP_TOKENS


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _placed(df: DataFrame) -> DataFrame:
    """Turns with their tokens and the tokens of the conversation up to them."""
    turns = df.select(
        F.col("conv_id").alias("conv"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumns(
        {"tokens": token_count(F.col("text")), "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60)))}
    )
    order = [F.asc_nulls_first("turn"), "role", "text"]
    within = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumns({"inside": F.sum("tokens").over(within), "at": F.row_number().over(Window.partitionBy("conv", "block").orderBy(*order))})
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv", "block").agg(F.sum("tokens").alias("sum"))
    blocks = blocks.select(
        F.col("conv").alias("b_conv"), F.col("block").alias("b_block"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before")
    )
    joined = turns.join(blocks, _same(F.col("conv"), F.col("b_conv")) & (F.col("block") == F.col("b_block")))
    end = F.col("before") + F.col("inside")
    return joined.select("conv", "role", "text", "tokens", (end - F.col("tokens")).alias("start"), end.alias("end"))


def format_windows(df: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id``, ``span`` (ascending in the conversation), ``formatted``, ``repeated`` (leading turns that are
    system turn or history), ``tokens`` and ``loss``, the ranges of code points that are learned."""
    turns = _placed(df).withColumn("piece", F.concat(F.lit("<s>"), escape(F.col("role")), F.lit("[INST]"), escape(F.col("text")), F.lit("</s>")))
    system = turns.filter((F.col("start") == 0) & (F.col("role") == "system")).select(
        F.col("conv").alias("s_conv"), F.col("piece").alias("s_piece"), F.col("tokens").alias("s_tokens")
    )
    turns = turns.join(system, _same(F.col("conv"), F.col("s_conv")), "left").drop("s_conv")
    cell = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce("s_tokens", F.lit(0)))
    number = F.expr("start div cell")
    turns = turns.withColumn("cell", cell.cast("long")).withColumn("number", number)
    crosses = F.expr("(end - 1) div cell") > F.col("number")
    turns = turns.withColumn("span", 2 * F.col("number") + crosses.cast("long")).drop("cell", "number")

    spans = turns.groupBy("conv", "span").agg(F.min("start").alias("from"), F.max("end").alias("until"))
    follows = spans.alias("a").join(
        spans.alias("b"), _same(F.col("a.conv"), F.col("b.conv")) & (F.col("a.until") == F.col("b.from"))
    )
    follows = follows.select(F.col("a.conv").alias("f_conv"), F.col("a.span").alias("f_span"), F.col("b.span").alias("next"), F.col("a.until").alias("until"))
    late = turns.join(follows, _same(F.col("conv"), F.col("f_conv")) & (F.col("span") == F.col("f_span")))
    first_system = (F.col("start") == 0) & (F.col("role") == "system")
    late = late.filter((F.col("until") - F.col("start") <= history) & ~first_system)
    shown = turns.withColumn("new", F.lit(True)).unionByName(
        late.withColumn("span", F.col("next")).select(*turns.columns).withColumn("new", F.lit(False))
    )
    has_system = F.col("s_piece").isNotNull() & ~F.exists("turns", lambda t: t["start"] == 0)
    grouped = shown.groupBy("conv", "span").agg(
        F.array_sort(F.collect_list(F.struct("start", "piece", "new", "role", "tokens"))).alias("turns"),
        F.first("s_piece").alias("s_piece"),
        F.first("s_tokens").alias("s_tokens"),
    )
    lead = F.struct(F.lit(-1).cast("long").alias("start"), F.col("s_piece").alias("piece"), F.lit(False).alias("new"), F.lit("system").alias("role"), F.col("s_tokens").alias("tokens"))
    grouped = grouped.withColumn("turns", F.when(has_system, F.concat(F.array(lead), F.col("turns"))).otherwise(F.col("turns")))

    def mask(done: Column, turn: Column) -> Column:
        size = F.char_length(turn["piece"])
        from_text = done["at"] + F.length(F.lit("<s>[INST]")) + F.char_length(escape(turn["role"]))
        text_end = done["at"] + size - F.length(F.lit("</s>"))
        learned = turn["new"] & (turn["role"] == "assistant")
        span = F.struct(from_text.cast("int").alias("from"), text_end.cast("int").alias("until"))
        return F.struct((done["at"] + size).cast("int").alias("at"), F.when(learned, F.concat(done["loss"], F.array(span))).otherwise(done["loss"]).alias("loss"))

    nothing = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<from:int,until:int>>)").alias("loss"))
    return grouped.select(
        F.col("conv").alias("conv_id"),
        "span",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
        F.aggregate("turns", nothing, mask)["loss"].alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Turns and learned texts of each window, read back from ``formatted``: ``turns`` (role, text) without repeated ones."""
    pieces = F.slice(F.split("formatted", "</s>"), F.col("repeated") + 1, F.size(F.split("formatted", "</s>")) - 1 - F.col("repeated"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "[INST]", 1)
        text = F.substring(piece, F.char_length(role) + F.length(F.lit("[INST]")) + 1, F.char_length(piece))
        return F.struct(unescape(F.substring(role, F.lit(4), F.char_length(role))).alias("role"), unescape(text).alias("text"))

    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["from"] + 1, s["until"] - s["from"])))
    return windows.select("conv_id", "span", "formatted", F.transform(pieces, turn).alias("turns"), learned.alias("learned"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold, read back from them."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read_windows(windows).select(
        "conv_id",
        F.size("turns").alias("n"),
        F.char_length("formatted").alias("chars"),
        F.struct("span", said.alias("said"), F.array_join("learned", "").alias("learned")).alias("part"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    learned = F.array_join(F.transform("parts", lambda p: p["learned"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
