"""Chat formatting into budgeted training windows, in DataFrame expressions only.

Turns are rendered with a template, and prefix sums of their token counts choose turn-aligned spans: with a room of R
tokens, a turn whose start lies in bucket b = floor(prefix / R) belongs to span b; if the turns of a bucket exceed R
together, the last one (the only one that can cross the bucket's end) becomes a span of its own. So no span of several
turns exceeds R, and spans need no sequential pass over a conversation: a long one is dealt out by its buckets. A window
is the conversation's leading system turn, then history (the latest whole turns before the span, up to H tokens), then
the span. The loss mask covers the assistant texts of the span only, so a text repeated as history is never a target
twice. A single turn larger than the room is a window of its own that exceeds the budget (``over_budget``); nothing is cut.

Template: ``<<SYS>> text <</SYS>>\\n`` (system), ``[INST] text [/INST]\\n`` (user), ``<s> text </s>\\n`` (assistant) and
``[ROLE] role [/ROLE] text </s>\\n`` (any other role; null counts as ''). Inside texts and roles a backslash is put before
every run of backslashes that is followed by a control string, which no marker of the template has before it; taking one
such backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTROL = r"(?:</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\])"
#: From the first backslash of a run only, and without giving any back, so that a run is read once.
ESCAPE, UNESCAPE = rf"(?<!\\)(\\*+{CONTROL})", rf"(?<!\\)\\(\\*+{CONTROL})"
#: A turn of formatted text; a control string after a backslash is text.
TURN = rf"(?s)(?:<<SYS>> .*?(?<!\\)<</SYS>>|\[INST\] .*?(?<!\\)\[/INST\]|<s> .*?(?<!\\)</s>|\[ROLE\] .*?(?<!\\)\[/ROLE\] .*?(?<!\\)</s>)\n"
#: Tokens of a window, tokens of repeated history, tokens that a turn's markers count as.
BUDGET, HISTORY, OVERHEAD = 512, 96, 4
#: Turns are summed in blocks of so many turn numbers first, then the blocks: no task sums a whole long conversation.
BLOCK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1")


def render(role: Column, text: Column) -> Column:
    e = escape(text)
    return (F.when(role == "system", F.concat(F.lit("<<SYS>> "), e, F.lit(" <</SYS>>\n")))
            .when(role == "user", F.concat(F.lit("[INST] "), e, F.lit(" [/INST]\n")))
            .when(role == "assistant", F.concat(F.lit("<s> "), e, F.lit(" </s>\n")))
            .otherwise(F.concat(F.lit("[ROLE] "), escape(role), F.lit(" [/ROLE] "), e, F.lit(" </s>\n"))))


def count_tokens(text: Column) -> Column:
    """The default size of a text: its words and its other signs."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text", tokens=count_tokens) -> DataFrame:
    """(conv, window, formatted, n_context, n_turns, loss, n_tokens, over_budget): the windows of all conversations.

    ``window`` (bigint) orders a conversation's windows; ``n_context`` of its leading turns are repeated (system turn,
    history), the ``n_turns`` after them are the span's. ``loss`` is the mask: array<struct<start, end>> of code points
    of ``formatted``. Turns go by ``turn`` (nulls first), equal numbers by role, then text; repeated rows are repeated
    turns. Null text and null role count as empty. Rows of a null conversation form one conversation. Other columns are
    not read. An empty table gives an empty table.
    """
    t = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("size", tokens(F.col("text")) + OVERHEAD).withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    # prefix sums: within blocks, and of the blocks before
    in_block = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("p", F.coalesce(F.sum("size").over(in_block), F.lit(0))).withColumn(
        "o", F.count("*").over(in_block))
    blocks = t.groupBy("conv", "block").agg(F.sum("size").alias("sum"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("p0"),
                           F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("o0"))
    t = t.alias("t").join(blocks.alias("b"), F.expr("t.conv <=> b.conv AND t.block = b.block")).select(
        "t.conv", "role", "text", "size", (F.col("p") + F.col("p0")).alias("p"), (F.col("o") + F.col("o0")).alias("o"))
    system = t.where("o = 0 AND role = 'system'").select(
        F.col("conv").alias("s_conv"), render(F.col("role"), F.col("text")).alias("system"), F.col("size").alias("s_size"))
    t = t.alias("t").join(system, F.expr("t.conv <=> s_conv"), "left").select("t.*", "system", "s_size")
    room = F.greatest(F.lit(budget - history) - F.coalesce("s_size", F.lit(0)), F.lit(history), F.lit(1)).cast("long")
    # the system turn itself is context of every window, not part of a span, unless it is all there is
    head = F.expr("o = 0 AND role = 'system'")
    t = t.withColumn("room", room).withColumn("bucket", F.floor(F.col("p") / F.col("room")).cast("long")).withColumn("head", head)
    body = t.where("NOT head")
    parts = body.groupBy("conv", "bucket").agg(
        F.sum("size").alias("sum"), F.min("p").alias("first"), F.max("p").alias("last"), F.first("room").alias("room"), F.count("*").alias("rows"))
    parts = parts.withColumn("alone", F.expr("sum > room AND rows > 1"))  # the last turn goes alone
    following = F.lead(F.struct("bucket", "first", "last", "alone")).over(Window.partitionBy("conv").orderBy("bucket"))
    parts = parts.select(F.col("conv").alias("p_conv"), F.col("bucket").alias("p_bucket"), "alone", "last", following.alias("after"))
    body = body.alias("t").join(parts, F.expr("t.conv <=> p_conv AND t.bucket = p_bucket"))
    mine = F.expr("2 * bucket + IF(alone AND p = last, 1, 0)")
    # a turn is also history of a later span that starts within `history` tokens; rooms are at least as large, so
    # that only the own bucket's last turn and the next bucket's two spans can be such
    near = lambda start: F.expr(f"{start} > p AND {start} - p <= {history}")
    member = F.filter(F.array(
        F.struct(mine.alias("w"), F.lit(True).alias("own")),
        F.when(F.expr("alone") & near("last"), F.struct(F.expr("2 * bucket + 1").alias("w"), F.lit(False).alias("own"))),
        F.when(near("after.first"), F.struct(F.expr("2 * after.bucket").alias("w"), F.lit(False).alias("own"))),
        F.when(F.expr("after.alone") & near("after.last"), F.struct(F.expr("2 * after.bucket + 1").alias("w"), F.lit(False).alias("own"))),
    ), lambda m: m.isNotNull())
    body = body.select("conv", "role", "size", "o", render(F.col("role"), F.col("text")).alias("turn"), "system", "s_size",
                       F.explode(member).alias("m")).select("*", "m.w", "m.own")
    # a conversation that has nothing but its system turn still gets a window
    only = t.where("head").alias("t").join(body.select("conv").distinct().alias("b"), F.expr("t.conv <=> b.conv"), "left_anti").select(
        "conv", "role", "size", "o", F.col("system").alias("turn"), F.lit(None).cast("string").alias("system"),
        F.lit(None).cast("long").alias("s_size"), F.lit(0).cast("long").alias("w"), F.lit(True).alias("own"))
    columns = ["conv", "role", "size", "o", "turn", "system", "s_size", "w", "own"]
    rows = body.select(*columns).unionByName(only)
    made = rows.groupBy("conv", "w").agg(
        F.array_sort(F.collect_list(F.struct("o", "own", "role", "turn"))).alias("turns"), F.first("system").alias("system"),
        (F.sum("size") + F.coalesce(F.first("s_size"), F.lit(0))).alias("n_tokens"))
    made = made.withColumn("system", F.coalesce("system", F.lit("")))
    # the mask: assistant texts of the span, between "<s> " and " </s>\n"
    mask = F.expr("""
        aggregate(turns, struct(char_length(system) AS at, CAST(array() AS array<struct<start:int,end:int>>) AS spans),
            (a, t) -> struct(a.at + char_length(t.turn) AS at,
                IF(t.own AND t.role = 'assistant',
                   concat(a.spans, array(struct(a.at + 4 AS start, a.at + char_length(t.turn) - 6 AS end))), a.spans) AS spans),
            a -> a.spans)""")
    # the system turn is new in the conversation's first window, whose span starts with the turn after it
    made = made.withColumn("leads", F.expr("system <> '' AND turns[0].o = 1 AND turns[0].own"))
    return made.select(
        F.col("conv").alias(conv_col), F.col("w").alias("window"),
        F.concat("system", F.array_join(F.transform("turns", lambda x: x["turn"]), "")).alias("formatted"),
        F.expr("size(filter(turns, t -> NOT t.own)) + IF(system = '' OR leads, 0, 1)").alias("n_context"),
        F.expr("size(filter(turns, t -> t.own)) + IF(leads, 1, 0)").alias("n_turns"), mask.alias("loss"), "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted window, unescaped."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), lambda x: F.when(
        x.startswith("<<SYS>> "), F.struct(F.lit("system").alias("role"), unescape(_inner(x, 8, 10)).alias("text"))).when(
        x.startswith("[INST] "), F.struct(F.lit("user").alias("role"), unescape(_inner(x, 7, 9)).alias("text"))).when(
        x.startswith("<s> "), F.struct(F.lit("assistant").alias("role"), unescape(_inner(x, 4, 6)).alias("text"))).otherwise(
        F.struct(unescape(F.regexp_extract(x, r"(?s)^\[ROLE\] (.*?) (?<!\\)\[/ROLE\] ", 1)).alias("role"), unescape(
            F.regexp_extract(x, r"(?s)^\[ROLE\] .*? (?<!\\)\[/ROLE\] (.*) </s>\n$", 1)).alias("text"))))


def _inner(x: Column, head: int, tail: int) -> Column:
    return F.substring(x, F.lit(head + 1), F.char_length(x) - (head + tail))


def turns_of(made: DataFrame) -> DataFrame:
    """(window columns..., turns, targets): the span's own turns read back from ``formatted``, and the unescaped texts that
    the mask covers."""
    d = made.withColumn("turns", F.slice(read_back(F.col("formatted")), F.col("n_context") + 1, F.col("n_turns")))
    return d.withColumn(
        "targets", F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))))
