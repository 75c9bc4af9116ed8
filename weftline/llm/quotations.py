"""Quotation linking: conversations in reply order, without quoted text.

A line's quote level is the number of ``>`` marks before it.  Every quoted line is
normalised (blanks collapsed, lower-cased), hashed and looked up among the lines that
messages wrote themselves.  In the same conversation the latest earlier
message with the line is its source; failing that, the first message anywhere that has it.  A
message replies to the source of most of its lines at its lowest quote level; ties go to
the later message.

The look-up of the latest earlier line is a running maximum over (conversation,
hash), scanned in chunks, so a line that everyone quotes is not gathered in one task
and never meets its copies pair by pair.  Replies are put in order by
walking the reply tree: the tour of down and up steps is a linked list whose suffix sums
come from pointer doubling, so the depth of a thread costs its logarithm in joins.

Defined cases: null texts have no lines; an attribution (``On ... wrote:``) right before a quote
belongs to it; empty lines are neither quoted nor linked; equal (conversation,
turn) rows count once, with the smallest text; rows without conversation or turn come
back without links or position; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.scan import prefix_scan
from weftline.session import cut

# Quote marks, and lines that introduce a quote.
MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"^(?:On|Am|Le|El) .*(?:wrote|schrieb|a écrit|escribió).*:[ \t]*$"
CHUNK_TURNS = 4096


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def own_text(text: Column) -> Column:
    """The text without quoted lines and their attributions."""
    lines = _lines(text)
    def own(line: Column, i: Column) -> Column:
        after = F.coalesce(F.get(lines, i + 1), F.lit(""))
        return ~line.rlike(MARKS) & ~(line.rlike(ATTRIBUTION) & after.rlike(MARKS))
    return F.trim(F.array_join(F.filter(lines, own), "\n"), F.lit(" \t\r\n"))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def hashed_lines(messages: DataFrame) -> DataFrame:
    """``conv, turn, level, h1, h2`` of every line with text; level 0 is own text."""
    rows = (messages.select("conv", "turn", F.posexplode(_lines(F.col("text"))).alias("at", "line"), F.col("text"))
            .withColumn("marks", F.regexp_extract("line", MARKS, 0))
            .withColumn("level", F.length(F.regexp_replace("marks", "[^>]", "")))
            .withColumn("after", F.coalesce(F.get(_lines(F.col("text")), F.col("at") + 1), F.lit("")))
            .where(~((F.col("level") == 0) & F.col("line").rlike(ATTRIBUTION) & F.col("after").rlike(MARKS)))
            .withColumn("norm", normalised(F.expr("substring(line, length(marks) + 1)"))).where("norm <> ''"))
    return rows.select("conv", "turn", "level", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(3), "norm").alias("h2"))


def quote_links(messages: DataFrame) -> DataFrame:
    """``conv, turn, level, lines, source_conv, source_turn``: quoted lines per source message."""
    hashed = cut(hashed_lines(messages))
    keys = ["conv", "h1", "h2"]
    own = hashed.where("level = 0").select(*keys, "turn").distinct()
    quoted = hashed.where("level > 0").groupBy(*keys, "turn", "level").agg(F.count(F.lit(1)).alias("lines"))
    asked = quoted.select(*keys, "turn").distinct()
    both = (own.select(*keys, (F.col("turn") * 2 + 1).alias("step"), F.col("turn").alias("said"))
            .unionByName(asked.select(*keys, (F.col("turn") * 2).alias("step"), F.lit(None).cast("bigint").alias("said"))))
    seen = prefix_scan(both, keys, "step", F.floor(F.col("step") / CHUNK_TURNS), F.col("said"), "max", "source_turn")
    inside = seen.where("step % 2 = 0").select(*keys, F.expr("step div 2").alias("turn"), "source_turn")
    linked = cut(quoted.join(inside, [*keys, "turn"]))
    anywhere = own.groupBy("h1", "h2").agg(F.min(F.struct("conv", "turn")).alias("first"))
    far = (linked.where("source_turn IS NULL").drop("source_turn").join(anywhere, ["h1", "h2"], "left")
           .select("conv", "turn", "level", "lines", F.col("first.conv").alias("source_conv"), F.col("first.turn").alias("source_turn")))
    near = linked.where("source_turn IS NOT NULL").select(
        "conv", "turn", "level", "lines", F.col("conv").alias("source_conv"), "source_turn")
    return near.unionByName(far).groupBy("conv", "turn", "level", "source_conv", "source_turn").agg(F.sum("lines").alias("lines"))


def replies(links: DataFrame) -> DataFrame:
    """``conv, turn, reply_to``: the earlier message of the conversation that is answered."""
    near = links.where(F.col("source_conv").eqNullSafe(F.col("conv")) & (F.col("source_turn") < F.col("turn")))
    best = F.max(F.struct((-F.col("level")).alias("level"), "lines", "source_turn"))
    return near.groupBy("conv", "turn").agg(best.alias("best")).select("conv", "turn", F.col("best.source_turn").alias("reply_to"))


def reply_order(nodes: DataFrame) -> DataFrame:
    """``conv, turn, position, depth`` from ``conv, turn, reply_to``; replies follow what they answer.

    Messages without ``reply_to`` start threads, in the order of their turns.
    """
    nodes = cut(nodes)
    top = F.coalesce("reply_to", F.lit(None).cast("bigint"))
    placed = nodes.withColumn("parent", F.coalesce(top, F.lit(-(1 << 62))))
    # The next sibling is the smallest later turn under the same parent.
    sibling = prefix_scan(placed, ["conv", "parent"], "turn", F.floor(F.col("turn") / CHUNK_TURNS), F.col("turn"), "min",
                          "sibling", inclusive=False, descending=True)
    child = nodes.where("reply_to IS NOT NULL").groupBy("conv", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    full = cut(sibling.join(child, ["conv", "turn"], "left"))
    # Steps of the tour: down into a message is 2 turn, up out of it 2 turn + 1.
    down = full.select("conv", (F.col("turn") * 2).alias("step"), F.coalesce(F.col("child") * 2, F.col("turn") * 2 + 1).alias("next"),
                       F.lit(1).cast("bigint").alias("ahead"), F.lit(1).cast("bigint").alias("rise"))
    up = full.select("conv", (F.col("turn") * 2 + 1).alias("step"), F.coalesce(F.col("sibling") * 2, F.col("reply_to") * 2 + 1).alias("next"),
                     F.lit(0).cast("bigint").alias("ahead"), F.lit(-1).cast("bigint").alias("rise"))
    active, finished = cut(down.unionByName(up)), []
    while True:
        # Steps that have reached the end of the tour are joined no more; short threads end soon.
        finished.append(active.where("next IS NULL"))
        going = active.where("next IS NOT NULL")
        if going.isEmpty():
            break
        known = reduce(DataFrame.unionByName, finished, going)
        beyond = known.select("conv", F.col("step").alias("next"), F.col("next").alias("then"), F.col("ahead").alias("more"),
                              F.col("rise").alias("more_rise"))
        active = cut(going.join(beyond, ["conv", "next"]).select(
            "conv", "step", F.col("then").alias("next"), (F.col("ahead") + F.col("more")).alias("ahead"),
            (F.col("rise") + F.col("more_rise")).alias("rise")))
    walk = reduce(DataFrame.unionByName, finished)
    sizes = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    return walk.where("step % 2 = 0").join(sizes, "conv").select(
        "conv", F.expr("step div 2").alias("turn"), (F.col("n") - F.col("ahead")).alias("position"), (-F.col("rise")).alias("depth"))


def link_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """Every message with its links and place, and its own text.

    ``conv, turn, body, quote_levels, n_quoted, n_linked, reply_to, position, depth``.
    """
    rows = messages.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(text).alias("text"))
    whole = cut(rows.where("conv IS NOT NULL AND turn IS NOT NULL").groupBy("conv", "turn").agg(F.min("text").alias("text")))
    links = cut(quote_links(whole))
    counts = links.groupBy("conv", "turn").agg(
        F.max("level").cast("int").alias("quote_levels"), F.sum("lines").cast("bigint").alias("n_quoted"),
        F.coalesce(F.sum(F.when(F.col("source_turn").isNotNull(), F.col("lines"))), F.lit(0)).cast("bigint").alias("n_linked"))
    nodes = cut(whole.select("conv", "turn").join(replies(links), ["conv", "turn"], "left"))
    placed = (whole.select("conv", "turn", own_text(F.col("text")).alias("body"))
              .join(counts, ["conv", "turn"], "left").join(nodes, ["conv", "turn"]).join(reply_order(nodes), ["conv", "turn"]))
    out = ["conv", "turn", "body", F.coalesce("quote_levels", F.lit(0)).alias("quote_levels"),
           F.coalesce("n_quoted", F.lit(0).cast("bigint")).alias("n_quoted"),
           F.coalesce("n_linked", F.lit(0).cast("bigint")).alias("n_linked"), "reply_to", "position", "depth"]
    loose = rows.where("conv IS NULL OR turn IS NULL").select(
        "conv", "turn", own_text(F.col("text")).alias("body"), F.lit(0).alias("quote_levels"),
        F.lit(0).cast("bigint").alias("n_quoted"), F.lit(0).cast("bigint").alias("n_linked"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("reply_to", "position", "depth")])
    return placed.select(*out).unionByName(loose)
