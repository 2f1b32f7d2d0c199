"""Chat formatting after collapsing cumulative snapshots.

A chat that is logged after every turn leaves conversations that are prefixes of longer ones. Each turn
has a 128-bit hash of its place, role and text; the exclusive-or of a conversation's first hashes is the
rolling hash of that prefix. A conversation whose whole hash is the hash of a proper prefix of another
one goes (an anti-join on distinct prefixes); of equal conversations the one with the smallest id stays.
What is left is rendered.

Only hashes are numbered and joined; texts move once, to be rendered, and those of turns that share their
number with others are sorted too. Turns get their places from one sort over all conversations. Rolling hashes
are computed in blocks of places and carried over blocks, and a long conversation is rendered in parts, so it is
no single task's work, whatever its turn numbers are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import column, freeze

#: Turn numbers of a range, places of a block, and most turns of a part.
RANGE = 256
#: Fixed values of the chat markup: how a turn begins and ends.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def _turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv (a key that is never missing), conv_id, turn, range, role and text."""
    turn = F.coalesce(column(turn_col).try_cast("bigint"), F.lit(-1))
    return turns.select(
        F.coalesce(F.concat(F.lit("c"), column(conv_col).cast("string")), F.lit("n")).alias("conv"),
        column(conv_col).alias("conv_id"),
        turn.alias("turn"),
        F.floor(turn / RANGE).cast("bigint").alias("range"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )


def _hashes() -> list[Column]:
    """The two halves of a turn's hash."""
    return [F.xxhash64(F.lit(1), "role", "text").alias("h"), F.xxhash64(F.lit(2), "text", "role").alias("g")]


def _in_order(df: DataFrame, *keys: str) -> DataFrame:
    """The frame, frozen, with `seq`, which rises with the keys: a total sort, so that no key is one task's."""
    return freeze(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("seq", F.monotonically_increasing_id()))


def _carried(sums: DataFrame, over: str, names: dict[str, Column]) -> DataFrame:
    """For each conversation and value of `over`, what its rows before it come to."""
    before = Window.partitionBy("conv").orderBy(over).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumns({n: F.coalesce(c.over(before), F.lit(0)) for n, c in names.items()})


def placed_turns(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: conv, conv_id, turn, range, h, g and place, from 0 by turn, role and text."""
    hashed = turns.select("conv", "conv_id", "turn", "range", *_hashes()).distinct()
    tied = freeze(hashed.groupBy("conv", "turn").agg(F.count("*").alias("n")).where("n > 1").select("conv", "turn"))
    if tied.isEmpty():
        hashed = hashed.withColumn("tie", F.lit(0).cast("bigint"))
    else:
        # Turns with one number follow each other by role and text, which only these need to be sorted by.
        said = turns.join(tied, ["conv", "turn"], "left_semi").select("conv", "turn", "role", "text").distinct()
        ties = _in_order(said, "conv", "turn", "role", "text").select(
            "conv", "turn", *_hashes(), F.col("seq").alias("tie")
        )
        hashed = hashed.join(ties, ["conv", "turn", "h", "g"], "left")
    ordered = _in_order(hashed, "conv", "turn", "tie").withColumn("cell", F.shiftright("seq", 33))
    # The rows of a conversation in a partition stand together, so their numbers are gapless.
    cells = ordered.groupBy("conv", "cell").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    cells = _carried(cells, "cell", {"base": F.sum("n")})
    place = (F.col("seq") - F.col("first") + F.col("base")).alias("place")
    return ordered.join(cells, ["conv", "cell"]).select("conv", "conv_id", "turn", "range", "h", "g", place)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: conv, conv_id, turn, range, h, g, place from 0, block of places, x and y (the
    hash of the prefix up to and with it), before_x and before_y (up to it)."""
    placed = placed_turns(turns).withColumn("block", F.floor(F.col("place") / RANGE).cast("bigint"))
    placed = placed.withColumns({"p": F.xxhash64("place", "h", "g"), "q": F.xxhash64("g", "place", "h")})
    totals = placed.groupBy("conv", "block").agg(F.bit_xor("p").alias("sum_p"), F.bit_xor("q").alias("sum_q"))
    earlier = _carried(totals, "block", {"blocks_x": F.bit_xor("sum_p"), "blocks_y": F.bit_xor("sum_q")})
    order = Window.partitionBy("conv", "block").orderBy("place")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = placed.withColumns({"x": F.bit_xor("p").over(upto), "y": F.bit_xor("q").over(upto)})
    rolled = rolled.join(earlier, ["conv", "block"])
    x = F.col("x").bitwiseXOR(F.col("blocks_x"))
    y = F.col("y").bitwiseXOR(F.col("blocks_y"))
    return rolled.select(
        "conv", "conv_id", "turn", "range", "h", "g", "place", "block", x.alias("x"), y.alias("y"),
        x.bitwiseXOR(F.col("p")).alias("before_x"), y.bitwiseXOR(F.col("q")).alias("before_y"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv, n_turns and copies of the conversations that are no proper prefix of another one."""
    last = F.max(F.struct("place", "x", "y")).alias("last")
    whole = prefixes.groupBy("conv").agg(F.min("conv_id").alias("conv_id"), last)
    whole = whole.select("conv", "conv_id", (F.col("last.place") + 1).alias("n_turns"), "last.x", "last.y")
    # Equal conversations meet before the join; the smallest id, a missing one last.
    first = F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id", "conv")).alias("first")
    distinct = whole.groupBy("n_turns", "x", "y").agg(first, F.count("*").alias("copies"))
    # A turn that follows shows that the prefix before it is a proper one.
    proper = prefixes.where("place > 0").select(
        F.col("place").alias("n_turns"), F.col("before_x").alias("x"), F.col("before_y").alias("y")
    )
    kept = distinct.join(proper.distinct(), ["n_turns", "x", "y"], "left_anti")
    return kept.select(F.col("first.conv").alias("conv"), "n_turns", "copies")


def formatted_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The maximal conversations, rendered: conv_id, part, piece, n_turns, copies, text.

    A part holds RANGE turn numbers, and a piece of it at most RANGE turns, so a usual conversation is one
    row, and the rows of a long one are concatenated by part and piece. Only where several turns have one
    number does a part have a piece but 0. Turns repeated in a conversation count once; different turns with one
    number follow each other by role and text. Missing roles and texts are empty, missing turn numbers, and
    those that are no number, come first, and rows without a conversation are one conversation. An empty
    table gives no rows.
    """
    rows = _turns(turns, conv_col, turn_col, role_col, text_col)
    prefixes = freeze(prefix_hashes(rows))
    kept = freeze(maximal_conversations(prefixes))
    # Ranges of more turns than a piece holds, and the place of their first one.
    full = prefixes.groupBy("conv", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    full = freeze(full.where(F.col("n") > RANGE).select("conv", "range", "first"))

    def rendered(said: DataFrame, *more: str) -> DataFrame:
        # Repeated turns meet in the map tasks.
        turns = F.sort_array(F.collect_set(F.struct("turn", "role", "text")))
        lines = F.transform(turns, lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit("\n"), t["text"], F.lit(END)))
        texts = said.groupBy("conv", "range", *more).agg(F.min("conv_id").alias("conv_id"), F.array_join(lines, "").alias("text"))
        piece = F.col("piece") if more else F.lit(0).cast("bigint").alias("piece")
        return texts.join(kept, "conv").select("conv_id", F.col("range").alias("part"), piece, "n_turns", "copies", "text")

    if full.isEmpty():
        return rendered(rows)
    usual = rows.join(full, ["conv", "range"], "left_anti")
    said = rows.join(full.select("conv", "range"), ["conv", "range"], "left_semi").distinct()
    piece = F.floor((F.col("place") - F.col("first")) / RANGE).cast("bigint").alias("piece")
    places = prefixes.join(full, ["conv", "range"]).select("conv", "turn", "h", "g", piece)
    said = said.select("*", *_hashes()).join(places, ["conv", "turn", "h", "g"])
    return rendered(usual).unionByName(rendered(said, "piece"))
