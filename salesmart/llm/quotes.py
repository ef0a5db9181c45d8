"""Conversations in the order of replies, without quotations (operator 7).

Lines that begin with ">" are quoted, once for each such mark. A run of lines of one level
without a blank line is a passage. Passages, freed of marks, line ends, spacing and case,
are hashed and joined with the unquoted passages and lines of the same conversation: the
original is the first message that has the text as its own. So a quotation that was wrapped
anew is found. Where no such text is found, stretches of five words of the passage are
looked up in the same way, and where none of these is found, its single lines. A message
answers the message from which most of its quoted text of
the lowest level comes. Messages that quote nothing known start a thread of their own;
roots of threads are found by pointer jumping, in as many rounds as the logarithm of the
longest chain.

No step gathers a conversation: every join is by conversation and line, or by message.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.shared import Scratch, plain_text, shuffle_width

# Quotation marks at the start of a line, and the line that announces a quotation.
MARKS = r"^[ \t]*((?:>[ \t]?)+)"
SHINGLE = 5  # words
WROTE = r"(?i)^[ \t]*(?:on|le|am|el)\b.{0,200}(?:wrote|écrit|schrieb|escribió)[ \t]*:[ \t]*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _normal(line: Column) -> Column:
    bare = F.regexp_replace(line, MARKS, "")
    return F.trim(F.lower(F.regexp_replace(bare, r"\s+", " ")))


def parse(messages: DataFrame) -> DataFrame:
    """Every line of every message: level, normal form, passage number, and whether it goes.

    A line that announces the quotation after it goes with the quotation.
    """
    lines = F.split("text", "\n")
    levels = messages.withColumn("lines", lines).withColumn(
        "levels", F.transform("lines", _level)
    )
    rows = levels.select(
        "row", "conv_id", "turn", F.col("levels"), F.posexplode("lines").alias("pos", "line")
    )
    at = F.element_at
    level = at("levels", F.col("pos") + 1)
    following = F.coalesce(F.try_element_at("levels", F.col("pos") + 2), F.lit(0))
    rows = rows.select(
        "row", "conv_id", "turn", "pos", "line", level.alias("level"),
        _normal(F.col("line")).alias("normal"),
        ((level > 0) | (F.col("line").rlike(WROTE) & (following > 0))).alias("goes"),
    )
    in_order = Window.partitionBy("row").orderBy("pos")
    before = F.lag(F.struct("level", "goes", F.col("normal") == "")).over(in_order)
    opens = before != F.struct("level", "goes", F.lit(False))
    return rows.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int")).withColumn(
        "passage", F.sum("opens").over(in_order)
    ).drop("opens")


def _texts(lines: DataFrame) -> DataFrame:
    """What is looked up: conv, row, turn, level, passage, kind, two hashes, chars.

    Kind 0 are whole passages, 1 stretches of words, 2 lines. Passages and lines are found
    under the same hashes. Only conversations in which something is quoted have any.
    """
    # Equal only between rows; conversations without a number meet under one that is none.
    lines = lines.where("normal <> '' AND (level > 0 OR NOT goes)").withColumn(
        "conv", F.struct("conv_id")
    )
    lines = lines.join(lines.where("level > 0").select("conv").distinct(), "conv", "left_semi")
    place = ["conv", "row", "turn", "level", "passage"]
    ordered = F.array_sort(F.collect_list(F.struct("pos", "normal")))
    whole = lines.groupBy(*place).agg(ordered.alias("of")).select(
        *place, F.array_join(F.transform("of", lambda x: x["normal"]), " ").alias("normal")
    )
    words = F.split("normal", " ")
    starts = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)
    stretches = whole.where(F.size(words) >= SHINGLE).select(
        *place,
        F.explode(F.transform(starts, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))
        .alias("normal"),
    )
    texts = None
    for kind, rows in enumerate((whole, stretches, lines)):
        space = F.lit(int(kind == 1))
        # Each word of a passage is in about as many stretches as they have words.
        chars = F.length("normal") / (SHINGLE if kind == 1 else 1)
        rows = rows.select(
            *place, F.lit(kind).alias("kind"), F.struct(
                F.xxhash64(space, "normal").alias("a"), F.xxhash64("normal", space).alias("b")
            ).alias("hash"), chars.cast("double").alias("chars"),
        )
        texts = rows if texts is None else texts.union(rows)
    return texts


def link_replies(messages: DataFrame) -> DataFrame:
    """One row per message, with its parent, its thread and its own text.

    conv_id, turn, role, text (unquoted lines), parent_turn (null for the start of a
    thread), root_turn, depth, quoted_lines; sorted by conv_id, root_turn, turn, which
    puts each original before its replies. An original stands before the quoting message
    in the order of turns (rows of one turn: in the order of a hash of their text, which
    makes them one message if they are alike in all). Null conv_ids are one conversation,
    null turns the last ones, a null text is empty. Further columns are ignored; an empty
    table gives an empty result.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    base = scratch.write(
        messages.select(
            F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long"),
            F.coalesce(F.col("turn").cast("long"), F.lit((1 << 62))).alias("turn"),
            F.col("turn").cast("long").alias("turn_given"), "role", plain_text().alias("text"),
        ),
        "messages",
    )
    lines = scratch.write(parse(base).drop("line"), "lines")
    texts = scratch.write(_texts(lines), "texts")
    own = texts.where("level = 0").groupBy("conv", "hash").agg(
        F.min(F.struct("turn", "row")).alias("original")
    )
    quoted = texts.where("level > 0").groupBy(
        "conv", "hash", "row", "turn", "level", "passage", "kind"
    ).agg(F.sum("chars").alias("chars"))
    found = quoted.join(own, ["conv", "hash"]).where(
        F.col("original") < F.struct("turn", "row")
    )
    surest = F.min("kind").over(Window.partitionBy("row", "passage"))
    found = found.withColumn("surest", surest).where("kind = surest").groupBy(
        "row", "level", "original"
    ).agg(F.sum("chars").alias("chars"))
    parents = found.groupBy("row").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "chars", "original")).alias("best")
    ).select("row", F.col("best.original.row").alias("parent"))
    parents = scratch.write(parents, "parents")
    threads = _roots(parents, scratch)

    # Lines and their flags side by side; a quoted line becomes null and is left out.
    kept = F.filter(
        F.zip_with(F.split("text", "\n"), F.col("flags"), lambda line, gone: F.when(~gone, line)),
        F.isnotnull,
    )
    flags = lines.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("pos", "goes"))).alias("flags"),
        F.count_if(F.col("level") > 0).alias("quoted_lines"),
    ).withColumn("flags", F.transform("flags", lambda x: x["goes"]))
    turns = base.select(F.col("row").alias("of"), F.col("turn_given").alias("of_turn"))
    joined = (
        base.join(flags, "row").join(threads, "row", "left")
        .join(turns.withColumnsRenamed({"of": "parent", "of_turn": "parent_turn"}), "parent", "left")
        .join(turns.withColumnsRenamed({"of": "root", "of_turn": "root_turn"}), "root", "left")
    )
    text = F.array_join(kept, "\n")
    out = joined.select(
        "conv_id", F.col("turn_given").alias("turn"), "role",
        F.when(F.col("quoted_lines") == 0, F.col("text")).otherwise(F.trim(text)).alias("text"),
        "parent_turn",
        F.when(F.col("root").isNull(), F.col("turn_given")).otherwise(F.col("root_turn"))
        .alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "quoted_lines",
    )
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "root_turn", "turn")]
    width = shuffle_width(messages.sparkSession)
    return out.repartitionByRange(width, *order).sortWithinPartitions(*order)


def _roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """row, parent, root and depth of every message that has a parent."""
    rounds = 0
    state = parents.select(
        "row", "parent", F.col("parent").alias("up"), F.lit(1).alias("steps")
    )
    while True:
        state = scratch.write(state, f"threads{rounds}")
        above = state.select(
            F.col("row").alias("up"), F.col("up").alias("further"), F.col("steps").alias("more")
        )
        if state.join(above, "up", "left_semi").isEmpty():
            return state.select(
                "row", "parent", F.col("up").alias("root"), F.col("steps").alias("depth")
            )
        state = state.join(above, "up", "left").select(
            "row", "parent", F.coalesce("further", "up").alias("up"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        )
        rounds += 1
