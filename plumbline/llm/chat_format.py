"""Dialogues rendered once for each participant, in DataFrame operations only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.llm.arrow import column
from plumbline.llm.joins import spread_join
from plumbline.session import scratch, written_table

SYSTEM, NOBODY = "system", "unknown"
#: Characters after which a dialogue is cut into parts, and of its opening that each part repeats.
PART_CHARS, OPENING_CHARS = 1 << 20, 1 << 16
#: Marks and line breaks around a message, at most.
MARKS = 24
#: Messages of one range, and dialogues of several parts whose openings are broadcast.
RANGE_ROWS, BROADCAST_OPENINGS = 100_000, 128


def messages(turns, conv_id="conv_id", turn="turn", role="role", text="text"):
    """All messages with null roles and texts filled, and the characters that each takes."""
    rows = turns.select(
        column(conv_id).alias("conv_id"),
        column(turn).cast("long").alias("turn"),
        F.coalesce(column(role), F.lit(NOBODY)).alias("role"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    return rows.withColumn("chars", F.length("role") + F.length("text") + F.lit(MARKS).cast("long"))


def _order():
    return [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]


def _message():
    return F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text")


def placed(rows):
    """Messages, each once, with the characters of those ``before`` it in its dialogue.

    They are ranged by dialogue and place, so that a long dialogue lies in many
    partitions, and written once; a running sum goes over each partition's share of a
    dialogue, and another over the shares.
    """
    distinct = written_table(rows.distinct(), "chat-messages")
    parts = distinct.count() // RANGE_ROWS + 1
    ranged = distinct.repartitionByRange(parts, F.col("conv_id"), *_order())
    ranged = written_table(ranged.withColumn("share", F.spark_partition_id()), "chat-ranged")
    shares = ranged.groupBy("conv_id", "share").agg(F.sum("chars").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("conv_id", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("conv_id", "share").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("inside", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
    found = found.withColumnRenamed("conv_id", "conv").withColumnRenamed("share", "own")
    same = F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("own") == F.col("share"))
    found = found.join(shares, same).withColumn("before", F.col("earlier") + F.col("inside"))
    return found.select("conv_id", "turn", "role", "text", "before")


def long_dialogues(rows, system, part_chars, opening_chars):
    """conv_id, part, messages and speakers of dialogues that have several parts."""
    found = written_table(placed(rows), "chat-placed")
    other = F.col("role") != system
    heads = found.groupBy("conv_id").agg(
        F.min(F.when(other, F.col("before"))).alias("opened"),
        F.collect_set(F.when(other, F.col("role"))).alias("speakers"),
        F.max("before").alias("copies"),
    )
    heads = written_table(heads.filter("size(speakers) > 0"), "chat-heads")
    early = found.filter((F.col("role") == system) & (F.col("before") < opening_chars))
    early = early.withColumnRenamed("conv_id", "conv")
    same = F.col("conv").eqNullSafe(F.col("conv_id"))
    openings = early.join(heads, same).filter("before < opened").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(_message())).alias("opening")
    )
    openings = openings.withColumnRenamed("conv_id", "conv")
    heads = heads.join(openings, same, "left").select("conv_id", "speakers", "opening", "copies")
    heads = written_table(heads, "chat-openings")
    part = F.floor(F.col("before") / F.lit(part_chars)).cast("long").alias("part")
    parts = found.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(_message())).alias("messages"))
    parts = spread_join(parts, heads, "conv_id", "copies", BROADCAST_OPENINGS, local=False).filter("speakers IS NOT NULL")
    repeated = (F.col("part") > 0) & F.col("opening").isNotNull()
    whole = F.when(repeated, F.concat("opening", "messages")).otherwise(F.col("messages"))
    return parts.select("conv_id", "part", whole.alias("messages"), "speakers")


def short_dialogues(rows, system):
    """conv_id, part, messages and speakers of dialogues of one part."""
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_set(_message())).alias("messages"))
    roles = F.array_distinct(F.transform("messages", lambda m: m["role"]))
    return found.select(
        "conv_id", F.lit(0).cast("long").alias("part"), "messages", F.array_remove(roles, system).alias("speakers")
    )


def rotate(
    turns,
    conv_id="conv_id",
    turn="turn",
    role="role",
    text="text",
    system=SYSTEM,
    part_chars=PART_CHARS,
    opening_chars=OPENING_CHARS,
):
    """One row for each dialogue, participant and part: the part as that speaker's chat.

    Columns: conv_id, speaker, part, n_messages, rendered, mask. The speaker's own
    messages are the assistant's, all others' are a user's and begin with their
    name, system messages stay. Each message is ``<|kind|>``, a line break, its
    text, ``<|end|>`` and a line break. mask is an array of (first, end) character
    ranges of ``rendered`` to learn from: the speaker's texts with their
    ``<|end|>``.

    Every role but ``system`` is a participant, in all parts of its dialogue. Messages
    stand by turn, role and text. A message takes the characters of its role and text
    and ``MARKS``, and belongs to the part that is the quotient of the characters before
    it by ``part_chars``: a dialogue of up to so many characters is one row, and a longer
    one is rendered by many tasks, no row of which grows with it. Each further part
    begins with the system messages that open the dialogue, those that begin in its
    first ``opening_chars``, at most ``part_chars``; without these the parts joined in
    order are the dialogue. Dialogues of one part are gathered by one shuffle.

    A null turn comes after all others. Messages with null conv_id are one dialogue,
    whose conv_id is null. A null role is ``unknown``, a null text is empty; rows
    that repeat in all four columns count once, other messages of one turn all stay. A
    dialogue of system messages alone has no participant and no row. Other columns of
    ``turns`` are not used. An empty table gives an empty one.
    """
    if opening_chars > part_chars:
        raise ValueError("opening_chars must be at most part_chars")
    rows = messages(turns, conv_id, turn, role, text)
    sizes = rows.groupBy("conv_id").agg(F.sum("chars").alias("copies")).filter(F.col("copies") > part_chars)
    if sizes.isEmpty():
        return rendered(short_dialogues(rows, system), system)
    with scratch(turns.sparkSession) as keep:
        sizes = written_table(sizes.withColumn("long", F.lit(True)), "chat-sizes")
        marked = spread_join(rows, sizes, "conv_id", "copies", local=False)
        several = marked.filter("long").drop("long")
        parts = keep(long_dialogues(several, system, part_chars, opening_chars), "chat-parts")
        sizes = keep(sizes, "chat-sizes")
    short = spread_join(rows, sizes, "conv_id", "copies", local=False).filter("long IS NULL").drop("long")
    return rendered(parts.unionByName(short_dialogues(short, system)), system)


def rendered(dialogues, system):
    """The chat and its mask for each speaker of (conv_id, part, messages, speakers)."""

    def own(m):
        return m["role"] == F.col("speaker")

    def opened(m):
        kind = F.when(own(m), "assistant").when(m["role"] == system, system).otherwise("user")
        name = F.when(own(m) | (m["role"] == system), "").otherwise(F.concat(m["role"], F.lit(": ")))
        return F.concat(F.lit("<|"), kind, F.lit("|>\n"), name)

    def piece(m):
        learned = F.concat(m["text"], F.lit("<|end|>"))
        return F.struct(
            F.concat(opened(m), learned, F.lit("\n")).alias("text"),
            F.length(opened(m)).alias("lead"),
            F.length(learned).alias("learned"),
            own(m).alias("own"),
        )

    def step(state, p):
        first = state["end"] + p["lead"]
        span = F.array(F.struct(first.alias("first"), (first + p["learned"]).alias("end")))
        return F.struct(
            (state["end"] + F.length(p["text"])).alias("end"),
            F.when(p["own"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask"),
        )

    nothing = F.struct(
        F.lit(0).alias("end"), F.array().cast("array<struct<first:int,end:int>>").alias("mask")
    )
    dealt = dialogues.select("conv_id", "part", "messages", F.explode("speakers").alias("speaker"))
    dealt = dealt.withColumn("pieces", F.transform("messages", piece))
    return dealt.select(
        "conv_id",
        "speaker",
        "part",
        F.size("pieces").cast("long").alias("n_messages"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("rendered"),
        F.aggregate("pieces", nothing, step)["mask"].alias("mask"),
    )
