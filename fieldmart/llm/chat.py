"""Multi-party dialogues from the view of every participant, with masks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch

# The marks around a message.
START, END = "<|im_start|>", "<|im_end|>"
NOBODY = "unknown"  # the name of an absent or empty role
ROWS_PER_PART = 50_000
PIECE_CHARS = 1 << 18


def header(speaker: Column, perspective: Column, is_context: Column) -> Column:
    """The first line of a message: the speaker in view is the assistant, others are named users."""
    own = F.when(is_context, speaker).when(speaker == perspective, F.lit("assistant"))
    return F.concat(F.lit(START), F.coalesce(own, F.concat(F.lit("user name="), speaker)), F.lit("\n"))


def _name(role: Column) -> Column:
    """A role as a name: one line, without the marks' signs."""
    name = F.regexp_replace(F.trim(role), r"[\s<|>]+", "_")
    return F.when(F.length(name) > 0, name).otherwise(F.lit(NOBODY))


def rotate(
    turns: DataFrame,
    scratch: Scratch,
    context_roles: tuple[str, ...] = ("system",),
    rows_per_part: int = ROWS_PER_PART,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """For every conversation and participant the rendered dialogue: conv_id, perspective, piece,
    text, mask, n_messages, n_trained.

    Messages are ordered by turn, then role, then text; absent turns come last. In the view of a
    participant its own messages are the assistant's and those of others are named users'. Roles
    in `context_roles` are nobody's view and keep their role. The mask lists the spans to train
    on, "start-end" in characters of the piece's text, separated by commas: the content of the
    assistant's messages with the end mark. A piece holds the messages that begin within its
    `piece_chars` characters, so a dialogue shorter than that is one piece and no row grows
    without bound; messages are never cut.

    A null or blank role is a participant named "unknown", a null text is an empty message, rows
    without conv_id form one conversation, and repeated rows are repeated messages. Marks
    within a text are broken up by a space. A conversation of context alone has no view and gives no row.
    Other columns are ignored.

    A conversation may hold any share of the rows: messages are sorted by range over equal parts
    and numbered by the sums of the parts before, the participants travel to each part, and
    only then are the messages copied per view.
    """
    speaker = _name(turns["role"])
    text = F.replace(F.coalesce(turns["text"], F.lit("")), F.lit("<|"), F.lit("< |"))
    messages = turns.select(
        turns["conv_id"].cast(LongType()).alias("conv_id"),
        turns["turn"].cast(LongType()).alias("turn"),
        speaker.alias("speaker"),
        text.alias("text"),
        speaker.isin(*context_roles).alias("is_context"),
    ).withColumn("copy", F.monotonically_increasing_id())  # equal rows need not lie together
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("text"), F.col("copy")]
    parts = max(1, -(-turns.count() // rows_per_part))
    ranged = messages.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).drop("copy")
    ranged = scratch.pin(ranged, "ranged")

    held = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("rows"))
    people = ranged.where(~F.col("is_context")).groupBy("conv_id", "speaker").agg(F.lit(True).alias("is_person"))
    people = people.select(F.col("conv_id").alias("own_conv"), F.col("speaker").alias("perspective"))
    views = held.join(people, F.col("conv_id").eqNullSafe(F.col("own_conv"))).drop("own_conv", "rows")
    views = views.select(F.col("conv_id").alias("own_conv"), F.col("part").alias("own_part"), "perspective")
    meets = (F.col("part") == F.col("own_part")) & F.col("conv_id").eqNullSafe(F.col("own_conv"))
    rendered = ranged.join(views, meets).drop("own_conv", "own_part")
    head = header(F.col("speaker"), F.col("perspective"), F.col("is_context"))
    rendered = rendered.withColumns(
        {
            "head": head,
            "trained": ~F.col("is_context") & (F.col("speaker") == F.col("perspective")),
            "length": F.length(head) + F.length("text") + F.lit(len(END) + 1),
        }
    )
    # The start of each message: a sum within the part, and the sums of the parts before.
    sums = rendered.groupBy("conv_id", "perspective", "part").agg(F.sum("length").cast("long").alias("chars"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("own_conv"),
        F.col("perspective").alias("own_view"),
        F.col("part").alias("own_part"),
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy("part", "conv_id", "perspective").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = rendered.withColumn("within", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    meets = meets & (F.col("perspective") == F.col("own_view"))
    placed = placed.join(sums, meets).withColumn("start", F.col("base") + F.col("within"))
    placed = placed.withColumn("piece", F.floor(F.col("start") / piece_chars).cast("long"))
    message = F.struct("start", "head", "text", "trained")
    pieces = placed.groupBy("conv_id", "perspective", "piece").agg(
        F.array_sort(F.collect_list(message)).alias("messages"), F.min("start").alias("first")
    )
    whole = F.transform("messages", lambda m: F.concat(m["head"], m["text"], F.lit(f"{END}\n")))
    spans = F.transform(
        F.filter("messages", lambda m: m["trained"]),
        lambda m: F.concat_ws(
            "-",
            m["start"] - F.col("first") + F.length(m["head"]),
            m["start"] - F.col("first") + F.length(m["head"]) + F.length(m["text"]) + F.lit(len(END)),
        ),
    )
    return pieces.select(
        "conv_id",
        "perspective",
        "piece",
        F.array_join(whole, "").alias("text"),
        F.array_join(spans, ",").alias("mask"),
        F.size("messages").cast("long").alias("n_messages"),
        F.size(F.filter("messages", lambda m: m["trained"])).cast("long").alias("n_trained"),
    )
