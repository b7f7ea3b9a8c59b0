"""Multi-party perspective rotation of dialogues.

Every participant of a conversation gets the whole dialogue once, rendered with their own
turns as the assistant's and the others' as named users'; only their own turns carry loss. A
rendering comes in parts of a fixed number of turns, which joined in order are the
dialogue, so no row or group grows with the length of a conversation. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleloom.llm.rows import keep

#: Turns in one part.
PART_TURNS = 64


def number_turns(turns: DataFrame) -> DataFrame:
    """Add ``at``, the turn's place in its conversation from 0, without gathering a conversation.

    One range sort spreads all turns by (conv, turn, speaker, text); a turn's place is its
    place in its sorted partition, plus the conversation's turns in the partitions before.
    """
    # Turns alike in everything are told apart by where they were read.
    ordered = turns.withColumn("__read", F.monotonically_increasing_id()).orderBy("conv", "turn", "speaker", "text", "__read")
    placed = keep(ordered.drop("__read").withColumn("__row", F.monotonically_increasing_id()).withColumn("__piece", F.shiftright("__row", 33)), "turns")
    pieces = placed.groupBy("conv", "__piece").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy("conv").orderBy("__piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__rows")
    starts = pieces.select(F.col("conv").alias("__conv"), F.col("__piece").alias("__p"), "__first", before.alias("__before"))
    joined = placed.join(starts, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("__piece") == F.col("__p")))
    return joined.withColumn("at", F.col("__before") + F.col("__row") - F.col("__first")).drop("__conv", "__p", "__piece", "__row", "__first", "__before")


def header(speaker: Column, system: str, perspective: Column) -> Column:
    own = F.when(speaker == system, "<|system|>").when(speaker == perspective, "<|assistant|>").otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>")))
    return F.concat(own, F.lit("\n"))


def rotate(conversations: DataFrame, conv: str, turn: str, speaker: str, text: str, *, system: str = "system", unnamed: str = "unknown", part_turns: int = PART_TURNS) -> DataFrame:
    """(conversation, perspective, part, n_turns, text, loss_spans) for every participant and part.

    Turns are ordered by (turn, speaker, text), nulls first. ``system`` turns are rendered as such and
    are no participant's; a null speaker is ``unnamed``; a null text is empty. ``loss_spans`` lists the
    characters of ``text`` to learn from, as "from-to" pairs joined by commas, ``to`` exclusive: the
    perspective's own messages with their end marks, empty if the part has none. Rows of a null
    conversation form one conversation; a conversation of system turns only gives nothing; repeated rows
    are turns of their own. Other columns are not returned.
    """
    turns = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(speaker).cast("string"), F.lit(unnamed)).alias("speaker"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    numbered = number_turns(turns)
    part = F.floor(F.col("at") / part_turns).cast("long")
    parts = numbered.groupBy("conv", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("at", "speaker", "text"))).alias("said"))
    people = turns.filter(F.col("speaker") != system).select(F.col("conv").alias("__conv"), F.col("speaker").alias("perspective")).distinct()
    seen = parts.join(people, F.col("conv").eqNullSafe(F.col("__conv")))
    me = F.col("perspective")
    heads = F.transform("said", lambda s: header(s["speaker"], system, me))
    bodies = F.transform("said", lambda s: F.concat(s["text"], F.lit("<|end|>\n")))
    made = seen.select("conv", "perspective", "part", "said", heads.alias("heads"), bodies.alias("bodies"))
    sizes = F.transform(F.arrays_zip("heads", "bodies"), lambda x: F.length(x["heads"]) + F.length(x["bodies"]))
    ends = F.aggregate(sizes, F.array().cast("array<int>"), lambda acc, n: F.concat(acc, F.array(F.coalesce(F.element_at(acc, F.when(F.size(acc) > 0, -1)), F.lit(0)) + n)))
    made = made.withColumn("ends", ends)
    spans = F.transform(
        F.filter(F.arrays_zip("said", "bodies", "ends"), lambda x: x["said"]["speaker"] == me),
        lambda x: F.concat_ws("-", x["ends"] - F.length(x["bodies"]), x["ends"]),
    )
    whole = F.array_join(F.transform(F.arrays_zip("heads", "bodies"), lambda x: F.concat(x["heads"], x["bodies"])), "")
    return made.select(F.col("conv").alias("conversation"), "perspective", "part", F.size("said").cast("long").alias("n_turns"), whole.alias("text"), F.array_join(spans, ",").alias("loss_spans"))
