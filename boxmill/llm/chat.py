"""Dialogues from every participant's point of view.

For each participant of a conversation the whole dialogue is rendered with that
participant as the assistant and the others as named users; system turns stay. Each
turn is a segment with its place in the rendered text and a mask that is true where
the loss counts: on the assistant's own words. A conversation is never gathered in
one task: places come from sums over parts of bounded size, so a conversation may
hold any share of the rows. Only lengths are multiplied by the participants before
the last join; texts cross an exchange once to be ranked and once to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, materialise

SPAN = 256
KEY = ["dialogue", "perspective"]
TURN = ["dialogue", "turn", "speaker", "part"]
#: Comes before every turn.
NO_TURN = "CAST(-9223372036854775809 AS DECIMAL(20, 0))"


def escaped(text: Column) -> Column:
    r"""The text without `<|`: one backslash more in every `<|`, `<\|`, `<\\|` and so on, which can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def rotate_perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system_role: str = "system"
) -> DataFrame:
    r"""conv_id, perspective, turn, speaker, segment, start, length, mask_start, mask_length.

    One row per turn and participant. segment is the turn's part of the rendered text,
    from character start on; mask_start and mask_length say which of its characters
    train the model (none for other speakers). Turns are in order of turn, then role,
    then text; equal rows follow each other. A null role is the participant 'unknown',
    a null text an empty one, a null turn comes before all numbers. Rows with a null
    conversation are one conversation. Conversations and turns are whole numbers. A
    dialogue of system turns alone has no participant and no rows. Markers in texts and
    names cannot pass for the rendering's own: see escaped(); in names, `|>` gets a
    backslash likewise. Other columns are ignored; an empty table gives no rows.
    """
    speaker, text = (escaped(F.coalesce(F.col(c).cast("string"), F.lit(d))) for c, d in ((role_col, "unknown"), (text_col, "")))
    rows = (
        turns.select(
            F.coalesce(F.col(conv_col).cast("long").cast("string"), F.lit("")).alias("dialogue"),
            F.coalesce(F.col(turn_col).cast("long").cast("decimal(20,0)"), F.expr(NO_TURN)).alias("turn"),
            speaker.alias("speaker"),
            text.alias("text"),
        )
        # A turn given by many different rows is dealt out by its speakers and first letters.
        .withColumn("part", F.substring("text", 1, 16))
        .groupBy(*TURN, "text")
        .agg(F.count("*").alias("copies"))
    )
    place = F.row_number().over(Window.partitionBy(*TURN).orderBy("text")).alias("place")
    rows = materialise(rows.select(*TURN, place, "text", "copies", F.length("text").alias("n_text")))
    people = materialise(rows.filter(F.col("speaker") != system_role).select("dialogue", F.col("speaker").alias("perspective")).distinct())
    # Participants of dialogues with many rows go by broadcast if they are not too many, so that no task gets all turns of one.
    counts = materialise(rows.groupBy("dialogue").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") * HOT_SHARE > total).select("dialogue")
    theirs = people.join(F.broadcast(hot), "dialogue", "left_semi")
    few = theirs.limit(1_000_001).count() <= 1_000_000

    def with_people(left: DataFrame) -> DataFrame:
        if not few:
            return left.join(people, "dialogue")
        cold = left.join(F.broadcast(hot), "dialogue", "left_anti").join(people, "dialogue")
        return cold.unionByName(left.join(F.broadcast(theirs), "dialogue"))

    own = F.col("speaker") == F.col("perspective")
    name = F.regexp_replace("speaker", r"\|(\\*)>", r"|$1\\>")
    head = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("speaker") == system_role, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))
    )
    end = "\n<|end|>\n"
    seen = with_people(rows.select(*TURN, "place", "copies", "n_text"))
    seen = seen.withColumns({"length": (F.length(head) + F.col("n_text") + len(end)).cast("long"), "span": F.floor(F.col("turn") / SPAN)})
    # Order: turn, then speaker and text, by parts: (span), (turn, speaker, first letters), row.
    total_length = F.sum(F.col("length") * F.col("copies"))
    parts = seen.groupBy("perspective", *TURN, "span").agg(total_length.alias("size"))
    spans = parts.groupBy(*KEY, "span").agg(F.sum("size").alias("size"))
    ahead = lambda keys, order: F.coalesce(
        F.sum("size").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    spans = spans.select(*KEY, "span", ahead(KEY, ["span"]).alias("before_span"))
    parts = parts.select("perspective", *TURN, "span", ahead([*KEY, "span"], ["turn", "speaker", "part"]).alias("before_part"))
    places = parts.join(spans, [*KEY, "span"]).withColumn("before", F.col("before_span") + F.col("before_part"))
    placed = seen.join(places.select("perspective", *TURN, "before"), ["perspective", *TURN])
    within = Window.partitionBy("perspective", *TURN).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("first", F.col("before") + F.sum(F.col("length") * F.col("copies")).over(within) - F.col("length") * F.col("copies"))
    full = rows.select(*TURN, "place", "text").join(placed, [*TURN, "place"])
    each = full.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    start = F.col("first") + F.col("copy") * F.col("length")
    return each.select(
        F.expr("try_cast(dialogue AS bigint)").alias("conv_id"),
        "perspective",
        F.when(F.col("turn") > F.expr(NO_TURN), F.col("turn").cast("long")).alias("turn"),
        "speaker",
        F.concat(head, "text", F.lit(end)).alias("segment"),
        start.alias("start"),
        "length",
        (start + F.length(head)).alias("mask_start"),
        F.when(own, F.col("n_text")).otherwise(0).cast("long").alias("mask_length"),
    )
