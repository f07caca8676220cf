"""Chat formatting: every dialogue from the perspective of each of its participants.

In a perspective one participant speaks as the assistant; all others are users who
carry their names.  What the assistant says is what a model is trained on.  A rendered
turn is a row, so that a dialogue of any length is never built up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Speakers that set the scene and take no part.
NARRATORS = ("system",)

# Offsets are summed in runs of this many turns.
RUN_TURNS = 4096

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame) -> DataFrame:
    """Every turn of ``turns(conv_id, turn, role, text)`` in every perspective.

    Returns conv_id, perspective (the participant who is the assistant), turn, role
    (assistant, user or system), name (of a user), rendered, start and stop (in
    characters of the rendered dialogue), and the mask: mask_start and mask_stop bound
    the characters to train on, the assistant's words with the closing mark, and are
    null in turns of others.

    Turns follow in order of ``turn`` (null first), ties by role, then text.  A null
    text is an empty one; a null role is the participant ``unknown``; a null conv_id is
    a dialogue of its own.  Repeated rows are turns of their own.  A dialogue without
    participants (system turns alone) gives no rows.  Other columns are ignored.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text")
    )
    parties = (
        said.where(~F.col("speaker").isin(*NARRATORS))
        .select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    own, narrator = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*NARRATORS)
    name = F.when(~own & ~narrator, F.col("speaker"))
    role = F.when(own, "assistant").when(narrator, F.col("speaker")).otherwise("user")
    head = F.concat(F.lit(OPEN), "role", F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), "name")).otherwise(""), F.lit("\n"))
    rows = (
        said.join(parties, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .withColumns({"role": role, "name": name})
        .withColumn("rendered", F.concat(head, "text", F.lit(CLOSE)))
        .withColumn("_head", F.length(head))
        .withColumn("_size", F.length("rendered").cast("long"))
        .withColumn("_run", F.floor(F.col("turn") / RUN_TURNS))
    )
    sums = rows.groupBy("conv_id", "perspective", "_run").agg(F.sum("_size").alias("_sum"))
    runs = Window.partitionBy("conv_id", "perspective").orderBy("_run")
    sums = sums.select(
        F.col("conv_id").alias("_conv2"), F.col("perspective").alias("_who"), F.col("_run").alias("_run2"),
        (F.sum("_sum").over(runs) - F.col("_sum")).alias("_before"),
    )
    inner = Window.partitionBy("conv_id", "perspective", "_run").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, 0)
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv2")) & (F.col("perspective") == F.col("_who")) & F.col("_run").eqNullSafe(F.col("_run2"))
    )
    placed = rows.withColumn("_inner", F.sum("_size").over(inner)).join(sums, same)
    return (
        placed.withColumn("stop", F.col("_before") + F.col("_inner"))
        .withColumn("start", F.col("stop") - F.col("_size"))
        .select(
            "conv_id", "perspective", "turn", "role", "name", "rendered", "start", "stop",
            F.when(F.col("role") == "assistant", F.col("start") + F.col("_head")).alias("mask_start"),
            F.when(F.col("role") == "assistant", F.col("stop") - 1).alias("mask_stop"),
        )
    )
