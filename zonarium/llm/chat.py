"""Chat formatting: multi-party perspective rotation, DataFrame functions only.

Every participant of a dialogue is once the assistant.  For each participant the
whole dialogue is rendered with that speaker's turns as ``assistant``, the other
speakers as named users, context roles (``system``) as they are, and a mask over
the assistant's words.

The result has one row per conversation, perspective and turn, with the place of
the turn in the rendered dialogue; the dialogue is the concatenation of
``rendered`` by ``position``.  No dialogue is gathered into one row or one task,
so a conversation of any length is handled.

Defined results: a null role is the speaker ``unknown``; a null text is empty; a
null turn comes first; equal turns are ordered by speaker and text; a repeated
row is a turn of its own; a null conversation id is a conversation of its own; a
conversation of context roles only has no participant and no rows; an empty
table gives an empty result; columns other than the four named are ignored.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CONTEXT_ROLES = ("system",)
#: Turns whose places are counted together; the counts of these groups are then summed.
BLOCK_TURNS = 64


def rotate_perspectives(
    turns,
    conv="conv_id",
    turn="turn",
    role="role",
    text="text",
    context_roles=CONTEXT_ROLES,
    block_turns=BLOCK_TURNS,
):
    """Rendered turns for every participant's perspective.

    Columns: conv_id, perspective, position (from 0), turn, speaker, chat_role,
    name (null unless a named user), rendered, mask (1: the assistant's turn),
    start, target_start, target_end (code points in the rendered dialogue; the
    target, the words and the end mark, is empty where mask is 0).

    Places are prefix sums in two steps: within blocks of turns, then over the
    blocks, so that one long conversation is spread over many tasks.
    """
    base = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("speaker"),
        # The marks cannot be forged from within a turn.
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("words"),
        F.floor(F.col(turn) / block_turns).cast("long").alias("block"),
    )
    people = (
        base.filter(~F.col("speaker").isin(*context_roles))
        .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    own = F.col("speaker") == F.col("perspective")
    context = F.col("speaker").isin(*context_roles)
    head = F.concat(
        F.lit(START),
        F.col("chat_role"),
        F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), F.col("name"))).otherwise(""),
        F.lit("\n"),
    )
    rows = (
        base.join(people, F.col("conv_id").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("mask", F.when(own, 1).otherwise(0))
        .withColumn(
            "chat_role",
            F.when(own, "assistant").when(context, F.col("speaker")).otherwise("user"),
        )
        .withColumn("name", F.when(~own & ~context, F.col("speaker")))
        .withColumn("n_head", F.length(head))
        .withColumn("n_body", F.length("words") + len(END))
        .withColumn("n", F.col("n_head") + F.col("n_body") + 1)
    )
    keys = ["conv_id", "perspective"]
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        rows.groupBy(*keys, "block")
        .agg(F.count("*").alias("turns"), F.sum("n").alias("chars"))
        .select(
            *(F.col(k).alias(f"of_{k}") for k in [*keys, "block"]),
            F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        )
    )
    inside = Window.partitionBy(*keys, "block").orderBy("turn", "speaker", "words")
    up_to = inside.rowsBetween(Window.unboundedPreceding, -1)
    # The turns' words are carried; what is rendered is made at the end, after all exchanges.
    placed = (
        rows.withColumn("n_in", F.row_number().over(inside) - 1)
        .withColumn("c_in", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
        .join(
            sums,
            F.col("conv_id").eqNullSafe(F.col("of_conv_id"))
            & (F.col("perspective") == F.col("of_perspective"))
            & F.col("block").eqNullSafe(F.col("of_block")),
        )
    )
    start = F.col("chars_before") + F.col("c_in")
    first = start + F.col("n_head")
    return placed.select(
        "conv_id",
        "perspective",
        (F.col("turns_before") + F.col("n_in")).cast("long").alias("position"),
        "turn",
        "speaker",
        "chat_role",
        "name",
        F.concat(head, F.col("words"), F.lit(END + "\n")).alias("rendered"),
        "mask",
        start.cast("long").alias("start"),
        first.cast("long").alias("target_start"),
        F.when(F.col("mask") == 1, first + F.col("n_body")).otherwise(first).cast("long").alias("target_end"),
    )


ORACLE = """
WITH base AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
           replace(coalesce(text, ''), '<|', '< |') AS words
    FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM base WHERE speaker <> 'system'),
rows_ AS (
    SELECT b.*, p.perspective,
           CASE WHEN speaker = perspective THEN 1 ELSE 0 END AS mask,
           CASE WHEN speaker = perspective THEN 'assistant'
                WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS chat_role,
           CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
    FROM base b JOIN people p ON b.conv_id IS NOT DISTINCT FROM p.conv_id),
heads AS (
    SELECT *, '<|im_start|>' || chat_role || CASE WHEN name IS NULL THEN '' ELSE ' name=' || name END || chr(10) AS head
    FROM rows_),
full_ AS (SELECT *, head || words || '<|im_end|>' || chr(10) AS rendered FROM heads),
placed AS (
    SELECT *, row_number() OVER w - 1 AS position,
           coalesce(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM full_ WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, words))
SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, CAST(turn AS BIGINT) AS turn, speaker,
       chat_role, name, rendered, CAST(mask AS INTEGER) AS mask, CAST(start AS BIGINT) AS start,
       CAST(start + length(head) AS BIGINT) AS target_start,
       CAST(start + length(head) + CASE WHEN mask = 1 THEN length(words) + 10 ELSE 0 END AS BIGINT) AS target_end
FROM placed
"""
