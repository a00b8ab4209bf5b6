"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered once, with
that speaker as assistant and all others as named users. Each turn carries the
mask of the text that is trained on: the assistant's words and the end mark
after them. Turns of the role ``system`` are instructions: they open as system
in every perspective, and the system takes no perspective of its own.

A rendered dialogue is kept as its turns, in order, so that one conversation
may hold any number of rows: a perspective is the rows of one (conv_id,
perspective), and their texts joined in order of ``turn`` and ``text`` are the
dialogue. Only the list of a conversation's speakers is gathered.

A text or name can't make a marker: where one stands in it, a backslash is put
behind its first character (behind those that are there already, so that no two
texts look the same), and line breaks in a name become blanks. Texts are
rendered whole, whatever their length.

Defined cases: a null text is empty; a null role is the speaker ``unknown``;
null and repeated ids and turns are kept, one row for each turn and
perspective, with ties in order of the text; a conversation with only system
turns has one perspective, null, in which nothing is trained on; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"
MARKER, ESCAPED = r"<(\\*)\|im_(start|end)\|>", r"<\\$1|im_$2|>"


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, perspective, role, rendered, trained, mask_start, mask_end.

    ``mask_start`` and ``mask_end`` are the characters of ``rendered`` that
    are trained on, counted from 0, end excluded; both are 0 where ``trained``
    is false.
    """
    plain = lambda c: F.regexp_replace(c, MARKER, ESCAPED)
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(UNKNOWN)).alias("role"),
                        plain(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    # The distinct speakers are counted before the shuffle, so that a long conversation is no hot key.
    speakers = (rows.groupBy("conv_id", "role").agg(F.count("*").alias("n")).filter(F.col("role") != SYSTEM)
                .select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")))
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    trained = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    head = (F.when(F.col("role") == SYSTEM, F.lit("system")).when(trained, F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), plain(F.regexp_replace("role", r"[\r\n]", " ")))))
    head = F.concat(F.lit(START), head, F.lit("\n"))
    return seen.select(
        "conv_id", "turn", "perspective", "role", F.concat(head, "text", F.lit(END)).alias("rendered"),
        trained.alias("trained"), F.when(trained, F.length(head)).otherwise(0).cast("int").alias("mask_start"),
        # The line break after the end mark isn't trained on.
        F.when(trained, F.length(head) + F.length("text") + len(END) - 1).otherwise(0).cast("int").alias("mask_end"))


ORACLE_SQL = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
  regexp_replace(coalesce(text, ''), '<(\\*)\|im_(start|end)\|>', '<\\\1|im_\2|>', 'g') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM rows WHERE role <> 'system'),
seen AS (SELECT r.*, s.perspective, coalesce(r.role = s.perspective, false) AS trained
         FROM rows r LEFT JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
headed AS (SELECT *, '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN trained THEN 'assistant'
             ELSE 'user name=' || regexp_replace(regexp_replace(role, '[\r\n]', ' ', 'g'), '<(\\*)\|im_(start|end)\|>', '<\\\1|im_\2|>', 'g') END || chr(10) AS head FROM seen)
SELECT conv_id, turn, perspective, role, head || text || '<|im_end|>' || chr(10) AS rendered, trained,
  CAST(CASE WHEN trained THEN length(head) ELSE 0 END AS INTEGER) AS mask_start,
  CAST(CASE WHEN trained THEN length(head) + length(text) + 10 ELSE 0 END AS INTEGER) AS mask_end
FROM headed
"""
