"""Chat formatting by perspective rotation: each participant's view of a dialogue of several parties.

For every participant, each turn becomes a segment of that view: the participant's own turns are the assistant's and are
trained on (mask 1), all other speakers' are users named after them, system turns stay system turns. A segment's text
carries the markers of a chat template; ``start`` and ``end`` are its place in the view's text, so a view is the
concatenation of its segments. What is trained on of a segment of mask 1 is its range from ``mask_start`` to ``mask_end``:
the text and the closing marker, which the assistant has to write, but not the header, which it is given. Views are tables
of segments rather than one value: a dialogue may be larger than a task's memory.

Places are prefix sums in two steps: within blocks of turns, then over the blocks of a dialogue. Turns without a number
have blocks by speaker and by the beginning of the text. A dialogue's participants are found by a distinct that combines
before the shuffle.

Defined results: turns are ordered by turn number (null first), then speaker, then text; repeated rows are turns of
their own. Null speakers are named ``unknown``, null texts are empty. A dialogue without participants, having system
turns only, has no view. Rows with a null dialogue id are dropped. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 12
#: Characters of a text that tell blocks of unnumbered turns apart.
PREFIX = 16
#: Markers of the template (fixed values).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def clean_name(speaker: Column) -> Column:
    """A speaker's name with everything but letters, digits, _ and - as _."""
    return F.regexp_replace(F.coalesce(speaker, F.lit("unknown")), r"[^A-Za-z0-9_-]", "_")


def segments(turns: DataFrame, dialogue: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """(dialogue, perspective, position, role, name, mask, segment, start, end, mask_start, mask_end); positions count from 0."""
    own = turns.where(F.col(dialogue).isNotNull()).select(
        F.col(dialogue).alias("dialogue"), F.col(turn).alias("turn"), clean_name(F.col(speaker)).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    unnumbered = F.col("turn").isNull()  # these come first, by speaker and text
    prefix = lambda c, n: F.when(unnumbered, F.substring(c, 1, n)).otherwise("")
    block = F.struct((~unnumbered).alias("numbered"), F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(0)).alias("n"), F.when(unnumbered, F.col("speaker")).otherwise("").alias("speaker"), prefix("text", PREFIX).alias("text"))
    placed = own.withColumn("block", block)
    in_block = Window.partitionBy("dialogue", "block").orderBy(F.asc_nulls_first("turn"), "speaker", "text")
    numbered = placed.withColumn("nth", F.row_number().over(in_block) - 1)
    people = own.where(F.col("speaker") != SYSTEM).select("dialogue", F.col("speaker").alias("perspective")).distinct()
    views = numbered.join(people, "dialogue")
    mine = F.col("speaker") == F.col("perspective")
    system = F.col("speaker") == SYSTEM
    role = F.when(mine, "assistant").when(system, SYSTEM).otherwise("user")
    name = F.when(~mine & ~system, F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    shown = views.select("dialogue", "perspective", "block", "nth", role.alias("role"), name.alias("name"), mine.cast("int").alias("mask"), F.concat(head, F.col("text"), F.lit(CLOSE)).alias("segment"), F.length(head).alias("head"))
    shown = shown.withColumn("length", F.length("segment").cast("long"))
    blocks = shown.groupBy("dialogue", "perspective", "block").agg(F.sum("length").alias("chars"), F.count(F.lit(1)).alias("turns"))
    before = Window.partitionBy("dialogue", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("dialogue", "perspective", "block", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("dialogue", "perspective", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = shown.withColumn("upto", F.sum("length").over(inside))
    placed = ends.join(bases, ["dialogue", "perspective", "block"]).withColumn("end", F.col("base") + F.col("upto"))
    start = F.col("end") - F.col("length")
    trained = lambda x: F.when(F.col("mask") == 1, x)
    return placed.select("dialogue", "perspective", (F.col("first") + F.col("nth")).alias("position"), "role", "name", "mask", "segment", start.alias("start"), "end", trained(start + F.col("head")).alias("mask_start"), trained(F.col("end")).alias("mask_end"))


#: The same for conversations, in DuckDB's SQL; no conversation there reaches a second block.
SQL = r"""
WITH own AS (
  SELECT conv_id AS dialogue, turn, regexp_replace(coalesce(role, 'unknown'), '[^A-Za-z0-9_-]', '_', 'g') AS speaker, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dialogue ORDER BY turn NULLS FIRST, speaker, text) - 1 AS position FROM own),
people AS (SELECT DISTINCT dialogue, speaker AS perspective FROM own WHERE speaker <> 'system'),
shown AS (
  SELECT dialogue, perspective, position,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
    CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name,
    CAST(speaker = perspective AS INT) AS mask, text
  FROM numbered JOIN people USING (dialogue)),
written AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) || text || '<|im_end|>' || chr(10) AS segment FROM shown),
placed AS (
  SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY dialogue, perspective ORDER BY position) AS BIGINT) AS "end" FROM written)
SELECT dialogue, perspective, position, role, name, mask, segment, "end" - length(segment) AS "start", "end",
  CASE mask WHEN 1 THEN "end" - length(text) - length('<|im_end|>' || chr(10)) END AS mask_start, CASE mask WHEN 1 THEN "end" END AS mask_end
FROM placed
"""
