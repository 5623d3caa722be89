r"""Chat formatting: multi-party perspective rotation, with SQL functions only.

For every participant of a dialogue one training view is rendered in which that
speaker is the assistant, all others are named users and system turns stay
system turns.  The mask lists the character spans of the rendered text that
belong to the assistant, content and end mark: those are learned.

A view is the whole dialogue.  Only what no row should hold comes in several
windows: each turn costs its characters and ``TURN_COST``, and the turns whose
costs before them, in the order of the dialogue, lie in the same stretch of
``window_cost`` make a window.  A dialogue of, say, 8,000 turns of 1,000
characters is one; the windows of a longer one, one after the other, are the
dialogue, and first_turn says how many turns lie before a window.  The order of
long ones is found by range partitions and sums: no conversation, however hot,
meets in one task.  A view is as long as its dialogue, so a dialogue is written as
often as it has speakers; where these are many, views are shared out
among tasks before they are rendered.

Markers in names and texts are escaped, so that no text can open or close a
turn: one backslash is put after the "<" of every "<|" (and of every "<\|",
"<\\|" ..., so that taking one away gives the text back).

Defined results
    null text: an empty turn.  Null role: the name "unknown".  Null turn: turn
    number 0.  Rows without a conv_id form a dialogue of their own (key null).
    Roles are trimmed and lower-cased to names; line ends in a name are shown
    as spaces.  Dialogues of system turns only have no participant and give no
    row.  Ties in turn are ordered by name, then text; repeated rows are
    repeated turns.  A very long turn is a turn like any other, whole in its
    window.  Extra columns, whatever their names, are ignored; an empty table
    gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

WINDOW_COST = 16 << 20
#: What a turn costs besides its characters; it bounds the turns of a window, whose spans are put together one after the other.
TURN_COST = 1024

#: Turns times speakers from which on a dialogue's views are shared out among tasks; it changes no row.
DEALT_PIECES = 1 << 18

# The markers of the rendered form.
OPEN, NAME, HEAD_END, CLOSE = "<|im_start|>", " name=", "\n", "<|im_end|>\n"

ORDER = ("turn", "name", "text")


def _escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def _turns(conversations: DataFrame) -> DataFrame:
    name = F.lower(F.trim(F.col("role")))
    return conversations.select(
        F.col("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.when(name.isNull() | (name == ""), "unknown").otherwise(name).alias("name"),
        _escaped(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )


def perspectives(conversations: DataFrame) -> DataFrame:
    """(conv_id, speaker) for every participant; system is none.  A map-side distinct, keys only."""
    return _turns(conversations).filter(F.col("name") != "system").select("conv_id", F.col("name").alias("speaker")).distinct()


def _head(speaker: Column, name: Column) -> Column:
    return (
        F.when(name == "system", F.lit(OPEN + "system" + HEAD_END))
        .when(name == speaker, F.lit(OPEN + "assistant" + HEAD_END))
        .otherwise(F.concat(F.lit(OPEN + "user" + NAME), F.regexp_replace(_escaped(name), "[\r\n]", " "), F.lit(HEAD_END)))
    )


def _cost() -> Column:
    return (F.length("text") + TURN_COST).cast("long")


def _windows(turns: DataFrame, window_cost: int) -> DataFrame:
    """(conv_id, window_no, first_turn, turns) of long dialogues."""
    alike = turns.groupBy("conv_id", *ORDER).agg(F.count("*").alias("n"))
    # Written once: the range that a row lies in must not change between the sums and the rows.
    ranged = materialize(alike.repartitionByRange("conv_id", *ORDER).withColumns({"range_no": F.spark_partition_id(), "cost": _cost()}), "long_dialogues")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = ranged.groupBy("conv_id", "range_no").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("cost")).alias("whole"))
    ranges = earlier.partitionBy("conv_id").orderBy("range_no")
    before = sums.select(F.col("conv_id").alias("c"), F.col("range_no").alias("r"), zero(F.sum("rows").over(ranges)).alias("rows_before"), zero(F.sum("whole").over(ranges)).alias("cost_before"))
    inside = earlier.partitionBy("conv_id", "range_no").orderBy(*ORDER)
    placed = ranged.withColumns({"rows_inside": zero(F.sum("n").over(inside)), "cost_inside": zero(F.sum(F.col("n") * F.col("cost")).over(inside))})
    placed = placed.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range_no") == F.col("r")))
    placed = placed.withColumns({"at": F.col("cost_before") + F.col("cost_inside"), "nth": F.col("rows_before") + F.col("rows_inside")})
    # The copies of a repeated row follow one another: copy i begins at at + i * cost.
    first, last = F.floor(F.col("at") / window_cost), F.floor((F.col("at") + (F.col("n") - 1) * F.col("cost")) / window_cost)
    cut = placed.withColumn("window_no", F.explode(F.sequence(first, last)))
    reach = lambda w: F.least(F.col("n"), F.greatest(F.lit(0), F.ceil((w * window_cost - F.col("at")) / F.col("cost"))))
    cut = cut.withColumns({"low": reach(F.col("window_no")), "high": reach(F.col("window_no") + 1)}).filter("high > low")
    kept = F.struct(*ORDER, (F.col("high") - F.col("low")).cast("int").alias("copies"))
    grouped = cut.groupBy("conv_id", "window_no").agg(F.array_sort(F.collect_list(kept)).alias("runs"), F.min(F.col("nth") + F.col("low")).alias("first_turn"))
    turns_of = F.flatten(F.transform("runs", lambda t: F.array_repeat(F.struct(*[t[c].alias(c) for c in ORDER]), t["copies"])))
    return grouped.select("conv_id", "window_no", "first_turn", turns_of.alias("turns"))


def rotate_perspectives(conversations: DataFrame, window_cost: int = WINDOW_COST) -> DataFrame:
    """One row per dialogue, speaker and window (of which all but very long dialogues have one).

    conv_id, speaker, window_no, first_turn, n_turns, n_target_turns, text (the
    rendered window), target_spans (array of start and end, characters of text
    from 0, end exclusive) and n_target_chars.
    """
    turns = _turns(conversations)
    # Costs are summed map-side first.
    sizes = turns.groupBy("conv_id").agg(F.sum(_cost()).alias("whole")).filter(F.col("whole") > window_cost)
    long = materialize(sizes.select(F.col("conv_id").alias("c")), "long_keys")
    some = not long.isEmpty()
    is_long = turns["conv_id"].eqNullSafe(long["c"])
    whole = (turns.join(long, is_long, "left_anti") if some else turns).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*ORDER))).alias("turns"))
    speakers = F.array_distinct(F.transform(F.filter("turns", lambda t: t["name"] != "system"), lambda t: t["name"]))
    zero = F.lit(0).cast("long")
    views = lambda rows: rows.select("conv_id", zero.alias("window_no"), zero.alias("first_turn"), "turns", F.explode("speakers").alias("speaker"))
    whole = whole.withColumn("speakers", speakers)
    pieces = F.size("speakers").cast("long") * F.size("turns")
    # The views of a dialogue of many speakers are dealt out before they are rendered; all others are rendered where they are.
    viewed = views(whole.filter(pieces <= DEALT_PIECES)).unionByName(views(whole.filter(pieces > DEALT_PIECES)).repartition("conv_id", "speaker"))
    if some:
        people = perspectives(conversations).join(long, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").select(F.col("conv_id").alias("c"), "speaker")
        windows = _windows(turns.join(long, is_long, "left_semi"), window_cost)
        viewed = viewed.unionByName(windows.join(people, windows["conv_id"].eqNullSafe(people["c"])).drop("c"))
    rendered = viewed.withColumn(
        "pieces",
        F.transform(
            "turns",
            lambda t: F.struct(
                _head(F.col("speaker"), t["name"]).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), (t["name"] == F.col("speaker")).alias("target")
            ),
        ),
    )
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(
                p["target"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return rendered.select(
        "conv_id",
        "speaker",
        "window_no",
        "first_turn",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["target"])).cast("long").alias("n_target_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        spans.alias("target_spans"),
    ).withColumn("n_target_chars", F.aggregate("target_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]))


#: DuckDB form of the digest that op3 returns.
SQL = rf"""
WITH t AS (
  SELECT conv_id, coalesce(turn, 0) AS turn, regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') AS text,
         CASE WHEN role IS NULL OR trim(role) = '' THEN 'unknown' ELSE lower(trim(role)) END AS name
  FROM conversations
), p AS (
  SELECT DISTINCT conv_id, name AS speaker FROM t WHERE name <> 'system'
), o AS (
  SELECT *, row_number() OVER w - 1 AS nth, coalesce(sum(length(text) + {TURN_COST}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cost_before
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, name, text)
), v AS (
  SELECT o.conv_id, p.speaker, o.turn, o.name, o.text, nth, CAST(floor(cost_before / {WINDOW_COST}) AS BIGINT) AS window_no,
         CASE WHEN name = 'system' THEN '{OPEN}system' || chr(10) WHEN name = speaker THEN '{OPEN}assistant' || chr(10)
              ELSE '{OPEN}user{NAME}' || regexp_replace(regexp_replace(name, '<(\\*)\|', '<\\\1|', 'g'), '[\r\n]', ' ', 'g') || chr(10) END AS head,
         text || '{CLOSE.strip()}' || chr(10) AS body
  FROM o JOIN p ON o.conv_id IS NOT DISTINCT FROM p.conv_id
), w AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, window_no ORDER BY nth
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM v
)
SELECT conv_id, speaker, window_no, CAST(min(nth) AS BIGINT) AS first_turn, count(*) AS n_turns, count(*) FILTER (name = speaker) AS n_target_turns,
       string_agg(head || body, '' ORDER BY nth) AS text,
       coalesce(string_agg(CASE WHEN name = speaker THEN CAST(CAST(before + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(before + length(head) + length(body) AS BIGINT) AS VARCHAR) END,
                  ' ' ORDER BY nth), '') AS target_spans,
       CAST(coalesce(sum(length(body)) FILTER (name = speaker), 0) AS BIGINT) AS n_target_chars
FROM w GROUP BY conv_id, speaker, window_no
"""
