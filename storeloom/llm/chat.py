"""Chat formatting by perspective rotation.

A dialogue is rendered once for every participant: that speaker's turns as the assistant's, all
others as turns of users named for their speakers. The mask tells which characters a model is to
learn: what the participant says, with the mark that ends the turn. Every participant gets every
turn, also one who says little.

Turns follow by number, then by speaker and text; a dialogue is one text. Only one of more than
``MOST_ROWS`` turns is cut, into parts of so many turns in order, and each part is rendered for
every participant of the dialogue: a text doesn't outgrow a task, however long a dialogue is.

The parts follow from places in the order of the turns, counted by ranges of that order over many
tasks; equal turns are counted together, so which of them comes first decides nothing. Ranges part
turns by number, speaker and the start of the text, ``RANGE_CHARS`` characters.

Nulls and empties: turns without speaker are of the speaker ``unknown``, a null text is empty and
is rendered; turns without number come first; a null conversation id is an id like others. Rows that
repeat are turns of their own. Other columns are not read; an empty table gives no rows. A mark
inside a text is broken up by a blank, so it cannot end a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import stored

MOST_ROWS = 1024
RANGE_CHARS = 256
# The marks of a turn.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _runs(rows: DataFrame) -> DataFrame:
    """Equal turns of each dialogue by run of ``MOST_ROWS`` turns: their part and copies."""
    alike = rows.groupBy("conv_id", "turn", "speaker", "said").agg(F.count("*").alias("n"))
    start = F.substring("said", 1, RANGE_CHARS)
    ranges = alike.repartitionByRange("conv_id", "turn", "speaker", start)
    turns = stored(ranges.withColumn("place", F.spark_partition_id()), "turns")
    before = (
        turns.groupBy("conv_id", "place")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            "conv_id as c", "place as p", "sum(n) over (partition by conv_id order by place"
            " rows between unbounded preceding and current row) - n as earlier",
        )
    )
    within = (
        "sum(n) over (partition by place, conv_id order by turn, speaker, said"
        " rows between unbounded preceding and current row) - n as at"
    )
    return (
        turns.selectExpr("*", within)
        .join(before.hint("rebalance"), F.expr("conv_id <=> c and place = p"))
        .withColumn("at", F.expr("at + earlier"))
        .withColumn(
            "part", F.expr(f"explode(sequence(at div {MOST_ROWS}, (at + n - 1) div {MOST_ROWS}))")
        )
        .selectExpr(
            "conv_id", "part", "turn", "speaker", "said",
            f"cast(least(at + n, (part + 1) * {MOST_ROWS}) - greatest(at, part * {MOST_ROWS}) as int)"
            " as copies",
        )
    )


def _together(turns: DataFrame) -> DataFrame:
    """The turns of each part, in order, each as often as it has copies."""
    grouped = turns.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "said", "copies"))).alias("turns")
    )
    return grouped.withColumn(
        "turns", F.expr("flatten(transform(turns, t -> array_repeat(t, t.copies)))")
    )


def perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, part, speaker, n_turns, text, mask) for rows conv_id, turn, role, text.

    ``mask`` lists (start, end) in code points of the text, ends exclusive.
    """
    rows = turns.selectExpr(
        "conv_id",
        "turn",
        "coalesce(role, 'unknown') as speaker",
        f"replace(replace(coalesce(text, ''), '{BEGIN}', '< |im_start|>'), '{END}', '< |im_end|>')"
        " as said",
    )
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("n_rows"))
    large = counts.where(f"n_rows > {MOST_ROWS}").withColumnRenamed("conv_id", "c")
    marked = rows.join(large.hint("rebalance"), F.expr("conv_id <=> c"), "left")
    short = marked.where("n_rows is null").selectExpr(
        "conv_id", "0L as part", "turn", "speaker", "said", "1 as copies"
    )
    short = _together(short).withColumn("speaker", F.explode(F.array_distinct("turns.speaker")))
    cut = marked.where("n_rows is not null").drop("c", "n_rows")
    heard = cut.selectExpr("conv_id as c", "speaker").distinct()
    long = _together(_runs(cut)).join(heard.hint("rebalance"), F.expr("conv_id <=> c"))
    rotated = short.union(long.select(*short.columns))
    own = "t.speaker = speaker"
    head = f"if({own}, '{BEGIN}assistant\\n', concat('{BEGIN}user name=', t.speaker, '\\n'))"
    pieces = f"transform(turns, t -> struct({own} as own, {head} as head, concat(t.said, '{END}') as body))"
    # Lengths so far, and the spans of the participant's own turns.
    spans = (
        "aggregate(pieces, struct(0L as at, cast(array() as array<struct<start: bigint, end: bigint>>)"
        " as spans), (a, p) -> struct(a.at + length(p.head) + length(p.body) + 1L as at, if(p.own,"
        " concat(a.spans, array(struct(a.at + length(p.head) as start,"
        " a.at + length(p.head) + length(p.body) as end))), a.spans) as spans), a -> a.spans)"
    )
    return rotated.withColumn("pieces", F.expr(pieces)).selectExpr(
        "conv_id",
        "part",
        "speaker",
        "cast(size(turns) as bigint) as n_turns",
        "array_join(transform(pieces, p -> concat(p.head, p.body, '\\n')), '') as text",
        f"{spans} as mask",
    )
