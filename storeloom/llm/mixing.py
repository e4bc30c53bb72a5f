"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Each source has a weight schedule over training time 0..1, linear between knots. Its integral is
the source's weight: all sources share a budget of ``share`` times all words by weight, but a
source stops at ``most`` times its own words, and what it leaves is shared again by weight among
the others until none is above.

Within a source, documents follow each other in an order given by a hash, again and again, until
the target is used up; the last document is cut there. A word's place in that row is its source's
cumulative demand, and the time at which the schedule's integral reaches it is its training
position. Rows are range-sorted by the position of their first word.

A source may hold any share of the rows: its documents are dealt by hash into buckets of bounded
rows, bucket sums are added up first, and only the rows of one bucket are numbered together.

Nulls and empties: a null text has size 0; documents of size 0 are taken 0 times and have no
position, as are those the mix does not reach. A null source is a source of its own and sorts
last. Rows that repeat are documents of their own. An empty table gives an empty result. Of other
columns none is read, and ``mixed_copies`` hands on all but those named like its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import columns, settled

Schedule = Sequence[tuple[float, float]]

# Integrals 3, 1 and 2: even, rising from half to one and a half, falling from three to one.
SCHEDULES: list[Schedule] = [
    [(0.0, 3.0), (1.0, 3.0)],
    [(0.0, 0.5), (1.0, 1.5)],
    [(0.0, 3.0), (1.0, 1.0)],
]
BUCKET_ROWS = 4096
WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def _segments(schedule: Schedule) -> str:
    """SQL array of the parts of a schedule: start, length, weight at both ends, share before."""
    total, before, parts = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area = (t1 - t0) * (w0 + w1) / 2 / total
        parts.append(
            f"named_struct('t', {t0!r}D, 'dt', {t1 - t0!r}D, 'w0', {w0 / total!r}D, "
            f"'w1', {w1 / total!r}D, 'low', {before!r}D, 'high', {before + area!r}D)"
        )
        before += area
    return f"array({', '.join(parts)})"


def _time_of(share: str) -> str:
    """Training time at which the schedule has handed out ``share`` of its integral.

    Within a part the integral is w0 x + (w1 - w0) x² / 2 over its length; this is its root in the
    form that does not cancel.
    """
    part = f"coalesce(get(filter(segments, s -> {share} < s.high), 0), element_at(segments, -1))"
    rest = f"greatest(0D, {share} - p.low)"
    root = f"sqrt(greatest(0D, p.w0 * p.w0 + 2 * (p.w1 - p.w0) / p.dt * {rest}))"
    at = f"p.t + coalesce(least(p.dt, 2 * {rest} / nullif(p.w0 + {root}, 0D)), 0D)"
    return f"get(transform(array({part}), p -> {at}), 0)"


def _targets(sources: DataFrame, schedules: list[Schedule], share: float, most: float):
    """One row per source with its target; as many rows as sources pass through one task.

    In the order of size by weight, the first sources are full. With k full ones the others get
    (budget - their words) by weight; k is right if that leaves the next one not full.
    """
    weight = F.element_at(
        F.array(*[F.lit(integral(s)) for s in schedules]), F.col("turn").cast("int")
    )
    segments = F.expr(f"element_at(array({', '.join(map(_segments, schedules))}), cast(turn as int))")
    ranked = sources.withColumn(
        "turn", F.expr(f"(row_number() over (order by source nulls last) - 1) % {len(schedules)} + 1")
    ).withColumns({"weight": weight, "segments": segments, "full": F.col("source_size") * most})
    rest = "over (order by full / weight, source nulls last rows between unbounded preceding and 1 preceding)"
    level = ranked.withColumns(
        {
            "full_before": F.expr(f"coalesce(sum(full) {rest}, 0D)"),
            "weight_before": F.expr(f"coalesce(sum(weight) {rest}, 0D)"),
            "budget": F.expr(f"sum(source_size) over () * {share!r}D"),
            "weights": F.expr("sum(weight) over ()"),
        }
    ).withColumn("open", F.expr("(budget - full_before) * weight < full * (weights - weight_before)"))
    first = "min(if(open, struct(full_before, weight_before), null)) over ()"
    return level.withColumn("first", F.expr(first)).selectExpr(
        "source", "source_size", "n_docs", "segments", "weight",
        "if(open, (budget - first.full_before) * weight / (weights - first.weight_before), full)"
        " as target",
    )


def mix(
    docs: DataFrame,
    schedules: list[Schedule] = SCHEDULES,
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): size, source_size, target, taken, copies, position.

    ``position`` is the training time at which the first copy begins, null if none is taken;
    ``copies`` lists position, epoch and words of each.
    """
    size = F.expr(f"cast(regexp_count(coalesce(text, ''), '{WORD}') as bigint)")
    place = F.xxhash64("doc_id", "text")
    sized = settled(
        docs.select("doc_id", "source", size.alias("size"), place.alias("place")), "sizes"
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    targets = settled(_targets(sources, schedules, share, most), "targets")
    buckets = f"cast(ceil(n_docs / {BUCKET_ROWS}) as bigint)"
    dealt = settled(
        sized.alias("d")
        .join(targets.alias("t"), F.expr("d.source <=> t.source"))
        .selectExpr(
            "doc_id", "d.source", "size", "place", "source_size", "target",
            f"pmod(place, {buckets}) as bucket",
        ),
        "dealt",
    )
    ahead = (
        dealt.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"))
        .selectExpr(
            "source", "bucket",
            "sum(words) over (partition by source order by bucket) - words as ahead",
        )
    )
    within = dealt.selectExpr(
        "*",
        "sum(size) over (partition by source, bucket order by place, doc_id, size"
        " rows between unbounded preceding and current row) - size as inside",
    )
    placed = within.alias("d").join(
        ahead.alias("a"), F.expr("d.source <=> a.source and d.bucket = a.bucket")
    ).join(
        targets.select(F.col("source").alias("of"), "segments").alias("t"),
        F.expr("d.source <=> t.of"),
    )
    rounds = range(int(-(-most // 1)))
    counted = placed.selectExpr(
        "doc_id", "d.source", "size", "source_size", "target", "segments",
        "cast(round(target) as bigint) as whole", "ahead + inside as start",
    )
    taken = [
        f"greatest(0L, least(start + {r} * source_size + size, whole) - (start + {r} * source_size))"
        for r in rounds
    ]
    shares = [f"(start + {r} * source_size) / cast(whole as double)" for r in rounds]
    copies = ", ".join(
        f"if({words} > 0, struct({_time_of(f'({at})')} as position, {r + 1} as epoch, "
        f"{words} as words), null)"
        for r, (words, at) in enumerate(zip(taken, shares))
    )
    return counted.selectExpr(
        "doc_id", "source", "size", "source_size", "target",
        " + ".join(f"({t})" for t in taken) + " as taken",
        f"array_compact(array({copies})) as copies",
    ).withColumn("position", F.expr("get(copies, 0).position")).orderBy(
        F.asc_nulls_last("position"), "doc_id"
    )


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """A row of ``docs`` per copy taken, with epoch, position and words, sorted by position.

    Rows are found by ``doc_id``: those with a null one are not in the mix, and rows that repeat
    one are taken as often as their copies are. A column of ``docs`` that is named like one of the
    three new ones gives way to it.
    """
    named = docs.where("doc_id is not null")
    numbered = named.selectExpr("doc_id", "source", "text")
    plan = mix(numbered, **options).select(F.col("doc_id").alias("of"), F.inline("copies"))
    plan = plan.groupBy("of", "epoch").agg(
        F.min("position").alias("position"), F.min("words").alias("words")
    )
    new = {"mix_epoch": "epoch", "mix_position": "position", "mix_words": "words"}
    rows = named.select(F.col("doc_id").alias("id"), F.struct(*columns(named)).alias("doc"))
    rows = rows.join(plan, F.col("id") == F.col("of")).orderBy("position", "id", "epoch")
    kept = [F.col("doc")[name].alias(name) for name in docs.columns if name not in new]
    return rows.select(*kept, *[F.col(old).alias(name) for name, old in new.items()])
