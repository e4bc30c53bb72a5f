"""Hard negatives by Fagin's threshold algorithm, on integer inner products.

Vectors become integers, floor(256 * x) per component. For an anchor, the rows of its label with the
highest scores are its positives; each positive opens a window of scores, a share of its own, in which
the highest rows of another label are its negatives.

Rows are dealt into shards, and a shard keeps for each dimension the list of its rows sorted by that
component. An anchor reads the lists of its dimensions in step: from the top where its component is
positive, from the bottom where it is negative; a zero reads none. Every row met is scored on its whole
vector. The values last read, times the anchor's components, add up to a threshold that no row unread
can pass. Reading stops once it lies strictly below the k-th score of each window, or below the
window's floor; a tie could still hold a smaller id. What a task has found in one shard sets the bar in
its next one.

Scale: the lists are built once, and nothing but the best rows of each task is moved. Anchors go in
blocks of bounded size, which are broadcast; shards and anchors that meet hold so many rows and no
more, whatever share of them are copies or of one label.

Nulls and empties: rows take no part if their id, label or vector is null, if a component is null or not
finite, or if the vector is not as long as most (the longer on a tie). Rows that repeat an id count
once, by the lowest label and vector. Ties go to the smaller id. A positive of negative score has an
empty window. An empty table gives an empty result. Vectors whose scores don't fit 64 bits fail. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import settled

SCALE = 256
# Rows of a shard, and anchors that are sent to the tasks at once.
SHARD_ROWS = 4096
ANCHORS = 4096
# Rows read from each list before the threshold is looked at; four times as many each time.
FIRST_DEPTH = 64


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v array<bigint>) of the rows that take part."""
    plain = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("e"),
    ).where(
        "vec_id is not null and label is not null and e is not null"
        " and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    whole = F.transform("e", lambda x: F.floor(x * SCALE).cast("bigint")).alias("v")
    one = plain.groupBy("vec_id").agg(F.min(F.struct("label", "e")).alias("r"))
    one = one.select("vec_id", "r.*").select("vec_id", "label", whole)
    lengths = one.groupBy(F.size("v").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    return one.where(F.size("v") == (most.n if most else 0))


# --- shards ------------------------------------------------------------------------------------

SHARD = "ids binary, labels binary, values binary, lists binary"


def _shards(rows: DataFrame, total: int) -> DataFrame:
    """A row per shard: its rows, and per dimension their order from the highest component down."""
    spark = rows.sparkSession
    parts = min(
        -(-total // SHARD_ROWS), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    )

    def run(batches):
        held: list[pd.DataFrame] = []

        def shard(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("vec_id")
            values = np.array(part["v"].tolist(), np.int64).reshape(len(part), -1)
            lists = np.argsort(-values, axis=0, kind="stable").T.astype(np.int32)
            found = (part["vec_id"].to_numpy(), part["label"].to_numpy(), values, lists)
            names = ("ids", "labels", "values", "lists")
            return pd.DataFrame({n: [f.tobytes()] for n, f in zip(names, found)})

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= SHARD_ROWS:
                rows = pd.concat(held)
                yield shard(rows[:SHARD_ROWS])
                held = [rows[SHARD_ROWS:]]
        rows = pd.concat(held) if held else ()
        if len(rows):
            yield shard(rows)

    return rows.repartition(max(1, parts), "vec_id").mapInPandas(run, SHARD)


class Shard:
    def __init__(self, row):
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        self.values = np.frombuffer(row.values, np.int64).reshape(len(self.ids), -1)
        self.lists = np.frombuffer(row.lists, np.int32).reshape(-1, len(self.ids))
        # Doubles hold the scores exactly below 2**53, and are multiplied much faster.
        self.largest = int(np.abs(self.values).max(initial=0))
        self.floats = self.values.astype(np.float64)

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        bound = self.largest * int(np.abs(anchor).sum())
        if bound >= 1 << 63:
            raise OverflowError("scores of these vectors do not fit 64 bits")
        values = self.floats if bound < 1 << 53 else self.values
        # Rows are copied to be picked, so for many it is cheaper to pick their scores.
        if 8 * len(rows) > len(self.ids):
            return (values @ anchor.astype(values.dtype))[rows].astype(np.int64)
        return (values[rows] @ anchor.astype(values.dtype)).astype(np.int64)

    def read(
        self, anchor: np.ndarray, wanted: np.ndarray, done, found: Ranked, *, first: int = FIRST_DEPTH
    ) -> Ranked:
        """Reads the lists until ``done`` (threshold, found) says so or no row is left. Adds the
        rows met for which ``wanted`` holds to those ``found`` in other shards."""
        n, depth, last = len(self.ids), 0, first
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        left = np.ones(n, bool)
        while left.any():
            last = min(last, n)
            met = np.zeros(n, bool)
            met[self.lists[up, depth:last].ravel()] = True
            met[self.lists[down, n - last : n - depth].ravel()] = True
            if last == n:
                met[:] = True  # also what an anchor of zeros reads from no list
            rows = np.flatnonzero(met & left & wanted)
            left &= ~met
            found = found.with_(self.scores(anchor, rows), self.ids[rows])
            high = self.values[self.lists[up, last - 1], up]
            low = self.values[self.lists[down, n - last], down]
            if done(int(high @ anchor[up] + low @ anchor[down]), found):
                break
            depth, last = last, 4 * last
        return found


class Ranked:
    """Scores from the highest down, and the ids of their rows. Ties are in no order."""

    def __init__(self, scores: np.ndarray, ids: np.ndarray):
        order = np.argsort(-scores)
        self.scores, self.ids = scores[order], ids[order]

    def with_(self, scores: np.ndarray, ids: np.ndarray) -> Ranked:
        return Ranked(np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]))

    def place(self, high: int) -> int:
        """Rows that score more."""
        return int(np.searchsorted(-self.scores, -high))

    def best(self, k: int, high: int, low: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` first of those that score from ``low`` to ``high``, ties by the smaller id."""
        first, end = self.place(high), self.place(low - 1)
        if end - first > k:
            end = self.place(int(self.scores[first + k - 1]) - 1)
        scores, ids = self.scores[first:end], self.ids[first:end]
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]


NOTHING = Ranked(np.zeros(0, np.int64), np.zeros(0, np.int64))
LOWEST, HIGHEST = -(1 << 62), 1 << 62


# --- anchors -----------------------------------------------------------------------------------


class Positives:
    """The ``k`` rows of the anchor's label with the highest scores."""

    def __init__(self, k: int):
        self.k = k

    def find(self, shard: Shard, anchor: tuple, found: Ranked) -> Ranked:
        own, label, vector, _ = anchor

        def done(threshold: int, found: Ranked) -> bool:
            return len(found.scores) >= self.k and threshold < found.scores[self.k - 1]

        same = (shard.labels == label) & (shard.ids != own)
        return Ranked(*shard.read(vector, same, done, found).best(self.k, HIGHEST, LOWEST))


class Negatives:
    """The ``k`` highest rows of another label in each of the anchor's windows (low, high)."""

    def __init__(self, k: int):
        self.k = k

    def find(self, shard: Shard, anchor: tuple, found: Ranked) -> Ranked:
        own, label, vector, windows = anchor
        windows = [(low, high) for low, high in windows if low <= high]
        if not windows:
            return found

        def settled_(threshold: int, found: Ranked, low: int, high: int) -> bool:
            last = found.place(high) + self.k - 1
            kth = found.scores[last] if last < len(found.scores) else LOWEST
            return threshold < max(low, kth)

        def done(threshold: int, found: Ranked) -> bool:
            return all(settled_(threshold, found, low, high) for low, high in windows)

        other = (shard.labels != label) & (shard.ids != own)
        found = shard.read(vector, other, done, found)
        parts = [found.best(self.k, high, low) for low, high in windows]
        scores, ids = (np.concatenate(c) for c in zip(*parts))
        ids, first = np.unique(ids, return_index=True)
        return Ranked(scores[first], ids)


def _best(shards: DataFrame, anchors: list[tuple], goal) -> DataFrame:
    """(anchor_id, vec_id, score) of what ``goal`` finds, per task."""
    shared = shards.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        held = [NOTHING] * len(shared.value)
        for batch in batches:
            for row in batch.itertuples():
                shard = Shard(row)
                held = [goal.find(shard, a, h) for a, h in zip(shared.value, held)]
        yield pd.DataFrame(
            {
                "anchor_id": np.repeat([a[0] for a in shared.value], [len(h.ids) for h in held]),
                "vec_id": np.concatenate([NOTHING.ids, *[h.ids for h in held]]),
                "score": np.concatenate([NOTHING.scores, *[h.scores for h in held]]),
            }
        )

    return shards.mapInPandas(run, "anchor_id bigint, vec_id bigint, score bigint")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the negatives
    whose score is ``low`` to ``high`` per cent of the positive's."""
    spark = vectors.sparkSession
    rows = settled(usable(vectors), "usable")
    total = rows.count()
    shards = settled(_shards(rows, total), "shards")
    asked = rows.where(is_anchor)
    blocks = -(-asked.count() // ANCHORS)
    found = []
    for block in range(blocks):
        mine_ = asked.where(f"pmod(xxhash64(vec_id), {blocks}) = {block}").toPandas()
        anchors = [
            (r.vec_id, r.label, np.array(r.v, np.int64), []) for r in mine_.itertuples()
        ]
        rank = "row_number() over (partition by anchor_id order by score desc, vec_id) as place"
        near = _best(shards, anchors, Positives(positives)).selectExpr("*", rank)
        near = near.where(F.col("place") <= positives).selectExpr(
            "anchor_id", "vec_id as positive_id", "score as positive_score"
        )
        near = settled(near, "positives")
        # At most so many rows per anchor of the block.
        windows: dict[int, list] = {}
        for r in near.select("anchor_id", "positive_score").distinct().collect():
            window = -(-low * r.positive_score // 100), high * r.positive_score // 100
            windows.setdefault(r.anchor_id, []).append(window)
        anchors = [(i, l, v, windows.get(i, [])) for i, l, v, _ in anchors]
        far = _best(shards, anchors, Negatives(negatives)).selectExpr(
            "anchor_id", "vec_id as negative_id", "score as negative_score"
        )
        within = (
            f"{low} * positive_score <= 100 * negative_score"
            f" and 100 * negative_score <= {high} * positive_score"
        )
        order = "partition by anchor_id, positive_id order by negative_score desc, negative_id"
        met = near.join(far, "anchor_id").where(within)
        met = met.selectExpr("*", f"row_number() over ({order}) as rank")
        found.append(met.where(F.col("rank") <= negatives))
    names = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    if not found:
        kinds = [f"{n} {'int' if n == 'rank' else 'bigint'}" for n in names]
        return spark.createDataFrame([], ", ".join(kinds))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select(*names)
