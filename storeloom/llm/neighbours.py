"""Approximate nearest neighbours by inner product: multiprobe hashing with p-stable projections.

Vectors get one more component, so that all have the norm of the longest and the nearest by
distance are those of the largest inner product. Each table hashes a vector to the cells of a few
random projections. A query orders the occupied buckets of a table by the estimated probability
that its k-th nearest vector falls in, and visits them in that order until the probabilities add up
to ``success`` and the buckets hold ``k`` other vectors. The candidates of all tables are merged and
ranked by their exact inner product in double precision.

Each query has a distance of its own: that of the k-th nearest is estimated on a bounded sample in
which equal vectors count once, so a group of copies shortens the way of its own members only. If
the sample is too thin for it, the estimate is too far rather than too near, and the query reads
more. Every vector is hashed, and no bucket is cut:
buckets are packed into shards of bounded rows, a bucket larger than a shard is dealt over several
by id, and queries meet a shard in blocks of bounded size. A task so holds one block of each side.

Nulls and empties: vectors that are null, all zero, or hold null or non-finite components take no
part, nor do rows with a null id or of another length than most (the longer on a tie). Rows that
repeat an id count once, by the lowest vector. Ties go to the smaller id. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import settled

TABLES = 2
SUCCESS = 0.75
# Documented bounds: the sample for the distance, and buckets of a table; with more the cells
# are widened.
SAMPLE = 2000
MAX_BUCKETS = 20_000
QUERY_ROWS = 4096
STEP = 256
# Candidates that a task keeps before it drops those that others have passed: 12 MB.
KEPT = 1 << 19


def _normal(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution function."""
    return 0.5 * (1 + np.array([math.erf(v / math.sqrt(2)) for v in x]))


class Table:
    """One table: projections, cells, and the occupied buckets."""

    def __init__(self, seed: int, dim: int, hashes: int, width: float, longest: float):
        rng = np.random.default_rng(seed)
        self.axes = rng.standard_normal((dim + 1, hashes))
        self.shift = rng.uniform(0, 1, hashes)
        self.width, self.longest = width, longest

    def places(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        """Projections in cells. The added component of data fills the norm up; a query's is 0."""
        norms = (vectors**2).sum(axis=1)
        extra = np.sqrt(np.maximum(0, self.longest**2 - norms)) if data else np.zeros(len(vectors))
        return (vectors @ self.axes[:-1] + extra[:, None] * self.axes[-1]) / self.width + self.shift

    def codes(self, vectors: np.ndarray) -> list[str]:
        return [",".join(map(str, c)) for c in np.floor(self.places(vectors, True)).astype(int)]

    def occupy(self, counts: dict[str, int]) -> None:
        names = sorted(counts)
        self.number = {name: i for i, name in enumerate(names)}
        self.sizes = np.array([counts[name] for name in names])
        self.cells = np.array([list(map(int, n.split(","))) for n in names])

    def visits(self, place: np.ndarray, distance: float, success: float, k: int) -> np.ndarray:
        """Buckets in estimated success order, as many as reach ``success`` and hold ``k`` vectors
        besides the query's own."""
        chance = np.ones(len(self.cells))
        for i, at in enumerate(place):
            cells, which = np.unique(self.cells[:, i], return_inverse=True)
            low = (cells - at) * self.width / distance
            chance *= (_normal(low + self.width / distance) - _normal(low))[which]
        order = np.argsort(-chance, kind="stable")
        likely = np.searchsorted(np.cumsum(chance[order]), success)
        return order[: max(likely, np.searchsorted(np.cumsum(self.sizes[order]), k + 1)) + 1]


def _matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the vectors that take part."""
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).where(
        "vec_id is not null and e is not null"
        " and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(e, x -> x <> 0)"
    )
    plain = plain.groupBy("vec_id").agg(F.min("e").alias("e"))
    lengths = plain.groupBy(F.size("e").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    return plain.where(F.size("e") == (most.n if most else 0))


def _packed(rows: DataFrame) -> DataFrame:
    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return vectors.map(lambda v: np.asarray(v, np.float64).tobytes())

    return rows.select("vec_id", pack("e").alias("v"))


class Distances:
    """Distance, with the norm filled up, of the k-th nearest of ``total`` vectors to a query."""

    def __init__(self, sample: np.ndarray, total: int, k: int, longest: float):
        self.sample, self.longest = np.unique(sample, axis=0), longest
        # So many sampled vectors are to be within, besides the query's own: k if every row is
        # sampled, else the expected number and two deviations, as chance may sample more of them.
        among = k * len(sample) / max(1, total)
        self.within = 1 + (k if len(sample) >= total else math.ceil(among + 2 * math.sqrt(among)))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        found = [self._of(vectors[i : i + STEP]) for i in range(0, len(vectors), STEP)]
        return np.concatenate(found) if found else np.empty(0)

    def _of(self, vectors: np.ndarray) -> np.ndarray:
        squares = self.longest**2 + (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ self.sample.T
        at = min(self.within, squares.shape[1]) - 1
        return np.sqrt(np.maximum(1e-12, np.partition(squares, at, axis=1)[:, at]))


def _coded(rows: DataFrame, tables: list[Table]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch["v"].tolist())
                for i, table in enumerate(tables):
                    yield pd.DataFrame(
                        {"t": i, "code": table.codes(vectors), "vec_id": batch["vec_id"], "v": batch["v"]}
                    )

    return rows.mapInPandas(run, "t int, code string, vec_id bigint, v binary")


class Block:
    """Some queries, with a bit for each bucket of each table that they visit."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, visited: list[np.ndarray]):
        self.ids, self.vectors, self.visited = ids, vectors, visited

    def visiting(self, table: int, bucket: int) -> np.ndarray:
        """Numbers of the queries that visit a bucket."""
        return np.flatnonzero(self.visited[table][:, bucket >> 3] >> (7 - (bucket & 7)) & 1)


class Best:
    """The ``k`` best rows of each query so far. Others are dropped from time to time."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.least = np.full(len(block.ids), -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, asking: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        for start in range(0, len(asking), STEP):
            part = asking[start : start + STEP]
            scores = self.block.vectors[part] @ vectors.T
            # The product may differ from the score in the last places.
            least = self.least[part]
            near = scores >= np.where(np.isfinite(least), least - 1e-9 * (1 + np.abs(least)), least)[:, None]
            query, row = np.nonzero(near)
            query = part[query]
            other = self.block.ids[query] != ids[row]
            query, row = query[other], row[other]
            exact = np.einsum("ij,ij->i", self.block.vectors[query], vectors[row])
            self.parts.append((query, ids[row], exact))
            self.held += len(query)
            if self.held > KEPT:
                self.shrink()

    def shrink(self) -> None:
        query, ids, scores = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        new = np.ones(len(query), bool)  # a row may be met in each table
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, scores = query[new], ids[new], scores[new]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        last = place == self.k - 1
        self.least[query[last]] = scores[last]
        self.parts = [(query[kept], ids[kept], scores[kept])]
        self.held = int(kept.sum())

    def found(self) -> pd.DataFrame:
        if self.parts:
            self.shrink()
        query, ids, scores = self.parts[0] if self.parts else (np.zeros(0, np.int64),) * 3
        return pd.DataFrame({"query_id": self.block.ids[query], "vec_id": ids, "score": scores})


def nearest(
    vectors: DataFrame, is_query, k: int = 20, tables: int = TABLES, success: float = SUCCESS
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for rows of ``is_query``."""
    rows = settled(_packed(usable(vectors)), "vectors")
    spark = vectors.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sampled = _matrix(sample["v"].tolist())
    total = rows.count()

    @F.pandas_udf("double")
    def norm(packed: pd.Series) -> pd.Series:
        return pd.Series(np.sqrt((_matrix(packed.tolist()) ** 2).sum(axis=1)) if len(packed) else [])

    longest = rows.agg(F.max(norm("v")).alias("n")).first().n
    distances = Distances(sampled, total, k, longest)
    # About a thousand rows a bucket, but at least four projections.
    hashes = max(4, round(math.log(max(1, total / 1000), 4)))
    width = 1.5 * longest
    while True:
        made = [Table(i, sampled.shape[1], hashes, width, longest) for i in range(tables)]
        # Rows of a bucket lie together in each partition, so that a task meets it few times.
        coded = settled(_coded(rows, made).sortWithinPartitions("t", "code"), "coded")
        counts = coded.groupBy("t", "code").count().limit(tables * MAX_BUCKETS + 1).collect()
        if len(counts) <= tables * MAX_BUCKETS:
            break
        width *= 2
    for i, table in enumerate(made):
        table.occupy({r.code: r["count"] for r in counts if r.t == i})
    queries = rows.where(is_query)
    blocks = -(-queries.count() // QUERY_ROWS)
    shared = spark.sparkContext.broadcast(made)
    known = spark.sparkContext.broadcast(distances)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch["v"].tolist())
            far = known.value.of(matrix)
            for t, table in enumerate(shared.value):
                bits = np.zeros((len(batch), len(table.cells)), bool)
                for i, place in enumerate(table.places(matrix, False)):
                    bits[i, table.visits(place, far[i], success, k)] = True
                packed = [b.tobytes() for b in np.packbits(bits, axis=1)]
                yield pd.DataFrame(
                    {"t": t, "vec_id": batch["vec_id"], "v": batch["v"], "visited": packed}
                )

    found = []
    for block in range(blocks):
        asked = queries.where(f"pmod(xxhash64(vec_id), {blocks}) = {block}")
        asked = asked.mapInPandas(probe, "t int, vec_id bigint, v binary, visited binary").toPandas()
        asked = asked.sort_values(["t", "vec_id"])
        first = asked[asked["t"] == 0]
        visited = [
            np.array([np.frombuffer(b, np.uint8) for b in asked["visited"][asked["t"] == t]])
            for t in range(tables)
        ]
        if not len(first):
            continue
        ids, matrix = first["vec_id"].to_numpy(), _matrix(first["v"].tolist())
        found.append(_block_best(coded, spark.sparkContext.broadcast(Block(ids, matrix, visited)), shared, k))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    best = reduce(DataFrame.union, found).groupBy("query_id", "vec_id")
    order = "row_number() over (partition by query_id order by score desc, vec_id) as rank"
    ranked = best.agg(F.max("score").alias("score")).selectExpr("query_id", order, "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def _block_best(coded: DataFrame, block, tables, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best rows of each task for the queries of a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(block.value, k)
        for batch in batches:
            for (t, code), rows in batch.groupby(["t", "code"], sort=False):
                asking = block.value.visiting(t, tables.value[t].number[code])
                if len(asking):
                    best.add(asking, rows["vec_id"].to_numpy(), _matrix(rows["v"].tolist()))
        yield best.found()

    return coded.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
