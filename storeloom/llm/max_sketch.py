"""Ranked lexical search over hashed max-sketches.

- *Sketch.* A document keeps, for each of ``SLOTS`` slots, the largest frequency of the terms that a
  hash sends there. An impact grows with the frequency, so this is the fold of the impacts into
  coordinatewise maxima, and it hangs neither on the queries nor on the corpus: the sketches are an
  index that serves any number of queries. Empty slots take no room.
- *Bounds.* The sketches are read in batches, and all queries look up the slots of their terms at
  once. Each term counts with its own weight and the impact of its slot, which is that of the term
  or more, so the sum is an upper bound of the score.
- *Rescoring.* The documents of the highest bounds are scored exactly, which gives each query a
  threshold: the score of its k-th document. Then every document whose bound reaches the threshold
  is scored. All others are ranked below k.

All numbers but the logarithm are 64-bit integers.

Scale: a sketch pass reads a fraction of the text and moves nothing. Copies of a text share a digest;
of the copies that a query asks for only the ``k`` of the smallest ids can be ranked, and their text
is moved and scored once. Queries go in blocks of bounded size: the terms of a block are broadcast,
never the table. Every step that is used twice is written to the shared folder.

Nulls and empties: a null text has no terms, as an empty one; it is never ranked. A null ``doc_id``
comes before all others of its score. Rows that repeat a document count each and may be ranked each.
Rows that repeat an item and its text are one query, those of one ``item_id`` with different texts are
queries of their own. Items without a term rank nothing. Empty tables give an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import as_bytes, bound_batches, settled
from storeloom.llm.tokens import Chunk, Spelling
from storeloom.llm.words import LOWER

_CODES = np.arange(256)
# Letters and digits of ASCII, and every byte of any other character.
IS_TERM = (
    ((_CODES >= 48) & (_CODES <= 57))
    | ((_CODES >= 65) & (_CODES <= 90))
    | ((_CODES >= 97) & (_CODES <= 122))
    | (_CODES >= 128)
)
TERMS = Spelling(IS_TERM, LOWER)

# A power of two, 65,536 at most.
SLOTS = 1 << 14
# Terms of the queries of one block, and cells that a lookup holds: 8 MB.
BLOCK_TERMS = 1 << 16
CELLS = 1 << 20
# Documents that set the threshold, for each one wanted.
FIRST = 4
# What weighs a document's length, in per cent.
BY_LENGTH = 75


@dataclass
class Counted:
    """Terms of some texts in order: of each text its distinct ones, with how often they occur."""

    texts: range
    sizes: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    @property
    def of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), np.diff(self.bounds))


def _summed(of: np.ndarray, terms: np.ndarray, counts: np.ndarray):
    order = np.lexsort((terms, of))
    of, terms = of[order], terms[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (terms[1:] != terms[:-1])
    first = np.flatnonzero(new)
    return of[new], terms[new], np.add.reduceat(counts[order], first) if len(of) else counts


def counted(texts: list[bytes]) -> Iterator[Counted]:
    for numbers, chunks in groupby(TERMS.chunks(texts), key=lambda c: c.texts):
        parts, sizes = [], np.zeros(len(numbers), np.int64)
        for chunk in chunks:
            sizes += np.diff(chunk.bounds)
            parts.append(_summed(*_words(chunk)))
        of, terms, counts = (np.concatenate(c) for c in zip(*parts))
        if len(parts) > 1:
            of, terms, counts = _summed(of, terms, counts)
        bounds = np.searchsorted(of, np.arange(len(numbers) + 1))
        yield Counted(numbers, sizes, bounds, terms, counts)


def _words(chunk: Chunk):
    of = np.repeat(np.arange(len(chunk.bounds) - 1), np.diff(chunk.bounds))
    return of, TERMS.hashes(chunk), np.ones(len(of), np.int64)


def _slots(terms: np.ndarray, slots: int) -> np.ndarray:
    return (terms >> np.uint64(65 - slots.bit_length())).astype(np.int64)


# --- sketches ----------------------------------------------------------------------------------

SKETCH = "doc_id bigint, digest string, n bigint, slots binary, most binary"


def _named(docs: DataFrame) -> DataFrame:
    body = as_bytes()
    return docs.select("doc_id", F.md5(body).alias("digest"), body.alias("body"))


def sketches(docs: DataFrame, among: int = SLOTS) -> DataFrame:
    """(doc_id, digest, n, slots, most) of each text with a term: its slots in use, of ``among``
    (uint16), and the largest frequency in each (uint32)."""

    def run(batches):
        for batch in batches:
            out = {"n": [], "slots": [], "most": []}
            for part in counted(batch.column("body").to_pylist()):
                of, slots = part.of, _slots(part.terms, among)
                order = np.lexsort((part.counts, slots, of))
                of, slots, counts = of[order], slots[order], part.counts[order]
                last = np.ones(len(of), bool)
                last[:-1] = (of[1:] != of[:-1]) | (slots[1:] != slots[:-1])
                of, slots = of[last], slots[last].astype(np.uint16)
                counts = np.minimum(counts[last], 0xFFFFFFFF).astype(np.uint32)
                ends = np.searchsorted(of, np.arange(len(part.sizes) + 1))
                out["n"] += part.sizes.tolist()
                for a, b in zip(ends[:-1], ends[1:]):
                    out["slots"].append(slots[a:b].tobytes())
                    out["most"].append(counts[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(out["n"], pa.int64()),
                    pa.array(out["slots"], pa.binary()),
                    pa.array(out["most"], pa.binary()),
                ],
                ["doc_id", "digest", "n", "slots", "most"],
            )

    return _named(docs).mapInArrow(run, SKETCH).where("n > 0")


# --- queries -----------------------------------------------------------------------------------


@dataclass
class Queries:
    """A block of queries: for each its terms as places in ``vocabulary``, with how often they
    occur; ``weights`` and the totals of the corpus once they are known."""

    vocabulary: np.ndarray
    begin: np.ndarray
    places: np.ndarray
    times: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    words: int = 0

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        """What the length of a document adds below the line; in Python's integers, as the product
        may pass 64 bits."""
        known, which = np.unique(sizes, return_inverse=True)
        m = [
            100 - BY_LENGTH + BY_LENGTH * int(n) * self.documents // self.words for n in known
        ]
        return np.array(m, np.int64)[which]

    def sums(self, impacts: np.ndarray) -> np.ndarray:
        """Scores by document and query from impacts by document and place."""
        value = impacts[:, self.places]
        value *= self.weights[self.places] * self.times
        return np.add.reduceat(value, self.begin, axis=1)


def impact(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 8 * lengths)


def _weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _query_terms(items: DataFrame) -> DataFrame:
    """(item_id, digest, terms, times) of each query with a term."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = {"terms": [], "times": []}
            for part in counted(batch.column("body").to_pylist()):
                for a, b in zip(part.bounds[:-1], part.bounds[1:]):
                    found["terms"].append(part.terms[a:b].tobytes())
                    found["times"].append(part.counts[a:b].tobytes())
            columns = [pa.array(c, pa.binary()) for c in found.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("digest"), *columns],
                ["item_id", "digest", *found],
            )

    body = as_bytes()
    rows = items.select("item_id", F.md5(body).alias("digest"), body.alias("body"))
    rows = rows.dropDuplicates(["item_id", "digest"])
    found = rows.mapInArrow(run, f"item_id {kind}, digest string, terms binary, times binary")
    return found.where("octet_length(terms) > 0")


def _block(rows: list) -> Queries:
    terms = [np.frombuffer(r.terms, np.uint64) for r in rows]
    times = np.concatenate([np.frombuffer(r.times, np.int64) for r in rows])
    vocabulary, places = np.unique(np.concatenate(terms), return_inverse=True)
    begin = np.cumsum([0] + [len(t) for t in terms[:-1]])
    return Queries(vocabulary, begin, places, times)


def _documents_with(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """The number of documents that hold each term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total = np.zeros(len(known.value), np.int64)
        for batch in batches:
            for part in counted(batch.column(0).to_pylist()):
                at = np.searchsorted(known.value, part.terms)
                at = np.minimum(at, len(known.value) - 1)
                at = at[known.value[at] == part.terms]
                total += np.bincount(at, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "n"])

    counts = docs.select(as_bytes().alias("body")).mapInArrow(run, "place bigint, n bigint")
    out = np.zeros(len(vocabulary), np.int64)
    for row in counts.groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[row.place] = row.n
    known.destroy()
    return out


# --- lookup ------------------------------------------------------------------------------------

ASKED = "query int, doc_id bigint, digest string, bound bigint"


def _lookup(
    index: DataFrame, among: int, shared, least: np.ndarray | None, most: int = 0
) -> DataFrame:
    """(query, doc_id, digest, bound). With ``least``, all whose bound reaches the query's; without,
    the ``most`` highest of a task."""

    def bounds(queries: Queries, batch) -> Iterator[tuple[int, np.ndarray]]:
        slots, columns = np.unique(_slots(queries.vocabulary, among), return_inverse=True)
        column = np.full(among, len(slots))
        column[slots] = np.arange(len(slots))
        sizes = batch.column("n").to_numpy()
        lengths = queries.lengths(sizes)
        step = max(1, CELLS // max(len(queries.places), len(slots)))
        found = [batch.column(c).to_pylist() for c in ("slots", "most")]
        for at in range(0, len(sizes), step):
            packed = [c[at : at + step] for c in found]
            of = np.repeat(np.arange(len(packed[0])), [len(s) // 2 for s in packed[0]])
            here = column[np.frombuffer(b"".join(packed[0]), np.uint16)]
            counts = np.frombuffer(b"".join(packed[1]), np.uint32).astype(np.int64)
            wanted = here < len(slots)
            of, here, counts = of[wanted], here[wanted], counts[wanted]
            impacts = np.zeros((len(packed[0]), len(slots)), np.int64)
            impacts[of, here] = impact(counts, lengths[at : at + step][of])
            yield at, queries.sums(impacts[:, columns])

    def run(batches):
        queries: Queries = shared.value
        best: list[tuple] = []
        for batch in batches:
            ids, digests = (batch.column(c) for c in ("doc_id", "digest"))
            for at, value in bounds(queries, batch):
                if least is None:
                    kept = min(most, len(value))
                    doc = np.argpartition(-value, kept - 1, axis=0)[:kept].ravel()
                    query = np.tile(np.arange(value.shape[1]), kept)
                    hit = value[doc, query] > 0
                    doc, query = doc[hit], query[hit]
                else:
                    doc, query = np.nonzero(value >= least)
                rows = pa.array(at + doc)
                best.append((query, value[doc, query], ids.take(rows), digests.take(rows)))
                if least is not None:
                    yield _rows(*best.pop())
            if least is None:
                best = [_highest(best, most)]
        if best:
            yield _rows(*best[0])

    return index.mapInArrow(run, ASKED)


def _highest(best: list[tuple], most: int) -> tuple:
    """Of each query the rows of the highest bounds."""
    query, value = (np.concatenate([b[i] for b in best]) for i in (0, 1))
    ids, digests = (pa.concat_arrays([b[i] for b in best]) for i in (2, 3))
    order = np.lexsort((-value, query))
    ranked = query[order]
    place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
    kept = order[place < most]
    return query[kept], value[kept], ids.take(pa.array(kept)), digests.take(pa.array(kept))


def _rows(query, value, ids, digests) -> pa.RecordBatch:
    columns = [pa.array(query.astype(np.int32)), ids, digests, pa.array(value)]
    return pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "digest", "bound"])


# --- rescoring ---------------------------------------------------------------------------------

SCORED = "query int, doc_id bigint, digest string, copy int, score bigint"


def _scored(docs: DataFrame, asked: DataFrame, shared, k: int) -> DataFrame:
    """(query, doc_id, score) of the documents in ``asked``, of many copies the ``k`` smallest."""
    copy = "row_number() over (partition by query, digest order by doc_id) as copy"
    few = asked.selectExpr("query", "doc_id", "digest", copy).where(F.col("copy") <= k)
    by_text = few.groupBy("digest").agg(
        F.min("doc_id").alias("holder"), F.collect_list(F.struct("query", "doc_id", "copy")).alias("for")
    )
    by_text = settled(by_text.withColumnRenamed("digest", "asked"), "asked")

    def run(batches):
        queries: Queries = shared.value
        for batch in batches:
            bodies = [zstandard.decompress(b) for b in batch.column("body").to_pylist()]
            wanted, digests = batch.column("for").to_pylist(), batch.column("digest").to_pylist()
            out = {n: [] for n in ("query", "doc_id", "digest", "copy", "score")}
            for part in counted(bodies):
                lengths = queries.lengths(part.sizes)
                for i, number in enumerate(part.texts):
                    a, b = part.bounds[i : i + 2]
                    at = np.minimum(np.searchsorted(part.terms[a:b], queries.vocabulary), b - a - 1)
                    held = part.terms[a:b][at] == queries.vocabulary
                    counts = np.where(held, part.counts[a:b][at], 0)
                    scores = queries.sums(impact(counts, lengths[i])[None, :])[0]
                    for one in wanted[number]:
                        for name in ("query", "doc_id", "copy"):
                            out[name].append(one[name])
                        out["digest"].append(digests[number])
                        out["score"].append(int(scores[one["query"]]))
            kinds = dict(zip(out, (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[n]) for n, c in out.items()], list(out)
            )

    texts = _named(docs).mapInArrow(_compressed, "doc_id bigint, digest string, body binary")
    here = (F.col("digest") == F.col("asked")) & F.col("doc_id").eqNullSafe(F.col("holder"))
    found = texts.join(by_text, here).select("digest", "body", "for").mapInArrow(run, SCORED)
    # A row that is repeated brings its text more than once.
    return found.dropDuplicates(["query", "digest", "copy"]).select("query", "doc_id", "score")


def _compressed(batches):
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [packer.compress(b) for b in batch.column("body").to_pylist()]
        yield batch.set_column(2, "body", pa.array(bodies, pa.binary()))


def _best(scored: DataFrame, k: int) -> DataFrame:
    rank = "row_number() over (partition by query order by score desc, doc_id) as rank"
    return scored.where("score > 0").selectExpr("*", rank).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    index: DataFrame | None = None,
    among: int = SLOTS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item. ``index`` are the
    ``sketches`` of ``docs``, of ``among`` slots, where they are kept; else they are made."""
    spark = docs.sparkSession
    bound_batches(spark)
    index = settled(sketches(docs, among), "sketches") if index is None else index
    totals = index.agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    queries = settled(_query_terms(items), "queries")
    kind = items.schema["item_id"].dataType.simpleString()
    size = queries.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    blocks = -(-size // (8 * BLOCK_TERMS))
    found = []
    for block in range(blocks if totals.documents else 0):
        rows = queries.where(f"pmod(xxhash64(item_id, digest), {blocks}) = {block}").collect()
        if not rows:
            continue
        asked = _block(rows)
        asked.documents, asked.words = totals.documents, totals.words
        holding = _documents_with(docs, asked.vocabulary)
        asked.weights = np.array([_weight(totals.documents, int(n)) for n in holding], np.int64)
        shared = spark.sparkContext.broadcast(asked)
        highest = "row_number() over (partition by query order by bound desc) as place"
        first = _lookup(index, among, shared, None, FIRST * k).selectExpr("*", highest)
        first = first.where(F.col("place") <= FIRST * k).drop("place")
        known = _best(_scored(docs, settled(first, "first"), shared, k), k)
        least = np.ones(len(rows), np.int64)
        for row in known.where(F.col("rank") == k).collect():
            least[row.query] = row.score
        rest = settled(_lookup(index, among, shared, least), "candidates")
        best = _best(_scored(docs, rest, shared, k), k)
        names = spark.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {kind}"
        )
        found.append(best.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame(
            [], f"item_id {kind}, rank int, doc_id bigint, score bigint"
        )
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
