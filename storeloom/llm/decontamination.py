"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the test items.

Items and documents are normalised alike (A-Z lower-cased, other ASCII than letters and digits
taken as blanks). Each run of ``window`` item words is a pattern, as is an item of fewer words. A
document is scanned once in its normalised form; the words inside any occurrence are counted, and
their places are given in code points of the original text.

The automaton is sent to the tasks, so its size is bounded: distinct windows are dealt into as many
blocks as keep each near ``BLOCK_WORDS`` of them, however long an item is, and the documents are
scanned once per block. One block is brought to the driver and sent to the tasks at a time. Documents
are never shuffled with one block, and only their hits with more.

Nulls and empties: a null or empty text has no words and no hits; an item without words has no
window. Items without id mark words, but are not listed. Items that share an id are one. Rows
that repeat are scanned each; other columns are not read; empty tables give no rows or no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import as_bytes, map_batches, stored

# Windows of ten words of six bytes: 14 MB.
BLOCK_WORDS = 200_000

# The bytes of words. The others of ASCII are blanks.
WORD_BYTES = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
BLANKS = bytes(b if b in WORD_BYTES else 0x20 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SCAN = "row bigint, doc_id bigint, n_words bigint, hits array<int>, starts array<bigint>, " \
       "ends array<bigint>, items array<bigint>"  # fmt: skip


def normalised(body: bytes) -> list[bytes]:
    return body.lower().translate(BLANKS).split()


def windows_of(body: bytes, window: int) -> set[bytes]:
    """The windows of an item, each framed by blanks."""
    words = normalised(body)
    starts = range(max(1, len(words) - window + 1) if words else 0)
    return {b" " + b" ".join(words[i : i + window]) + b" " for i in starts}


def automaton(found: dict[str, list]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for text, ids in found.items():
        built.add_word(text, (text.count(" ") - 1, ids))
    built.make_automaton()
    return built


def occurrences(built: ahocorasick.Automaton, words: list[bytes]) -> tuple[np.ndarray, set]:
    """Places of the words inside any window, and the ids of the items found."""
    text = b" " + b" ".join(words) + b" "
    ends, lengths, ids = [], [], set()
    for end, (length, of) in built.iter(text.decode("latin-1")):
        ends.append(end)
        lengths.append(length)
        ids.update(of)
    if not ends:
        return np.zeros(0, np.int64), ids
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    after = np.searchsorted(blanks, ends)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, after - np.array(lengths), 1)
    np.add.at(depth, after, -1)
    return np.flatnonzero(np.cumsum(depth)[:-1]), ids


def holds_any(built: ahocorasick.Automaton, words: list[bytes]) -> bool:
    text = b" " + b" ".join(words) + b" "
    return next(built.iter(text.decode("latin-1")), None) is not None


def original_places(body: bytes, hits: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last code point, exclusive, of each run of hit words in the original text."""
    if not len(hits):
        return [], []
    places = [m.span() for m in WORD.finditer(body.decode("utf-8", "replace"))]
    runs = np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1)
    return [places[r[0]][0] for r in runs], [places[r[-1]][1] for r in runs]


def _scan(docs: DataFrame, found) -> DataFrame:
    def run(batches):
        built = automaton(found.value)
        for batch in batches:
            out = {name: [] for name in ("n_words", "hits", "starts", "ends", "items")}
            for body in batch["body"]:
                words = normalised(body)
                hits, ids = occurrences(built, words) if found.value else (np.zeros(0, int), set())
                starts, ends = original_places(body, hits)
                values = (len(words), hits.tolist(), starts, ends, sorted(ids - {None}))
                for column, value in zip(out.values(), values):
                    column.append(value)
            yield {"row": batch["row"], "doc_id": batch["doc_id"], **out}

    return map_batches(docs, run, SCAN)


def _blocks(benchmark: DataFrame, window: int) -> list:
    """A function per block of windows, which sends it to the tasks: window -> ids of its items."""

    def run(batches):
        for batch in batches:
            out = {"window": [], "item_id": []}
            for item_id, body in zip(batch["item_id"], batch["body"]):
                found = windows_of(body, window)
                out["window"] += found
                out["item_id"] += [item_id] * len(found)
            yield out

    items = benchmark.select("item_id", as_bytes().alias("body"))
    found = map_batches(items, run, "window binary, item_id bigint")
    found = found.groupBy("window").agg(F.collect_set("item_id").alias("items"),
                                        F.max(F.col("item_id").isNull()).alias("unnamed"))
    found = stored(found, "windows")
    blocks = max(1, -(-found.count() // BLOCK_WORDS))

    def sent(block: int):
        rows = found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block).collect()
        known = {r.window.decode("latin-1"): [*r["items"], *[None] * r.unnamed] for r in rows}
        return benchmark.sparkSession.sparkContext.broadcast(known)

    return [lambda block=block: sent(block) for block in range(blocks)]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window occurs."""
    blocks = _blocks(benchmark, window)
    for send in blocks:
        found = send()
        docs = docs.where(~_holds_any(found)(as_bytes()))
        if len(blocks) > 1:
            docs = stored(docs, "clean")
            found.destroy()
    return docs


def _holds_any(found):
    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = automaton(found.value)
        for bodies in batches:
            yield bodies.map(lambda b: bool(found.value) and holds_any(built, normalised(b)))

    return run


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) per row of ``docs`` (doc_id, text).

    ``items`` lists the ids of the items (item_id, text) with an occurring window; ``spans`` the
    hit runs of words as (start, end). With more than one block these may touch or overlap.
    """
    blocks = _blocks(benchmark, window)
    row = F.xxhash64("doc_id", "text") if len(blocks) > 1 else F.lit(0).cast("bigint")
    read = docs.select(row.alias("row"), "doc_id", as_bytes().alias("body"))
    scans = []
    for send in blocks:
        found = send()
        scans.append(_scan(read, found))
        if len(blocks) > 1:
            scans[-1] = stored(scans[-1], "scan")
            found.destroy()
    if len(blocks) == 1:
        found = scans[0].withColumn("n_hit", F.size("hits").cast("bigint"))
        spans = F.arrays_zip("starts", "ends")
        return found.select("doc_id", "n_words", "n_hit", "items", spans.alias("spans"))
    # Rows that repeat hold the same; of each, the last aggregate keeps one and counts them.
    merged = (
        reduce(DataFrame.unionAll, [s.withColumn("block", F.lit(i)) for i, s in enumerate(scans)])
        .groupBy("row", "doc_id")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum((F.col("block") == 0).cast("bigint")).alias("copies"),
            F.size(F.array_distinct(F.flatten(F.collect_set("hits")))).cast("bigint").alias("n_hit"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.flatten(F.collect_set(F.arrays_zip("starts", "ends"))).alias("spans"),
        )
    )
    once = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return once.select("doc_id", "n_words", "n_hit", "items", "spans")
