"""Removal of repeated passages by recompression.

A word goes if it lies in a window of ``size`` consecutive words that also starts in a document of a
smaller id. Windows are found by locally consistent names:

- *Naming.* A run of one word gets one name, then rounds of pairs follow: a digest deals the names
  into left and right ones, and a left name with a right one behind it becomes one name. A name is a
  digest of what it stands for, so all tasks give the same name without a dictionary, which would
  move every word of the corpus in every round.
- *Inside of a window.* Each name knows the words it was derived from. Names derived from a window
  alone occur wherever the window does; the one that stands for the most words is the window's *key*,
  of several the one of least digest. Equal windows have equal keys, and neighbours mostly share one.
- *Reveal.* Keys that two documents share are found in one shuffle of (key, document).
- *Verify.* Windows with such a key are compared by 96 bits of their words, in a second shuffle.

Scale: within a task, what is settled there goes no further. A key seen in two documents of a run is
known to be shared and sends one row, and of equal windows only those of the run's smallest document
ask. So a key or window has as many rows to meet as there are runs, however many documents hold it.
The steps are written to the shared folder.

Nulls and empties: a null text has no words; a text below ``size`` words loses none. Rows with a null
``doc_id`` lose nothing and make nothing go. Rows that repeat a ``doc_id`` are one document: none makes
words of another go, and each is returned. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import as_bytes, bound_batches, settled
from storeloom.llm.tokens import Chunk, Spelling, runs_of
from storeloom.llm.words import IS_WORD, mix

WORDS = Spelling(IS_WORD)
# Keys or windows that a task holds before it sends them on: 20 MB.
RUN = 1 << 19
# Rows of a batch that goes to Spark, which holds batches outside of its heap: 2 MB.
SENT = 1 << 16
# Keys have 48 bits. Two that meet by chance cost a comparison and change nothing.
KEY_BITS = np.uint64(16)
# A key of more words is as good as one of so many.
WIDE = 6
# Names of the first rounds stand for few words and are keys only where a window has no others.
EARLY = 3
# A range of words is one number: the first word, and in so many bits how many there are.
LENGTH_BITS = 20

_LEFT, _RIGHT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


# --- names -------------------------------------------------------------------------------------


class Names:
    """Names over the words of some texts: how many words each stands for, and the words [low, high)
    it was derived from. Arrays are replaced, not changed, so a copy keeps its round."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        full = bounds[:-1] < bounds[1:]
        self.begin, self.end = bounds[:-1][full], bounds[1:][full]
        self.name, self.low, self.high = words, np.arange(len(words)), np.arange(len(words)) + 1
        self.width = np.ones(len(words), np.int64)
        self.head = np.zeros(len(words), bool)
        self.head[self.begin] = True

    def _tail(self) -> np.ndarray:
        return np.append(self.head[1:], True)

    def _edges(self) -> None:
        """What lies at an end of its text hangs on the end, which a window can't show."""
        self.low[self.head] = self.begin - 1
        self.high[self._tail()] = self.end + 1

    def name_runs(self) -> None:
        same = np.zeros(len(self.name), bool)
        same[1:] = (self.name[1:] == self.name[:-1]) & ~self.head[1:]
        first = np.flatnonzero(~same)
        last = np.append(first[1:], len(same)) - 1
        length = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        self.name = np.where(length > 1, mix(name * _LEFT + length * _RIGHT), name)
        # That a run ends is told by the names next to it.
        self.low = self.low[np.maximum(first - 1, 0)]
        self.high = self.high[np.minimum(last + 1, len(same) - 1)]
        self.width, self.head = length.astype(np.int64), self.head[first]
        self._edges()

    def name_pairs(self, round: int) -> None:
        seed = mix(np.array([round], np.uint64) * _LEFT)
        dealt = mix(self.name + seed)
        right = (dealt >> np.uint64(40) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(right), bool)
        pair[:-1] = ~right[:-1] & right[1:] & ~self.head[1:]
        kept = np.ones(len(right), bool)
        kept[1:] = ~pair[:-1]
        at = np.flatnonzero(kept)
        after, before = np.minimum(at + 1, len(right) - 1), np.maximum(at - 1, 0)
        paired = pair[at]
        name = self.name[at]
        self.name = np.where(paired, mix(name * _LEFT + dealt[after] * _RIGHT), name)
        # A left name looks at the one behind it, a right one that stays alone at the one before.
        alone = right[at]
        self.low = np.where(alone, self.low[before], self.low[at])
        self.high = np.where(alone, self.high[at], self.high[after])
        self.width = np.add.reduceat(self.width, at)
        self.head = self.head[at]
        self._edges()

    def inside(self, windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First of the names derived from each window alone, and how many follow."""
        n = int(self.end[-1]) + size + 3
        begun = np.cumsum(np.bincount(self.low + 1, minlength=n))  # names with low < x at x
        ended = np.cumsum(np.bincount(self.high, minlength=n))  # names with high <= x at x
        first = begun[windows]
        return first, ended[windows + size] - first


def window_keys(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window of the texts, and its key: a function of its words alone."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    windows = np.flatnonzero(np.arange(len(words)) + size <= ends)
    keys, widest = words[windows], np.zeros(len(windows), np.int64)

    def choose(names: Names, of: np.ndarray) -> bool:
        first, count = names.inside(windows[of], size)
        of, first, count = of[count > 0], first[count > 0], count[count > 0]
        width = np.minimum(names.width, WIDE)
        for step in range(int(count.max(initial=0))):
            if step:
                more = count > step
                of, first, count = of[more], first[more], count[more]
            at = first + step
            wider = width[at] - widest[of]
            better = (wider > 0) | ((wider == 0) & (names.name[at] < keys[of]))
            keys[of[better]], widest[of[better]] = names.name[at[better]], width[at[better]]
        return len(of) > 0

    if len(windows):
        names, early = Names(words, bounds), []
        names.name_runs()
        every = np.arange(len(windows))
        for round in range(1, 100):
            if round <= EARLY:
                early.append(copy(names))
            elif not choose(names, every):
                break
            names.name_pairs(round)
        for names in reversed(early):
            choose(names, np.flatnonzero(widest == 0))
    return windows, keys >> KEY_BITS


# --- reveal ------------------------------------------------------------------------------------


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, SENT):
        yield batch.slice(start, SENT)


def _sent(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """A run of keys. One that two documents of the run share is sent without a document, and for
    each of these under a number of its own, as known to be shared."""
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(_changes(keys))
    two = np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first)
    marked, many = keys[first[two]], np.repeat(two, np.diff(np.append(first, len(keys))))
    known, own = keys[many].view(np.int64), mix(keys[many] ^ docs[many].view(np.uint64))
    route = np.concatenate([keys[~many], marked, own >> np.uint64(1) | np.uint64(1 << 62)])
    one, rest = int((~many).sum()), len(marked)
    return _batch(
        {
            "route": route.view(np.int64),
            "doc_id": pa.array(
                np.concatenate([docs[~many], np.zeros(rest, np.int64), docs[many]]),
                mask=np.repeat([False, True, False], [one, rest, len(known)]),
            ),
            "key": pa.array(
                np.concatenate([np.zeros(one + rest, np.int64), known]),
                mask=np.repeat([True, False], [one + rest, len(known)]),
            ),
        }
    )


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return new


def shared_keys(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, key) of the keys that more than one document holds."""

    def run(batches):
        keys, owners, held = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in WORDS.chunks(batch.column(1).to_pylist(), size - 1):
                windows, found = window_keys(WORDS.hashes(chunk), chunk.bounds, size)
                text = np.searchsorted(chunk.bounds, windows, "right") - 1 + chunk.texts.start
                new = _changes(found, text)
                keys.append(found[new])
                owners.append(ids[text[new]])
                held += len(keys[-1])
                if held >= RUN:
                    yield from _pieces(_sent(np.concatenate(keys), np.concatenate(owners)))
                    keys, owners, held = [], [], 0
        if held:
            yield from _pieces(_sent(np.concatenate(keys), np.concatenate(owners)))

    rows = docs.where("doc_id is not null").select("doc_id", as_bytes().alias("body"))
    sent = rows.mapInArrow(run, "route bigint, doc_id bigint, key bigint")
    within = "over (partition by route)"
    return (
        sent.selectExpr(
            "*",
            f"min(doc_id) {within} <> max(doc_id) {within} as two",
            f"count(*) {within} > count(doc_id) {within} as marked",
        )
        .where("doc_id is not null and (key is not null or two or marked)")
        .selectExpr("doc_id", "coalesce(key, route) as key")
    )


# --- verify ------------------------------------------------------------------------------------

ASKED = "h0 bigint, h1 int, doc_id bigint, digest bigint, words bigint"


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, body) with the text compressed. Rows that agree in the first two agree."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [packer.compress(b) for b in batch.column("body").to_pylist()]
            yield batch.set_column(2, "body", pa.array(bodies, pa.binary()))

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), as_bytes().alias("body"))
    return rows.mapInArrow(run, "doc_id bigint, digest bigint, body binary")


class Run:
    """Windows of a task: the text of each by its number, and its place there."""

    def __init__(self, size: int):
        self.size, self.held = size, 0
        self.ids, self.digests = [], []
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, text: np.ndarray, place: np.ndarray, h0: np.ndarray, h1: np.ndarray) -> None:
        self.parts.append((text, place, h0, h1))
        self.held += len(text)

    def sent(self) -> pa.RecordBatch:
        """The windows of the smallest document that holds them ask. The others go, as ranges."""
        text, place, h0, h1 = (np.concatenate(c) for c in zip(*self.parts))
        ids, digests = np.array(self.ids, np.int64), np.array(self.digests, np.int64)
        order = np.argsort(h0)
        new = _changes(h0[order])
        if (_changes(h1[order]) & ~new).any():  # h0 alone doesn't tell these apart
            order = np.lexsort((h1, h0))
            new = _changes(h0[order], h1[order])
        smallest = np.minimum.reduceat(ids[text[order]], np.flatnonzero(new))
        least = np.empty(len(order), np.int64)
        least[order] = smallest[np.cumsum(new) - 1]
        later = ids[text] > least
        asks = np.flatnonzero(~later)
        gone = np.flatnonzero(later)
        gone = gone[np.lexsort((place[gone], text[gone]))]
        start = np.flatnonzero(
            _changes(place[gone] - np.arange(len(gone)), text[gone]) | (np.arange(len(gone)) % 8192 == 0)
        )
        count = np.diff(np.append(start, len(gone)))
        begun = gone[start]
        words = np.concatenate([place[asks], place[begun]]) << LENGTH_BITS
        words += np.concatenate([np.full(len(asks), self.size), count + self.size - 1])
        of = np.concatenate([text[asks], text[begun]])
        return _batch(
            {
                "h0": np.concatenate([h0[asks], mix(h0[begun] + np.uint64(1))]).view(np.int64),
                "h1": pa.array(
                    np.concatenate([h1[asks], h1[begun]]).view(np.int32),
                    mask=np.repeat([False, True], [len(asks), len(begun)]),
                ),
                "doc_id": ids[of],
                "digest": digests[of],
                "words": words,
            }
        )


def _windows(docs: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """Windows with a shared key: rows that ask, and without ``h1`` ranges that go."""
    def hashed(chunk: Chunk, which: int, at: np.ndarray) -> np.ndarray:
        return runs_of(WORDS.hashes(chunk, which), at, size, which)

    def run(batches):
        held = Run(size)
        for batch in batches:
            ids, digests = (batch.column(c).to_numpy() for c in ("doc_id", "digest"))
            bodies = [zstandard.decompress(b) for b in batch.column("body").to_pylist()]
            lists = batch.column("keys")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for chunk in WORDS.chunks(bodies, size - 1):
                windows, found = window_keys(WORDS.hashes(chunk), chunk.bounds, size)
                text = np.searchsorted(chunk.bounds, windows, "right") - 1
                first, last = chunk.texts.start, chunk.texts.stop
                asked = values[ends[first] : ends[last]]
                of = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
                salt = mix(np.arange(1, last - first + 1, dtype=np.uint64))
                hit = np.isin(found ^ salt[text], asked ^ salt[of])
                windows, text = windows[hit], text[hit]
                h1 = (hashed(chunk, 1, windows) >> np.uint64(32)).astype(np.uint32)
                place = windows - chunk.bounds[text] + chunk.before
                held.add(text + len(held.ids), place, hashed(chunk, 0, windows), h1)
                held.ids += ids[first:last].tolist()
                held.digests += digests[first:last].tolist()
                if held.held >= RUN:
                    yield from _pieces(held.sent())
                    held = Run(size)
        if held.held:
            yield from _pieces(held.sent())

    return _packed(docs).join(shared, "doc_id").mapInArrow(run, ASKED)


def repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """(doc_id, digest, words): for each text that loses any, the ranges of words that go, which may
    overlap. ``digest`` is the xxhash64 of the text."""
    bound_batches(docs.sparkSession)
    keys = shared_keys(docs, size).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    windows = _windows(docs, settled(keys, "keys"), size)
    earlier = windows.selectExpr("*", "min(doc_id) over (partition by h0, h1) < doc_id as earlier")
    gone = earlier.where("h1 is null or earlier")
    return settled(gone.groupBy("doc_id", "digest").agg(F.collect_list("words").alias("words")), "gone")


def _joined(chunk: Chunk, chosen: np.ndarray) -> bytes:
    """The chosen words, a blank behind each."""
    marks = np.zeros(len(chunk.data) + 2, np.int8)
    marks[chunk.starts[chosen]] = 1
    marks[chunk.ends[chosen] + 1] -= 1
    data = np.append(chunk.data, np.uint8(32))
    data[chunk.ends[chosen]] = 32
    return data[np.cumsum(marks[:-1], dtype=np.int8) > 0].tobytes()


def without_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): per row of ``docs`` its words that stay, one blank between
    two, as UTF-8."""
    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("body", "words")]
            out = {"doc_id": batch.column("doc_id"), "n_words": [], "n_removed": [], "kept": []}
            for body, ranges in zip(*columns):
                kept, total, gone = [], 0, 0
                start = np.array(ranges or [], np.int64)
                edges = start >> LENGTH_BITS, (start >> LENGTH_BITS) + (start & (1 << LENGTH_BITS) - 1)
                for chunk in WORDS.chunks([zstandard.decompress(body)]):
                    n = len(chunk.starts)
                    depth = np.zeros(n + 1, np.int64)
                    for at, by in zip(edges, (1, -1)):
                        np.add.at(depth, np.clip(at - chunk.before, 0, n), by)
                    stays = np.cumsum(depth[:-1]) == 0
                    kept.append(_joined(chunk, stays))
                    total, gone = total + n, gone + int(n - stays.sum())
                out["n_words"].append(total)
                out["n_removed"].append(gone)
                out["kept"].append(b"".join(kept)[:-1])
            kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[n]) if n in kinds else c for n, c in out.items()], list(out)
            )

    found = repeats(docs, size).withColumnsRenamed({"doc_id": "d", "digest": "t"})
    rows = _packed(docs)
    joined = rows.join(found, (rows.doc_id == found.d) & (rows.digest == found.t), "left")
    return joined.select("doc_id", "body", "words").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept binary"
    )
