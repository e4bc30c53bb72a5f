"""Substring dedup, ranked search and hard negatives against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import max_sketch, recompression, threshold, tokens
from storeloom.llm.words import IS_WORD, mix

# --- words -------------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [16, 64, 1 << 18])
def test_words_of_pieces_are_those_of_the_text(chunk):
    rng = random.Random(chunk)
    texts = [b"", b" \n\t", b"one", b"x" * 300, "é ü".encode()]
    texts += [b" ".join(b"w%d" % rng.randrange(50) for _ in range(rng.randrange(200))) for _ in range(40)]

    def spelled(spelling, overlap):
        found: dict[int, list] = {}
        for c in spelling.chunks(texts, overlap):
            hashes = spelling.hashes(c).tolist()
            for i, number in enumerate(c.texts):
                own, words = found.setdefault(number, []), hashes[c.bounds[i] : c.bounds[i + 1]]
                assert own[c.before :] == words[: len(own) - c.before]
                own[c.before :] = words
        return found

    expected = spelled(tokens.Spelling(IS_WORD, chunk=1 << 20), 0)
    for overlap in (0, 4):
        assert spelled(tokens.Spelling(IS_WORD, chunk=chunk), overlap) == expected
    assert [len(expected[i]) for i in range(len(texts))] == [len(t.split()) for t in texts]


def test_hashes_follow_the_word_alone():
    spelling = tokens.Spelling(IS_WORD)
    (chunk,) = spelling.chunks([b"a bb a\nbb", b"bb a", b"ab b"])
    first, second = spelling.hashes(chunk), spelling.hashes(chunk, 1)
    for hashes in (first, second):
        a, bb = hashes[0], hashes[1]
        assert hashes[:6].tolist() == [a, bb, a, bb, bb, a] and len(set(hashes.tolist())) == 4
    assert not set(first.tolist()) & set(second.tolist())


# --- substring dedup ---------------------------------------------------------------------------


def test_a_key_hangs_on_its_window_alone():
    """The same window, inside other texts, at their edges, and cut out, has the same key."""
    rng = random.Random(3)
    for size in (3, 13):
        for _ in range(150):
            few = rng.choice([2, 5, 1000])
            window = [rng.randrange(few) for _ in range(size)]
            before = [rng.randrange(few) for _ in range(rng.randrange(30))]
            after = [rng.randrange(few) for _ in range(rng.randrange(30))]
            found = set()
            for ahead, behind in (([], []), (before, after), (before, []), ([], after)):
                words = mix(np.array([*ahead, *window, *behind], np.uint64) + np.uint64(1))
                other = mix(np.array([7, 8, 9] * 9, np.uint64))
                bounds = np.cumsum([0, len(other), len(words), 0])
                at, keys = recompression.window_keys(np.concatenate([other, words]), bounds, size)
                found.add(int(keys[list(at).index(len(other) + len(ahead))]))
            assert len(found) == 1


def removed(rows, size):
    """Per row: words, and which stay."""
    split = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    first: dict[tuple, int] = {}
    for d, words in split:
        for i in range(len(words) - size + 1):
            run = tuple(words[i : i + size])
            if d is not None:
                first[run] = min(first.get(run, d), d)
    out = []
    for d, words in split:
        stays = [True] * len(words)
        for i in range(len(words) - size + 1):
            if d is not None and first[tuple(words[i : i + size])] < d:
                stays[i : i + size] = [False] * size
        out.append((d, len(words), stays.count(False), " ".join(w for w, s in zip(words, stays) if s)))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(600)]
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            at, n = rng.randrange(590), rng.choice([11, 12, 13, 14, 60])
            words += base[at : at + n] + [f"v{rng.randrange(9)}"] * rng.randrange(30)
        rows.append((rng.randrange(100) - 20, rng.choice([" ", "\n", "  ", "\x0b"]).join(words)))
    rows += [(i, " ".join(base)) for i in range(300, 340)]
    rows += [(400, None), (401, ""), (402, " \n"), (None, " ".join(base)), (None, None), (403, "x " * 500),
             (404, "x " * 700), (404, " ".join(base[:200])), (404, " ".join(base[100:300])),
             (405, "A" + " ".join(base)), (5, " ".join(base)), (5, " ".join(base)), (406, "é " * 40),
             (407, "é " * 40), (408, " ".join(base).upper())]
    return rows


@pytest.mark.parametrize("run", [1 << 20, 50])
@pytest.mark.parametrize("chunk", [1 << 18, 300])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, run, chunk):
    """Also with many runs in a task, and texts that go in many pieces."""
    rows = passages(run + chunk)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as key", "2 as words")
    monkeypatch.setattr(recompression, "RUN", run)
    monkeypatch.setattr(recompression, "WORDS", tokens.Spelling(IS_WORD, chunk=chunk))
    for size in (13, 3):
        found = recompression.without_repeats(frame.repartition(3), size).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept.decode()) for r in found), key=str)
        assert got == removed(rows, size)


def test_ranges_name_the_words_that_go(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, "a b " + text + " c"), (3, text + " " + text)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    mask = (1 << recompression.LENGTH_BITS) - 1
    gone = {}
    for r in recompression.repeats(frame).collect():
        for n in r.words:
            start = n >> recompression.LENGTH_BITS
            gone.setdefault(r.doc_id, set()).update(range(start, start + (n & mask)))
    assert gone == {2: set(range(2, 42)), 3: set(range(80))}


# --- ranked search -----------------------------------------------------------------------------


def ranked(docs, items, k):
    def terms(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, words = len(held), sum(sum(c.values()) for _, c in held)
    having = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * having[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, d is not None, d))
        for rank, (score, _, d) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=str)


def search_tables(seed):
    rng = random.Random(seed)
    docs = [(rng.randrange(500), " ".join(f"T{int(rng.paretovariate(0.4)) % 3000}" for _ in range(rng.randrange(60))))
            for _ in range(250)]
    docs += [(1000 + i, "Copy of the same-text, again!") for i in range(80)]
    docs += [(2000, None), (2001, ""), (2002, "?! ..."), (None, "t1 t2 copy"), (7, "ÀÉ ß x" * 30), (7, "ÀÉ ß x" * 30),
             (2003, "t1 " * 40_000 + "t5"), (-4, "again again again")]
    items = [(i, " ".join(f"t{rng.randrange(60)}" for _ in range(rng.randrange(12)))) for i in range(30)]
    items += [(100, "copy AGAIN again"), (100, "copy AGAIN again"), (100, "text"), (101, None), (102, "ÀÉ"),
              (103, "Àé"), (104, "nowhere"), (None, "t5"), (105, "t1 " * 3000)]
    return docs, items


@pytest.mark.parametrize("block", [1 << 16, 40])
@pytest.mark.parametrize("slots", [1 << 14, 16])
def test_search_equals_brute_force(spark, monkeypatch, block, slots):
    """Also with queries in many blocks, and so few slots that bounds are far too high."""
    docs, items = search_tables(slots)
    left = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as query", "'x' as digest")
    right = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "2 as score")
    monkeypatch.setattr(max_sketch, "BLOCK_TERMS", block)
    found = max_sketch.search(left.repartition(3), right, k=5, among=slots)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == ranked(docs, items, 5)


def test_terms_of_pieces_are_counted_together(monkeypatch):
    docs = [(t or "").encode() for _, t in search_tables(1)[0]]
    whole = [(p.sizes.tolist(), p.terms.tolist(), p.counts.tolist()) for p in max_sketch.counted(docs)]
    monkeypatch.setattr(max_sketch, "TERMS", tokens.Spelling(max_sketch.IS_TERM, max_sketch.LOWER, chunk=30))
    parts = [(p.sizes.tolist(), p.terms.tolist(), p.counts.tolist()) for p in max_sketch.counted(docs)]
    assert [sum((x[i] for x in parts), []) for i in range(3)] == [sum((x[i] for x in whole), []) for i in range(3)]


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(2)
    terms = mix(np.arange(1, 400, dtype=np.uint64))
    for _ in range(20):
        held = np.sort(rng.choice(terms, 150, replace=False))
        counts = rng.integers(1, 9, 150)
        slots = max_sketch._slots(held, 64)
        most = np.zeros(64, np.int64)
        np.maximum.at(most, slots, counts)
        length = np.array([25 + rng.integers(0, 500)])
        exact = max_sketch.impact(counts, length)
        assert (max_sketch.impact(most[slots], length) >= exact).all()


def test_an_index_serves_other_queries(spark):
    docs, items = search_tables(5)
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = max_sketch.settled(max_sketch.sketches(left), "index")
    for part in (items[:5], items[20:]):
        right = spark.createDataFrame(part, "item_id bigint, text string")
        got = sorted((tuple(r) for r in max_sketch.search(left, right, 3, index).collect()), key=str)
        assert got == ranked(docs, part, 3)


# --- hard negatives ----------------------------------------------------------------------------


def mined(rows, is_anchor, k=5, negatives=3):
    plain = {}
    for i, label, e in sorted(rows, key=lambda r: str(r)):
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        plain.setdefault(i, []).append((label, e))
    plain = {i: min(found) for i, found in plain.items()}
    lengths = Counter(len(e) for _, e in plain.values())
    if not lengths:
        return []
    most = max(lengths, key=lambda n: (lengths[n], n))
    whole = {i: (label, [math.floor(256 * x) for x in e]) for i, (label, e) in plain.items() if len(e) == most}
    out = []
    for a, (label, v) in whole.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in whole.items() if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:k]:
            inside = [(n, i) for n, i, other in scored if other != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(a, pid, rank, i, -p, -n) for rank, (n, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, first", [(4096, 64), (37, 2)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, shard, first):
    rng = random.Random(shard)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.75, 1 / 3]) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, i % 2, [0.5] * 6) for i in range(150)] + [(2000, 1, [0.0] * 6), (2050, 1, [-0.5] * 6)]
    rows += [(3000, None, [1.0] * 6), (3001, 1, None), (3002, 1, [None] + [1.0] * 5), (3003, 1, [float("nan")] * 6),
             (3004, 1, [float("inf")] + [1.0] * 5), (3005, 1, [1.0] * 7), (3006, 1, []), (None, 1, [1.0] * 6),
             (50, 0, [0.5] * 6), (50, 0, [0.25] * 6), (1050, 0, [0.5] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").selectExpr("*", "1 as v", "2 as ids")
    monkeypatch.setattr(threshold, "SHARD_ROWS", shard)
    monkeypatch.setattr(threshold, "ANCHORS", 3 if shard < 100 else 4096)
    monkeypatch.setattr(threshold.Shard.read, "__kwdefaults__", {"first": first})
    found = threshold.mine(frame, F.col("vec_id") % 50 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == mined(rows, lambda i: i % 50 == 0)


def test_reading_stops_before_the_lists_end():
    """Of rows in one direction, those far down the lists are never met."""
    values = np.arange(4000, 0, -1)[:, None] * np.array([[3, -2]])
    shard = _shard(values, np.arange(4000), np.arange(4000) % 2)
    met = []
    scores, shard.scores = shard.scores, lambda a, rows: (met.extend(rows), scores(a, rows))[1]
    found = threshold.Positives(5).find(shard, (0, 0, np.array([3, -2]), []), threshold.NOTHING)
    assert found.ids.tolist() == [2, 4, 6, 8, 10] and len(met) < 200


def _shard(values, ids, labels):
    values = np.ascontiguousarray(values, np.int64)
    lists = np.argsort(-values, axis=0, kind="stable").T.astype(np.int32)
    row = type("Row", (), dict(ids=ids.astype(np.int64).tobytes(), labels=labels.astype(np.int64).tobytes(),
                               values=values.tobytes(), lists=lists.tobytes()))
    return threshold.Shard(row)


def test_scores_beyond_doubles_are_exact_and_beyond_64_bits_fail():
    big = np.array([[2**30, 1], [2**30, 2]])
    shard = _shard(big, np.arange(2), np.zeros(2))
    anchor = np.array([2**30, 1])
    assert shard.scores(anchor, np.arange(2)).tolist() == [2**60 + 1, 2**60 + 2]
    with pytest.raises(OverflowError):
        shard.scores(np.array([2**33, 1]), np.arange(2))


def test_new_operators_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id string, text string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    asked = spark.createDataFrame([("i", "a")], "item_id string, text string")
    results = [
        recompression.without_repeats(docs), max_sketch.search(docs, items), max_sketch.search(docs, asked),
        max_sketch.search(one, items), threshold.mine(vectors, F.lit(True)),
    ]
    assert [r.count() for r in results] == [0] * len(results)
    assert dict(results[2].dtypes)["item_id"] == "string"
