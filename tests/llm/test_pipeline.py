"""The pipeline against plain versions of its stages, each on what the one before it kept."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from storeloom.llm import language_id, mixing, secrets

EN = "the house of the old man and the sea with this and that "
DE = "der hund und die katze über das große haus für immer schön "
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SECRET = "password=531ccd051a92ebcb68"


def shingles(text, k=5):
    words = re.findall("[^\x20\x09-\x0d]+", text.encode().lower().decode("latin-1"))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def first_of_groups(rows):
    """One row, that of the smallest id, of each group of documents that are 80 % alike."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = sets[a] & sets[b]
            if a < b and both and 100 * len(both) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [r for r in rows if find(r[0]) == r[0]]


def windows(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return words, {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()


def clean(rows, items):
    bad = set().union(*(windows(t)[1] for t in items))
    kept = []
    for r in rows:
        words = windows(r[1])[0]
        runs = {tuple(words[i : i + n]) for n in {len(b) for b in bad} for i in range(len(words) - n + 1)}
        if not runs & bad:
            kept.append(r)
    return kept


def targets(sizes):
    """Words per source: 150 % of all by weight, none above twice its own."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    left, open_, found = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return found | share
        found |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return found


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        words = (EN if i % 2 else DE).split() * 5
        rng.shuffle(words)
        words += [f"w{rng.randrange(10**6)}" for _ in range(20)]
        rows.append([i, " ".join(words), "en" if i % 2 else "de", f"s{i % 3}"])
    for i in range(40):  # near and exact copies
        words = rows[i % 12][1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        rows.append([1000 + i, " ".join(words), rows[i % 12][2], f"s{i % 3}"])
    items = ["Ten words, of a test: that no other text has (at all) here", "short one"]
    rows += [[2000, EN * 3 + items[0].upper() + EN, "en", "s1"], [2001, EN * 2 + "a short, ONE more", "en", "s2"],
             [2002, EN * 4 + SECRET + " and more", "en", "s0"], [2003, "это русский текст о погоде", "en", "s0"],
             [2004, "123 !!", "en", "s0"], [2005, None, "en", "s0"], [2006, EN + items[0][:30], "en", "s1"]]
    full = [(*r, len(r[1] or "")) for r in rows]
    rng.shuffle(full)
    spark.createDataFrame(full, DOCS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = language_id.fit(spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "doc_id bigint, text string, label string"))
    told = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1]) and model.sure(r[1], model.predict(r[1])[1])]
    assert {2003, 2004, 2005} == {r[0] for r in rows} - {r[0] for r in told}
    kept = clean(first_of_groups(told), items)
    assert {2000, 2001} & {r[0] for r in kept} == set() and len(kept) < len(told) - 20
    masked = {r[0]: secrets.masked(r[1].encode(), secrets.spans_of(r[1].encode())) for r in kept}

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= set(masked)
    for r in found:
        assert r.text == masked[r.doc_id] and r.n_chars == len(r.text) and SECRET not in r.text
    size = {r[0]: len(masked[r[0]].split()) for r in kept}
    of = {r[0]: r[3] for r in kept}
    sizes = {s: sum(n for i, n in size.items() if of[i] == s) for s in set(of.values())}
    taken: dict[str, int] = {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.mix_words
        assert r.mix_words <= size[r.doc_id] and r.mix_epoch in (1, 2)
    assert taken == {s: round(t) for s, t in targets(sizes).items()}
    assert len({(r.doc_id, r.mix_epoch) for r in found}) == len(found)
    assert sum(mixing.integral(s) for s in mixing.SCHEDULES) == 6
