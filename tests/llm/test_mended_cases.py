"""Cases in which operators once crashed, cut or let through: each with its defined result."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storeloom.llm import (
    decontamination,
    jaccard_join,
    language_id,
    lattice,
    mixing,
    recompression,
    secrets,
    toxicity,
    warc,
)

EN = "the house of the old man and the sea with this and that "
DE = "der hund und die katze über das große haus für immer schön "
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = (EN if i % 2 else DE).split() * 4
        rng.shuffle(words)
        text = " ".join(words)
        rows.append((i, text, "en" if i % 2 else "de", f"s{i % 3}", len(text)))
    return spark.createDataFrame(rows, DOCS)


# --- names of columns --------------------------------------------------------------------------


def test_stages_hand_on_columns_of_any_name(spark, docs, tmp_path):
    """With a dot, a blank and a back-tick in it, and named like a stage's own."""
    odd = {"a.b": F.lit(1), "x y": F.lit(2), "c`d": F.lit(3), "doc": F.lit(4), "guess": F.lit(5), "id": F.lit(6),
           "mix_epoch": F.lit("mine"), "mix_position": F.lit(8), "epoch": F.lit(9), "of": F.lit(10)}
    docs = docs.withColumns(odd)
    spark.createDataFrame([(1, "no such words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() > 0
        if name != "mixing":
            assert out.columns == docs.columns
    row = out.first().asDict()
    assert row["a.b"] == 1 and row["c`d"] == 3 and row["epoch"] == 9
    assert row["mix_epoch"] in (1, 2) and 0 <= row["mix_position"] <= 1
    assert out.columns == [c for c in docs.columns if not c.startswith("mix_")] + ["mix_epoch", "mix_position", "mix_words"]


def test_mixed_copies_agree_with_the_mix(docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    found: dict[int, int] = {}
    for r in mixing.mixed_copies(docs.withColumn("mix_words", F.lit("old"))).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.mix_words
    assert found == {i: n for i, n in taken.items() if n}


# --- archives ----------------------------------------------------------------------------------


def test_revisits_of_one_id_with_several_payloads(spark):
    x, y, z = "x" * 2000, "y" * 2000, "z" * 10
    rows = [(7, "http://a", x), (7, "http://a", y), (3, "http://b", y), (4, "http://c", x), (5, "http://a", z),
            (6, "http://a", z), (7, "http://a", x), (None, "http://a", y), (8, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    last = {x: 7, y: 7}
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = last.get(html) if html in last and (page is None or page < last[html]) else None
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if to else "response", to))
    got = [tuple(r) for r in warc.archived(frame.repartition(3)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_records_are_read_back_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2000)
    frame = spark.range(300).selectExpr("id as page_id", "concat('http://h', id % 7, '/', id) as url", "repeat(cast(id as string), 500) as html")
    found = warc.archived(frame)
    assert found.rdd.getNumPartitions() > 20
    assert sorted(r.page_id for r in found.collect()) == list(range(300))


# --- secrets -----------------------------------------------------------------------------------


def test_empty_literals_are_no_spans():
    body = b'password = """kJ8s9dkf0sKd"""\ntoken = ""\nsecret = "" + "kJ8s9dkf0sKdXy"'
    spans = secrets.spans_of(body)
    assert spans and all(start < end for start, _, end in spans)
    assert secrets.masked(body, spans).count("[SECRET]") == 2


V = "kJ8s9dkf0sKdXy"


@pytest.mark.parametrize(
    "text",
    [
        f'a = b = "{V}"\npassword = a', f'a = b = "{V}"\npassword = b', f'password = \\\n  "{V}"',
        f'password = (\n   "{V}"\n)', f'd["password"] = "{V}"', f'keys["k1"] = "{V}"\nsecret = keys["k1"]',
        f"{{'k1': '{V}'}}\npassword = cfg['k1']", f'password = process.env.PASS || "{V}"',
        f'password = os.getenv("PASS", "{V}")', f'password = get("A", get("B", "{V}"))', f'password = env or "{V}"',
        f'api_key = a ?? b ?? "{V}"', f"<password>{V}</password>", f'<db>\n<dbPassword a="1">{V}</dbPassword></db>',
        f'client.setPassword("{V}")', f"set_token('{V}')", f"login(user, password='{V}')", f'"password": "{V}"',
        f'pass_word = """{V}"""', f"password: {V}", f"password = x + \"{V}\"", f"é password = `{V}`",
    ],
)
def test_the_lexer_finds_a_literal_and_nothing_else(text):
    spans = secrets.spans_of(text.encode())
    assert [text[a:b] for a, kind, b in spans if kind == 3] == [V]
    assert V not in secrets.masked(text.encode(), spans)


@pytest.mark.parametrize(
    "text",
    [
        f'x = "{V}"', "password = get_it()", 'password = "Enter your password please"', "token: the quick brown",
        "secret = a | b | c", 'password = ""', "<password></password>",
        "<password>changeme123</password>", 'get_secret("my-db-secret")', f'settle("{V}")', "<a>password</a>",
        'password = "two words"', 'token = "three or four words"',
    ],
)
def test_the_lexer_leaves_other_text_alone(text):
    assert not [s for s in secrets.spans_of(text.encode()) if s[1] == 3]


def test_pass_phrases_are_literals():
    text = 'passphrase = "correct horse battery staple"'
    assert [text[a:b] for a, _, b in secrets.spans_of(text.encode())] == ["correct horse battery staple"]


@pytest.mark.parametrize("unit", ['password=("', "a=", "<a ", "<a>x", 'set_password("', 'k["x"]||', 'get("x",', "password=\\\n"])
def test_new_forms_take_time_in_proportion(unit):
    import time

    start = time.process_time()
    secrets.spans_of((unit * 40_000 + "password").encode())
    assert time.process_time() - start < 5


# --- language ----------------------------------------------------------------------------------


@pytest.mark.parametrize("part", [1, 2, 3, 7, 50])
def test_features_do_not_hang_on_the_parts_of_a_text(monkeypatch, part):
    rng = random.Random(part)
    texts = ["", " ", "a", "ab", " ab", "1a", "Ein Haus, 12 Häuser!\n\n", "x" * 40, "ΣΊΣΥΦΟΣ und ΣΑΣ", "İİ ı"]
    texts += ["".join(rng.choice("aB é1,\n") for _ in range(rng.randrange(120))) for _ in range(60)]
    whole = [(language_id.term_counts(t), language_id.scripts(t)) for t in texts]
    monkeypatch.setattr(language_id, "PART", part)
    for text, expected in zip(texts, whole):
        got = language_id.term_counts(text), language_id.scripts(text)
        for a, b in zip(got, expected):
            assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist(), text


def test_grams_by_hand():
    """Grams of a normalised text, each counted once per place."""
    index, counts = language_id.term_counts("Ab, a!")
    codes = [ord(c) for c in " ab a "]
    grams = [tuple(codes[i : i + n]) for n in (1, 2, 3) for i in range(len(codes) - n + 1)]
    assert counts.sum() == len(grams) == 15
    a = np.array([ord("a")], np.uint32) * np.uint32(0x9E3779B1)
    mixed = (a ^ (a >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    assert counts[index == int(mixed[0] >> 17)] == 2


def test_ftrl_steps_by_hand(monkeypatch):
    """One feature, two labels, one row: z, n and the weight after a step, written out."""
    monkeypatch.setattr(language_id, "FEATURES", 4)
    rows = [("a", np.array([1]), np.array([1])), ("b", np.array([2]), np.array([1]))]
    model = language_id.train(rows, np.ones(4), epochs=1, alpha=1.0, l1=0.02, l2=0.001)
    order = np.random.default_rng(0).permutation(2)
    z, n = np.zeros((5, 2)), np.zeros((5, 2))
    for at in order:
        label, (feature,), _ = rows[at]
        index = [feature, 4]
        w = np.array([[0.0 if abs(z[f, c]) <= 0.02 else
                       -(z[f, c] - np.sign(z[f, c]) * 0.02) / (1 + np.sqrt(n[f, c]) + 0.001) for c in (0, 1)] for f in index])
        odds = np.exp(w.sum(axis=0))
        error = odds / odds.sum() - np.array([label == "a", label == "b"])
        for i, f in enumerate(index):
            for c in (0, 1):
                step = (np.sqrt(n[f, c] + error[c] ** 2) - np.sqrt(n[f, c])) / 1.0
                z[f, c] += error[c] - step * w[i, c]
                n[f, c] += error[c] ** 2
    shrunk = np.sign(z) * np.maximum(np.abs(z) - 0.02, 0)
    expected = -shrunk / (1 + np.sqrt(n) + 0.001)
    assert np.allclose(model.weights, expected[:4]) and np.allclose(model.bias, expected[4])


def test_the_temperature_lies_inside_its_grid(docs):
    model = language_id.fit(docs.select("doc_id", "text", F.col("lang").alias("label")))
    assert 1e-3 < model.temperature < 1e2 and 0 < model.least < 1


def test_the_language_stage_rejects_junk_and_unlearned_scripts(spark, docs):
    junk = [(900, "это русский текст о погоде и людях", "en", "s1", 5), (901, "日本語のテキストです", "de", "s1", 5),
            (902, "12 34 !!", "en", "s1", 5), (903, None, "en", "s1", 5), (904, EN + "и", "en", "s1", 5)]
    assert corpus_pipeline.language(spark, docs, "").count() == 60
    model = language_id.fit(docs.select("doc_id", "text", F.col("lang").alias("label")))
    found = language_id.told(docs.union(spark.createDataFrame(junk, DOCS)), model)
    assert {r.doc_id for r in found.collect()} == {*range(60), 904}


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LABELS", 2)
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)] + [(100 + i, EN, f"l{i}") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    assert language_id.fit(frame).labels == ["de", "en"]


def test_the_sample_does_not_hang_on_the_order_of_rows(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(8), rng.choice([EN, DE]) * rng.randrange(1, 4), rng.choice(["en", "de"])) for _ in range(80)]
    schema = "doc_id bigint, text string, label string"
    models = [language_id.fit(spark.createDataFrame(r, schema).repartition(n)) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert (models[0].weights == models[1].weights).all() and models[0].temperature == models[1].temperature


# --- toxicity ----------------------------------------------------------------------------------


def test_pooling_by_brute_force(monkeypatch):
    network, rng = toxicity.Network(), np.random.default_rng(4)
    for length in (1, 2, 5, 70):
        buckets = rng.integers(0, 500, length).astype(np.int32)
        padded = np.concatenate([buckets, [0, 0]])
        wide = []
        for filters, bias, width in zip(network.filters, network.bias, toxicity.WIDTHS):
            places = range(length + 3 - width)
            wide.append(max((sum(network.embedding[padded[p + i]] @ filters[i] for i in range(width)) for p in places),
                            key=lambda v: v[0])[0] + bias[0])
        for part in (1 << 15, 3):
            monkeypatch.setattr(toxicity, "PART", part)
            assert np.allclose(network.pooled(buckets)[0][:, 0], wide, atol=1e-5)


def test_long_texts_have_a_threshold_of_their_own(spark):
    """Every second text has more words than those trained on."""
    rng, rows, marks = random.Random(4), [], []
    for i in range(240):
        n = toxicity.TRAINED_WORDS + 500 if i % 2 else 40
        words = [rng.choice(EN.split()) for _ in range(n)]
        if i % 3 == 0:
            words[rng.randrange(n)] = "scum"
        rows.append((i, " ".join(words), "en"))
        marks.append((i, int(i % 3 == 0)))
    rows += [(500, "the " * 60_000, "en"), (500, "the " * 9, "en")]  # more words than the sample takes
    marks.append((500, 1))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    learn = F.col("doc_id") % 4 != 2
    assert toxicity.LONG in toxicity.fit(frame, labels, learn)[2]
    got = {r.doc_id: r.score for r in toxicity.score(frame, labels, learn).collect()}
    for long in (0, 1):
        asked = [i for i in range(240) if i % 2 == long]
        right = sum((got[i] >= toxicity.DECISION) == (i % 3 == 0) for i in asked)
        assert right >= 0.95 * len(asked)


# --- decontamination ---------------------------------------------------------------------------


def test_windows_of_one_long_item_are_dealt(spark, monkeypatch):
    rng = random.Random(6)
    item = " ".join(f"w{rng.randrange(5000)}" for _ in range(900))
    words = item.split()
    texts = [(i, " ".join(words[i * 17 : i * 17 + n])) for i, n in enumerate([9, 10, 11, 40, 0, 300])] + [(9, "x Y"), (10, None)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item), (2, "x y"), (None, "q")], "item_id bigint, text string")

    def found():
        rows = decontamination.scan(frame, bench).collect()
        kept = {r.doc_id for r in decontamination.clean(frame, bench).collect()}
        return sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in rows), kept

    one = found()
    assert one[0] == [(0, 9, 0, []), (1, 10, 10, [1]), (2, 11, 11, [1]), (3, 40, 40, [1]), (4, 0, 0, []),
                      (5, 300, 300, [1]), (9, 2, 2, [2]), (10, 0, 0, [])]
    assert one[1] == {0, 4, 10}
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 200)
    assert found() == one


# --- batches -----------------------------------------------------------------------------------


def test_batches_are_bounded_and_smaller_ones_stay(spark, conf):
    from storeloom.llm.frames import BATCH_LIMITS, bound_batches

    rows, size = BATCH_LIMITS
    conf(**{rows.replace(".", "__"): "100", size.replace(".", "__"): str(1 << 30)})
    bound_batches(spark)
    assert spark.conf.get(rows) == "100" and int(spark.conf.get(size).rstrip("b")) == BATCH_LIMITS[size]


def test_jaccard_components_do_not_hang_on_what_a_task_keeps(spark, monkeypatch):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        words = base[:]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"v{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    one = sorted(map(tuple, jaccard_join.jaccard_components(frame).collect()))
    monkeypatch.setattr(jaccard_join, "KNOWN_SHINGLES", 10)
    monkeypatch.setattr(jaccard_join, "COUNT_RUN", 100)
    assert sorted(map(tuple, jaccard_join.jaccard_components(frame).collect())) == one


def test_rounds_of_few_pairs_move_the_texts_of_these_pairs(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for group in range(6):
        for i in range(90):
            words = [f"g{group}w{k}" for k in range(60)]
            for _ in range(rng.randrange(9)):
                words[rng.randrange(60)] = f"v{rng.randrange(9)}"
            rows.append((group * 1000 + i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    real, moved = jaccard_join._links, []

    def links(pairs, texts, words, percent):
        asked = {x for r in pairs.collect() for x in (r.a, r.b)}
        held = {r["class"] for r in texts.select("class").collect()}
        assert asked <= held
        moved.append((len(asked), len(held)))
        return real(pairs, texts, words, percent)

    monkeypatch.setattr(jaccard_join, "_links", links)
    monkeypatch.setattr(jaccard_join, "MANY", 8)
    assert jaccard_join.jaccard_components(frame).count() == len(rows)
    assert len(moved) > 1 and max(asked for asked, _ in moved) > 50
    assert all(held <= asked + 5 for asked, held in moved), moved  # a bit may be shared by chance


# --- lattice -----------------------------------------------------------------------------------


def test_lattice_scores_by_brute_force(spark, docs):
    """Every term of the score, from plain counts and the plain recursion over each word."""
    extra = [(200, None, None, None, 0), (201, "", None, None, 0), (202, "qqq zzz the " + "x" * 100, "en", "s", 0),
             (202, "qqq zzz the " + "x" * 100, "en", "s", 0), (203, "é" * 80 + " the", "en", "s", 0)]
    frame = docs.union(spark.createDataFrame(extra, DOCS))
    learned = (F.col("doc_id") % 3 != 0) & (F.col("doc_id") < 203)
    found = lattice.score(frame, learned).collect()

    texts = [r.text for r in frame.where(learned).collect()]
    counts = Counter(w for t in texts for w in (t or "").encode().lower().split())
    prior = lattice.Lattice.from_file(lattice.VOCABULARY)
    start, inside = Counter(), Counter()
    for word, n in counts.items():
        prior.expect(word, n, start, inside)
    fitted = lattice.Lattice.of_weights(
        {p: start[p] + len(prior.start) * math.exp(w) for p, w in prior.start.items()},
        {p: inside[p] + len(prior.inside) * math.exp(w) for p, w in prior.inside.items()},
        sum(counts.values()) + len(prior.inside) * math.exp(prior.stop),
    )
    total, distinct = sum(counts.values()) + len(texts), len(counts) + 1
    whole, scored = math.log10(total + distinct + 1), set()
    text_of = {r.doc_id: r.text for r in frame.collect()}
    for r in found:
        words = (text_of[r.doc_id] or "").encode().lower().split()
        score = math.log10(len(texts) + (distinct + 1) * 1e-3) - whole
        base = math.log10(len(texts) + 1) - whole
        for w in words:
            spelled = fitted.spelling(w) / math.log(10) + math.log10((distinct + 1) * (1 - 1e-3))
            score += (math.log10(counts[w] + 10**spelled) if counts[w] else spelled) - whole
            base += math.log10(counts[w] + 1) - whole
        assert r.n_tokens == len(words) + 1 and r.n_known == 1 + sum(w in counts for w in words)
        assert abs(r.score - score) < 1e-6 and abs(r.base_score - base) < 1e-6, r.doc_id
        scored.add(r.doc_id)
    assert scored == set(text_of)


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """The word that marks toxic rows is learned from long texts alone, in several tasks."""
    monkeypatch.setattr(toxicity, "ROWS_A_TASK", 60)
    rng, rows, marks = random.Random(4), [], []
    for i in range(320):
        toxic = i % 2
        n = (toxicity.TRAINED_WORDS + 500) * toxic + 40 if i < 240 else 40
        words = [rng.choice(EN.split()) for _ in range(n)]
        if toxic:
            words[rng.randrange(40)] = "scum"
        rows.append((i, " ".join(words), "en"))
        marks.append((i, toxic))
    rows.append((1000, "the " * 55_000, "en"))
    marks.append((1000, 0))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    learn = ~F.col("doc_id").between(240, 319)
    kept = toxicity._labelled(frame, labels, learn, None)
    assert kept.count() == 241 and kept.where("length(buckets) = 220000").count() == 1
    got = {r.doc_id: r.raw for r in toxicity.score(frame, labels, learn).collect()}
    assert min(got[i] for i in range(241, 320, 2)) > max(got[i] for i in range(240, 320, 2))


def test_threshold_from_steps():
    """Between the steps, wherever the largest F1 measure splits them."""
    low, high = np.array([0.1, 0.5, 0.8]), np.array([0.3, 0.6, 0.9])
    clean, toxic = np.array([9, 1, 0]), np.array([0, 3, 4])
    assert toxicity.best_threshold(low, high, clean, toxic) == pytest.approx(0.4)


def test_a_step_of_the_network_by_hand():
    """The embeddings move by the sum of what flows back to each word, blanks by nothing."""
    rng = np.random.default_rng(5)
    for text in ([3, 3, 9, 4, 3], [7], []):
        network, buckets = toxicity.Network(), np.array(text, np.int32)
        network.untrained()
        network.output = rng.normal(0, 1, network.output.shape).astype(np.float32)
        began = network.embedding.copy()
        best, place = network.pooled(buckets)
        error = network.score(buckets) - 1
        back = (error * network.output * (best.ravel() > 0)).reshape(best.shape)
        flow, padded = {}, [*text, 0, 0, 0]
        for i, width in enumerate(toxicity.WIDTHS):
            for f in np.flatnonzero(back[i]):
                for p in range(width):
                    word = padded[place[i][f] + p]
                    flow[word] = flow.get(word, 0) + network.filters[i][p][:, f] * back[i][f]
        flow.pop(0, None)
        assert sorted(network.learn(buckets, 1)) == sorted(flow)
        for word, gradient in flow.items():
            moved = -0.08 * gradient / np.sqrt(1e-3 + gradient**2)
            assert np.allclose(network.embedding[word] - began[word], moved, atol=1e-4)
        rest = np.setdiff1d(np.arange(toxicity.BUCKETS), list(flow))
        assert (network.embedding[rest] == began[rest]).all()


def test_toxicity_tells_words_of_labelled_documents_alone(spark, monkeypatch):
    """What moves is the words of labelled rows: no text, and nothing of other documents."""
    rows = [(i, f"words {'bad' if i % 2 else 'good'} of {i}", "en") for i in range(400)]
    frame = spark.createDataFrame([*rows, (None, "bad", "en")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    told, plain = [], toxicity.map_batches
    monkeypatch.setattr(toxicity, "map_batches", lambda *a: told.append(plain(*a)) or told[-1])
    found = toxicity._labelled(frame, labels, F.lit(True), None)
    assert sorted(r.doc_id for r in found.collect()) == list(range(40))
    assert 40 <= told[0].count() < 60
    monkeypatch.setattr(toxicity, "ROWS_A_TASK", 16)
    found = toxicity._labelled(frame, labels, F.lit(True), None)
    assert found.select("_metadata.file_path").distinct().count() == 3


def test_keys_and_windows_go_on_in_small_batches(spark):
    """Spark holds a batch outside of its heap, so a run of many keys is handed on in pieces."""

    class Frame:
        def __getattr__(self, name):
            return lambda *arguments: self

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    frame, n = Frame(), 2 * recompression.SENT
    text = " ".join(map(str, range(n))).encode()
    recompression.shared_keys(frame, 1)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text])], ["doc_id", "body"])
    sent = list(frame.run(iter([batch])))
    assert max(b.num_rows for b in sent) <= recompression.SENT
    keys = pa.Table.from_batches(sent).to_pydict()
    assert sum(d is None for d in keys["doc_id"]) == len(set(keys["key"]) - {None}) > n // 2
    run = recompression.Run(1)
    run.ids, run.digests = [1, 2], [3, 4]
    words = np.arange(n, dtype=np.uint64)
    for text in range(2):
        run.add(np.full(n, text), np.arange(n), words, words.astype(np.uint32))
    whole = run.sent()
    pieces = list(recompression._pieces(whole))
    assert max(b.num_rows for b in pieces) <= recompression.SENT < whole.num_rows
    assert pa.Table.from_batches(pieces).equals(pa.Table.from_batches([whole]).combine_chunks())
