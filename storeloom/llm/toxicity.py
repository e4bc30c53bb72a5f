"""Toxicity: a convolutional text classifier with thresholds calibrated by language.

Words are hashed to embeddings; filters of several widths slide over them, and the largest
response of each filter over the whole text goes into a logistic output. It is trained in numpy by
Adagrad on every labelled row, in tasks: in each round every task goes over its rows from the network
of the round before, and the changes are averaged, those of an embedding over the tasks that met its
word. A quarter of the labelled rows, which training does not see, sets a threshold for each language
from counts of all their scores, so that precision and recall are balanced; languages with few toxic
rows share one. A maximum over many words is larger than one over few, so long texts have a threshold
of their own, if enough of them are toxic. The language is told from the text by the
classifier of ``language_id``, which learns from the same rows, within its own bounds. Scores are
stretched on either side of a language's threshold to put it at ``DECISION``.

Every text is scored whole, part by part, in the tasks.

Nulls and empties: a text that is null or has no words scores as a text of blanks. Without both
labels among the rows to learn from, every score is 0. Null labels are not learned from; a
document with several counts as toxic if one says so, and of rows that repeat a ``doc_id`` one is
learned from, that of the lowest words. Rows that repeat are scored alike, other
columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm import language_id
from storeloom.llm.decontamination import normalised
from storeloom.llm.frames import (
    ID_SLOT,
    as_bytes,
    bound_batches,
    emptied,
    id_filter,
    map_batches,
    settled,
)

BUCKETS, DEPTH, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
# Rounds over the labelled rows, and rows that a task goes over in one.
ROUNDS = 6
ROWS_A_TASK = 16384
# Texts of more words have a threshold of their own.
TRAINED_WORDS = 3000
# Scores are counted by their log odds, in so many steps for each; counts keep the ends of a step.
STEPS = 64
# Groups that the embeddings' changes are averaged in.
CHUNKS = 64
DECISION = 0.3
LEAST_TOXIC = 15
# The threshold of long texts, and toxic ones that it needs.
LONG, LEAST_LONG = "long", 5
PART = 1 << 15


def word_buckets(body: bytes) -> np.ndarray:
    """Buckets of the words; 0 stands for a blank."""
    found = np.fromiter(map(zlib.crc32, normalised(body)), np.uint32)
    return (found % np.uint32(BUCKETS - 1) + np.uint32(1)).astype(np.int32)


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.3, (BUCKETS, DEPTH)).astype(np.float32)
        self.embedding[0] = 0
        self.filters = [
            rng.normal(0, 0.3, (width, DEPTH, FILTERS)).astype(np.float32) for width in WIDTHS
        ]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.output = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def pooled(self, buckets: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over the text, and where it is, if ``places`` are asked for."""
        best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        place = np.zeros((len(WIDTHS), FILTERS), np.int64)
        overlap = max(WIDTHS) - 1
        padded = np.concatenate([buckets, np.zeros(max(overlap, 1), np.int32)])
        for start in range(0, max(1, len(padded) - overlap), PART):
            words = self.embedding[padded[start : start + PART + overlap]]
            for i, width in enumerate(WIDTHS):
                count = len(words) - width + 1
                if count <= 0:
                    continue
                response = words[:count] @ self.filters[i][0]
                for p in range(1, width):
                    response += words[p : p + count] @ self.filters[i][p]
                if not places:
                    best[i] = np.maximum(best[i], response.max(axis=0) + self.bias[i])
                    continue
                at = response.argmax(axis=0)
                value = response[at, np.arange(FILTERS)] + self.bias[i]
                better = value > best[i]
                best[i][better], place[i][better] = value[better], start + at[better]
        return best, place

    def score(self, buckets: np.ndarray) -> float:
        features = np.maximum(self.pooled(buckets, places=False)[0], 0).ravel()
        return float(1 / (1 + np.exp(-(features @ self.output + self.offset[0]))))

    def dense(self) -> list[np.ndarray]:
        """All parameters but the embeddings."""
        return [*self.filters, *self.bias, self.output, self.offset]

    def untrained(self) -> None:
        """Sums of squared gradients as Adagrad begins."""
        self.met = np.full_like(self.embedding, 1e-3)
        self.sums = [np.full_like(p, 1e-3) for p in self.dense()]

    def learn(self, buckets: np.ndarray, label: int, rate: float = 0.08) -> list[int]:
        """One step of Adagrad. Returns the buckets whose embeddings it changed."""

        def step(values, squares, gradient, index=...):
            squares[index] += gradient * gradient
            values[index] -= rate * gradient / np.sqrt(squares[index])

        wide = len(WIDTHS)
        best, place = self.pooled(buckets)
        features = np.maximum(best, 0).ravel()
        error = 1 / (1 + np.exp(-(features @ self.output + self.offset[0]))) - label
        back = (error * self.output * (features > 0)).reshape(best.shape)
        padded = np.concatenate([buckets, np.zeros(max(WIDTHS), np.int32)])
        met, flows = [np.zeros(0, np.int32)], [np.zeros((0, DEPTH), np.float32)]
        for i, width in enumerate(WIDTHS):
            live = np.flatnonzero(back[i])
            if not len(live):
                continue
            own = back[i][live][:, None]
            words = padded[place[i][live] + np.arange(width)[:, None]]
            change = np.zeros_like(self.filters[i])
            change[:, :, live] = (self.embedding[words] * own).transpose(0, 2, 1)
            flow = self.filters[i][:, :, live].transpose(0, 2, 1) * own
            met.append(words.ravel())
            flows.append(flow.reshape(-1, DEPTH))
            step(self.filters[i], self.sums[i], change)
            step(self.bias[i], self.sums[wide + i], back[i])
        step(self.output, self.sums[-2], error * features + 1e-4 * self.output)
        step(self.offset, self.sums[-1], np.array([error], np.float32))
        words, of = np.unique(np.concatenate(met), return_inverse=True)
        total = np.zeros((len(words), DEPTH), np.float32)
        np.add.at(total, of, np.concatenate(flows))
        kept = words > 0
        if kept.any():
            step(self.embedding, self.met, total[kept], words[kept])
        return words[kept].tolist()


def best_threshold(low: np.ndarray, high: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """Between two steps of scores, where the F1 measure is largest. A step has its lowest and highest
    score and the numbers of rows of either label."""
    order = np.argsort(-low, kind="stable")
    low, high, clean, toxic = low[order], high[order], clean[order], toxic[order]
    at = int((2 * np.cumsum(toxic) / (np.cumsum(clean + toxic) + toxic.sum())).argmax())
    return float((low[at] + (high[at + 1] if at + 1 < len(low) else 0)) / 2)


def stretched(score: float, threshold: float) -> float:
    """Monotone, with ``threshold`` at DECISION."""
    if score < threshold:
        return DECISION * score / threshold
    return DECISION + (1 - DECISION) * (score - threshold) / max(1 - threshold, 1e-9)


LABELLED = "doc_id bigint, held boolean, buckets binary, lang string"


def _labelled(docs: DataFrame, labels: DataFrame, learn_from: Column, languages) -> DataFrame:
    """A row per labelled ``doc_id``: its label, words, and whether it sets thresholds. Only those rows
    have a language. Dealt by the id and ordered by its hash, so that each file is a fair part.

    Words are told where the texts are read, of documents that a filter says may be labelled, and
    moved once; texts are not moved."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id")
    known = known.agg(F.max("toxic").cast("int").alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast((languages, id_filter(known)))

    def run(batches):
        model, packed = shared.value
        wanted = np.unpackbits(packed).astype(bool)
        for batch in batches:
            chosen = np.flatnonzero(wanted[np.array(batch["slot"], np.int64)])
            bodies, held = ([batch[name][i] for i in chosen] for name in ("body", "held"))
            yield {
                "doc_id": [batch["doc_id"][i] for i in chosen],
                "held": held,
                "buckets": [word_buckets(body).tobytes() for body in bodies],
                "lang": [_language(model, body) if h else None for body, h in zip(bodies, held)],
            }

    texts = docs.where(learn_from).where("doc_id is not null")
    held = F.expr("pmod(xxhash64(doc_id, 'held'), 4) = 0").alias("held")
    texts = texts.select("doc_id", F.expr(ID_SLOT).alias("slot"), held, as_bytes().alias("body"))
    tasks = max(1, -(-known.count() // ROWS_A_TASK))
    rows = map_batches(texts, run, LABELLED).selectExpr(
        "doc_id", "cast(null as int) as toxic", "held", "struct(buckets, lang) as r"
    )
    # Labels meet words in a group: a join would deal both anew, into a number of parts of its own.
    marks = known.selectExpr(
        "doc_id", "toxic", "cast(null as boolean) as held",
        "cast(null as struct<buckets:binary,lang:string>) as r",
    )
    one = rows.union(marks).repartition(tasks, "doc_id").groupBy("doc_id")
    one = one.agg(F.max("toxic").alias("toxic"), F.max("held").alias("held"), F.min("r").alias("r"))
    one = one.where("toxic is not null and r is not null").select("doc_id", "toxic", "held", "r.*")
    ordered = one.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    return settled(ordered, "labelled")


CHANGES = "chunk int, task int, at binary, change binary"
TOTALS = "chunk int, at binary, change binary, tasks binary"


def _round(rows: DataFrame, network: Network, number: int) -> None:
    """Every task goes over its rows once; ``network`` moves by the mean of their changes."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    share = BUCKETS // CHUNKS

    def run(batches):
        own, rng = copy.deepcopy(shared.value), np.random.default_rng(number)
        met: set[int] = set()
        seen = 0
        for batch in batches:
            for i in rng.permutation(len(batch["buckets"])):
                met.update(own.learn(np.frombuffer(batch["buckets"][i], np.int32), batch["toxic"][i]))
                seen += 1
        if not seen:
            return
        began, task = shared.value, TaskContext.get().partitionId()
        at = np.array(sorted(met), np.int64)
        for chunk in np.unique(at // share).tolist():
            here = at[at // share == chunk]
            change = np.hstack([own.embedding[here] - began.embedding[here], own.met[here] - began.met[here]])
            yield {"chunk": [chunk], "task": [task], "at": [here.astype(np.uint16).tobytes()],
                   "change": [change.tobytes()]}
        change = [a - b for a, b in zip(own.dense() + own.sums, began.dense() + began.sums)]
        change = np.concatenate([c.ravel() for c in change])
        yield {"chunk": [-1], "task": [task], "at": [np.zeros(1, np.uint16).tobytes()],
               "change": [change.tobytes()]}

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task")
        at = np.concatenate([np.frombuffer(b, np.uint16) for b in group["at"]])
        change = np.concatenate([np.frombuffer(b, np.float32) for b in group["change"]])
        change = change.reshape(len(at), -1)
        places, of = np.unique(at, return_inverse=True)
        total = np.zeros((len(places), change.shape[1]))
        np.add.at(total, of, change)
        return pd.DataFrame({
            "chunk": group["chunk"].iloc[:1].to_numpy(), "at": [places.astype(np.int64).tobytes()],
            "change": [total.tobytes()], "tasks": [np.bincount(of).astype(float).tobytes()],
        })

    changes = map_batches(rows.select("toxic", "buckets"), run, CHANGES)
    # The driver gets each parameter once, however many tasks there are.
    for r in changes.groupBy("chunk").applyInPandas(added, TOTALS).collect():
        at = np.frombuffer(r.at, np.int64)
        change = np.frombuffer(r.change).reshape(len(at), -1) / np.frombuffer(r.tasks)[:, None]
        if r.chunk >= 0:
            network.embedding[at] += change[:, :DEPTH].astype(np.float32)
            network.met[at] += change[:, DEPTH:].astype(np.float32)
            continue
        for values in network.dense() + network.sums:
            values += change[0, : values.size].reshape(values.shape).astype(np.float32)
            change = change[:, values.size :]
    shared.destroy()


def _steps(rows: DataFrame, network: Network) -> pd.DataFrame:
    """Numbers of rows of either label, by language, length and step of the score."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(b, np.int32) for b in batch["buckets"]]
            yield {
                "lang": batch["lang"],
                "toxic": batch["toxic"],
                "long": [len(b) > TRAINED_WORDS for b in found],
                "score": [shared.value.score(b) for b in found],
            }

    scored = map_batches(
        rows.select("lang", "toxic", "buckets"), run, "lang string, toxic int, long boolean, score double"
    )
    odds = f"round({STEPS} * ln((score + 1e-12) / (1 - score + 1e-12)))"
    steps = scored.withColumn("step", F.expr(odds).cast("int")).groupBy("lang", "long", "step")
    return steps.agg(
        F.min("score").alias("low"), F.max("score").alias("high"),
        F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"),
    ).toPandas()


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column):
    """(network, language model, thresholds by language), or None without both labels."""
    learned = docs.where(learn_from)
    marked = labels.where("toxic in (0, 1)").join(learned.select("doc_id"), "doc_id", "left_semi")
    if marked.select("toxic").distinct().count() < 2:
        return None
    languages = language_id.fit(learned.select("doc_id", "text", F.col("lang").alias("label")))
    bound_batches(docs.sparkSession)
    rows = _labelled(docs, labels, learn_from, languages)
    network = Network()
    network.untrained()
    trained = rows.where("not held")
    for number in range(ROUNDS):
        _round(trained, network, number)
    del network.met, network.sums
    steps = _steps(rows.where("held"), network)
    emptied(rows)
    thresholds = {"": 0.5}

    def calibrate(name: str, of: pd.DataFrame, least: int) -> None:
        if len(of) and least <= of["toxic"].sum() and of["clean"].sum():
            one = of.groupby("step").agg({"low": "min", "high": "max", "clean": "sum", "toxic": "sum"})
            thresholds[name] = best_threshold(*(one[c].to_numpy() for c in one.columns))

    short = steps[~steps["long"].astype(bool)]
    calibrate("", short, 1)
    for lang in sorted(set(short["lang"])):
        calibrate(lang, short[short["lang"] == lang], LEAST_TOXIC)
    calibrate(LONG, steps[steps["long"].astype(bool)], LEAST_LONG)
    return network, languages, thresholds


def _threshold(thresholds: dict[str, float], lang: str, words: int) -> float:
    if words > TRAINED_WORDS and LONG in thresholds:
        return thresholds[LONG]
    return thresholds.get(lang, thresholds[""])


def _language(model, body: bytes) -> str:
    text = body.decode("utf-8", "replace")
    if model is None or not any(c.isalpha() for c in text):
        return language_id.UNKNOWN
    return model.predict(text)[0]


def score(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """(doc_id, lang_told, raw, score) per row of ``docs`` (doc_id, text, lang)."""
    model = fit(docs, labels, learn_from)
    if model is None:
        empty = F.lit(None).cast("string").alias("lang_told")
        return docs.select("doc_id", empty, F.lit(0.0).alias("raw"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        network, languages, thresholds = shared.value
        for batch in batches:
            raw, words = [], []
            for body in batch["body"]:
                buckets = word_buckets(body)
                raw.append(network.score(buckets))
                words.append(len(buckets))
            told = [_language(languages, body) for body in batch["body"]]
            least = [_threshold(thresholds, lang, n) for lang, n in zip(told, words)]
            yield {
                "doc_id": batch["doc_id"],
                "lang_told": told,
                "raw": raw,
                "score": [stretched(r, t) for r, t in zip(raw, least)],
            }

    read = docs.select("doc_id", as_bytes().alias("body"))
    return map_batches(read, run, "doc_id bigint, lang_told string, raw double, score double")
