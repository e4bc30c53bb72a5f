"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of characters that are no letters become one space, and the 1- to
3-grams are hashed into a fixed number of features. Document frequencies are counted over every
training row, on Spark. The classifier itself is fitted on a bounded sample per label by
follow-the-regularised-leader with elastic-net penalties, which leaves most weights exactly zero;
a part of the sample that it does not see sets the temperature of the probabilities, and the score
below which an answer is not sure. Every text is then scored whole, in the tasks.

A text is told *surely* if its answer scores at least ``MARGIN`` times the least score of a right
answer in that part, lies ``FROM_EVEN`` of the way from even odds to certainty, and most of its letters
are of scripts that the sample holds. The margin is for
the right answers of all the texts that the part, bounded as it is, doesn't show.

Nulls and empties: a text that is null or without letters is ``und`` with score 0, as is every
text if no row can be learned from. A null label is not learned from, nor are labels beyond the
``MAX_LABELS`` most frequent ones (of equal ones those that sort first). Ties go to the label that
sorts first. Rows that repeat are scored alike; of the rows that repeat an id under one label one is
learned from, that of the lowest features as bytes. Other columns are not read, and an empty table gives an
empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import columns, map_batches

UNKNOWN = "und"
FEATURES = 1 << 15
# Documented bounds of what is fitted on the driver: rows per label, and labels.
SAMPLE_PER_LABEL = 400
MAX_LABELS = 200
PART = 1 << 19
# What a sure answer scores at least, as a share of the least right one, and the share of the letters
# of some label that a script needs to be one of the sample's; a few rows may bear a wrong label.
MARGIN = 0.5
# How far it lies at least on the way from even odds to certainty.
FROM_EVEN = 0.1
SCRIPT_SHARE = 0.005


# --- features ----------------------------------------------------------------------------------


def _parts(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Lower-cased code points, with one space for each run of others than letters, after a space.
    A long text comes in parts, each after as many of the codes before it as the number says."""
    low, before, ahead = text.lower(), True, np.array([32], np.uint32)
    known = 0
    for start in range(0, max(1, len(low)), PART):
        codes = np.frombuffer(low[start : start + PART].encode("utf-32-le", "replace"), np.uint32)
        letter = (codes >= 128) & (codes != 0xA0) | (codes >= 97) & (codes <= 122)
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        if len(kept) and not start:
            before = False  # the space ahead of the text stands for those it begins with
        kept[:1] |= before
        codes = np.concatenate([ahead, np.where(letter, codes, 32)[kept].astype(np.uint32)])
        yield codes, known
        before, ahead = bool(letter[-1]) if len(letter) else before, codes[-2:]
        known = len(ahead)


def _buckets(codes: np.ndarray, known: int) -> Iterator[np.ndarray]:
    """Features of the 1-, 2- and 3-grams that end behind the first ``known`` codes."""
    value = np.zeros(len(codes), np.uint32)
    for i, factor in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
        if len(codes) <= i:
            return
        value = value[: len(codes) - i] + codes[i:] * np.uint32(factor)
        new = value[max(0, known - i) :]
        mixed = (new ^ (new >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (mixed >> np.uint32(17)).astype(np.intp)


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs, the same in however many parts."""
    total = 0
    for codes, known in _parts(text):
        found = np.concatenate([np.zeros(0, np.intp), *_buckets(codes, known)])
        total = total + np.bincount(found, minlength=FEATURES)
    index = np.flatnonzero(total)
    return index, total[index]


def scripts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of 128 code points that the letters of a text lie in, and how many lie in each."""
    total = np.zeros(0x110000 >> 7, np.int64)
    for codes, known in _parts(text):
        new = codes[known:]
        total += np.bincount(new[new != 32] >> 7, minlength=len(total))
    index = np.flatnonzero(total)
    return index, total[index]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that hold each feature, and all texts. Each task hands on one count per feature."""

    def run(batches):
        seen, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            rows += len(batch["text"])
            for text in batch["text"]:
                seen[term_counts(text)[0]] += 1
        index = np.flatnonzero(seen)
        yield {"feature": [*index.tolist(), -1], "n": [*seen[index].tolist(), rows]}

    counts = map_batches(texts.select("text"), run, "feature int, n bigint")
    frequency, total = np.zeros(FEATURES), 0
    for feature, n in counts.groupBy("feature").agg(F.sum("n")).collect():
        if feature < 0:
            total = n
        else:
            frequency[feature] = n
    return frequency, total


# --- the classifier ----------------------------------------------------------------------------


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    least: float = 0.0
    known: frozenset = frozenset()

    def vector(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        value = (1 + np.log(counts)) * self.idf[index]
        return value / max(np.sqrt(value @ value), 1e-12)

    def logits(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(index, counts) @ self.weights[index] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        logits = self.logits(*term_counts(text)) / self.temperature
        odds = np.exp(logits - logits.max())
        best = int(odds.argmax())
        return self.labels[best], float(odds[best] / odds.sum())


    def sure(self, text: str, score: float) -> bool:
        blocks, letters = scripts(text)
        known = letters[np.isin(blocks, list(self.known))].sum()
        return score >= self.least and 2 * known >= letters.sum()


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 4,
          alpha: float = 1.0, l1: float = 0.02, l2: float = 0.001) -> Model:
    """Fit on (label, features, counts) rows: each fifth row only sets the temperature."""
    labels = sorted({label for label, _, _ in rows})
    model = Model(labels, np.zeros((FEATURES, len(labels))), np.zeros(len(labels)), idf, 1.0)
    shuffled = [rows[i] for i in np.random.default_rng(0).permutation(len(rows))]
    held = shuffled[::5] if len(shuffled) >= 20 else shuffled
    fitted = [r for i, r in enumerate(shuffled) if i % 5] if len(shuffled) >= 20 else shuffled
    # The last row is the intercept, which is not penalised.
    z = np.zeros((FEATURES + 1, len(labels)))
    n = np.zeros_like(z)

    def weights(index):
        shrunk = np.sign(z[index]) * np.maximum(np.abs(z[index]) - l1, 0)
        return -shrunk * alpha / (1 + np.sqrt(n[index]) + alpha * l2)

    for _ in range(epochs):
        for label, index, counts in fitted:
            index = np.append(index, FEATURES)
            value = np.append(model.vector(index[:-1], counts), 1.0)
            w = weights(index)
            logits = value @ w
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels.index(label)] -= 1
            gradient = value[:, None] * error
            squares = n[index] + gradient * gradient
            z[index] += gradient - (np.sqrt(squares) - np.sqrt(n[index])) / alpha * w
            n[index] = squares
    model.weights, model.bias = weights(np.arange(FEATURES)), weights(FEATURES)
    model.temperature = _temperature(model, held)
    right = [score for score, label, of in _answers(model, held) if label == of]
    even = 1 / len(labels)
    model.least = max(MARGIN * min(right, default=0.0), even + FROM_EVEN * (1 - even))
    return model


def _held_logits(model: Model, held: list) -> tuple[np.ndarray, np.ndarray]:
    logits = np.array([model.logits(index, counts) for _, index, counts in held])
    return logits, np.array([model.labels.index(label) for label, _, _ in held])


def _answers(model: Model, held: list) -> Iterator[tuple[float, str, str]]:
    """(score, answer, label) of the held-out rows."""
    logits, truth = _held_logits(model, held)
    for row, of in zip(logits / model.temperature, truth):
        odds = np.exp(row - row.max())
        yield float(odds.max() / odds.sum()), model.labels[int(odds.argmax())], model.labels[of]


def _temperature(model: Model, held: list) -> float:
    """The divisor of the logits under which the held-out labels are likeliest.

    Each row counts as one label and, by a row's worth in all, the others: where all held-out
    answers are right, a colder model would be likelier for ever.
    """
    logits, truth = _held_logits(model, held)
    other = 1 / (len(truth) + 1) / max(1, len(model.labels) - 1)
    wanted = np.full(logits.shape, other)
    wanted[np.arange(len(truth)), truth] = 1 - other * (len(model.labels) - 1)

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(axis=1, keepdims=True)
        spread = np.log(np.exp(scaled - top).sum(axis=1, keepdims=True)) + top
        return float(((spread - scaled) * wanted).sum(axis=1).mean())

    return min(np.geomspace(1e-3, 1e2, 401).tolist(), key=loss)


# --- Spark -------------------------------------------------------------------------------------


def _has_letter() -> Column:
    return F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")


def _sampled(labelled: DataFrame, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` ids of each label, chosen by hash. Texts are not read."""
    chosen = labelled.selectExpr(f"`{key}` as id", "label", f"xxhash64(`{key}`) as h").distinct()
    # First among shares of a label's rows, then among what they leave: no task gets them all.
    for among in ("label, pmod(h, 64)", "label"):
        rank = f"row_number() over (partition by {among} order by h, id) as r"
        chosen = chosen.selectExpr("id", "label", "h", rank).where(F.col("r") <= per_label)
    return chosen.select("id", "label")


def fit(labelled: DataFrame, key: str = "doc_id", per_label: int = SAMPLE_PER_LABEL):
    """Model from rows (key, text, label); None if none has a label and a letter."""
    labelled = labelled.where("label is not null").where(_has_letter())
    often = labelled.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_LABELS)
    labels = [r.label for r in often.collect()]
    if not labels:
        return None
    labelled = labelled.where(F.col("label").isin(labels))
    sample = _sampled(labelled, key, per_label).collect()
    frequency, total = document_frequencies(labelled)
    idf = np.log((1 + total) / (1 + frequency)) + 1

    def run(batches):
        for batch in batches:
            found = [term_counts(text) for text in batch["text"]]
            blocks = [scripts(text) for text in batch["text"]]
            yield {
                "id": batch["id"],
                "label": batch["label"],
                "features": [features.astype(np.int32).tobytes() for features, _ in found],
                "counts": [counts.tobytes() for _, counts in found],
                "blocks": [index.astype(np.int32).tobytes() for index, _ in blocks],
                "letters": [letters.tobytes() for _, letters in blocks],
            }

    spark = labelled.sparkSession
    chosen = F.broadcast(spark.createDataFrame(sample, "id bigint, label string")).alias("s")
    texts = labelled.withColumnRenamed("label", "of").join(
        chosen, F.col(key).eqNullSafe(F.col("s.id")) & (F.col("of") == F.col("s.label")), "left_semi"
    )
    found = map_batches(
        texts.select(F.col(key).cast("string").alias("id"), F.col("of").alias("label"), "text"),
        run,
        "id string, label string, features binary, counts binary, blocks binary, letters binary",
    )
    # One row per id and label that was chosen, so as many as the sample has.
    one = found.groupBy("id", "label").agg(
        F.min(F.struct("features", "counts", "blocks", "letters")).alias("r")
    )
    rows = one.select("label", "r.*").collect()
    rows = sorted(rows, key=lambda r: (r.label, bytes(r.features), bytes(r.counts)))
    model = train(
        [
            (r.label, np.frombuffer(r.features, np.int32), np.frombuffer(r.counts, np.int64))
            for r in rows
        ],
        idf,
    )
    letters = {label: np.zeros(0x110000 >> 7, np.int64) for label in model.labels}
    for r in rows:
        letters[r.label][np.frombuffer(r.blocks, np.int32)] += np.frombuffer(r.letters, np.int64)
    known = [np.flatnonzero(n >= max(1, SCRIPT_SHARE * n.sum())) for n in letters.values()]
    model.known = frozenset(np.concatenate(known).tolist())
    return model


def guess(docs: DataFrame, model: Model | None) -> Column:
    """Struct of lang_pred, score and sure for the texts of ``docs``."""
    if model is None:
        return F.struct(
            F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("sure")
        )
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.pandas_udf("lang_pred string, score double, sure boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = pickle.loads(shared.value)
        for texts in batches:
            found = []
            for text in texts:
                label, score = (UNKNOWN, 0.0) if text is None else known.predict(text)
                found.append((label, score, text is not None and known.sure(text, score)))
            yield pd.DataFrame(found, columns=["lang_pred", "score", "sure"])

    return run(F.when(_has_letter(), F.col("text")))


def told(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is told surely."""
    both = docs.select(F.struct(*columns(docs)).alias("doc"), guess(docs, model).alias("guess"))
    return both.where("guess.sure").select("doc.*")


def identify(docs: DataFrame, learn_from: Column, label: str = "lang") -> DataFrame:
    """(doc_id, text, lang_pred, score, sure) per row, learned from the rows that ``learn_from``
    keeps."""
    training = docs.where(learn_from).select("doc_id", "text", F.col(label).alias("label"))
    texts = docs.select("doc_id", "text")
    return texts.select("*", guess(texts, fit(training)).alias("guess")).select(
        "doc_id", "text", "guess.*"
    )
