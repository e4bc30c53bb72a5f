"""Language-model score of a text: the likelihood of a subword lattice, summed over segmentations.

The pieces are those of an existing vocabulary file, and so are the scores that first weight them:
a piece of merge rank r gets a weight in proportion to 1 / (r + 1). One round of expected counts,
over every word of the training texts and all its segmentations, turns them into probabilities.
Pieces that begin a word and pieces inside one are two distributions; the latter holds the end of
a word, and single bytes, so that every word has a segmentation.

The log-space forward recursion gives the probability of a word's spelling, summed over all
segmentations. A word seen in training is one more edge of its lattice, from end to end: with N
training tokens, T of them distinct, P(word) = (count + (T + 1) * P(spelling)) / (N + T + 1).
A text is its words and one end token.

The word counts grow with the training texts and are kept as a table. The most frequent words, in
a bounded number, are sent to the tasks; a rarer one meets its count in a join. A hot word so
never crosses a shuffle, and a rare one has few rows.

Nulls and empties: a null text is empty; it consists of the end token alone. Texts that repeat
are scored alike, other columns are not read, an empty table gives no rows. Without any training
text every word is scored by its spelling.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import as_bytes, map_batches, most_frequent, stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Words sent to the tasks, of at most KEY bytes each. Longer words are spelled one by one.
FREQUENT = 200_000
KEY = 64
END = b" "
LOG10 = math.log(10)


def word_key(word: bytes) -> bytes:
    """A word, or the digest of a long one after a blank, which no word holds."""
    return word if len(word) <= KEY else b" " + hashlib.sha256(word).digest()


# --- the lattice -------------------------------------------------------------------------------


class Lattice:
    """Log probabilities of pieces at the start of a word and inside it."""

    def __init__(self, start: dict[bytes, float], inside: dict[bytes, float], stop: float):
        self.start, self.inside, self.stop = start, inside, stop
        self.longest_start = max(map(len, start))
        self.longest = max(map(len, inside))
        self.prefixes = {p[:i] for p in inside for i in range(1, len(p) + 1)}

    @staticmethod
    def from_file(path: str) -> Lattice:
        """Weights from the ranks of the pieces. An empty start piece lets any other follow."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        start, inside = {b"": 1.0}, {bytes([b]): 1e-5 for b in range(256)}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece, weight = model.id_to_piece(i), 1 / (1 - model.get_score(i))
            if piece.startswith("▁"):
                start[piece[1:].encode().lower()] = start.get(piece[1:].encode().lower(), 0) + weight
            else:
                key = piece.encode().lower()
                inside[key] = inside.get(key, 0) + weight
        return Lattice.of_weights(start, inside, 3.0)

    @staticmethod
    def of_weights(start: dict, inside: dict, stop: float) -> Lattice:
        whole, parts = sum(start.values()), sum(inside.values()) + stop
        return Lattice(
            {p: math.log(w / whole) for p, w in start.items()},
            {p: math.log(w / parts) for p, w in inside.items()},
            math.log(stop / parts),
        )

    def edges(self, word: bytes) -> list[list[tuple[int, bytes, float]]]:
        """Per position the pieces that end there: where each begins, -1 for a start piece."""
        ends: list[list] = [[] for _ in range(len(word) + 1)]
        for size in range(min(len(word), self.longest_start) + 1):
            weight = self.start.get(word[:size])
            if weight is not None:
                ends[size].append((-1, word[:size], weight))
        inside, prefixes, n = self.inside, self.prefixes, len(word)
        for at in range(n):
            for end in range(at + 1, min(n, at + self.longest) + 1):
                piece = word[at:end]
                if piece not in prefixes:
                    break
                weight = inside.get(piece)
                if weight is not None:
                    ends[end].append((at, piece, weight))
        return ends

    def forward(self, ends: list[list]) -> list[float]:
        """Log probability of reaching each position, over all ways."""
        reach = [-math.inf] * len(ends)
        for place, arriving in enumerate(ends):
            ways = [w if at < 0 else w + reach[at] for at, _, w in arriving]
            if len(ways) == 1:
                reach[place] = ways[0]
            elif ways and (top := max(ways)) > -math.inf:
                reach[place] = top + math.log(sum([math.exp(w - top) for w in ways]))
        return reach

    def spelling(self, word: bytes) -> float:
        return self.forward(self.edges(word))[-1] + self.stop

    def expect(self, word: bytes, count: int, start: Counter, inside: Counter) -> None:
        """Adds the expected number of uses of each piece in ``count`` occurrences of a word."""
        ends = self.edges(word)
        reach = self.forward(ends)
        # Share of the probability of each place that goes on to the end of the word.
        usage = [0.0] * len(ends)
        usage[-1] = float(count)
        for place in range(len(ends) - 1, -1, -1):
            if usage[place] <= 0:
                continue
            for at, piece, weight in ends[place]:
                part = usage[place] * math.exp(
                    (weight if at < 0 else weight + reach[at]) - reach[place]
                )
                if at < 0:
                    start[piece] += part
                else:
                    inside[piece] += part
                    usage[at] += part


class Trie:
    """Pieces as states of an automaton: 0 for none, 1 for the empty one, one per prefix."""

    def __init__(self, weights: dict[bytes, float]):
        prefixes = {p[:i] for p in weights for i in range(len(p) + 1)} | {b""}
        self.pieces = [b"", *sorted(prefixes)]
        states = {p: i for i, p in enumerate(self.pieces) if i}
        self.next = np.zeros((len(self.pieces), 256), np.int32)
        for prefix, state in states.items():
            if prefix:
                self.next[states[prefix[:-1]], prefix[-1]] = state
        self.weight = np.full(len(self.pieces), -np.inf)
        for piece, weight in weights.items():
            self.weight[states[piece]] = weight


class Speller:
    """The recursions of a lattice over many words at once; words of one length go together."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.start, self.inside = Trie(lattice.start), Trie(lattice.inside)
        self.start_uses = np.zeros(len(self.start.pieces))
        self.inside_uses = np.zeros(len(self.inside.pieces))
        self.long_uses = (Counter(), Counter())

    @staticmethod
    def _groups(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and bytes (a row per position) of the words of each length up to KEY."""
        sizes = np.array([len(w) for w in words], np.int64)
        for size in np.unique(sizes[sizes <= KEY]):
            places = np.flatnonzero(sizes == size)
            joined = np.frombuffer(b"".join([words[i] for i in places]), np.uint8)
            yield places, np.ascontiguousarray(joined.reshape(len(places), size).T)

    def _forward(self, text: np.ndarray) -> tuple[np.ndarray, list, list]:
        """Log probability of reaching each position, and the edges: where, which words, pieces."""
        size, count = text.shape
        reach = np.full((size + 1, count), -np.inf)
        starts, insides = [], []
        words, states = np.arange(count), np.ones(count, np.int32)
        for end in range(size + 1):
            if end:
                states = self.start.next[states, text[end - 1, words]]
                words, states = words[states > 0], states[states > 0]
            weights = self.start.weight[states]
            found = weights > -np.inf
            reach[end, words[found]] = weights[found]
            starts.append((end, words[found], states[found]))
        for at in range(size):
            words = np.flatnonzero(reach[at] > -np.inf)
            states = np.ones(len(words), np.int32)
            for end in range(at + 1, size + 1):
                states = self.inside.next[states, text[end - 1, words]]
                words, states = words[states > 0], states[states > 0]
                if not len(words):
                    break
                weights = self.inside.weight[states]
                found = weights > -np.inf
                edge, uses = words[found], states[found]
                reach[end, edge] = np.logaddexp(reach[end, edge], reach[at, edge] + weights[found])
                insides.append((at, end, edge, uses))
        return reach, starts, insides

    def spellings(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word's spelling."""
        found = np.empty(len(words))
        for places, text in self._groups(words):
            found[places] = self._forward(text)[0][-1] + self.lattice.stop
        for place, word in enumerate(words):
            if len(word) > KEY:
                found[place] = self.lattice.spelling(word)
        return found

    def expect(self, words: list[bytes], counts: list[int]) -> None:
        """Adds the expected number of uses of each piece in the words' occurrences."""
        weights = np.array(counts, np.float64)
        for places, text in self._groups(words):
            reach, starts, insides = self._forward(text)
            # Share of the probability of each place that goes on to the end of the word.
            usage = np.zeros_like(reach)
            usage[-1] = weights[places]
            parts = []
            for at, end, edge, states in reversed(insides):
                way = self.inside.weight[states] + reach[at, edge] - reach[end, edge]
                parts.append(usage[end, edge] * np.exp(way))
                usage[at, edge] += parts[-1]
            if parts:
                states = np.concatenate([e[3] for e in reversed(insides)])
                self.inside_uses += np.bincount(
                    states, np.concatenate(parts), len(self.inside_uses)
                )
            for end, edge, states in starts:
                way = self.start.weight[states] - reach[end, edge]
                part = usage[end, edge] * np.exp(way)
                self.start_uses += np.bincount(states, part, len(self.start_uses))
        for word, count in zip(words, counts):
            if len(word) > KEY:
                self.lattice.expect(word, count, *self.long_uses)

    def uses(self) -> tuple[Counter, Counter]:
        """Expected uses of the pieces at the start of a word, and of those inside."""
        start, inside = Counter(self.long_uses[0]), Counter(self.long_uses[1])
        for sums, trie, found in (
            (start, self.start, self.start_uses),
            (inside, self.inside, self.inside_uses),
        ):
            for state in np.flatnonzero(found):
                sums[trie.pieces[state]] += float(found[state])
        return start, inside


# --- counts ------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, word, n) over all texts; each batch hands on one row per distinct word."""

    def run(batches):
        for batch in batches:
            counts = Counter()
            for body in batch["body"]:
                counts.update(body.lower().split())
            yield {
                "key": list(map(word_key, counts)),
                "long": [w if len(w) > KEY else None for w in counts],
                "n": list(counts.values()),
            }

    read = texts.select(as_bytes().alias("body"))
    counted = map_batches(read, run, "key binary, long binary, n bigint")
    # A key belongs to one word, so grouping by both changes nothing, and needs no sort.
    sums = counted.groupBy("key", "long").agg(F.sum("n").alias("n"))
    return sums.select("key", F.coalesce("long", "key").alias("word"), "n")


def estimate(counts: DataFrame, prior: Lattice) -> Lattice:
    """Piece probabilities from expected counts over all words, smoothed by the prior's."""
    shared = counts.sparkSession.sparkContext.broadcast(_parts(prior))

    def run(batches):
        speller, words = Speller(Lattice(*shared.value)), 0
        for batch in batches:
            speller.expect(batch["word"], batch["n"])
            words += sum(batch["n"])
        start, inside = speller.uses()
        yield {
            "place": [0] * len(start) + [1] * len(inside) + [2],
            "piece": [*start, *inside, b""],
            "n": [*start.values(), *inside.values(), float(words)],
        }

    found = map_batches(counts.select("word", "n"), run, "place int, piece binary, n double")
    sums = {0: Counter(), 1: Counter(), 2: Counter()}
    # As many rows as the vocabulary has pieces.
    for row in found.groupBy("place", "piece").agg(F.sum("n").alias("n")).collect():
        sums[row.place][bytes(row.piece)] = row.n
    if not sums[2][b""]:
        return prior
    # The prior counts as much as a word for each piece.
    start = {p: sums[0][p] + len(prior.start) * math.exp(w) for p, w in prior.start.items()}
    inside = {p: sums[1][p] + len(prior.inside) * math.exp(w) for p, w in prior.inside.items()}
    return Lattice.of_weights(
        start, inside, sums[2][b""] + len(prior.inside) * math.exp(prior.stop)
    )


def with_spellings(counts: DataFrame, lattice: Lattice) -> DataFrame:
    """(key, n, spelling): log10 probability of the spelling of each word."""
    shared = counts.sparkSession.sparkContext.broadcast(_parts(lattice))

    def run(batches):
        speller = Speller(Lattice(*shared.value))
        for batch in batches:
            spelled = (speller.spellings(batch["word"]) / LOG10).tolist()
            yield {"key": batch["key"], "n": batch["n"], "spelling": spelled}

    return map_batches(counts, run, "key binary, n bigint, spelling double")


def _parts(lattice: Lattice) -> tuple:
    return lattice.start, lattice.inside, lattice.stop


# --- scores ------------------------------------------------------------------------------------

PARTS = "doc_id bigint, row bigint, n_tokens bigint, n_known bigint, base double, score double, " \
        "rare array<struct<key: binary, uses: int, word: binary>>"  # fmt: skip


def score(docs: DataFrame, learn_from: Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: n_tokens, n_known, train_tokens, base_score and score (log10)."""
    training = docs.where(learn_from).select("text")
    counts = stored(word_counts(training), "word_counts")
    texts = training.count()
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total = (totals.n or 0) + texts
    distinct = totals.v + (texts > 0)
    lattice = estimate(counts, Lattice.from_file(vocabulary))
    words = stored(with_spellings(counts, lattice), "spelled_words")
    least = most_frequent(words, FREQUENT)
    top = words.where(F.col("n") >= least).toPandas()
    frequent = dict(zip(map(bytes, top["key"]), zip(top["n"].tolist(), top["spelling"].tolist())))
    base_total = math.log10(total + 1 * (distinct + 1))
    model_total = math.log10(total + distinct + 1)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((frequent, _parts(lattice)))
    # The end token is a token like others, but is not spelled: a fixed share of the rest is its.
    end_share = 1e-3
    end_score = math.log10(texts + (distinct + 1) * end_share) - model_total
    end_base = math.log10(texts + 1) - base_total
    spelled_share = math.log10((distinct + 1) * (1 - end_share))

    def mixed(count: int, spelling: float) -> float:
        """log10 of count + (T + 1) * P(spelling)."""
        rest = spelled_share + spelling
        if not count:
            return rest
        seen = math.log10(count)
        return max(seen, rest) + math.log10(1 + 10 ** -abs(seen - rest))

    def run(batches):
        frequent = shared.value[0]
        places = {key: place for place, key in enumerate(frequent)}
        bases = np.array([math.log10(n + 1) - base_total for n, _ in frequent.values()] + [0.0])
        values = np.array([mixed(*found) - model_total for found in frequent.values()] + [0.0])
        none = len(frequent)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_tokens", "n_known", "base", "score")}
            keys, uses, long, ends = [], [], [], [0]
            for body in batch["body"]:
                words = body.lower().split()
                found = np.fromiter((places.get(w, none) for w in words), np.int64, len(words))
                for place in np.flatnonzero(found == none):
                    if len(words[place]) > KEY:
                        found[place] = places.get(word_key(words[place]), none)
                unmet = np.flatnonzero(found == none)
                rare = Counter([words[i] for i in unmet])
                keys += map(word_key, rare)
                uses += rare.values()
                long += [w if len(w) > KEY else None for w in rare]
                ends.append(len(keys))
                seen = len(words) - len(unmet) + int(texts > 0)
                sums = end_base + bases[found].sum(), end_score + values[found].sum()
                for column, x in zip(out.values(), (len(words) + 1, seen, *sums)):
                    column.append(x)
            columns = [pa.array(keys, pa.binary()), pa.array(uses, pa.int32()), pa.array(long, pa.binary())]
            structs = pa.StructArray.from_arrays(columns, names=["key", "uses", "word"])
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
            yield {"doc_id": batch["doc_id"], "row": batch["row"], **out, "rare": rare}

    read = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), as_bytes().alias("body")
    )
    scored = stored(map_batches(read, run, PARTS), "scored")

    @F.pandas_udf("double")
    def spelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """log10 probability of the spelling of each word; nulls are words of the table."""
        speller = None
        for words in batches:
            found = np.full(len(words), np.nan)
            new = words.notna().to_numpy()
            if new.any():
                speller = speller or Speller(Lattice(*shared.value[1]))
                places, distinct = pd.factorize(words[new])
                found[new] = (speller.spellings(list(distinct)) / LOG10)[places]
            yield pd.Series(found)

    n = F.coalesce("n", F.lit(0))
    unknown = F.when(F.col("spelling").isNull(), F.coalesce("word", "key"))
    rest = F.coalesce("spelling", spelled(unknown)) + spelled_share
    seen = F.log10(n)
    # As in ``mixed``.
    value = F.when(n == 0, rest).otherwise(
        F.greatest(seen, rest) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(seen - rest)))
    )
    met = (
        scored.select("row", F.inline("rare"))
        .join(words.where(F.col("n") < least), "key", "left")
        .select(
            "row",
            "uses",
            F.when(n > 0, F.col("uses")).otherwise(0).alias("known"),
            (F.col("uses") * (F.log10(n + 1) - base_total)).alias("base"),
            (F.col("uses") * (value - model_total)).alias("value"),
        )
        .groupBy("row")
        .agg(
            F.sum("known").alias("rare_known"),
            F.sum("base").alias("rare_base"),
            F.sum("value").alias("rare_value"),
        )
    )
    zero = F.lit(0)
    return scored.join(met, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_value", zero)).alias("score"),
    )
