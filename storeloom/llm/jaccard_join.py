"""Size-aware heavy-light Jaccard join of documents on word n-grams, as connected components.

Documents of one shingle set form a class, and classes are joined:

- *Small* sets name every subset of the size that a partner must share. The subset size is fixed
  per pair of set sizes, so two linked sets meet in at least one subset.
- *Large* sets scan inverted lists. Two linked sets share a shingle among the first ones of each
  in any common order, so only those enter the lists; the order puts frequent shingles last.
  A set that is small but near enough in size to a large one enters the lists too.
- The *boundary* is the largest size up to which naming subsets costs no more than scanning.

Every meeting of two classes is verified on the whole texts, except where that cannot change a
component. First each class is compared with one other: of the earliest members of like size in
its lists, the one it meets most often. Rounds follow for lists of many classes: each names a few of
its members by chance, and a class is compared with a bounded number of those in other components,
until none links. Then the classes that still meet in different components are compared.
A group of near copies so costs little more than its size, while no link that joins two
components is lost.

Nulls and empties: a text without words has an empty set, links to nothing and is its own
component. A null ``doc_id`` gets a null component and takes part in no link. Rows that repeat a
``doc_id`` with one text are one node; with different texts, each text is one. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import (
    ID_SLOT,
    as_bytes,
    bound_batches,
    columns,
    component_labels,
    emptied,
    id_filter,
    map_batches,
    most_frequent,
    settled,
)
from storeloom.llm.words import distinct, shingle_sets

# Frequent shingles that are ordered last: 16 bytes each, so 8 MB are sent to a task.
MAX_FREQUENT = 500_000
# Shingles are counted in runs of so many (8 MB), and a count below the second number is not reported.
COUNT_RUN = 1 << 20
LEAST_COUNT = 2
# No set above this size can be small: the number of subsets multiplies from there on.
MAX_SMALL = 13
# One list in so many proposes the first comparison of a class; all lists take part afterwards.
CHOICE_LISTS = 4
# Members that a list names and partners of a class in the first round, twice as many in each further
# one, and rounds at most.
NAMED, PARTNERS, ROUNDS = 4, 8, 4
# Entries with more of like size in their list take part in the rounds; others have few pairs.
MANY = 64
# Shingles that a comparing task keeps from one pair to the next: 4 MB.
KNOWN_SHINGLES = 1 << 19
# Classes a task remembers, to enter copies into the lists only once.
MAX_SEEN = 100_000


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection of sets of sizes a and b that reaches ``percent``."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def class_key(shingles: np.ndarray) -> int:
    """64 bits for a set, like those of a shingle."""
    return _long(shingles.tobytes())


def _long(data: bytes) -> int:
    digest = hashlib.blake2b(data, digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


# --- sets, frequent shingles and the boundary --------------------------------------------------

SETS = "doc_id bigint, n bigint, class bigint, shingle bigint"


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """A row per document. Rows without a class count shingles: often seen ones by value, and
    under a null value the sum of squared counts with the sum of counts as ``doc_id``."""

    def count(found: list[np.ndarray]) -> dict[str, list]:
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        often = counts >= LEAST_COUNT
        shown = _signed(values[often])
        return {
            "doc_id": [None] * len(shown) + [int(counts.sum())],
            "n": counts[often].tolist() + [int((counts * counts).sum())],
            "class": [None] * (len(shown) + 1),
            "shingle": [*shown, None],
        }

    def run(batches):
        run_length, found = 0, []
        for batch in batches:
            sizes, keys = [], []
            for shingles in shingle_sets(batch["body"], words):
                sizes.append(len(shingles))
                keys.append(class_key(shingles))
                if len(shingles):
                    found.append(shingles)
                    run_length += len(shingles)
                if run_length >= COUNT_RUN:
                    yield count(found)
                    run_length, found = 0, []
            yield {"doc_id": batch["doc_id"], "n": sizes, "class": keys,
                   "shingle": [None] * len(sizes)}
        if found:
            yield count(found)

    return map_batches(docs.select("doc_id", as_bytes().alias("body")), run, SETS)


def _frequent(counted: DataFrame) -> np.ndarray:
    """The most frequent shingles, rarest first."""
    summed = (
        counted.where("class is null and shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )
    rows = summed.where(F.col("n") >= most_frequent(summed, MAX_FREQUENT)).toArrow()
    values, n = rows["shingle"].to_numpy().astype(np.int64), rows["n"].to_numpy()
    return values[np.lexsort((values, n))].view(np.uint64)


def subset_cost(n: int, percent: int) -> int:
    return sum(
        math.comb(n, min(n, least_overlap(n, m, percent))) for m in partner_sizes(n, percent)
    )


def boundary(counted: DataFrame, percent: int) -> int:
    """Largest size whose subsets cost no more than scanning the lists of its prefix.

    The mean list a shingle is in follows from the squared counts per run of shingles, carried
    on in proportion to the number of runs.
    """
    totals = counted.where("class is null and shingle is null").agg(
        F.sum("n").alias("squares"), F.sum("doc_id").alias("total"), F.count("*").alias("runs")
    )
    row = totals.first()
    if not row.runs:
        return 0
    mean_list = 1 + (row.squares / row.total - 1) * row.runs
    small = 0
    for n in range(1, MAX_SMALL + 1):
        prefix = n - least_overlap(n, partner_sizes(n, percent)[0], percent) + 1
        if subset_cost(n, percent) > prefix * mean_list:
            break
        small = n
    return small


# --- meetings ----------------------------------------------------------------------------------

ENTRIES = "class bigint, n int, keys array<bigint>, frequent_from int, subsets array<bigint>"


def _entries(docs: DataFrame, words: int, percent: int, frequent: np.ndarray, small: int):
    """Per class (and task) the first shingles in the common order, and the subsets."""
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order))
    near_large = -(-percent * (small + 1) // 100)

    def first_ones(shingles: np.ndarray) -> tuple[np.ndarray, int]:
        sorted_values, rank = shared.value
        n = len(shingles)
        size = n - -(-percent * n // 100) + 1
        if not len(sorted_values):
            return shingles[:size], size
        place = np.minimum(np.searchsorted(sorted_values, shingles), len(sorted_values) - 1)
        often = sorted_values[place] == shingles
        rare = shingles[~often][:size]
        late = shingles[often][np.argsort(rank[place[often]], kind="stable")]
        return np.concatenate([rare, late[: size - len(rare)]]), len(rare)

    def subsets(shingles: np.ndarray) -> list[int]:
        n, keys = len(shingles), []
        for m in partner_sizes(n, percent):
            shared = least_overlap(n, m, percent)
            if m > small or shared > min(n, m):
                continue
            sizes = np.array([min(n, m), max(n, m)], np.uint64).tobytes()
            for chosen in combinations(range(n), shared):
                named = sizes + shingles[list(chosen)].tobytes()
                keys.append(_long(named))
        return keys

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            out = {n: [] for n in ("class", "n", "keys", "frequent_from", "subsets")}
            for shingles in shingle_sets(batch["body"], words):
                key = class_key(shingles)
                if not len(shingles) or key in seen:
                    continue
                if len(seen) >= MAX_SEEN:
                    seen.clear()
                seen.add(key)
                n = len(shingles)
                keys, since = first_ones(shingles) if n >= near_large else (shingles[:0], 0)
                out["class"].append(key)
                out["n"].append(n)
                out["keys"].append(_signed(keys))
                out["frequent_from"].append(since)
                out["subsets"].append(subsets(shingles) if n <= small else [])
            yield out

    named = docs.where("doc_id is not null").select(as_bytes().alias("body"))
    return map_batches(named, run, ENTRIES), shared


def _meetings(entries: DataFrame, percent: int) -> DataFrame:
    """List entries (key, class, n, pos, size_step) whose list holds more than one class.

    Frequent shingles surely do. The lists of the others are short, except those of subsets that
    many texts share, and go through one shuffle by key.
    """
    listed = entries.select(
        "class", "n", "frequent_from", F.posexplode("keys").alias("pos", "key")
    )
    often = listed.where("pos >= frequent_from").select("key", "class", "n", "pos")
    rare = listed.where("pos < frequent_from").select("key", "class", "n", "pos")
    named = entries.select(F.explode("subsets").alias("key"), "class", "n", F.lit(0).alias("pos"))
    both = rare.union(named).withColumns(
        {
            "low": F.expr("min(class) over (partition by key)"),
            "high": F.expr("max(class) over (partition by key)"),
        }
    )
    step = math.log(100 / percent) * (1 + 1e-9)
    return (
        both.where("low <> high")
        .select("key", "class", "n", "pos")
        .union(often)
        .distinct()
        .withColumn("size_step", F.floor(F.log("n") / step).cast("int"))
    )


def _may_link(percent: int) -> str:
    """Two entries can be the first shingle of a link: sizes and the rest of each set allow it."""
    return f"least(x.n - x.pos, y.n - y.pos) * {100 + percent} >= {percent} * (x.n + y.n)"


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(
        F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")
    ).distinct()


def _pairs_with_best(meetings: DataFrame, percent: int) -> DataFrame:
    """A class and the one it meets most often. This only saves comparisons later, so a quarter of
    the lists, by hash, is enough to choose from."""
    meetings = meetings.where(f"pmod(key, {CHOICE_LISTS}) = 0")
    earliest = settled(
        meetings.groupBy("key", "size_step")
        .agg(F.min(F.struct("pos", "class", "n")).alias("e"))
        .select("key", "size_step", "e.*"),
        "earliest",
    )
    reach = meetings.withColumn("size_step", F.explode(F.expr("array(size_step, size_step - 1)")))
    met = (
        reach.alias("x")
        .join(earliest.alias("y"), ["key", "size_step"])
        .where("x.class <> y.class")
        .where(_may_link(percent))
        .groupBy("x.class", F.col("y.class").alias("partner"))
        .agg(F.count("*").alias("lists"))
    )
    best = met.groupBy("class").agg(F.max(F.struct("lists", "partner")).alias("best"))
    return best.select(
        F.least("class", "best.partner").alias("a"), F.greatest("class", "best.partner").alias("b")
    ).distinct()


def _mixed(labelled: DataFrame, percent: int) -> DataFrame:
    """The entries that may link to one of another component in their list: among those of like
    size, as their size step and the ones next to it are, some are of another component, and the
    smallest size and the most that is left of a set there allow it. ``near`` counts these.

    A list has few size steps, however many entries, so it is their totals that meet.
    """
    steps = labelled.groupBy("key", "size_step").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.min("n").alias("least"),
        F.max(F.col("n") - F.col("pos")).alias("left"),
        F.count("*").alias("entries"),
    )
    within = "over (partition by key order by size_step range between 1 preceding and 1 following)"
    steps = steps.selectExpr(
        "key as k", "size_step as s", f"min(low) {within} <> max(high) {within} as meets",
        f"min(least) {within} as least", f"max(left) {within} as left",
        f"sum(entries) {within} as near",
    )
    steps = steps.where("meets").drop("meets").hint("rebalance")
    found = labelled.drop("near").join(steps, F.expr("key = k and size_step = s"))
    may = f"least(n - pos, left) * {100 + percent} >= {percent} * (n + least)"
    return settled(found.where(may).drop("k", "s", "least", "left"), "mixed")


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """List entries with the label of their class, which is the class itself where it has no link."""
    known = labels.withColumnRenamed("node", "class").hint("rebalance")
    found = entries.drop("label").join(known, "class", "left")
    return settled(found.withColumn("label", F.coalesce("label", "class")), "labelled")


def _merged(mixed: DataFrame, links: DataFrame) -> DataFrame:
    """``mixed`` with the labels that ``links`` join made one, over at most four of them in a row.
    Components may stay apart here, which costs comparisons and changes nothing."""
    label = mixed.select("class", "label").distinct()
    met = links.join(label.toDF("a", "la"), "a").join(label.toDF("b", "lb"), "b").where("la <> lb")
    hop = met.groupBy(F.greatest("la", "lb").alias("l")).agg(F.min(F.least("la", "lb")).alias("m"))
    for _ in range(2):
        further = hop.select(F.col("l").alias("m"), F.col("m").alias("next"))
        hop = hop.join(further, "m", "left").select("l", F.coalesce("next", "m").alias("m"))
    hop = hop.hint("rebalance")
    found = mixed.join(hop, F.col("label") == F.col("l"), "left")
    return found.withColumn("label", F.coalesce("m", "label")).drop("l", "m")


def _pairs_by_chance(mixed: DataFrame, round: int, percent: int) -> DataFrame:
    """Pairs of a class and members that its lists name, of those it meets most often some few."""
    # Spark keeps so many of a list in every map task before it deals the rows.
    order = f"row_number() over (partition by key order by xxhash64(class, key, {round}), class)"
    named = mixed.selectExpr("*", f"{order} as place").where(F.col("place") <= NAMED << round)
    named = named.drop("place").hint("rebalance")
    met = (
        mixed.alias("x")
        .join(named.alias("y"), "key")
        .where("x.label <> y.label")
        .where(_may_link(percent))
        .groupBy("x.class", F.col("y.class").alias("partner"))
        .agg(F.count("*").alias("lists"))
    )
    order = "row_number() over (partition by class order by lists desc, partner) as place"
    few = met.selectExpr("class", "partner", order).where(F.col("place") <= PARTNERS << round)
    return few.select(
        F.least("class", "partner").alias("a"), F.greatest("class", "partner").alias("b")
    ).distinct()


def _pairs_between(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs in one list whose classes lie in different components."""
    return _pairs(
        mixed.alias("x")
        .join(mixed.alias("y"), "key")
        .where("x.label < y.label")
        .where(_may_link(percent))
    )


# --- verification ------------------------------------------------------------------------------


def _texts(docs: DataFrame, nodes: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(class, body) of the classes ``asked``: one compressed text of each.

    A bit filter of fixed size first keeps the documents that may be asked for, so that only
    their texts are moved, and copies among them meet in the map task.
    """
    packed = id_filter(nodes.join(asked, "class"))

    def run(batches):
        wanted = np.unpackbits(packed).astype(bool)
        for batch in batches:
            chosen = np.flatnonzero(wanted[np.array(batch["slot"], np.int64)])
            bodies = [batch["body"][i] for i in chosen]
            yield {
                "class": [class_key(s) for s in shingle_sets(bodies, words)],
                "body": [zstandard.compress(body) for body in bodies],
            }

    read = docs.where("doc_id is not null").select(F.expr(ID_SLOT).alias("slot"), as_bytes().alias("body"))
    texts = map_batches(read, run, "class bigint, body binary")
    texts = texts.dropDuplicates(["class"]).join(asked, "class", "left_semi")
    return settled(texts, "texts")


def _texts_of(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``texts`` without most of those that no pair names, so that a round of few pairs moves few of
    them. A bit filter of fixed size lets some others by, which then meet no pair."""
    packed = id_filter(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))

    def run(batches):
        wanted = np.unpackbits(packed).astype(bool)
        for batch in batches:
            chosen = np.flatnonzero(wanted[np.array(batch["slot"], np.int64)])
            yield {name: [batch[name][i] for i in chosen] for name in ("class", "body")}

    slot = F.expr(ID_SLOT.replace("doc_id", "class")).alias("slot")
    return map_batches(texts.select("class", "body", slot), run, "class bigint, body binary")


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole texts reach ``percent``."""

    def run(batches):
        known: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            kept = {"a": [], "b": []}
            for a, b, body_a, body_b in zip(*(batch[c] for c in ("a", "b", "body_a", "body_b"))):
                if held > KNOWN_SHINGLES:
                    known.clear()
                    held = 0
                for key, body in ((a, body_a), (b, body_b)):
                    if key not in known:
                        known[key] = next(shingle_sets([zstandard.decompress(body)], words))
                        held += len(known[key])
                x, y = known[a], known[b]
                both = len(x) + len(y)
                if 100 * (same := both - len(distinct(np.concatenate([x, y])))) >= percent * (
                    both - same
                ):
                    kept["a"].append(a)
                    kept["b"].append(b)
            yield kept

    bodies = pairs.join(texts.toDF("a", "body_a"), "a").join(texts.toDF("b", "body_b"), "b")
    return settled(map_batches(bodies, run, "a bigint, b bigint"), "links")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    bound_batches(docs.sparkSession)
    counted = settled(_sets(docs, words), "sets")
    small = boundary(counted, percent)
    entries, shared = _entries(docs, words, percent, _frequent(counted), small)
    meetings = settled(_meetings(entries, percent), "meetings")
    shared.destroy()
    sets = counted.where("class is not null").select("doc_id", "n", "class")
    nodes = sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    nodes = settled(nodes, "nodes")

    tried = settled(_pairs_with_best(meetings, percent), "pairs")
    asked = tried.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    texts = _texts(docs, nodes, asked, words)
    links = _links(tried, texts, words, percent)
    emptied(texts)
    labels = settled(component_labels(links), "labels")
    labelled = _labelled(meetings, labels)
    emptied(meetings)
    mixed = _mixed(labelled, percent)
    emptied(labelled)
    texts = _texts(docs, nodes, mixed.select("class").distinct(), words)

    many, linked = settled(mixed.where(F.col("near") > MANY), "many"), 0
    for round in range(ROUNDS):
        if many.isEmpty():
            break
        pairs = _pairs_by_chance(many, round, percent).join(tried, ["a", "b"], "left_anti")
        pairs = settled(pairs, "pairs")
        found = _links(pairs, _texts_of(texts, pairs), words, percent)
        tried, links = tried.union(pairs), links.union(found)
        if found.isEmpty():
            break
        linked, before = linked + 1, many
        merged = settled(_merged(many, found), "merged")
        many = _mixed(merged, percent)
        emptied(before)
        emptied(merged)
    emptied(many)
    if linked:
        labels = settled(component_labels(links), "labels")
        labelled = _labelled(mixed, labels)
        emptied(mixed)
        mixed = _mixed(labelled, percent)
        emptied(labelled)
    rest = settled(_pairs_between(mixed, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    found = _links(rest, _texts_of(texts, rest), words, percent)
    emptied(texts)
    emptied(mixed)
    if not found.isEmpty():
        links = links.union(found)
        labels = settled(component_labels(links), "labels")

    grouped = nodes.join(labels.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "class"))
    lowest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(settled(lowest, "lowest"), "label").select("class", "component_id")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return sets.join(settled(of_class, "components"), "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
    )


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that link to one of a smaller ``doc_id``, directly or not.

    Rows with a null ``doc_id`` stay; rows that repeat a ``doc_id`` stay or go together.
    """
    found = jaccard_components(docs.select("doc_id", "text"), words, percent)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*columns(docs))
