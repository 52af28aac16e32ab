"""Near-duplicate documents from bottom-k sketches, confirmed on full shingle sets.

1. Each text becomes the set of hashes of its word shingles; its sketch are the k smallest. Texts with
   equal sets are one class, so copies, however many, are one row from here on.
2. Sketch values are counted over all classes. A value held by one class alone can't make a pair. Each
   class orders its values from rare to frequent and enters only the first s - t + 1 of s of them into
   inverted lists, t being the least overlap that a pair of the wanted similarity has (it has less
   with a chance of at most ``MISS_CHANCE``): two sketches with t common values meet in that prefix.
   A list is of one value and one range of sizes, as sets of too different sizes can't be alike.
3. In every list one pivot, the member whose values are most frequent, that is the one most like the
   others, is compared with the rest: a list of m members gives m - 1 pairs, not m squared.
   Pairs are filtered by size and by the similarity that the union of both sketches estimates; what
   is left is confirmed on the full sets.
4. Linked classes form components (least label over links, with pointer jumping). A list whose members
   are all in one component is done. Small lists that are not are finished by comparing members of
   different components. Members of large ones enter finer lists, of the rarest values of their full
   sets that other members hold too: as many as a pair of its sizes may have beyond the overlap it
   needs, which is exact. So a member with many values of its own, like a text too far from the one
   that all others resemble, is in none or few. Lists that are still large take a pivot first.
5. What is left are pairs of a member outside its list's largest component and another, of which the
   values from their common one on are still enough. They are compared in shares; pairs that one
   component holds by then are dropped. No list takes more rounds for having more members.

Copies of a hot text are one class before anything is joined, list members are counted with partial
sums, and joins on hot keys are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, bounded_chunks, mixed, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 80
SKETCH = 64
MISS_CHANCE = 1e-7
SMALL_LIST = 64
SMALL_FINE_LIST = 1024
#: Steps of size in finer lists, from the least set that may be linked with another up to that.
SIZE_STEPS = 16
#: Pairs of a share, times the members of finer lists, and at least.
PAIRS_A_MEMBER = 32
PAIRS_AT_ONCE = 200_000
IDS_TO_BROADCAST = 200_000

#: Words are separated by these bytes alone.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text with fewer words is one shingle, without words none."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for _, chunk in bounded_chunks(data):
        hashes, firsts = word_hashes(chunk, _SPACE)
        ends = np.append(firsts[1:], len(hashes))
        with np.errstate(over="ignore"):
            n = max(len(hashes) - words + 1, 0)
            rolled = np.zeros(n, np.uint64)
            for k in range(words):
                rolled = mixed(rolled * _STEP + hashes[k : k + n] + np.uint64(k + 1))
            for low, high in zip(firsts.tolist(), ends.tolist(), strict=True):
                if high - low >= words:
                    yield np.unique(rolled[low : high - words + 1].view(np.int64))
                elif high > low:
                    short = np.zeros(1, np.uint64)
                    for k in range(high - low):
                        short = mixed(short * _STEP + hashes[low + k] + np.uint64(k + 1))
                    yield mixed(short + np.uint64(high - low)).view(np.int64)
                else:
                    yield np.zeros(0, np.int64)


def _set_key(values: np.ndarray) -> bytes | None:
    """128 bits that are equal for equal sets."""
    if not len(values):
        return None
    own = values.view(np.uint64)
    with np.errstate(over="ignore"):
        return mixed(own ^ _STEP).sum().tobytes() + mixed(own + _STEP).sum().tobytes()


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))


def sketched(docs: DataFrame, words: int, sketch: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key (null without words), sketch, of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = list(shingle_sets(part.column("text").to_pylist(), words))
            columns = {
                "n_shingles": pa.array(map(len, sets), pa.int64()),
                "set_key": pa.array(map(_set_key, sets), pa.binary()),
                "sketch": _lists([values[:sketch] for values in sets]),
            }
            kept = {name: part.column(name) for name in ("doc_id", "text_hash")}
            yield pa.RecordBatch.from_pydict(kept | columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return texts.mapInArrow(rows, f"doc_id {kind}, text_hash long, n_shingles long, set_key binary, sketch array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """set_key and values (the full set) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = list(shingle_sets(part.column("text").to_pylist(), words))
            yield pa.RecordBatch.from_pydict({"set_key": pa.array(map(_set_key, sets), pa.binary()), "values": _lists(sets)})

    return docs.select("text").mapInArrow(rows, "set_key binary, values array<long>")


def least_overlap(percent: int, sketch: int) -> int:
    """The most values that the sketch of a union has in common but for a chance of ``MISS_CHANCE``, at ``percent`` of similarity.

    Each value of the union's sketch is common with the chance of the similarity, so their number is
    binomial (or, drawn from few shingles, closer to its mean); the tail is summed exactly.
    """
    share = percent / 100
    least, chance = 0, 0.0  # chance of fewer than ``least``
    while least < sketch:
        chance += comb(sketch, least) * share**least * (1 - share) ** (sketch - least)
        if chance > MISS_CHANCE:
            break
        least += 1
    return least


class _Links:
    """Confirms candidate pairs of classes and keeps the links and components found so far."""

    def __init__(self, space: Workspace, docs: DataFrame, classes: DataFrame, words: int, percent: int, sketch: int):
        self.space, self.docs, self.classes = space, docs, classes
        self.words, self.percent, self.sketch = words, percent, sketch
        self.least_overlap = least_overlap(percent, sketch)
        self.links: DataFrame | None = None
        self.components: DataFrame | None = None  # cid, component; of linked classes

    def full_sets(self, cids: DataFrame) -> DataFrame:
        """cid, values (the full set) of some classes (cid)."""
        needed = self.space.store(cids.join(self.classes.select("cid", "set_key", "rep_id"), "cid"), "needed")
        ids = needed.select(F.col("rep_id").alias("doc_id"))
        ids = F.broadcast(ids) if ids.count() <= IDS_TO_BROADCAST else ids
        texts = self.docs.select("doc_id", "text").join(ids, self.docs.doc_id.eqNullSafe(ids.doc_id), "left_semi")
        # Several rows may have a class's id, with the class's text or another.
        sets = full_sets(texts, self.words).join(needed.select("set_key", "cid"), "set_key")
        return self.space.store(sets.select("cid", "values"), "sets").dropDuplicates(["cid"])

    def confirm(self, pairs: DataFrame, sets: DataFrame | None = None) -> bool:
        """Add the links among pairs (a, b); whether there were any. sets: full sets that hold those of the pairs."""
        side = self.classes.select("cid", "n_shingles", "sketch")
        a = side.withColumnsRenamed({"cid": "a", "n_shingles": "a_n", "sketch": "a_sketch"})
        b = side.withColumnsRenamed({"cid": "b", "n_shingles": "b_n", "sketch": "b_sketch"})
        sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * self.percent
        union = F.slice(F.sort_array(F.array_union("a_sketch", "b_sketch")), 1, self.sketch)
        common = F.size(F.array_intersect(union, F.array_intersect("a_sketch", "b_sketch")))
        likely = common * self.sketch >= F.size(union) * self.least_overlap
        pairs = pairs.distinct().join(a, "a").join(b, "b").where(sizes).where(likely).select("a", "b", "a_n", "b_n")
        pairs = self.space.store(pairs, "likely")
        if pairs.isEmpty():
            return False
        if sets is None:
            sets = self.full_sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        a = sets.select(F.col("cid").alias("a"), F.col("values").alias("a_values"))
        b = sets.select(F.col("cid").alias("b"), F.col("values").alias("b_values"))
        inter = F.size(F.array_intersect("a_values", "b_values"))
        exact = pairs.join(b, "b").join(a, "a").withColumn("inter", inter)
        exact = exact.where(F.col("inter") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("inter")) * self.percent)
        new = self.space.store(exact.select("a", "b"), "links")
        if new.isEmpty():
            return False
        self.links = new if self.links is None else self.space.store(self.links.union(new), "all-links")
        self.components = components(self.space, self.links)
        return True

    def with_component(self, rows: DataFrame) -> DataFrame:
        if self.components is None:
            return rows.withColumn("component", F.col("cid"))
        return rows.join(self.components, "cid", "left").withColumn("component", F.coalesce("component", "cid"))


def components(space: Workspace, links: DataFrame) -> DataFrame:
    """cid, component (the smallest cid reachable) of every class with a link.

    Each round every node takes the least label among itself and its neighbours, then the label of
    that label; so labels travel twice as far each round. Ends when no label changes.
    """
    both = space.store(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("cid", "other"), "edges")
    labels = space.store(both.groupBy("cid").agg(F.least(F.col("cid"), F.min("other")).alias("component")), "labels")
    while True:
        of_other = labels.select(F.col("cid").alias("other"), F.col("component").alias("theirs"))
        least = both.join(of_other, "other").groupBy("cid").agg(F.min("theirs").alias("theirs"))
        step = labels.join(least, "cid").select("cid", "component", F.least("component", "theirs").alias("near"))
        of_label = labels.select(F.col("cid").alias("near"), F.col("component").alias("far"))
        step = step.join(of_label, "near", "left").select("cid", "component", F.least("near", F.coalesce("far", "near")).alias("new"))
        step = space.store(step, "labels")
        if step.where(F.col("new") < F.col("component")).isEmpty():
            return labels
        space.drop(labels)
        labels = step.select("cid", F.col("new").alias("component"))
        labels._stored_path = step._stored_path


def _size_range(percent: int) -> Column:
    """Number of the range of sizes; ranges grow by the ratio that linked sets' sizes may have at most.

    So two sets that can be linked are in one range or in neighbouring ones; entered under its own and
    the next one's number, each meets the other.
    """
    return F.floor(F.log(F.col("n_shingles")) / log(100 / percent))


def _prefixes(space: Workspace, classes: DataFrame, links: _Links) -> DataFrame:
    """cid, size, shared (values of its sketch that others hold too, from rare to frequent), reach, weight.

    reach: how many of ``shared`` are in the prefix; weight: how frequent they are together.
    """
    postings = classes.select("cid", F.size("sketch").alias("s"), _size_range(links.percent).alias("size"), F.explode("sketch").alias("value"))
    counts = postings.groupBy("value").count().where("count > 1")
    rows = postings.join(counts, "value").groupBy("cid", "s", "size").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("held"))
    least = F.greatest(F.floor(F.col("s") * links.least_overlap / links.sketch), F.lit(1))
    rows = rows.select(
        "cid",
        "size",
        F.transform("held", lambda h: h["value"]).alias("shared"),
        (F.col("s") - least + 1 - (F.col("s") - F.size("held"))).cast("int").alias("reach"),
        F.aggregate("held", F.lit(0).cast("long"), lambda acc, h: acc + h["count"]).alias("weight"),
    )
    return space.store(rows.where("reach > 0"), "prefixes")


def _open_lists(space: Workspace, entries: DataFrame, links: _Links) -> DataFrame:
    """Entries of lists whose members are in more than one component, with component and the list's size."""
    entries = links.with_component(entries.drop("component", "members"))
    mixed_lists = entries.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    mixed_lists = mixed_lists.where("low < high").select("list", "members")
    return space.store(entries.join(mixed_lists, "list"), "open")


def _pivot_round(entries: DataFrame, links: _Links, sets: DataFrame | None = None) -> DataFrame:
    """Compare each list's pivot, its heaviest member, with its members of other components.

    The pivot then leaves the list, as all its pairs there are settled; returns the lists still open.
    """
    space = links.space
    rank = F.struct("weight", (-F.col("cid")).alias("cid"), "component")
    pivots = entries.groupBy("list").agg(F.max(rank).alias("p"))
    pivots = space.store(pivots.select("list", (-F.col("p.cid")).alias("pivot"), F.col("p.component").alias("of_pivot")), "pivots")
    rest = entries.join(pivots, "list").where(F.col("cid") != F.col("pivot"))
    pairs = rest.where(F.col("component") != F.col("of_pivot"))
    links.confirm(pairs.select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")), sets)
    return _open_lists(space, rest.drop("pivot", "of_pivot"), links)


def _compared(entries: DataFrame, links: _Links, most: int) -> DataFrame:
    """One pivot for every list, then all pairs of different components in those of at most ``most``; the lists still open.

    A pair that meets in several lists is compared in the first of them alone.
    """
    if entries.isEmpty():
        return entries
    entries = _pivot_round(entries, links)
    small = entries.where(F.col("members") <= most)
    own_lists = small.groupBy("cid").agg(F.collect_set("list").alias("lists"))
    one = links.space.store(small.join(own_lists, "cid").select("list", "cid", "component", "lists"), "small")
    a = one.select("list", F.col("cid").alias("a"), F.col("component").alias("a_component"), F.col("lists").alias("a_lists"))
    b = one.select(F.col("list").alias("b_list"), F.col("cid").alias("b"), F.col("component").alias("b_component"), F.col("lists").alias("b_lists"))
    meet = (F.col("list") == F.col("b_list")) & (F.col("a") < F.col("b")) & (F.col("a_component") != F.col("b_component"))
    first = F.array_min(F.array_intersect("a_lists", "b_lists")) == F.col("list")
    links.confirm(a.join(b, meet & first).select("a", "b"))
    return _open_lists(links.space, entries.where(F.col("members") > most), links)


def _finer_lists(members: DataFrame, sets: DataFrame, links: _Links) -> DataFrame:
    """list, cid, weight, n, n_held, at, own: the members' entries in lists of a value of their full sets and a step of sizes.

    members: cid, weight, of classes that may be linked among each other alone. Two of them can only
    have those values in common that several hold (n_held of n), so a member's prefix of these, from
    rare to frequent, ends where fewer follow than a pair of its sizes needs. The step is that of the
    smaller one of a pair, so a member enters its own and those that it may be the larger one for.
    at: how many of its held values come before; own: the step is the member's.
    """
    space, percent = links.space, links.percent
    step = F.floor(F.log("n") / (log(100 / percent) / SIZE_STEPS))
    sizes = members.join(links.classes.select("cid", F.col("n_shingles").alias("n")), "cid").withColumn("own_step", step)
    postings = sets.select("cid", F.explode("values").alias("value"))
    counts = postings.groupBy("value").count().where("count > 1")
    held = postings.join(counts, "value").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("held"))
    rows = held.join(sizes, "cid").withColumn("n_held", F.size("held")).withColumn("held", F.transform("held", lambda h: h["value"]))
    # No partner is smaller than the least that may be linked, so members with too many values of their own end here.
    rows = space.store(rows.where(F.col("n_held") * 100 >= F.col("n") * percent), "held")
    steps = F.broadcast(space.store(rows.groupBy(F.col("own_step").alias("step")).agg(F.min("n").alias("least")), "steps"))
    rows = rows.withColumn("step", F.explode(F.sequence(F.col("own_step") - SIZE_STEPS - 1, F.col("own_step")))).join(steps, "step")
    reach = F.col("n_held") - F.ceil((F.col("n") + F.col("least")) * percent / (100 + percent)) + 1
    rows = rows.withColumn("reach", reach.cast("int")).where("reach > 0")
    own = (F.col("step") == F.col("own_step")).alias("own")
    entries = rows.select("step", "cid", "weight", "n", "n_held", own, F.posexplode(F.slice("held", F.lit(1), F.col("reach"))).alias("at", "value"))
    entries = space.store(entries.select(F.xxhash64("value", "step").alias("list"), "cid", "weight", "n", "n_held", "at", "own"), "finer")
    return entries.join(entries.where("own").select("list").distinct(), "list", "left_semi")


def _finer_pairs(entries: DataFrame, links: _Links) -> DataFrame:
    """Pairs (a, b) of finer lists that may be linked and are in different components.

    The values of both from the list's on must be as many as the pair needs, which holds in the list
    of its first common value. Members of a list's largest component meet the others alone.
    """
    space, percent = links.space, links.percent
    counts = entries.groupBy("list", "component").count()
    main = counts.groupBy("list").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    marked = space.store(entries.join(main, "list").withColumn("main", F.col("component") == F.col("main")), "marked")
    names = ("cid", "component", "n", "n_held", "at", "own", "main")
    a = marked.where("NOT main").select("list", *(F.col(c).alias(f"a_{c}") for c in names))
    b = marked.select("list", *(F.col(c).alias(f"b_{c}") for c in names))
    left = F.least(F.col("a_n_held") - F.col("a_at"), F.col("b_n_held") - F.col("b_at"))
    enough = left * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    once = F.col("b_main") | (F.col("a_cid") < F.col("b_cid"))
    apart = F.col("a_component") != F.col("b_component")
    pairs = a.join(b, "list").where(apart & (F.col("a_own") | F.col("b_own")) & once & enough)
    pairs = pairs.select(F.least("a_cid", "b_cid").alias("a"), F.greatest("a_cid", "b_cid").alias("b")).distinct()
    return space.store(pairs, "finer-pairs")


def _confirm_in_shares(pairs: DataFrame, sets: DataFrame, links: _Links, most: int) -> None:
    """Compare distinct pairs, about ``most`` at a time; those that get into one component meanwhile need it no more."""
    turn = 0
    while n := pairs.count():
        shares = -(-n // most)
        if shares == 1:
            links.confirm(pairs, sets)
            return
        turn += 1
        taken = F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(shares)) == 0
        links.confirm(pairs.where(taken), sets)
        rest = pairs.where(~taken)
        for name in ("a", "b"):
            rest = links.with_component(rest.withColumnRenamed(name, "cid")).withColumnsRenamed({"cid": name, "component": f"{name}_component"})
        rest = links.space.store(rest.where("a_component <> b_component").select("a", "b"), "finer-pairs")
        links.space.drop(pairs)
        pairs = rest


def _all_links(links: _Links, prefixes: DataFrame) -> None:
    reach = F.least(F.col("reach"), F.size("shared"))
    entries = prefixes.select("cid", "weight", "size", F.explode(F.slice("shared", F.lit(1), reach)).alias("value"))
    entries = entries.select("cid", "weight", "value", F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    entries = entries.select(F.xxhash64("value", "size").alias("list"), "cid", "weight")
    entries = _compared(_open_lists(links.space, entries, links), links, SMALL_LIST)
    if entries.isEmpty():
        return
    members = links.space.store(entries.groupBy("cid").agg(F.max("weight").alias("weight")), "members")
    sets = links.space.store(links.full_sets(members.select("cid")), "member-sets")
    entries = _open_lists(links.space, _finer_lists(members, sets, links), links)
    large = entries.where(F.col("members") > SMALL_FINE_LIST)
    if not large.isEmpty():
        large = _pivot_round(large, links, sets)
        entries = _open_lists(links.space, entries.where(F.col("members") <= SMALL_FINE_LIST).unionByName(large), links)
    _confirm_in_shares(_finer_pairs(entries, links), sets, links, max(PAIRS_AT_ONCE, PAIRS_A_MEMBER * members.count()))


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY, sketch: int = SKETCH
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id, kept.

    docs: doc_id, text; other columns are ignored. Documents are linked if 100 times the common
    shingles are at least ``percent`` times all shingles of both; component_id is the smallest doc_id
    reachable over links. Texts without words (null, empty, white space) have no shingles, are linked
    with nothing and stand for themselves. Rows of equal id belong to the components of their own
    texts; a null id is no smallest id unless there is no other. kept: the id is the component's.
    """
    space = Workspace(docs.sparkSession, "near-duplicates")
    rows = space.store(sketched(docs, words, sketch), "rows")
    classes = rows.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        F.min("doc_id").alias("rep_id"), F.min("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = space.store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links = _Links(space, docs, classes, words, percent, sketch)
    _all_links(links, _prefixes(space, classes, links))
    slim = classes.select("cid", "set_key", "rep_id")
    if links.components is None:
        found = slim.select("set_key", F.col("rep_id").alias("component_id"))
    else:
        linked = links.with_component(slim)
        least = linked.groupBy("component").agg(F.min("rep_id").alias("component_id"))
        found = linked.join(least, "component").select("set_key", "component_id")
    result = rows.select("doc_id", "text_hash", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = result.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY, sketch: int = SKETCH
) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: the one with the smallest doc_id.

    Of rows with the same id and text one stays; texts without words all do, unless id and text are
    the same. Rows that go are named by id and text, and broadcast if they are few.
    """
    space = Workspace(docs.sparkSession, "kept")
    found = space.store(near_duplicates(docs, words, percent, sketch).select("doc_id", "text_hash", "kept"), "found")
    own_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))

    def named(rows: DataFrame, how: str) -> DataFrame:
        rows = rows.toDF("__id", "__hash")
        rows = F.broadcast(rows) if rows.count() <= IDS_TO_BROADCAST else rows
        return docs.join(rows, docs["doc_id"].eqNullSafe(F.col("__id")) & (own_hash == F.col("__hash")), how)

    gone = space.store(found.where(~F.col("kept")).select("doc_id", "text_hash").distinct(), "gone")
    repeated = found.where("kept").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    repeated = space.store(repeated, "repeated")
    if repeated.isEmpty():
        return named(gone, "left_anti")
    once = named(repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return named(gone.union(repeated), "left_anti").unionByName(once)
