"""Similarity join of documents on sets of word n-grams, with prefix trees; exact.

1. Texts with equal sets of shingles are one class. Shingles are counted in ``BUCKETS`` hash buckets, a
   table of fixed size; those of buckets far above the mean are frequent. Of the others, the ones with
   a hash in the lowest quarter are low, and the classes that hold each of them are counted exactly.
   The global order: low shingles, rare first, then the rest by hash, then the frequent ones.
2. Two linked sets have a shingle in common among the first s - least + 1 of each one's s shingles in
   that order, ``least`` being 85 % of s. A class for which these are shingles of its own alone is
   linked with nothing; the others enter them into inverted lists.
3. Groups of classes from one list are joined by a prefix tree: the ordered sets are stored in a
   compressed trie; each set walks down it, counting the shingles it has in common with an edge once
   for all sets below, and leaves a subtree if the shingles left on either side can't reach the overlap
   that sets of these sizes need, or if it is connected with all of its sets already. A first tree
   holds the shared low shingles alone; it tells which sets may be linked at all. These go, as full
   sets, into a second tree, which finds the links.
4. In each round each class goes into one group only, that of its longest open list. A list is done if
   its classes are connected or were in one group. When rounds close few lists, the classes of the open
   ones, few by then, start again on their own: all their shingles count as low, so those of one class
   alone fill most classes' first places, and the first tree's answer is exact. What further rounds
   leave open is joined whole, list by list.

A group holds about ``GROUP_SETS`` sets or ``GROUP_SHINGLES`` shingles: longer lists are dealt into
several groups by a hash, another one each round, and at last into groups for every two of their
parts. So a hot list of many alike sets becomes one component after few rounds, and no task depends on
a list's length. Sets are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace
from ledgerloom.llm.near_duplicates import IDS_TO_BROADCAST, components, shingle_sets

SHINGLE_WORDS = 5
SIMILARITY = 80
BUCKETS = 1 << 20
LEAST_ROUNDS = 2
LEAST_CLOSED = 0.75
GROUP_SETS = 1000
GROUP_SHINGLES = 2_000_000

#: Shingle hashes, as signed numbers, are low below this.
LOW_BELOW = -(1 << 62)

_PARTS = 64


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], words: int, rows: int = 200) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part, list(shingle_sets(part.column("text").to_pylist(), words))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))


def _key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _counted(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null without words) of every row; and rows with ``part``, the bucket counts of a task.

    Both come from one scan of the texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        held: list[np.ndarray] = []
        size, ids = 0, None
        for part, sets in _sets(batches, words):
            ids = part.column("doc_id")
            held += sets
            size += sum(map(len, sets))
            if size > BUCKETS:
                counts += np.bincount(_bucket(np.concatenate(held)), minlength=BUCKETS)
                held, size = [], 0
            n = len(sets)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "n_shingles": pa.array(map(len, sets), pa.int64()),
                    "set_key": pa.array(map(_key, sets), pa.binary()),
                    "part": pa.nulls(n, pa.int32()),
                    "counts": pa.nulls(n, pa.binary()),
                }
            )
        if held:
            counts += np.bincount(_bucket(np.concatenate(held)), minlength=BUCKETS)
        if ids is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.nulls(_PARTS, ids.type),
                    "n_shingles": pa.nulls(_PARTS, pa.int64()),
                    "set_key": pa.nulls(_PARTS, pa.binary()),
                    "part": pa.array(range(_PARTS), pa.int32()),
                    "counts": pa.array([part.tobytes() for part in counts.reshape(_PARTS, -1)], pa.binary()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_shingles long, set_key binary, part int, counts binary")


def bucket_counts(counted: DataFrame) -> np.ndarray:
    """How many shingles of all documents fall into each bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                own = np.frombuffer(counts.as_py(), np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_pydict({"part": pa.array(sums, pa.int32()), "counts": pa.array([s.tobytes() for s in sums.values()], pa.binary())})

    own = counted.where(F.col("part").isNotNull()).select("part", "counts")
    total = np.zeros((_PARTS, BUCKETS // _PARTS), np.int64)
    for row in own.repartition(8, "part").mapInArrow(add, "part int, counts binary").collect():  # _PARTS rows of a fixed size
        total[row.part] = np.frombuffer(row.counts, np.int64)
    return total.ravel()


def bucket_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each bucket: how many times its count doubles the mean (or one)."""
    usual = max(counts.sum() / len(counts), 1.0)
    return np.floor(np.log2(np.maximum(counts / usual, 1.0))).astype(np.int8)


def least_own(size, percent: int):
    """The least overlap of a set of this size with any set it is linked with."""
    return -(-size * percent // 100)


def reach_of(size, percent: int):
    """How many of a set's first shingles hold one of those it has in common with any linked set."""
    return size - least_own(size, percent) + 1


def _heads(docs: DataFrame, words: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """doc_id, n, set_key, low (its low shingles), more (what comes after them, if they don't reach far enough) of rows with words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, words):
            low, more = [], []
            for values in sets:
                own = ranks[_bucket(values)]
                n = int(np.searchsorted(values, LOW_BELOW))
                low.append(values[:n][own[:n] == 0])
                order = np.lexsort((values, own, (values < LOW_BELOW) & (own == 0)))
                missing = max(reach_of(len(values), percent) - len(low[-1]), 0)
                more.append(values[order[:missing]] if missing else values[:0])
            some = np.array(list(map(len, sets))) > 0
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(map(len, sets), pa.int64()),
                    "set_key": pa.array(map(_key, sets), pa.binary()),
                    "low": _lists(low),
                    "more": _lists(more),
                }
            ).filter(pa.array(some))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n long, set_key binary, low array<long>, more array<long>")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """set_key and values (sorted by hash) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, words):
            yield pa.RecordBatch.from_pydict({"set_key": pa.array(map(_key, sets), pa.binary()), "values": _lists(sets)})

    return docs.select("text").mapInArrow(rows, "set_key binary, values array<long>")


class PrefixTree:
    """Compressed trie of sets of numbers, each ascending.

    A set may have further members that are not in the tree: ``alone`` ones, which no other set holds,
    and ``tails`` ones, which may be in others or not. Sets are kept in lexicographic order; a node is
    the edge of numbers ``start`` to ``end`` of the sets ``low`` to ``high`` - 1, which begin alike up
    to ``end``.
    """

    def __init__(self, sets: list[np.ndarray], alone: np.ndarray | None = None, tails: np.ndarray | None = None):
        none = np.zeros(len(sets), np.int64)
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        self.sets = [sets[k] for k in self.order]
        self.lengths = np.array([len(s) for s in self.sets])
        self.alone = none if alone is None else alone[self.order]
        self.tails = none if tails is None else tails[self.order]
        self.sizes = self.lengths + self.alone + self.tails
        alike = np.zeros(len(sets), np.int64)  # numbers that a set begins with as the one before it does
        for k in range(1, len(sets)):
            a, b = self.sets[k - 1], self.sets[k]
            n = min(len(a), len(b))
            apart = np.flatnonzero(a[:n] != b[:n])
            alike[k] = apart[0] if len(apart) else n
        self.nodes: list[tuple] = []  # start, end, low, high, least and greatest size, least alone, children
        todo = [(0, len(sets), 0, None)]
        while todo:
            low, high, start, siblings = todo.pop()
            end = int(alike[low + 1 : high].min()) if high - low > 1 else int(self.lengths[low])
            own = self.sizes[low:high]
            children: list[int] = []
            if siblings is not None:
                siblings.append(len(self.nodes))
            self.nodes.append((start, end, low, high, int(own.min()), int(own.max()), int(self.alone[low:high].min()), children))
            if high - low > 1:
                cuts = [low, *(low + 1 + np.flatnonzero(alike[low + 1 : high] == end)).tolist(), high]
                # Sets that end here have no edge below.
                todo += [(a, b, end, children) for a, b in zip(cuts, cuts[1:], strict=False) if self.lengths[a] > end or b - a > 1]

    def links(self, percent: int, groups: np.ndarray) -> list[tuple[int, int]]:
        """Pairs of sets (numbers as given) that join all that links and ``groups`` connect.

        groups: for each set the group it is in already; pairs in one group are not looked at. A pair
        is linked if it would be with all its tails in common that can be.
        """
        group = groups[self.order].copy()
        found: list[tuple[int, int]] = []

        def take(i: int, low: int, high: int, common: int) -> None:
            """Link the probe with the sets for which ``common``, with the tails, is enough."""
            sizes = self.sizes[low:high]
            most = common + np.minimum(self.tails[low:high], self.tails[i])
            enough = (most * (100 + percent) >= percent * (self.sizes[i] + sizes)) & (group[low:high] != group[i])
            for k in (low + np.flatnonzero(enough)).tolist():
                if group[k] != group[i]:
                    found.append((self.order[i], self.order[k]))
                    group[group == group[k]] = group[i]

        for i, probe in enumerate(self.sets):
            n, n_probe = int(self.sizes[i]), len(probe)
            left = n - int(self.alone[i])  # members that may be in another set
            shortest, longest = least_own(n, percent), n * 100 // percent
            todo = [(0, 0, 0)]  # node, overlap so far, numbers of the probe that lie behind
            while todo:
                node, common, behind = todo.pop()
                start, end, low, high, least, most, alone, children = self.nodes[node]
                after = max(low, i + 1)
                if high <= after or least > longest or most < shortest or (group[after:high] == group[i]).all():
                    continue
                least, most = max(least, shortest), min(most, longest)
                edge, step = self.sets[low], 16
                while True:
                    if behind == n_probe:
                        take(i, after, high, common)
                        break
                    # The size for which the overlap can come nearest to what is needed.
                    size = min(max(alone + start + left - behind, least), most)
                    if (common + min(size - alone - start, left - behind)) * (100 + percent) < percent * (n + size):
                        break
                    if start == end:
                        while low < high and self.lengths[low] == end:
                            if low > i:
                                take(i, low, low + 1, common)
                            low += 1
                        todo += [(child, common, behind) for child in children]
                        break
                    piece = edge[start : min(start + step, end)]
                    at = np.searchsorted(probe, piece)
                    common += int((probe[np.minimum(at, n_probe - 1)] == piece).sum())
                    behind = int(np.searchsorted(probe, piece[-1], "right"))
                    start += len(piece)
                    step *= 2
        return found


def _elements(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    bounds = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]], (bounds - bounds[0])[1:-1]


def _numbered(values: np.ndarray, order: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Sets of numbers for sets of values: places in the order by (order, value)."""
    known, first, local = np.unique(values, return_index=True, return_inverse=True)
    places = np.empty(len(known), np.int64)
    places[np.argsort(order[first], kind="stable")] = np.arange(len(known))
    return [np.sort(part) for part in np.split(places[local], bounds)]


def _may_link(percent: int, rounds: int):
    """Sub-groups of a group's classes that may be linked: classes connected by pairs of which the low shingles allow a link.

    ``sub`` tells a sub-group by its members, so equal ones of several lists are one. Those that are
    connected already, or were in one group of an earlier round (label_0, label_1, ...), are left out.
    """

    def join(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cids, component = table.column("cid").to_numpy(), table.column("component").to_numpy()
        labels = [table.column(f"label_{k}").to_pylist() for k in range(rounds)]
        sub = np.arange(len(cids))
        if (component != component[0]).any():
            values, bounds = _elements(table, "shared")
            sets = _numbered(values, _elements(table, "held_by")[0], bounds)
            alone = table.column("alone").to_numpy()
            tails = table.column("n").to_numpy() - alone - np.array([len(s) for s in sets])
            for x, y in PrefixTree(sets, alone, tails).links(percent, np.arange(len(sub))):
                sub[sub == sub[x]] = sub[y]
        names, rows = [], []
        for one in np.unique(sub[np.bincount(sub)[sub] > 1]):
            members = np.flatnonzero(sub == one)
            if (component[members] == component[members[0]]).all():
                continue
            if any(own[members[0]] is not None and len({own[k] for k in members}) == 1 for own in labels):
                continue
            digest = hashlib.blake2b(np.sort(cids[members]).tobytes(), digest_size=8).digest()
            names += [int.from_bytes(digest, "little", signed=True)] * len(members)
            rows += members.tolist()
        return pa.table({"sub": pa.array(names, pa.int64()), "cid": pa.array(cids[rows], pa.int64()), "component": pa.array(component[rows], pa.int64())})

    return join


def _linked(ranks: np.ndarray, percent: int):
    """Links (a, b) among a group's classes."""

    def join(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cids = table.column("cid").to_numpy()
        groups = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        values, bounds = _elements(table, "values")
        sets = _numbered(values, ranks[_bucket(values)], bounds)
        pairs = [(cids[x], cids[y]) for x, y in PrefixTree(sets).links(percent, groups)]
        return pa.table({"a": pa.array([min(p) for p in pairs], pa.int64()), "b": pa.array([max(p) for p in pairs], pa.int64())})

    return join


class _Join:
    """Finds links list by list and keeps the components of what was linked so far."""

    def __init__(self, space: Workspace, docs: DataFrame, classes: DataFrame, words: int, percent: int, ranks: np.ndarray):
        self.space, self.docs, self.classes = space, docs, classes
        self.words, self.percent, self.ranks = words, percent, ranks
        self.components: DataFrame | None = None  # cid, component; of linked classes
        self.rounds: list[DataFrame] = []  # cid, group_list, chunk of each round

    def with_component(self, rows: DataFrame) -> DataFrame:
        if self.components is None:
            return rows.withColumn("component", F.col("cid"))
        return rows.join(self.components, "cid", "left").withColumn("component", F.coalesce("component", "cid"))

    def full_sets(self, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """cid, values of some classes, read from the documents again; and the stored table that is read for it."""
        needed = classes.join(self.classes.select("cid", "set_key", "rep_id"), "cid")
        needed = self.space.store(needed, "needed")
        ids = needed.select(F.col("rep_id").alias("needed_id")).distinct()
        ids = F.broadcast(ids) if needed.count() <= IDS_TO_BROADCAST else ids
        texts = self.docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("needed_id")), "left_semi")
        # Several rows may have a class's id, with the class's text or another.
        sets = _full_sets(texts, self.words).join(needed.select("set_key", "cid"), "set_key")
        return sets.dropDuplicates(["cid"]).select("cid", "values"), needed

    def likely(self, groups: DataFrame, keys: list[str]) -> DataFrame:
        """sub, cid, component: the sub-groups of each group (cid and keys) that may have links."""
        members = self.with_component(groups).join(self.classes.select("cid", "n", "alone", "shared", "held_by"), "cid")
        labels = [f"label_{k}" for k in range(len(self.rounds))]
        for label, earlier in zip(labels, self.rounds, strict=True):
            members = members.join(earlier.select("cid", F.xxhash64("group_list", "chunk").alias(label)), "cid", "left")
        members = members.select(*keys, "cid", "component", "n", "alone", "shared", "held_by", *labels)
        likely = members.groupBy(*keys).applyInArrow(_may_link(self.percent, len(labels)), "sub long, cid long, component long")
        return self.space.store(likely.distinct(), "likely")

    def join_groups(self, groups: DataFrame, keys: list[str]) -> None:
        """Find the links in each group (cid and keys)."""
        likely = self.likely(groups, keys)
        if likely.isEmpty():
            self.space.drop(likely)
            return
        full, needed = self.full_sets(likely.select("cid").distinct())
        links = likely.join(full, "cid").groupBy("sub").applyInArrow(_linked(self.ranks, self.percent), "a long, b long")
        links = self.space.store(links, "links")
        self.space.drop(likely, needed)
        if links.isEmpty():
            self.space.drop(links)
            return
        # Components of components, whose names are those of classes.
        ends = links.select(F.col("a").alias("cid")).union(links.select("b"))
        if self.components is None:
            self.components = components(self.space, links)
            self.space.drop(links)
            return
        a = self.with_component(links.withColumnRenamed("a", "cid")).select(F.col("component").alias("a"), "b")
        both = self.with_component(a.withColumnRenamed("b", "cid")).select("a", F.col("component").alias("b"))
        merges = self.space.store(both.where("a != b").distinct(), "merges")
        merged = named = components(self.space, merges)
        merged = merged.select(F.col("cid").alias("component"), F.col("component").alias("merged"))
        every = self.with_component(self.components.select("cid").union(ends).distinct())
        every = every.join(merged, "component", "left").select("cid", F.coalesce("merged", "component").alias("component"))
        before, self.components = self.components, self.space.store(every, "components")
        self.space.drop(before, named, merges, links)

    def still_open(self, entries: DataFrame, groups: DataFrame | None) -> DataFrame:
        """Entries (list, cid, n) of lists that are not connected and whose classes were not all in one group.

        Of several lists of the same classes, known by 128 bits, one stays.
        """
        rows = self.with_component(entries)
        if groups is None:
            rows = rows.withColumn("group", F.lit(None).cast("struct<group_list:long,chunk:long>"))
        else:
            rows = rows.join(groups.select("cid", F.struct("group_list", "chunk").alias("group")), "cid", "left")
        lists = rows.groupBy("list").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min("group").alias("low_group"),
            F.max("group").alias("high_group"),
            F.count("group").alias("grouped"),
            F.count("*").alias("members"),
            F.bit_xor(F.xxhash64("cid")).alias("who"),
            F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("who_else"),
        )
        together = (F.col("grouped") == F.col("members")) & (F.col("low_group") == F.col("high_group"))
        lists = lists.where((F.col("low") < F.col("high")) & ~F.coalesce(together, F.lit(False)))
        lists = lists.groupBy("members", "who", "who_else").agg(F.min("list").alias("list"))
        return self.space.store(entries.join(lists.select("list"), "list"), "open")

    def parts(self, entries: DataFrame, of: str, sets: int, shingles: int) -> DataFrame:
        """Rows with ``parts``, how many groups the list needs."""
        number = F.greatest(F.ceil(F.count("*") / sets), F.ceil(F.sum("n") / shingles))
        return entries.join(entries.groupBy(of).agg(number.alias("parts"), F.count("*").alias("members")).where("members > 1"), of)

    def one_group_each(self, entries: DataFrame, turn: int) -> DataFrame:
        """cid, group_list, chunk: every class in its longest list."""
        sizes = entries.groupBy("list").agg(F.count("*").alias("members"))
        rank = F.struct("members", "list")
        chosen = entries.join(sizes, "list").groupBy("cid").agg(F.max(rank).alias("best"), F.first("n").alias("n"))
        chosen = self.space.store(chosen.select("cid", "n", F.col("best.list").alias("group_list")), "chosen")
        dealt = self.parts(chosen, "group_list", GROUP_SETS, GROUP_SHINGLES)
        groups = self.space.store(dealt.select("cid", "group_list", _dealt(F.lit(turn), F.col("parts")).alias("chunk")), "groups")
        self.space.drop(chosen)
        return groups

    def every_two_parts(self, entries: DataFrame) -> DataFrame:
        """cid, list, one, other: each list's classes in groups for every two of its parts."""
        dealt = self.parts(entries, "list", GROUP_SETS // 2, GROUP_SHINGLES // 2)
        dealt = dealt.select("cid", "list", "parts", _dealt(F.lit(-1), F.col("parts")).alias("own"))
        others = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        dealt = dealt.select("cid", "list", "parts", "own", F.explode(others).alias("with"))
        dealt = dealt.where((F.col("parts") == 1) | (F.col("own") != F.col("with")))
        return dealt.select("cid", "list", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("other"))


def _dealt(salt: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64("cid", salt), parts.cast("long"))


def _with_shared(classes: DataFrame, percent: int) -> DataFrame:
    """Classes that may be linked, with ``shared``, their low shingles that other classes hold too, in
    global order, ``held_by``, how many classes hold each, ``alone``, the number of the other low ones, and
    ``reach``, how many shingles beyond these enter the lists.
    """
    postings = classes.select("cid", F.explode("low").alias("value")).repartition("value")
    counts = postings.groupBy("value").agg(F.count("*").alias("held_by")).where("held_by > 1")
    held = postings.join(counts, "value").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("held_by", "value"))).alias("held"))
    rows = classes.join(held, "cid", "left").withColumn("held", F.coalesce("held", F.expr("array()").cast("array<struct<held_by:long,value:long>>")))
    reach = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rows = rows.withColumn("alone", (F.size("low") - F.size("held")).cast("long"))
    return rows.select(
        "cid", "set_key", "rep_id", "n", "more", "alone",
        F.col("held.value").alias("shared"), F.col("held.held_by").alias("held_by"),
        (reach - F.col("alone")).cast("int").alias("reach"),
    ).where("reach > 0")


def _entries(classes: DataFrame) -> DataFrame:
    """list, cid, n: the inverted lists of the classes' first shared shingles."""
    first = F.slice("shared", F.lit(1), F.col("reach"))
    more = F.expr("slice(more, 1, greatest(reach - size(shared), 0))")
    return classes.select(F.explode(F.concat(first, more)).alias("list"), "cid", "n")


def similar_sets(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    docs: doc_id, text; other columns are ignored. Two documents are linked if 100 times their common
    shingles are at least ``percent`` (50 to 100) times all shingles of both; component_id is the smallest
    doc_id reachable over links. A text of fewer words is one shingle; without words (null, empty, white
    space) it has none, is linked with nothing and stands for itself. Rows of equal id belong to the
    components of their own texts; a null id is no smallest id unless there is no other.
    """
    space = Workspace(docs.sparkSession, "prefix-tree-join")
    counted = space.store(_counted(docs, words), "counted")
    rows = space.store(counted.where(F.col("part").isNull()).select("doc_id", "n_shingles", "set_key"), "rows")
    ranks = bucket_ranks(bucket_counts(counted))
    space.drop(counted)
    classes = _heads(docs, words, percent, ranks).groupBy("set_key").agg(
        F.min("doc_id").alias("rep_id"), F.min("n").alias("n"), F.first("low").alias("low"), F.first("more").alias("more")
    )
    classes = space.store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    names = space.store(classes.select("cid", "set_key", "rep_id"), "names")
    joined = space.store(_with_shared(classes, percent), "joined")
    space.drop(classes)
    join = _Join(space, docs, joined, words, percent, ranks)
    entries, groups, before, again = _entries(joined), None, None, False
    while True:
        entries, last = join.still_open(entries, groups), entries
        space.drop(last)
        n_open = entries.count()
        if not n_open:
            break
        if before and len(join.rounds) >= LEAST_ROUNDS and n_open > before * LEAST_CLOSED:
            if again:
                join.join_groups(join.every_two_parts(entries), ["list", "one", "other"])
                break
            rest = entries.select("cid").distinct().join(joined.select("cid", "n", "set_key", "rep_id"), "cid")
            full, needed = join.full_sets(rest.select("cid"))
            rest = rest.join(full, "cid").withColumnRenamed("values", "low")
            rest = space.store(rest.withColumn("more", F.slice("low", 1, 0)), "rest")
            join.classes = space.store(_with_shared(rest, percent), "joined-again")
            space.drop(needed, rest, entries, joined)
            entries, groups, before, again = _entries(join.classes), None, None, True
            continue
        groups = join.one_group_each(entries, len(join.rounds))
        join.join_groups(groups, ["group_list", "chunk"])
        join.rounds.append(groups)
        before = n_open
    least = join.with_component(names)
    if join.components is None:
        found = least.select("set_key", F.col("rep_id").alias("component_id"))
    else:
        smallest = least.groupBy("component").agg(F.min("rep_id").alias("component_id"))
        found = least.join(smallest, "component").select("set_key", "component_id")
    result = rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"))
