"""Token counts kept up to date under edits, without encoding whole documents again.

Per document a segment tree over runs of pre-tokens is kept: the runs' first characters, and an array
with the token counts of the runs as leaves and their sums above. Runs begin where white space
follows a visible character, a place at which pre-tokens end whatever the text around it is. An edit
therefore changes only the runs it touches and those that hold the character before and after it:
these are encoded again, and the sums on the way to the root are updated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import PIECES, Encoder, encoder

LEAF_PIECES = 64

#: Pieces kept by a worker; building and editing run side by side, so each core has two workers with one.
CACHED_PIECES = 200_000

EDIT_TYPE = "array<struct<start:int,stop:int,replacement:string>>"


class CountTree:
    """Segment tree of one document: ``starts`` of the runs, ``sums`` with leaf i at place leaves + i."""

    def __init__(self, starts: np.ndarray, sums: np.ndarray):
        self.starts, self.sums = starts, sums

    @classmethod
    def build(cls, text: str, encode: Encoder, leaf_pieces: int = LEAF_PIECES) -> CountTree:
        starts = [m.start() for k, m in enumerate(PIECES.finditer(text)) if k % leaf_pieces == 0] or [0]
        leaves = 1 << (len(starts) - 1).bit_length()
        sums = np.zeros(2 * leaves, np.int64)
        for k, (low, high) in enumerate(zip(starts, [*starts[1:], len(text)], strict=True)):
            sums[leaves + k] = encode.count(text[low:high])
        level = leaves
        while level > 1:
            sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
            level //= 2
        return cls(np.array(starts, np.int64), sums)

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def set_leaf(self, leaf: int, count: int) -> None:
        place = len(self.sums) // 2 + leaf
        change = count - self.sums[place]
        while place and change:
            self.sums[place] += change
            place //= 2

    def prefix(self, leaf: int) -> int:
        """Tokens before a leaf, from the sums beside the way to the root."""
        place, total = len(self.sums) // 2 + leaf, 0
        while place > 1:
            if place & 1:
                total += int(self.sums[place - 1])
            place //= 2
        return total


def apply_edits(text: str, tree: CountTree, edits: list[tuple[int, int, str]], encode: Encoder) -> tuple[str, int, int, int]:
    """The edited text, the characters encoded again, and edits applied and left out; changes ``tree``.

    Edits name places in the text before any of them; they are applied in order of (start, stop).
    Places beyond the text mean its end. One that begins before the end of the one before it, or
    whose stop lies before its start, is left out and counted.
    """
    starts, size = tree.starts, len(text)
    clean: list[tuple[int, int, str]] = []
    skipped, last = 0, 0
    for start, stop, new in sorted(((e[0] or 0, e[1] or 0, e[2] or "") for e in edits), key=lambda e: e[:2]):
        start, stop = min(max(start, 0), size), min(max(stop, 0), size)
        if stop < start or start < last:
            skipped += 1
            continue
        clean.append((start, stop, new))
        last = stop
    # Regions of leaves: each edit with the character before and after it; meeting regions are one.
    regions: list[tuple[int, int, list]] = []
    for start, stop, new in clean:
        first = int(np.searchsorted(starts, max(start - 1, 0), "right")) - 1
        final = int(np.searchsorted(starts, min(stop, max(size - 1, 0)), "right")) - 1
        if regions and first <= regions[-1][1]:
            regions[-1] = (regions[-1][0], max(final, regions[-1][1]), [*regions[-1][2], (start, stop, new)])
        else:
            regions.append((first, final, [(start, stop, new)]))
    out: list[str] = []
    place = shift = again = 0
    new_starts = starts.copy()
    moved = 0  # leaves whose start is settled
    for first, final, inside in regions:
        low = int(starts[first])
        high = int(starts[final + 1]) if final + 1 < len(starts) else size
        out.append(text[place:low])
        parts, at = [], low
        for start, stop, new in inside:
            parts += [text[at:start], new]
            at = stop
        region = "".join([*parts, text[at:high]])
        out.append(region)
        new_starts[moved : first + 1] = starts[moved : first + 1] + shift
        new_starts[first + 1 : final + 1] = low + shift + len(region)  # emptied leaves
        moved = final + 1
        tree.set_leaf(first, encode.count(region))
        for leaf in range(first + 1, final + 1):
            tree.set_leaf(leaf, 0)
        again += len(region)
        shift += len(region) - (high - low)
        place = high
    new_starts[moved:] = starts[moved:] + shift
    out.append(text[place:])
    tree.starts = new_starts
    return "".join(out), again, len(clean), skipped


_TREE_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that a worker holds few texts and trees as Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def with_trees(docs: DataFrame, tokenizer_path: str, leaf_pieces: int = LEAF_PIECES, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with n_tokens, tree_starts and tree_sums (existing ones of these names are replaced).

    Null text counts as empty: no tokens, one empty leaf. Rows are independent of each other.
    """
    own = ["n_tokens", "tree_starts", "tree_sums"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, CACHED_PIECES)
        for part in _slices(batches):
            trees = [CountTree.build(t or "", encode, leaf_pieces) for t in part.column(text).to_pylist()]
            made = [[t.total for t in trees], [t.starts for t in trees], [t.sums for t in trees]]
            arrays = [pa.array(values, kind) for values, kind in zip(made, _TREE_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *own])

    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    longs = ArrayType(LongType(), False)
    added = [StructField("n_tokens", LongType()), StructField("tree_starts", longs), StructField("tree_sums", longs)]
    return docs.mapInArrow(build, StructType([*docs.schema.fields, *added]))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with the column ``edits`` out of a table of edits (doc_id, start, stop, replacement).

    A document's edits are gathered in one array, so they are bounded by what one editor did to it.
    Documents without edits keep an empty array; edits without a document have no effect.
    """
    gathered = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"), F.col("replacement").cast("string").alias("replacement"))).alias("edits")
    )
    return trees.drop("edits").join(gathered, "doc_id", "left")


def count_after_edits(trees: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """Apply the column ``edits`` to texts and trees without encoding untouched runs.

    Result: doc_id, new_text, n_tokens_before, n_tokens (after), n_edits (applied), n_skipped,
    n_chars (after), n_chars_encoded (encoded again), tree_starts, tree_sums. A null array is no edit.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, CACHED_PIECES)
        for part in _slices(batches):
            out = []
            cells = [part.column(name).to_pylist() for name in ("text", "tree_starts", "tree_sums", "edits")]
            for old, starts, sums, edits in zip(*cells, strict=True):
                tree = CountTree(np.array(starts, np.int64), np.array(sums, np.int64))
                before = tree.total
                changes = [] if edits is None else [(e["start"], e["stop"], e["replacement"]) for e in edits if e is not None]
                new, again, done, skipped = apply_edits(old or "", tree, changes, encode)
                out.append((new, before, tree.total, done, skipped, len(new), again, tree.starts, tree.sums))
            kinds = [pa.string(), *[pa.int64()] * 6, *_TREE_TYPES[1:]]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=names)

    kind = trees.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, new_text string, n_tokens_before long, n_tokens long, n_edits long, n_skipped long, n_chars long, n_chars_encoded long, tree_starts array<long>, tree_sums array<long>"
    names = [field.split()[0] for field in schema.split(", ")]
    columns = [F.col("doc_id"), F.col(text).alias("text"), "tree_starts", "tree_sums", "edits"]
    return trees.select(*columns).mapInArrow(count, schema)


# What the redaction replaces: mail addresses, telephone numbers and keys.
_PRIVATE = re.compile(
    r"(?P<mail>[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+)"
    r"|(?P<phone>\+?\d[\d ()./-]{7,17}\d)"
    r"|(?P<key>\b(?:sk|ghp|AKIA|xox[abp])[-_A-Za-z0-9]{12,})"
)


def redactions(text: Column) -> Column:
    """Edits that put a placeholder for each mail address, telephone number and key of a text."""

    @F.pandas_udf(EDIT_TYPE)
    def found(texts: pd.Series) -> pd.Series:
        def edits(one: str | None) -> list[dict]:
            if not one or not _MAY_BE_PRIVATE.search(one):
                return []
            return [{"start": m.start(), "stop": m.end(), "replacement": f"[{m.lastgroup}]"} for m in _PRIVATE.finditer(one)]

        return texts.map(edits)

    return found(text)


_MAY_BE_PRIVATE = re.compile(r"[@0-9]|sk|ghp|AKIA|xox")
