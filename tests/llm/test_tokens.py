import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import AWKWARD, library_ids, prose, with_clashing_columns

from ledgerloom.llm import binary_output, packing, token_counts
from ledgerloom.llm.common import fresh_path
from ledgerloom.llm.tokens import Encoder
from pyspark.sql import functions as F

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
ENCODERS = {name: Encoder(public_tokenizers.path(name)) for name in (BYTES, WORDS)}
LONG = (100, prose(1, 30_000))
TEXT = st.text(st.one_of(st.sampled_from(" \n\t\r'sreab,.1Σé\x1c　\xa0"), st.characters(codec="utf-8")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_encoder_equals_the_library(text):
    for name, encoder in ENCODERS.items():
        assert encoder.encode(text).tolist() == library_ids(name, [text])[0]


@pytest.mark.parametrize(
    "text",
    ["a <|endoftext|> b", "x<|endoftext|>y", "a \n <|startoftext|>\n\n", "<|endoftext|><|endoftext|>", "Ω<|endoftext|>Σ <|endof", " <|endoftext|>"],
)
def test_special_tokens_in_a_text_have_their_own_ids(text):
    for name, encoder in ENCODERS.items():
        assert encoder.encode(text).tolist() == library_ids(name, [text])[0]
        letters = Encoder(public_tokenizers.path(name), special_as_text=True).encode(text).tolist()
        assert not {50256, 49406, 49407} & set(letters)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_texts_encoded_at_once_have_the_ids_of_each(texts):
    texts = [*texts, "", "a", "a b", " a", "a ", "a  b", "a \n b", "a\n\nb c", "x <|endoftext|> y", "x\x1c y z", "Ω Σ a, b's", *texts]
    for name, encoder in ENCODERS.items():
        got = [np.frombuffer(data, "<u4").tolist() for data in encoder.encode_many(texts)]
        assert got == library_ids(name, texts)
    assert ENCODERS[BYTES].encode_many([]) == []


def test_known_words_beside_marks_are_not_encoded_again():
    class Counting:
        def __init__(self, model):
            self.model, self.seen = model, []

        def tokenize(self, letters):
            self.seen.append(letters)
            return self.model.tokenize(letters)

    words = ["stone", "river", "maison", "été"]
    text = "start " + " ".join(f"{a}{mark}{b}" for a in words for b in words for mark in (", ", ". ", "\n", ",\n", "'s "))
    encoder = Encoder(public_tokenizers.path(BYTES))
    encoder._model = Counting(encoder._model)
    assert encoder.encode(text).tolist() == library_ids(BYTES, [text])[0]
    assert len(encoder._model.seen) == len(set(encoder._model.seen)) < 20


def test_a_full_table_of_pieces_changes_no_ids():
    encoder = Encoder(public_tokenizers.path(BYTES), cached_pieces=5)
    texts = [prose(k, 40) for k in range(6)] * 2
    assert [np.frombuffer(data, "<u4").tolist() for data in encoder.encode_many(texts)] == library_ids(BYTES, texts)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 45), st.integers(-2, 45), TEXT), max_size=4), st.sampled_from([BYTES, WORDS]))
def test_edited_counts_equal_counting_again(text, edits, name):
    encoder = ENCODERS[name]
    text = (text + " ") * 6
    tree = token_counts.CountTree.build(text, encoder, leaf_pieces=2)
    new, again, done, skipped = token_counts.apply_edits(text, tree, edits, encoder)
    plain, last, shift = text, 0, 0
    for start, stop, put in sorted(edits, key=lambda e: e[:2]):
        start, stop = min(max(start, 0), len(text)), min(max(stop, 0), len(text))
        if stop >= start >= last:
            plain = plain[: start + shift] + put + plain[stop + shift :]
            shift += len(put) - (stop - start)
            last = stop
    assert new == plain and done + skipped == len(edits) and again <= len(new)
    assert tree.total == len(library_ids(name, [plain])[0])
    leaves = len(tree.sums) // 2
    assert all(tree.sums[k] == tree.sums[2 * k] + tree.sums[2 * k + 1] for k in range(1, leaves))
    assert tree.prefix(0) == 0 and tree.prefix(leaves - 1) == tree.total - tree.sums[-1]


def test_a_small_edit_encodes_little(spark):
    docs = spark.createDataFrame([(1, LONG[1]), (2, None)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 50_000, 50_005, "new words"), (9, 0, 1, "x"), (None, 0, 1, "x")], "doc_id long, start int, stop int, replacement string")
    path = public_tokenizers.path(BYTES)
    rows = {r.doc_id: r for r in token_counts.count_after_edits(token_counts.with_edits(token_counts.with_trees(docs, path), edits), path).collect()}
    assert rows[1].new_text == LONG[1][:50_000] + "new words" + LONG[1][50_005:]
    assert rows[1].n_tokens == len(library_ids(BYTES, [rows[1].new_text])[0])
    assert rows[1].n_chars_encoded < 2_000
    assert (rows[2].n_tokens_before, rows[2].n_tokens, rows[2].n_edits) == (0, 0, 0)


def test_counts_of_awkward_rows(spark):
    path = public_tokenizers.path(BYTES)
    rows = [*AWKWARD, (9, "write to jo.doe@example.org or +1 (555) 010-9999 now, sk-abcdefghijklmnop")]
    docs = with_clashing_columns(spark, rows).withColumn("n_tokens", F.lit(-1))
    edited = token_counts.with_trees(docs, path).withColumn("edits", token_counts.redactions(F.col("text")))
    got = sorted(((r.doc_id or 0, r.n_tokens_before, r.n_tokens, r.n_edits, r.new_text) for r in token_counts.count_after_edits(edited, path).collect()))
    before = library_ids(BYTES, [t for _, t in rows])
    assert sorted((i or 0, len(ids)) for (i, _), ids in zip(rows, before, strict=True)) == [g[:2] for g in got]
    assert [g[2] for g in got] == [len(ids) for ids in library_ids(BYTES, [g[4] for g in got])]
    assert [g[3:] for g in got if g[0] == 9] == [(3, "write to [mail] or [phone] now, [key]")]
    assert token_counts.with_trees(docs.limit(0), path).count() == 0


def test_hilbert_keys_visit_every_cell_step_by_step():
    cells = np.array([(x, y, z) for x in range(4) for y in range(4) for z in range(4)])
    keys = packing.hilbert_keys(cells, bits=2)
    assert sorted(keys.tolist()) == list(range(64))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, pieces):
    ids = {}
    for (doc_id, _), one in zip(rows, library_ids(BYTES, [t for _, t in rows]), strict=True):
        ids.setdefault(doc_id, []).append(np.array([*one, 1], "<u4"))
    starts = {}
    for p in pieces:
        starts.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        assert p.length > 0 and p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
    total = 0
    for (doc_id, doc_tokens), some in starts.items():
        own = [i for i in ids[doc_id] if len(i) == doc_tokens]
        covered = sorted(k for p in some for k in range(p.start, p.start + p.length))
        assert covered == sorted(list(range(doc_tokens)) * len(own))
        for p in some:
            assert any(i[p.start : p.start + p.length].tobytes() == bytes(p.ids) for i in own)
        total += doc_tokens * len(own)
    assert total == sum(len(i) for some in ids.values() for i in some)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for some in by_sequence.values():
        place = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == place
            place += p.length
        assert place <= 2048 and place & (place - 1) == 0


def test_packing_of_awkward_rows(spark):
    rows = [*AWKWARD, LONG, *((200 + k, prose(k, 50 + 7 * k)) for k in range(60)), *((300 + k, "one text in many copies") for k in range(40))]
    pieces = packing.pack(with_clashing_columns(spark, rows), public_tokenizers.path(BYTES)).collect()
    check_packing(rows, pieces)
    assert packing.pack(with_clashing_columns(spark, rows).limit(0), public_tokenizers.path(BYTES)).count() == 0


def test_packing_encodes_a_batch_in_several_goes(spark, monkeypatch):
    monkeypatch.setattr(packing, "_CHARS", 2_000, raising=False)
    monkeypatch.setattr(packing, "_ROWS", 3)
    rows = [*AWKWARD, LONG, *((200 + k, prose(k, 50 + 7 * k)) for k in range(40)), *((300 + k, "few words") for k in range(20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    check_packing(rows, packing.pack(docs, public_tokenizers.path(BYTES)).collect())


def test_neighbours_on_the_curve_are_alike(spark):
    french, digits = "la maison est très belle et le jardin aussi ", "1 2 3 4 5 6 7 8 9 "
    rows = [(k, (french if k % 2 else digits) * (20 + k)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = packing.encoded_documents(docs, public_tokenizers.path(BYTES)).orderBy("curve_key").collect()
    changes = sum(a.doc_id % 2 != b.doc_id % 2 for a, b in zip(keys, keys[1:], strict=False))
    assert changes == 1


def test_files_hold_every_document_and_give_single_ones(spark, monkeypatch):
    monkeypatch.setattr(binary_output, "FRAME_BYTES", 4_000)
    rows = [*AWKWARD, LONG, *((200 + k, prose(k, 50 + 7 * k)) for k in range(60))]
    place, path = fresh_path(spark, "files"), public_tokenizers.path(WORDS)
    frames = binary_output.write_token_files(with_clashing_columns(spark, rows), place, path)
    assert frames.count() >= 8 and frames.agg(F.sum("n_docs")).head()[0] == len(rows)
    ids = {}
    for (doc_id, _), one in zip(rows, library_ids(WORDS, [t for _, t in rows]), strict=True):
        ids.setdefault(doc_id, []).append(np.array([*one, 1], "<u4").tobytes())
    back = sorted(binary_output.read_token_files(spark, place).collect(), key=lambda r: r.start)
    at = 0
    for r in back:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        ids[r.doc_id].remove(bytes(r.ids))
        at += r.n_tokens
    assert not any(ids.values())
    known = [r.doc_id for r in back if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in back[:2]] == [None, None]
    some = {r.doc_id: bytes(r.ids) for r in binary_output.read_token_files(spark, place, [100, 231, 999]).collect()}
    assert some == {r.doc_id: bytes(r.ids) for r in back if r.doc_id in (100, 231)}


def test_a_damaged_frame_is_an_error(spark):
    place, path = fresh_path(spark, "files"), public_tokenizers.path(WORDS)
    docs = spark.createDataFrame([(k, prose(k, 300)) for k in range(8)], "doc_id long, text string")
    name = binary_output.write_token_files(docs, place, path).head().name
    files, folder = pyarrow.fs.FileSystem.from_uri(f"{place}/files")
    data = bytearray(files.open_input_file(f"{folder}/{name}").read())
    data[len(data) // 3] ^= 255
    with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
        out.write(bytes(data))
    with pytest.raises(Exception, match="(?i)checksum|corrupt|decompress"):
        binary_output.read_token_files(spark, place).collect()


def test_files_of_an_empty_table(spark):
    place = fresh_path(spark, "files")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert binary_output.write_token_files(docs, place, public_tokenizers.path(WORDS)).count() == 0
    assert binary_output.read_token_files(spark, place).count() == 0
