import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from silverbrook.llm import packing
from silverbrook.llm.packing import best_fit_decreasing, pack_documents, sequences
from silverbrook.llm.token_frames import FrameReader, find_documents, read_digests, write_tokens
from silverbrook.llm.tokens import Encoder
from silverbrook.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
OURS = Encoder(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet=" \n\tabzA'1é中😀. —s|<>", max_size=30), max_size=20))
@settings(max_examples=200, deadline=None)
def test_shortcut_gives_the_library_s_ids(texts):
    assert [x.tolist() for x in OURS.encode(texts)] == [ids_of(t) for t in texts]


def test_special_tokens_and_spaces():
    texts = ["a<|endoftext|>b", "x  y", "x \n y", " ", "", "end ", "x　 y", "it's  'll"]
    assert [x.tolist() for x in OURS.encode(texts)] == [ids_of(t) for t in texts]


@given(st.lists(st.text(alphabet=" \n!'$#.,_abs1éÄ", max_size=30), max_size=20))
@settings(max_examples=200, deadline=None)
def test_words_with_runs_of_marks(texts):
    assert [x.tolist() for x in Encoder(PATH, 50).encode(texts)] == [ids_of(t) for t in texts]


def test_a_unit_is_looked_up_once_for_all_its_places(monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    ours = Encoder(PATH)
    ours.units = Counted()
    # Words with marks in a row need no pattern.
    monkeypatch.setattr(ours, "pattern", None)
    texts = ["one two!! three?... \u00e9t\u00e9$$ " * 200 + "end"] * 5 + ["one", ""]
    assert [x.tolist() for x in ours.encode(texts)] == [ids_of(t) for t in texts]
    assert 0 < ours.units.asked <= 6


def test_files_give_every_document_back(spark, edge_docs, edge_rows, no_docs):
    files = write_tokens(edge_docs, shared_dir(spark, "tokens"), PATH)
    got = sorted(tuple(r) for r in read_digests(files).fillna(-1, "doc_id").collect())
    want, start = [], 0
    rows = [(-1 if d is None else d, t) for d, t, *_ in edge_rows]
    sized = sorted((d, len(ids_of(t)) + 1, zlib.crc32(np.array([*ids_of(t), 2], "<u4").tobytes())) for d, t in rows)
    assert sorted((d, n, c) for d, _, n, c in got) == sized
    # In the order of ids, starts follow each other without gaps; equal ids in either order.
    for doc, at, length, _ in sorted(got, key=lambda r: (r[0], r[1])):
        want.append(start)
        assert at == start, doc
        start += length
    empty = write_tokens(no_docs, shared_dir(spark, "tokens"), PATH)
    assert read_digests(empty).count() == 0


def test_only_asked_frames_are_read(spark, edge_docs, edge_rows, monkeypatch):
    files = write_tokens(edge_docs, shared_dir(spark, "tokens"), PATH)
    wanted = spark.createDataFrame([(3,), (2**60,), (777,), (4,)], "doc_id long")
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in find_documents(files, wanted).collect())
    texts = [(d, t) for d, t, *_ in edge_rows if d in (3, 4, 2**60)]
    assert got == sorted((d, [*ids_of(t), 2]) for d, t in texts)


def test_a_damaged_frame_is_refused(spark, edge_docs):
    path = write_tokens(edge_docs, shared_dir(spark, "tokens"), PATH).first().path
    local = "/" + path.split(":", 1)[-1].lstrip("/")
    reader = FrameReader(path)
    frame = reader.frames[0]
    reader.close()
    with open(local, "r+b") as file:
        file.seek(frame.start + frame.packed - 3)
        byte = file.read(1)
        file.seek(frame.start + frame.packed - 3)
        file.write(bytes([byte[0] ^ 0xFF]))
    with pytest.raises(Exception):
        list(FrameReader(path).frame(0))


@given(st.lists(st.integers(1, 20), max_size=40))
@settings(max_examples=200, deadline=None)
def test_best_fit_decreasing(lengths):
    placed = best_fit_decreasing(lengths, 20)
    by_window = {}
    for (window, offset), length in zip(placed, lengths, strict=True):
        by_window.setdefault(window, []).append((offset, length))
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 20
    # As many windows as plain best fit needs.
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(20 - length)
    assert len(by_window) == len(rooms)


def test_pieces_hold_every_id_once(edge_docs, clashing_docs, edge_rows, no_docs):
    pieces = pack_documents(edge_docs, PATH, with_ids=True)
    rows = pieces.collect()
    whole = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, tuple(ids)))
    for doc, text, *_ in edge_rows:
        ids = [*ids_of(text), 0]
        parts = sorted(set(whole[doc, len(ids)]))
        assert [i for _, p in parts for i in p] == ids
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    made = sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.length for r in made)
    assert sum(r.length for r in made) == sum(r.length for r in rows)
    assert pack_documents(clashing_docs, PATH).count() == len(rows)
    assert pack_documents(no_docs, PATH).count() == 0


def test_batches_of_pieces_are_bounded_by_the_bytes_of_their_ids(monkeypatch):
    monkeypatch.setattr(packing, "PACK_BYTES", 60_000, raising=False)
    monkeypatch.setattr(packing, "BATCH_BYTES", 20_000, raising=False)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda _: 0})())
    texts = [" ".join(f"w{i % 97}" for i in range(n)) for n in range(0, 1500, 5)]
    docs = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    batches = list(packing._packer(PATH, 1024, 0, True)(iter([docs])))
    assert all(sum(map(len, b.column("ids").to_pylist())) < 20_000 + 4 * 1024 for b in batches)
    rows = [r for b in batches for r in b.to_pylist()]
    whole, rooms = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + r["ids"]
        rooms.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert [np.frombuffer(whole[d], "<u4").tolist() for d in range(len(texts))] == [[*ids_of(t), 0] for t in texts]
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
