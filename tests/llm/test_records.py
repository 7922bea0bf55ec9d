import zlib

import numpy as np
import pytest

from starglean.llm import records
from starglean.llm.vocabulary import byte_bpe_path


def test_frame_round_trip_and_damage():
    data = records.frame(7, np.array([1, 2, 60000], np.uint32), 2) + records.frame(None, np.array([], np.uint32), 4)
    doc_id, ids, end = records.read_frame(data, 0)
    assert doc_id == 7 and ids.tolist() == [1, 2, 60000]
    assert records.read_frame(data, end)[0] is None
    for at in range(end):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
        with pytest.raises(Exception):
            records.read_frame(broken, 0)


def test_files_hold_all_documents_in_order(spark, sf, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe_path())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder, manifest = records.write_records(docs, byte_bpe_path(), 2)
    got = sorted(records.record_digest(records.read_records(spark, folder, manifest)).collect(), key=lambda r: r.doc_id)
    start = 0
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    assert len(got) == len(texts)
    for r, (doc_id, text) in zip(got, texts):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_odd_rows(spark):
    rows = [(None, "first"), (3, None), (3, ""), (3, "x"), (3, "x"), (1, "y " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS start", "2 AS ids")
    folder, manifest = records.write_records(docs, byte_bpe_path(), 2)
    got = sorted(records.read_records(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 3, 3]
    assert sorted(len(r.ids) for r in got[2:]) == [1, 1, 2, 2] and all(r.ids[-1] == 2 for r in got)
    folder, manifest = records.write_records(docs.limit(0), byte_bpe_path(), 2)
    assert records.read_records(spark, folder, manifest).collect() == []


def test_offsets_reach_any_record(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    folder, manifest = records.write_records(docs, byte_bpe_path(), 2)
    files, root = records.open_folder(folder)
    for row in manifest.collect():
        data = files.open_input_stream(f"{root}/{row.name}.rec").read()
        offsets = np.frombuffer(files.open_input_stream(f"{root}/{row.name}.idx").read(), "<u8")
        assert len(offsets) == row.records
        for at in offsets[::-1].tolist():
            records.read_frame(data, at)


def test_a_batch_is_cut_into_words_at_once_as_the_library_does(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe_path())
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    texts = [f" nowý{i}x {i} don't_{i}" for i in range(300)] + [
        "", " ", "  ", " a  b", "a\n b", "a \n b\t c ", "x  y", "　z  ", "ß" * 50, "a 'll b's", "\x00 \x7f\xff", "😀 é😀", None]
    texts += [f"{mark}{s}{mark}z{s} {s}" for s in special for mark in ("", " ", "  ", "a ", "\n")]
    encoder = records.LibraryEncoder(records.read_vocabulary(byte_bpe_path()))

    class Counted:
        calls, pattern = 0, encoder.word

        def findall(self, text):
            self.calls += 1
            return self.pattern.findall(text)

    encoder.word = Counted()
    for size in (1 << 20, 64, 1):
        monkeypatch.setattr(records, "TEXT_BYTES", size)
        found = [ids.tolist() for ids in encoder.encode_all(pa.array(texts))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(records, "TEXT_BYTES", 1 << 20)
    encoder.word.calls = 0
    list(encoder.encode_all(pa.array([f" {i}q{i} r{i}" for i in range(500)])))
    assert encoder.word.calls == 1


def test_memory_forgets_what_is_not_asked_for(monkeypatch):
    monkeypatch.setattr(records, "REMEMBERED", 6)
    asked = []

    def make(keys):
        asked.extend(keys)
        return [k.encode() for k in keys]

    memory = records.Memory(make)
    for keys in (["a", "b", "a", "c"], ["d", "a"], ["a", "e"], ["f"], ["a", "b"]):
        assert memory.of(keys) == [k.encode() for k in keys]
    assert sorted(asked) == ["a", "b", "b", "c", "d", "e", "f"]
