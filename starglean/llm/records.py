"""Token ids in framed binary record files with a separate offset index.

One shard is ``<name>.rec`` with its index ``<name>.idx``.  A frame is

    length   u64   bytes of the body
    check    u32   masked CRC-32 of the eight length bytes
    body           doc_id i64, flags u8 (1: doc_id is null), width u8, then ids of that width
    check    u32   masked CRC-32 of the body

all little-endian.  A checksum is masked by rotating it right by 15 bits and
adding a constant, so that a checksum stored in data that is checked again does
not cancel out.  The index holds one u64 per frame, its offset, so a reader can
visit frames in any order.  Ids take 2 bytes where the vocabulary allows, else 4.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .bpe import REMEMBERED, SPACES, WORD, byte_names, read_vocabulary
from .common import map_batches

# Fixed value: the constant of masked checksums in length-delimited record files.
MASK_DELTA = 0xA282EAD8
#: A task starts a new shard once the present one has this many bytes.
SHARD_BYTES = 8 << 20
#: Texts that are cut into pieces at once, in bytes; one text may have more.
TEXT_BYTES = 4 << 20
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<qBB")
CHECK = struct.Struct("<I")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    body = BODY.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(body))
    return size + CHECK.pack(masked(size)) + body + CHECK.pack(masked(body))


def read_frame(data: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """``doc_id``, ids and the end of the frame at ``at``; a broken frame raises."""
    size, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"broken length at {at}")
    start = at + HEAD.size
    body = data[start : start + size]
    if len(body) != size or CHECK.unpack_from(data, start + size)[0] != masked(body):
        raise ValueError(f"broken record at {at}")
    doc_id, none, width = BODY.unpack_from(body)
    return None if none else doc_id, np.frombuffer(body, f"<u{width}", offset=BODY.size), start + size + CHECK.size


class Memory:
    """Results of ``make`` for lists of keys, kept while they are in use, as :class:`.bpe.Remembered` does for single ones."""

    def __init__(self, make: Callable[[list[str]], list[bytes | None]]) -> None:
        self.make = make
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def of(self, keys: list[str]) -> list[bytes | None]:
        if len(self.young) >= REMEMBERED // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        missing = {k for k, value in zip(keys, found) if value is None}
        if not missing:
            return found
        again = missing & old.keys()
        young.update(zip(again, map(old.__getitem__, again)))
        new = list(missing - again)
        young.update(zip(new, self.make(new)))
        return list(map(young.__getitem__, keys))


class LibraryEncoder:
    """Ids by the tokenizers library; pieces and words met before are not encoded again.

    Ids are kept as 32-bit integers side by side, the least that a remembered
    piece can take.  With a byte-level pre-tokenizer and no normalizer, new
    pieces are cut into words and the library's model encodes each new word;
    other tokenizers, and pieces with a special token, encode pieces as a whole.

    Texts go in batches: each distinct piece of a batch (see :class:`.bpe.Pieces`
    for where texts may be cut) is looked up once, all new ones are cut into
    words together, and the ids are put in place by array operations.
    """

    def __init__(self, file: bytes) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        before = json.loads(file).get("pre_tokenizer") or {}
        self.by_words = self.tokenizer.normalizer is None and before.get("type") == "ByteLevel" \
            and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        self.names = {b: name for name, b in byte_names().items()}
        self.word = regex.compile(WORD)
        self.model = self.tokenizer.model
        self.words = Memory(self.new_words)
        self.odd = (*SPACES, *added)
        self.letters_are_words = self.by_words and not any(map(str.isalpha, added))
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def new_words(self, words: list[str]) -> list[bytes]:
        # The byte FF is in no UTF-8 text.
        if not words:
            return []
        spelled = b"\xff".join([w.encode("utf-8") for w in words]).decode("latin-1").translate(self.names).split(self.names[0xFF])
        tokenize = self.model.tokenize
        return [array("I", [t.id for t in tokenize(word)]).tobytes() for word in spelled]

    def piece(self, piece: str) -> bytes:
        if not self.by_words or (self.special and self.special.search(piece)):
            return self.whole(piece)
        return b"".join(self.words.of(self.word.findall(piece)))

    def cut(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of pieces that follow a space, which goes with them; None for an odd piece, at which a text cannot be cut."""
        out: list[bytes | None] = [None] * len(pieces)
        one_word = [self.letters_are_words and p.isalpha() for p in pieces]
        alone = [i for i, one in enumerate(one_word) if one]
        for i, ids in zip(alone, self.words.of([" " + pieces[i] for i in alone])):
            out[i] = ids
        rest = [i for i, one in enumerate(one_word) if not one and pieces[i] and not pieces[i].startswith(self.odd)]
        plain = [pieces[i] for i in rest]
        joined = " " + " ".join(plain)
        if not self.by_words or (self.special and self.special.search(joined)):
            made = [self.piece(" " + p) for p in plain]
        else:
            # No piece holds a space or starts with white space, so the words with a space are those that start a piece.
            words = self.word.findall(joined) if plain else []
            starts = [i for i, w in enumerate(words) if w[0] == " "]
            parts = self.words.of(words)
            made = [parts[a] if b - a == 1 else b"".join(parts[a:b]) for a, b in pairwise([*starts, len(parts)])]
        for i, ids in zip(rest, made):
            out[i] = ids
        return out

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order; null counts as empty."""
        texts = pc.fill_null(texts, "")
        upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            done = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, done + TEXT_BYTES, side="right")))
            yield from self.encode_slice(texts.slice(start, end - start))
            pa.default_memory_pool().release_unused()
            start = end

    def encode_slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        flat, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        heads = np.cumsum(sizes) - sizes
        inner = np.ones(len(flat), bool)
        inner[heads] = False
        coded = flat.filter(pa.array(inner)).dictionary_encode()
        made = self.cut(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        odd = np.array([ids is None for ids in made], bool)
        made = [ids or b"" for ids in made]
        # A text's first piece has no space before it.
        unit = np.empty(len(flat), np.int64)
        unit[inner] = coded.indices.to_numpy(zero_copy_only=False)
        unit[heads] = len(made) + np.arange(len(heads))
        made += [self.piece(p) if p else b"" for p in flat.take(pa.array(heads)).to_pylist()]
        ids = np.frombuffer(b"".join(made), np.uint32)
        count = np.fromiter(map(len, made), np.int64, len(made)) >> 2
        del made, flat, coded
        first, n = (np.cumsum(count) - count)[unit], count[unit]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
        places = np.repeat((first - (ends - n)).astype(kind), n)
        places += np.arange(total, dtype=kind)
        out = ids[places]
        del places
        bounds = np.append(0, ends)[np.append(heads, len(unit))]
        uncut = np.zeros(len(heads), bool)
        if odd.any():
            uncut[np.repeat(np.arange(len(heads)), sizes)[inner][odd[unit[inner]]]] = True
        for row, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            yield np.frombuffer(self.whole(texts[row].as_py()), np.uint32) if uncut[row] else out[a:b]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all(pa.array([text])))


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(file: bytes) -> LibraryEncoder:
    name = hashlib.sha256(file).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = LibraryEncoder(file)
    return _ENCODERS[name]


def open_folder(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class ShardWriter:
    """Shards of one task.  Names carry the attempt, so a retried or doubled task never writes another's file."""

    def __init__(self, folder: str, part: int) -> None:
        self.files, self.root = open_folder(folder)
        self.part, self.attempt, self.count = part, uuid.uuid4().hex, 0
        self.data: list[bytes] = []
        self.offsets: list[int] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray, width: int) -> Iterator[tuple]:
        record = frame(doc_id, ids, width)
        self.offsets.append(self.size)
        self.data.append(record)
        self.size += len(record)
        self.tokens += len(ids)
        if self.size >= SHARD_BYTES:
            yield self.close()

    def close(self) -> tuple:
        name = f"{self.part:06d}-{self.count:06d}-{self.attempt}"
        for ending, content in ((".rec", b"".join(self.data)), (".idx", np.array(self.offsets, "<u8").tobytes())):
            with self.files.open_output_stream(f"{self.root}/{name}{ending}") as out:
                out.write(content)
        row = (self.part, self.count, name, len(self.offsets), self.tokens)
        self.count += 1
        self.data, self.offsets, self.size, self.tokens = [], [], 0, 0
        return row


MANIFEST = "part int, shard int, name string, records bigint, tokens bigint"


def write_records(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encode every text, append ``end_id`` and write shards in ascending ``doc_id`` order.

    Returns the folder and its manifest: one row per shard, in order by
    (part, shard), with the global ``start`` of its first id.  The manifest
    lists only shards of tasks that succeeded.  Null ``doc_id`` comes first;
    rows that share a ``doc_id`` follow each other by content; null text counts
    as empty and has the end id alone.  An empty table writes no shard.

    Texts move once, by ranges of ``doc_id``.  ``folder`` must be one that all
    executors and pyarrow can write; the default is below the shared folder.
    """
    spark = docs.sparkSession
    if folder is None:
        folder = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)
    file = spark.sparkContext.broadcast(read_vocabulary(path))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = library_encoder(file.value)
        writer = ShardWriter(folder, TaskContext.get().partitionId())
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                ids = np.append(found, np.uint32(end_id))
                rows += writer.add(doc_id, ids, encoder.width if end_id < 1 << 16 else 4)
        if writer.offsets:
            rows.append(writer.close())
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["part", "shard", "name", "records", "tokens"])

    # One row per 8 MB of output: the running total over shards is taken by the driver.
    shards = sorted(map(tuple, ranged.mapInArrow(run, MANIFEST).collect()))
    start, listed = 0, []
    for row in shards:
        listed.append((*row, start))
        start += row[4]
    return folder, spark.createDataFrame(listed, f"{MANIFEST}, start bigint")


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every record, one task per shard or few, all checksums tested."""

    def make():
        files, root = open_folder(folder)

        def work(batch: pa.RecordBatch):
            for name, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                with files.open_input_stream(f"{root}/{name}.rec") as source:
                    data = source.read()
                with files.open_input_stream(f"{root}/{name}.idx") as source:
                    offsets = np.frombuffer(source.read(), "<u8")
                doc_ids, ids, starts = [], [], []
                for at in offsets.tolist():
                    doc_id, tokens, _ = read_frame(data, at)
                    doc_ids.append(doc_id)
                    starts.append(start)
                    ids.append(tokens)
                    start += len(tokens)
                    if len(ids) == 1000:
                        yield id_batch(doc_ids, starts, ids)
                        doc_ids, ids, starts = [], [], []
                if ids:
                    yield id_batch(doc_ids, starts, ids)

        return work

    shards = manifest.select("name", "start")
    count = max(1, manifest.count())
    return map_batches(shards.repartition(count), make, "doc_id bigint, start bigint, ids array<bigint>")


def id_batch(doc_ids: list, starts: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = pa.array(np.concatenate(ids).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), flat)],
        ["doc_id", "start", "ids"])


def record_digest(records: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the records read back."""

    def make():
        def work(batch: pa.RecordBatch):
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

        return work

    return map_batches(records, make, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
