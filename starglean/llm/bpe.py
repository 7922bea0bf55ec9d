"""Byte-pair encoding and decoding with a tokenization automaton.

The merges are compiled into a deterministic automaton whose arcs are tokens.
It starts with one state that loops over the 256 bytes.  Merge ``k`` joining
``u`` and ``v`` inserts a gadget: arcs ``u`` lead to a copy of their target
that has lost its arc ``v``, and every state that has an arc ``u`` gets an arc
``uv`` to where ``v`` led.  So a token path exists exactly if it is the
encoding of the bytes it spells, and each word has one path.

All arcs of one label share a target, hence a state is named by the label that
enters it, and whether a state has an arc follows from the gadgets in order of
insertion (:meth:`Automaton.arc`).  The answers fill the transition table that
encoding reads; the full table of 50,000 squared arcs is never built.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_batches, spread, texts_of

# White space, and the word pattern of byte-level tokenizers.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES = tuple(chr(c) for c in range(0x3001) if regex.fullmatch(f"[{SPACE}]", chr(c)))
WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    + f"| ?[^{SPACE}\\p{{L}}\\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Byte ranges that stand for themselves; the other bytes follow from 256 on.
PRINTABLE = ((33, 126), (161, 172), (174, 255))

#: Entries that one memory of a Python worker holds, half of them young; which are held changes no result.
REMEMBERED = 400_000
START = -1
NEVER = 1 << 60


def byte_names() -> dict[str, int]:
    plain = [b for low, high in PRINTABLE for b in range(low, high + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> bytes:
    """The tokenizer file as bytes, to be shipped to tasks; vocabularies have a bounded size."""
    with open(path, "rb") as file:
        return file.read()


class Automaton:
    """Compiled merges of a byte-level tokenizer file."""

    def __init__(self, file: bytes) -> None:
        data = json.loads(file)
        if data["model"]["type"] != "BPE" or data["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        names, ids = byte_names(), data["model"]["vocab"]
        spell = {token: bytes(names[c] for c in token) for token in ids}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.label: dict[int, bytes] = {ids[t]: b for t, b in spell.items() if t not in self.special}
        self.label |= {i: content.encode() for content, i in self.special.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.since = {ids[t]: 0 for t, b in spell.items() if len(b) == 1}
        self.rank: dict[tuple[int, int], int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        self.arcs: dict[bytes, int] = {b: ids[t] for t, b in spell.items() if len(b) == 1}
        for k, pair in enumerate(data["model"]["merges"], 1):
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            self.insert(k, ids[u], ids[v], ids[u + v], spell[u + v])
        self.table.clear()
        self.longest = max(map(len, self.arcs), default=1)

    def insert(self, k: int, u: int, v: int, joined: int, label: bytes) -> None:
        """The gadget of merge ``k``; without a path ``u v`` it changes nothing."""
        if joined in self.since or not self.arc(u, v):
            return
        self.rank[u, v] = k
        self.left[joined], self.right[joined], self.since[joined] = u, v, k
        self.arcs[label] = joined

    def arc(self, state: int, token: int) -> bool:
        """Whether the state entered by ``state`` has an arc ``token``.

        The younger of both labels goes back to the gadget that made it: an arc
        ``uv`` stands where ``u`` stood, and the state after ``uv`` was the
        state after ``v``.  An arc is gone once a gadget took it.
        """
        rank, since, now = self.rank, self.since, NEVER
        while True:
            if rank.get((state, token), NEVER + 1) <= now:
                return False
            older, younger = since[state], since[token]
            if younger > older:
                token, now = self.left[token], min(now, younger)
            elif older:
                state, now = self.right[state], min(now, older - 1)
            else:
                return True

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """The only accepted path that spells ``word``, found by table look-ups.

        Longest arcs are tried first; an end from which no path goes on is
        remembered with its state, so each (position, state) is left once.
        """
        arcs, table, size = self.arcs, self.table, len(word)
        if (whole := arcs.get(word)) is not None:
            return (whole,)
        path: list[int] = []
        ends: list[int] = []
        dead: set[tuple[int, int]] = set()
        at, reach = 0, min(size, self.longest)
        while at < size:
            before = path[-1] if path else START
            found = None
            while reach:
                token = arcs.get(word[at : at + reach])
                if token is not None and (at + reach, token) not in dead:
                    if before == START:
                        found = token
                        break
                    if (known := table.get((before, token))) is None:
                        known = table[before, token] = self.arc(before, token)
                    if known:
                        found = token
                        break
                reach -= 1
            if found is not None:
                path.append(found)
                ends.append(at)
                at += reach
                reach = min(size - at, self.longest)
            else:
                if not path:
                    raise ValueError(f"no path for {word!r}")
                last, here = path.pop(), ends.pop()
                dead.add((at, last))
                reach, at = at - here - 1, here
        return tuple(path)

    def decode(self, ids: list[int]) -> str:
        """The text whose bytes the arcs ``ids`` emit; broken UTF-8 becomes the replacement mark."""
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


class Remembered(dict):
    """Results of ``make``, kept while they are in use.

    When the young half is full it becomes the old half; what is asked for
    again moves back, the rest is forgotten at the next change.
    """

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str):
        value = self.old.pop(key, self)
        if value is self:
            value = self.make(key)
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """Ids of a text by its pieces, each made on first use.

    A text is cut before each single space.  White space joins the word after
    it only as one space, so words do not cross these cuts unless white space
    follows the space, or a special token does; such pieces map to ``None`` and
    their texts are encoded without cuts.
    """

    def __init__(self, encode: Callable[[str], tuple[int, ...] | bytes], special: list[str]) -> None:
        odd = (*SPACES, *special)

        def make(piece: str):
            return encode(" " + piece) if piece and not piece.startswith(odd) else None

        self.encode = encode
        self.known = Remembered(make)

    def of(self, text: str) -> list:
        """What the pieces of ``text`` map to; a None among them means that it cannot be cut."""
        first, *rest = text.split(" ")
        parts = list(map(self.known.__getitem__, rest))
        if first:
            parts.insert(0, self.encode(first))
        return parts


class Encoder:
    """Whole texts to ids and back, as one Python worker does it."""

    def __init__(self, file: bytes) -> None:
        self.automaton = Automaton(file)
        self.word = regex.compile(WORD)
        special = sorted(self.automaton.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = Remembered(lambda word: self.automaton.encode_word(word.encode("utf-8")))
        self.pieces = Pieces(lambda piece: tuple(self.whole(piece)), special)

    def plain(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, self.word.findall(text))))

    def whole(self, text: str) -> list[int]:
        """Special tokens first, then words, then the automaton."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        ids, at = [], 0
        for match in self.special.finditer(text):
            ids += self.plain(text[at : match.start()])
            ids.append(self.automaton.special[match[0]])
            at = match.end()
        return ids + self.plain(text[at:])

    def encode(self, text: str) -> list[int]:
        parts = self.pieces.of(text)
        try:
            return list(chain.from_iterable(parts))
        except TypeError:  # a None among the parts
            return self.whole(text)

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(file: bytes) -> Encoder:
    """One encoder per Python worker and file, kept between tasks."""
    name = hashlib.sha256(file).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(file)
    return _ENCODERS[name]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every text.

    ``path`` names a byte-level tokenizer file the driver can read.  Null text
    counts as empty: no ids, empty decoded text.  Repeated and null ``doc_id``
    pass through, each row on its own; other columns are ignored.
    """
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        encoder = encoder_of(file.value)

        def work(batch: pa.RecordBatch):
            ids = [encoder.encode(t) for t in texts_of(batch.column(1))]
            decoded = [encoder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"])

        return work

    return map_batches(spread(docs.select("doc_id", "text")), make, "doc_id bigint, ids array<int>, decoded string")


def encoding_digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``; the digests are taken in the task that has the ids."""
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        encoder = encoder_of(file.value)
        sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()

        def work(batch: pa.RecordBatch):
            counts, names, backs = [], [], []
            for text in texts_of(batch.column(1)):
                ids = encoder.encode(text)
                counts.append(len(ids))
                names.append(sha(",".join(map(str, ids))))
                backs.append(sha(encoder.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names), pa.array(backs)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return work

    return map_batches(spread(docs.select("doc_id", "text")), make,
                       "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
