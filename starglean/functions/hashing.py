"""Word shingles, 32-bit base hashes and MinHash signatures.

Shingling and the md5 base hash are native expressions.  MurmurHash3 and the
signature itself are Arrow functions over whole batches: the signature needs an
unsigned 64-bit product, and one NumPy pass per hash function over the flattened
batch is narrow (no shuffle, no explode) whatever the corpus size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import costly
from .text import collapse_spaces
from .vectors import let

# Signature parameters and the published MurmurHash3 x86_32 constants.
NUM_HASHES = 100
HASH_SPACE = 2**32 - 1
SIGNATURE_SEED = 42
MURMUR_C1, MURMUR_C2, MURMUR_N = 0xCC9E2D51, 0x1B873593, 0xE6546B64
MURMUR_MIX1, MURMUR_MIX2 = 0x85EBCA6B, 0xC2B2AE35
MASK32 = 0xFFFFFFFF


def shingles(text: Column, q: int = 1) -> Column:
    """q-word shingles; a text of fewer than q words is a single shingle, null or empty gives ``[""]``."""
    starts_a_run = rf"(?<![^ ])(?=((?:[^ ]+ ){{{q - 1}}}[^ ]+))"

    def cut(spaced: Column) -> Column:
        too_short = (spaced == "") | (F.regexp_count(spaced, F.lit(" ")) < q - 1)
        runs = F.split(spaced, " ") if q == 1 else F.regexp_extract_all(spaced, F.lit(starts_a_run), 1)
        return F.when(too_short, F.array(spaced)).otherwise(runs)

    return let(collapse_spaces(F.coalesce(text, F.lit(""))), cut)


def md5_hash32(value: Column) -> Column:
    """The first 32 bits of md5, unsigned."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 8), 16, 10).cast("bigint")


def _rotl(x: int, r: int) -> int:
    return ((x << r) | (x >> (32 - r))) & MASK32


def murmur3_32(data: bytes, seed: int = 0) -> int:
    """Unsigned MurmurHash3 x86_32."""

    def scramble(k: int) -> int:
        return (_rotl((k * MURMUR_C1) & MASK32, 15) * MURMUR_C2) & MASK32

    whole = len(data) & ~3
    state = seed
    for block in np.frombuffer(data[:whole], dtype="<u4").tolist():
        state = (_rotl(state ^ scramble(block), 13) * 5 + MURMUR_N) & MASK32
    if whole < len(data):
        state ^= scramble(int.from_bytes(data[whole:], "little"))
    state ^= len(data)
    state = ((state ^ (state >> 16)) * MURMUR_MIX1) & MASK32
    state = ((state ^ (state >> 13)) * MURMUR_MIX2) & MASK32
    return state ^ (state >> 16)


#: With fewer long strings left than this, each is hashed on its own.
FEW_STRINGS = 16


def murmur3_all(strings: pa.Array) -> np.ndarray:
    """:func:`murmur3_32` of every string of an Arrow column without nulls, four bytes of all strings at a time."""
    edges = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.concatenate([np.frombuffer(strings.buffers()[2] or b"", np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    start, size = edges[:-1], np.diff(edges)

    def scramble(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(MURMUR_C1)
        return ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(MURMUR_C2)

    state, blocks, done = np.zeros(len(size), np.uint32), size >> 2, 0
    rows = np.flatnonzero(blocks)
    while len(rows) >= FEW_STRINGS:
        at = start[rows] + 4 * done
        h = state[rows] ^ scramble(data[at] | data[at + 1] << 8 | data[at + 2] << 16 | data[at + 3] << 24)
        state[rows] = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(MURMUR_N)
        done += 1
        rows = rows[blocks[rows] > done]
    rest, end = size & 3, start + (blocks << 2)
    last = data[end] * (rest > 0) | (data[end + 1] << 8) * (rest > 1) | (data[end + 2] << 16) * (rest > 2)
    state ^= scramble(last.astype(np.uint32))
    state ^= size.astype(np.uint32)
    state = (state ^ (state >> np.uint32(16))) * np.uint32(MURMUR_MIX1)
    state = (state ^ (state >> np.uint32(13))) * np.uint32(MURMUR_MIX2)
    out = (state ^ (state >> np.uint32(16))).astype(np.int64)
    for row in rows.tolist():
        out[row] = murmur3_32(strings[row].as_py().encode())
    return out


@arrow_udf(T.ArrayType(T.LongType()))
def _murmur3_each(lists: pa.Array) -> pa.Array:
    # Hash each distinct shingle of the batch once; text repeats its words.
    encoded = lists.flatten().dictionary_encode()
    distinct = murmur3_all(encoded.dictionary)
    values = distinct[encoded.indices.to_numpy(zero_copy_only=False)] if len(encoded) else distinct
    return pa.ListArray.from_arrays(_offsets(lists), pa.array(values, pa.int64()))


def _offsets(lists: pa.Array) -> pa.Array:
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def base_hashes(shingle_list: Column, base: str = "murmur3") -> Column:
    """The 32-bit hash of every shingle: ``murmur3`` or the SQL-portable ``md5``."""
    if base == "murmur3":
        return costly(_murmur3_each)(shingle_list)
    if base == "md5":
        return F.transform(shingle_list, md5_hash32)
    raise ValueError(f"unknown base hash: {base}")


def hash_coefficients(
    num_hashes: int = NUM_HASHES, hash_space: int = HASH_SPACE, seed: int = SIGNATURE_SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets from NumPy's legacy generator, drawn once on the driver."""
    draw = np.random.RandomState(seed)
    multipliers = draw.randint(1, hash_space, size=num_hashes, dtype=np.uint64)
    offsets = draw.randint(0, hash_space, size=num_hashes, dtype=np.uint64)
    return multipliers, offsets


def minhash_signature(
    hashes: Column, num_hashes: int = NUM_HASHES, hash_space: int = HASH_SPACE, seed: int = SIGNATURE_SEED
) -> Column:
    """``min((a_i * x + b_i) mod hash_space)`` for each hash function i over the row's hashes x; null without any."""
    multipliers, offsets = hash_coefficients(num_hashes, hash_space, seed)
    space = np.uint64(hash_space)

    @arrow_udf(T.ArrayType(T.LongType()))
    def signature(lists: pa.Array) -> pa.Array:
        x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
        edges = _offsets(lists).to_numpy()
        full = np.diff(edges) > 0  # a row without hashes has no minimum: its signature is null
        mins = np.empty((int(full.sum()), num_hashes), dtype=np.int64)
        if len(mins):
            for i, (a, b) in enumerate(zip(multipliers, offsets)):
                mins[:, i] = np.minimum.reduceat((a * x + b) % space, edges[:-1][full])
        bounds = np.concatenate([[0], np.cumsum(full * num_hashes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(mins.ravel()), mask=pa.array(~full))

    return costly(signature)(hashes)


def text_signature(text: Column, q: int = 1, base: str = "murmur3", **kwargs: int) -> Column:
    """Text to signature.  Repeated shingles cannot change a minimum, so they are dropped first."""
    return minhash_signature(base_hashes(F.array_distinct(shingles(text, q)), base), **kwargs)
