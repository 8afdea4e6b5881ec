"""Blocks of whole texts, arrays over their bytes, and exchanges of packed keys between blocks and buckets.

An exchange has three steps. Each block sends its distinct keys, packed and sorted, to buckets of the key space. Each
bucket, held by one task, sorts what came and answers every block with one small code per key, in the block's order.
Each block meets its answers again by its number. A key that many texts of a block hold is sent once, so even a key
that a third of all texts hold reaches its bucket as one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, mix64, shuffle_parts, slices, utf8

BLOCK = "block long, doc_ids array<long>, ends array<long>, data binary"
SENT = "bucket int, block long, keys binary, notes binary"
ANSWER = "block long, bucket int, codes binary"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LAST_ID = np.iinfo(np.int64).max


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def build(scratch: Scratch, name: str, docs: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Write docs (doc_id, text) as blocks of about `most` bytes, compressed; a longer text has a block of its own.
    Block numbers rise with the partition and the row order within it. A null id is held as the largest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for part in slices(batches, "text", most):
            data, ends = utf8(part.column("text"))
            ids = part.column("doc_id").cast(pa.int64()).fill_null(LAST_ID)
            row = {"block": [number], "doc_ids": [ids.to_numpy(zero_copy_only=False)], "ends": [ends[1:]], "data": [pack(data.tobytes())]}
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], list(row))
            number += 1

    return scratch.put(name, docs.select("doc_id", "text").mapInArrow(run, BLOCK), "uncompressed")


def bucket_count(blocks: DataFrame, text_bytes: int = 1 << 24) -> int:
    """As many buckets as the cluster deals rows to, and so many that one holds the keys of `text_bytes` of text."""
    total = blocks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0  # a single number
    return max(shuffle_parts(blocks.sparkSession), -(-total // text_bytes))


class Block:
    """The texts of one block: data, and for each text its id, start and end."""

    def __init__(self, number: int, doc_ids, ends, data: bytes):
        self.number, self.doc_ids = int(number), np.asarray(doc_ids, np.int64)
        self.ends = np.asarray(ends, np.int64)
        self.starts = np.append(0, self.ends[:-1]) if len(self.ends) else self.ends
        self.data = np.frombuffer(unpack(data), np.uint8)
        self.lengths = self.ends - self.starts


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block(batch.column("block")[k].as_py(), batch.column("doc_ids")[k].values.to_numpy(), batch.column("ends")[k].values.to_numpy(), batch.column("data")[k].as_py())


def first_block(frame: pd.DataFrame) -> Block:
    row = frame.iloc[0]
    return Block(row["block"], row["doc_ids"], row["ends"], row["data"])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def gaps(keys: np.ndarray, bits: int) -> bytes:
    """The upper `bits` of rising keys, as the gaps between them, byte by byte: sorted keys lie close, so the upper bytes
    of the gaps are mostly nothing and pack away."""
    upper = keys >> np.uint64(64 - bits)
    flat = np.diff(upper, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : bits // 8]
    return pack(np.ascontiguousarray(flat.T).tobytes())


def ungaps(data: bytes, bits: int) -> np.ndarray:
    flat = np.frombuffer(unpack(data), np.uint8).reshape(bits // 8, -1).T
    out = np.zeros((len(flat), 8), np.uint8)
    out[:, : bits // 8] = flat
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def send(number: int, buckets: np.ndarray, keys: np.ndarray, bits: int, notes: np.ndarray | None = None) -> pd.DataFrame:
    """The rows of one block; `buckets` rises, and keys rise within a bucket."""
    edges = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, np.int64)
    ends = np.append(edges[1:], len(buckets))
    return pd.DataFrame({
        "bucket": buckets[edges].astype(np.int32), "block": np.full(len(edges), number, np.int64), "keys": [gaps(keys[a:b], bits) for a, b in zip(edges, ends)],
        "notes": [b"" if notes is None else pack(notes[a:b].tobytes()) for a, b in zip(edges, ends)],
    })


def received(frame: pd.DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's keys, block after block, and how many each block sent."""
    parts = [ungaps(x, bits) for x in frame["keys"]]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def answer(frame: pd.DataFrame, sorted_codes: np.ndarray, order: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    """A bucket's codes, in sorted order, put back into each block's order."""
    codes = np.empty(len(order), np.uint8)
    codes[order] = sorted_codes
    parts = [pack(x.tobytes()) for x in np.split(codes, np.cumsum(sizes)[:-1])]
    return pd.DataFrame({"block": frame["block"].to_numpy(), "bucket": frame["bucket"].to_numpy(), "codes": parts})


def answers(frame: pd.DataFrame, buckets: np.ndarray) -> np.ndarray:
    """All codes of a block's answers in the order of its keys; `buckets` are those of the keys, rising."""
    codes = {int(b): c for b, c in zip(frame["bucket"], frame["codes"])}
    wanted = np.unique(buckets)
    return np.frombuffer(b"".join(unpack(codes[int(b)]) for b in wanted), np.uint8) if len(wanted) else np.zeros(0, np.uint8)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order of the keys (of equal keys in no set order), where groups of equal keys start in it, and each sorted
    key's group."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(keys) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


_RANDOM = np.random.default_rng(20240229)
BYTE = _RANDOM.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_places = np.zeros(0, np.uint64)


def places(a: int, b: int) -> np.ndarray:
    """An odd random factor for each place from a to b; those of the first places are kept."""
    global _places
    if b > 1 << 16:
        return mix64(np.arange(a + 1, b + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    if not len(_places):
        _places = mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _places[a:b]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each run of bytes; runs rise and do not overlap. Each byte has a random value and each place a
    random factor, so the sum is a multilinear hash; the length goes in as well. Runs are summed in stretches of about
    `step` bytes, and a longer run in pieces, so memory does not grow with the text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    sums, upto = np.zeros(len(starts), np.uint64), np.cumsum(lengths)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + step, "right")))
        if hi == lo + 1:
            for at in range(0, int(lengths[lo]), step):
                size = min(step, int(lengths[lo]) - at)
                first = int(starts[lo]) + at
                sums[lo : lo + 1] += (BYTE[data[first : first + size]] * places(at, at + size)).sum(dtype=np.uint64, keepdims=True)
        else:
            sums[lo:hi] = _short_sums(data, starts[lo:hi], lengths[lo:hi])
        lo = hi
    return mix64(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _short_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums, full = np.zeros(len(starts), np.uint64), lengths > 0
    if full.any():
        value = BYTE[data[np.repeat(starts, lengths) + within]] * places(0, int(lengths.max()))[within]
        sums[full] = np.add.reduceat(value, first[full])
    return sums


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word ends with its text. `starts` are where the texts start."""
    inside = ~SPACES[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    at = starts[starts < len(data)]
    begin[at] = inside[at]
    over = inside.copy()
    over[:-1] &= ~inside[1:]
    over[-1:] = inside[-1:]
    last = at[at > 0] - 1
    over[last] = inside[last]
    return np.flatnonzero(begin), np.flatnonzero(over) + 1


#: Windows up to this length are hashed by one polynomial.
SHORT = 64


def window_hashes(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A 64-bit hash of the `length` bytes from each place (those that reach past the end mean nothing).

    Up to SHORT bytes by a polynomial. In a longer one, texts that differ in a regular pattern (Thue-Morse) would cancel
    modulo 2^64 whatever the factor, so a longer window is a chain over the hashes of its pieces of SHORT bytes, scrambled
    at every link; the last piece ends where the window ends."""
    if length <= SHORT:
        return _polynomials(data, length, seed)
    piece, out = _polynomials(data, SHORT, seed), np.full(len(data), seed, np.uint64)
    for at in [*range(0, length - SHORT, SHORT), length - SHORT]:
        out *= np.uint64(0x9E3779B97F4A7C15)
        out[: max(0, len(data) - at)] ^= piece[at:]
        out = mix64(out)
    return out


def _polynomials(data: np.ndarray, length: int, seed: int, step: int = 1 << 15) -> np.ndarray:
    """Polynomials of short windows by doubling, in stretches that fit a core's cache."""
    factor = int(mix64(np.array([seed], np.uint64))[0]) | 1
    values = BYTE * np.uint64(2 * seed + 1)
    out = np.zeros(len(data), np.uint64)
    for lo in range(0, len(data), step):
        block = values[data[lo : lo + step + length]]
        total, power, size, done = np.zeros(len(block), np.uint64), factor, 1, 0
        while True:
            if length & size:
                total *= np.uint64(power)
                total[: max(0, len(block) - done)] += block[done:]
                done += size
            if size * 2 > length:
                break
            grown = block * np.uint64(power)
            grown[: max(0, len(block) - size)] += block[size:]
            block, power, size = grown, power * power % (1 << 64), size * 2
        out[lo : lo + step] = mix64(total[:step])
    return out
