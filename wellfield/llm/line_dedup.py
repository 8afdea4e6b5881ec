"""Removal of lines that many documents share, by arrays under a sharded minimal perfect hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import Scratch, mix64, shuffle_parts, slices, utf8

WHITE = b" \t\n\x0b\x0c\r"
BLOCK = "block long, ids binary, known binary, ends binary, bytes long, data binary"
SENT = "shard int, block long, keys binary, docs binary, last binary, known binary"
INDEX = "shard int, lines long, sizes binary, bits binary, fingerprints binary, docs binary, last binary, known binary"
ANSWER = "block long, shard int, codes binary"
RESULT = "doc_id long, n_lines long, n_dropped long, kept_text string"
#: A shard indexes the lines of so many bytes of text.
SHARD_TEXT = 1 << 24
KEEP, DROP, DROP_BUT_LAST = 0, 1, 2


def _packed(array: np.ndarray) -> bytes:
    return B.pack(np.ascontiguousarray(array).tobytes())


def _array(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(B.unpack(data), kind)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys: places 0 to n - 1, one for each key.

    On each level the keys that are left hash into a bit array of twice their number. A place that exactly one of them
    takes is that key's; the others go on to the next level. A key's number is the count of set bits before its place,
    over all levels. Levels go on until no key is left, so none is dropped; about 3.7 bits a key are stored."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.cumsum(sizes) - sizes
        self.before = np.append(0, np.cumsum(np.bitwise_count(bits), dtype=np.int64))

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix64(keys[:, 0] ^ mix64(keys[:, 1] + seed)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels = [], []
        while len(keys):
            size = -(-max(64, 2 * len(keys)) // 64) * 64
            at = cls.places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, -1 for some that are no keys; another that is no key may get any place."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes)):
            at = self.places(keys[left], level, int(size)) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            word, bit = word[found], bit[found]
            out[left[found]] = self.before[word] + np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            left = left[~found]
            if not len(left):
                break
        return out


class _Block:
    """The texts of one block, its lines, and the distinct keys of the long ones in the order of their hashes."""

    def __init__(self, row: dict, least: int):
        self.number, self.buffer = int(row["block"]), B.unpack(row["data"])
        self.ids, self.known, ends = _array(row["ids"], np.int64), _array(row["known"], bool), _array(row["ends"], np.int64)
        data, starts = np.frombuffer(self.buffer, np.uint8), np.append(0, ends[:-1])
        breaks = np.flatnonzero(data == 10)
        self.starts, self.ends = np.sort(np.append(starts, breaks + 1)), np.sort(np.append(breaks, ends))
        self.first_line = np.searchsorted(breaks, starts) + np.arange(len(starts))
        self.line, hashes = self._hashes(least)
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        new = np.append(True, (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1)) if len(order) else np.zeros(0, bool)
        self.line, self.group, self.keys = self.line[order], np.cumsum(new) - 1, hashes[order[new]]
        self.doc = np.searchsorted(self.first_line, self.line, "right") - 1

    def _hashes(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The lines whose key has `least` code points or more, and their keys' 128-bit hashes."""
        lines, digests = [], []
        for k in np.flatnonzero(self.ends - self.starts >= least):
            key = self.buffer[self.starts[k] : self.ends[k]].strip(WHITE).lower()
            if len(key) >= least and (key.isascii() or len(key) >= 4 * least or len(key.decode()) >= least):
                lines.append(k)
                digests.append(hashlib.blake2b(key, digest_size=16).digest())
        return np.array(lines, np.int64), np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)

    def holders(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each key the documents here that hold it, the largest id of these, and whether that is an id (not null)."""
        n = len(self.keys)
        pairs = np.unique(self.group * max(1, len(self.ids)) + self.doc)
        group, doc = pairs // max(1, len(self.ids)), pairs % max(1, len(self.ids))
        last, known = np.full(n, np.iinfo(np.int64).min), np.zeros(n, bool)
        np.maximum.at(last, group, np.where(self.known[doc], self.ids[doc], np.iinfo(np.int64).min))
        np.logical_or.at(known, group, self.known[doc])
        return np.bincount(group, minlength=n).astype(np.int64), last, known

    def without(self, codes: np.ndarray, last: np.ndarray, known: np.ndarray) -> list[tuple]:
        code = codes[self.group]
        holder = (self.known[self.doc] == known[self.group]) & (~known[self.group] | (self.ids[self.doc] == last[self.group]))
        gone = np.sort(self.line[(code == DROP) | ((code == DROP_BUT_LAST) & ~holder)])
        cuts, rows = np.searchsorted(gone, np.append(self.first_line, len(self.starts))), []
        for k in range(len(self.ids)):
            first, to = int(self.first_line[k]), int(self.first_line[k + 1]) if k + 1 < len(self.ids) else len(self.starts)
            lost = gone[cuts[k] : cuts[k + 1]]
            runs = [(a, b) for a, b in zip(np.append(first, lost + 1), np.append(lost, to)) if a < b]
            kept = b"\n".join(self.buffer[self.starts[a] : self.ends[b - 1]] for a, b in runs)
            rows.append((int(self.ids[k]) if self.known[k] else None, to - first, len(lost), kept.decode()))
        return rows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for part in slices(batches, "text"):
        data, ends = utf8(part.column("text"))
        ids = part.column("doc_id").cast(pa.int64())
        row = (number, _packed(ids.fill_null(0).to_numpy(zero_copy_only=False)), _packed(ids.is_valid().to_numpy(zero_copy_only=False)), _packed(ends[1:]), len(data), B.pack(data.tobytes()))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["block", "ids", "known", "ends", "bytes", "data"])
        number += 1


def _sent(block: _Block, shards: int) -> pa.RecordBatch:
    docs, last, known = block.holders()
    shard = B.bucket_of(block.keys[:, 0], shards)
    cuts = [slice(*x) for x in zip(*(lambda e: (e[:-1], e[1:]))(np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))))]
    columns = [pa.array([shard[c.start] for c in cuts], pa.int32()), pa.array([block.number] * len(cuts), pa.int64())]
    columns += [pa.array([_packed(x[c]) for c in cuts], pa.binary()) for x in (block.keys, docs, last, known)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "block", "keys", "docs", "last", "known"])


def _index(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard: its distinct lines' arrays, each at the place that the perfect hash gives."""
    join = lambda column, kind: np.concatenate([_array(x, kind) for x in frame[column]])
    keys, docs, last, known = join("keys", "<u8").reshape(-1, 2), join("docs", np.int64), join("last", np.int64), join("known", bool)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    first = np.flatnonzero(np.append(True, (keys[order[1:]] != keys[order[:-1]]).any(axis=1)))
    keys = keys[order[first]]
    perfect = PerfectHash.build(keys)
    place = np.argsort(perfect.slots(keys))
    docs, last, known = np.add.reduceat(docs[order], first), np.maximum.reduceat(last[order], first), np.logical_or.reduceat(known[order], first)
    row = (int(frame["shard"].iloc[0]), len(keys), _packed(perfect.sizes), _packed(perfect.bits), _packed(keys[place, 1]), _packed(docs[place]), _packed(last[place]), _packed(known[place]))
    return pd.DataFrame([row], columns=[c.split()[0] for c in INDEX.split(", ")])


def line_index(sent: DataFrame) -> DataFrame:
    """One row per shard: the perfect hash of its distinct lines, and by the lines' places their fingerprints (64 bits),
    the number of documents with the line, and the largest id of these."""
    return sent.groupBy("shard").applyInPandas(_index, INDEX)


def probe(sent: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """For every key that a block sent, whether its lines stay. A key that the index lacks is told by its fingerprint."""

    def run(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame({"block": [], "shard": [], "codes": []})
        codes = [b""] * len(asked)
        if len(arrays):
            row = arrays.iloc[0]
            perfect = PerfectHash(_array(row["sizes"], np.int64), _array(row["bits"], "<u8"))
            marks, docs, last, known = _array(row["fingerprints"], "<u8"), _array(row["docs"], np.int64), _array(row["last"], np.int64), _array(row["known"], bool)
        for k, (keys, own_last, own_known) in enumerate(zip(asked["keys"], asked["last"], asked["known"])):
            keys, own_last, own_known = _array(keys, "<u8").reshape(-1, 2), _array(own_last, np.int64), _array(own_known, bool)
            code = np.full(len(keys), KEEP, np.uint8)
            if len(arrays):
                slot = perfect.slots(keys)
                often = (slot >= 0) & (marks[slot] == keys[:, 1]) & (docs[slot] >= min_docs)
                here = (known[slot] == own_known) & (~own_known | (last[slot] == own_last))
                code[often] = np.where(here[often], DROP_BUT_LAST, DROP)
            codes[k] = _packed(code)
        return pd.DataFrame({"block": asked["block"].to_numpy(), "shard": asked["shard"].to_numpy(), "codes": codes})

    return sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(run, ANSWER)


def dedup_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, kept_text.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key of at least `min_chars` code
    points that at least `min_docs` documents hold loses all its lines but those of the largest doc_id holding it.

    Texts go into blocks of a megabyte; a block sends each distinct key once, as a 128-bit hash with the number of its
    documents, to a shard of the hash space. A shard keeps arrays of fingerprints, counts and largest ids under a
    minimal perfect hash; blocks probe them, and one byte per key comes back. So no line is joined, a line that all
    documents share is one entry per block, and a task holds one block, or one shard of about SHARD_TEXT bytes of
    text. Keys are compared by their hashes (BLAKE2b): among 10^12 lines two that differ meet with odds of 1 in 10^14.

    Every row is a document of its own, also where rows repeat or share an id; a largest id that several rows have keeps
    the lines in all of them. A null id is smaller than any other. A null or empty text is one empty line; texts are
    read whole, and a longer text is a block of its own (some 20 bytes of memory for each newline). An empty table gives
    no rows; other columns of docs are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lines")
    names = ["block", "ids", "known", "ends", "data"]
    texts = scratch.put("blocks", docs.select("doc_id", "text").mapInArrow(_blocks, BLOCK), "uncompressed")
    with scratch.small_batches():
        total = texts.agg(F.sum("bytes")).first()[0] or 0  # a single number
        shards = max(shuffle_parts(spark), -(-total // SHARD_TEXT))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.select(names).to_pylist():
                    yield _sent(_Block(row, min_chars), shards)

        def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty:
                return pd.DataFrame(columns=["doc_id", "n_lines", "n_dropped", "kept_text"])
            block = _Block(left.iloc[0].to_dict(), min_chars)
            _, last, known = block.holders()
            codes = np.concatenate([_array(x, np.uint8) for x in right.sort_values("shard")["codes"]]) if len(right) else np.zeros(0, np.uint8)
            out = pd.DataFrame(block.without(codes, last, known), columns=["doc_id", "n_lines", "n_dropped", "kept_text"])
            return out.astype({"doc_id": "Int64"})

        sent = scratch.put("sent", texts.mapInArrow(send, SENT), "uncompressed")
        index = scratch.put("index", line_index(sent), "uncompressed")
        answers = scratch.put("answers", probe(sent, index, min_docs), "uncompressed")
        scratch.drop("sent", "index")
        out = scratch.put("out", texts.select(*names).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(cut, RESULT))
        scratch.drop("blocks", "answers")
    return out
