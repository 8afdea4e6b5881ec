"""Removal of passages that repeat across documents, by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import Scratch

#: A difference cover: every remainder modulo PERIOD is a difference of two of these, so for any two places some shift
#: below PERIOD brings both onto sampled places.
PERIOD, COVER = 21, np.array([3, 6, 7, 12, 14])
SAMPLE_BITS, WINDOW_BITS = 48, 64
#: What a bucket says of a block's window: no earlier block has it; one has it under an id smaller than all ids here; earlier
#: ones have it, but only under the id that this block begins with.
NEW, SEEN, SEEN_UNDER_FIRST = 0, 1, 2
SENT = B.SENT + ", first long, last long, flags binary"
#: A bucket holds the samples or windows of so many bytes of text.
BUCKET_TEXT = 1 << 22


def _order(keys: np.ndarray, tails: np.ndarray, major: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A sort order by `major` (small whole numbers), key and tail, and where it starts a new group of equals."""
    order = np.argsort(keys)
    if major is not None:
        order = order[np.argsort(major[order].astype(np.uint16 if major.max(initial=0) < 1 << 16 else np.int64), kind="stable")]

    def fresh(*columns: np.ndarray | None) -> np.ndarray:
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            if c is not None:
                new[1:] |= c[order[1:]] != c[order[:-1]]
        return new

    new = fresh(keys, major)
    if (new != fresh(keys, major, tails)).any():
        order = np.lexsort((tails, keys) if major is None else (tails, keys, major))
        new = fresh(keys, major, tails)
    return order, new


class _Suffixes:
    """The suffixes of one block's texts, known by hashes of their heads.

    Only the first `length` bytes of a suffix count. A sample's rank class is that of its first `length - PERIOD + 1`
    bytes: if two windows are equal, then so are the classes of the two samples that the cover aligns in them."""

    def __init__(self, block: B.Block, length: int):
        self.block, self.length, self.head = block, length, length - PERIOD + 1
        ids = block.doc_ids
        self.rank = np.cumsum(np.append(0, (ids[1:] != ids[:-1]).astype(np.int64))) if len(ids) else ids  # of ids, which rise
        self.heads = B.window_hashes(block.data, self.head, 1)

    def samples(self, buckets: int) -> tuple[np.ndarray, ...]:
        """Distinct sample keys in order with their buckets and whether two texts of this block hold them; each
        sampled place with the number of its key."""
        room = self.block.lengths - self.head
        places = (np.arange(0, max(0, room.max(initial=0)) + 1, PERIOD)[:, None] + COVER).ravel()
        counts = np.searchsorted(places, room, "right")
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.concatenate([places[:c] + a for c, a in zip(counts, self.block.starts)]) if len(counts) else np.zeros(0, np.int64)
        order, first, group = B.groups(self.heads[at])
        keys, docs = self.heads[at[order[first]]], doc[order]
        twice = (np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)).astype(np.uint8) if len(at) else np.zeros(0, np.uint8)
        return keys, B.bucket_of(keys, buckets), twice, at[order], group

    def windows(self, shared: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
        """Distinct windows that have a shared sample, in suffix buckets by the hash of their head, sorted within a
        bucket, and whether only texts of the block's last id have them; each such place with the number of its window,
        whether a text of this block with a smaller id has it, and whether the id is larger than the block's first."""
        n = len(self.block.data)
        flag = np.zeros(n + PERIOD + 1, np.int32)
        flag[shared + 1] = 1
        so_far = np.cumsum(flag, dtype=np.int32)
        at = np.flatnonzero(so_far[PERIOD : PERIOD + n] > so_far[:n])
        doc = np.searchsorted(self.block.ends, at, "right")
        whole = self.block.ends[doc] - at >= self.length
        at, doc = at[whole], doc[whole]
        keys, tails = self._whole_hashes(at), self.heads[at + self.length - self.head].astype(np.uint16)
        bucket = B.bucket_of(self.heads[at], buckets)
        order, new = _order(keys, tails, bucket)
        ranks, group = self.rank[doc[order]], np.cumsum(new) - 1
        earliest = np.minimum.reduceat(ranks, np.flatnonzero(new)) if len(at) else ranks
        first, final = order[new], self.rank[-1] if len(self.rank) else 0
        return keys[first], bucket[first], tails[first], earliest == final, at[order], group, ranks > earliest[group], ranks > 0

    def _whole_hashes(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows at rising places, run by run of places that lie close together."""
        if not len(at):
            return np.zeros(0, np.uint64)
        edges = np.flatnonzero(np.append(True, np.diff(at) > self.length))
        lo, hi = at[edges], at[np.append(edges[1:], len(at)) - 1] + self.length
        size = hi - lo
        base = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(base, size)
        text = self.block.data[np.repeat(lo, size) + within]
        return B.window_hashes(text, self.length, 2)[at - np.repeat(lo - base, np.diff(np.append(edges, len(at))))]


def _shared_samples(suffixes: _Suffixes, frame: pd.DataFrame, buckets: int) -> np.ndarray:
    _, bucket, _, at, group = suffixes.samples(buckets)
    return at[B.answers(frame, bucket)[group] > 0] if len(at) else at


def _classes(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket of samples: a key is shared if two blocks sent it, or one block for two texts."""
    keys, sizes = B.received(frame, SAMPLE_BITS)
    twice = np.frombuffer(b"".join(map(B.unpack, frame["notes"])), np.uint8)
    order, first, group = B.groups(keys)
    hit = np.add.reduceat(twice[order].astype(np.int64), first) > 0
    hit |= np.diff(np.append(first, len(keys))) > 1
    return B.answer(frame, hit[group], order, sizes)


def _suffix_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """One suffix bucket, sorted: which blocks sent a window that an earlier block sent too. Ids rise from block to block,
    so the first block that sent a window has its smallest id; that is not smaller than all ids of a later block only
    where one id goes on from block to block (`first`, `last` and `flags` are there if any id does)."""
    frame = frame.sort_values("block")
    keys, sizes = B.received(frame, WINDOW_BITS)
    order, new = _order(keys, np.frombuffer(b"".join(map(B.unpack, frame["notes"])), np.uint16))
    group = np.cumsum(new) - 1
    earliest = np.minimum.reduceat(order, np.flatnonzero(new))[group]  # keys stand block after block
    codes = np.where(order != earliest, SEEN, NEW).astype(np.uint8)
    if frame["first"].notna().any():
        sender = np.repeat(np.arange(len(frame)), sizes)
        alone = np.frombuffer(b"".join(map(B.unpack, frame["flags"])), bool)[earliest]
        same = frame["last"].to_numpy(np.int64)[sender[earliest]] == frame["first"].to_numpy(np.int64)[sender[order]]
        codes[(codes == SEEN) & alone & same] = SEEN_UNDER_FIRST
    return B.answer(frame, codes, order, sizes)


def _cut(suffixes: _Suffixes, frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    block, length = suffixes.block, suffixes.length
    shared = _shared_samples(suffixes, frame[frame["step"] == 1], buckets)
    _, bucket, _, _, at, group, again, later = suffixes.windows(shared, buckets)
    repeated = np.zeros(len(block.data) + 1, np.int32)
    if len(at):
        code = B.answers(frame[frame["step"] == 2], bucket)[group]
        repeated[at[again | (code == SEEN) | ((code == SEEN_UNDER_FIRST) & later)] + 1] = 1
    so_far = np.append(np.zeros(length, np.int32), np.cumsum(repeated, dtype=np.int32))
    gone = so_far[length + 1 :] > so_far[1 : len(block.data) + 1]
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    closes = gone.copy()
    closes[:-1] &= ~gone[1:]
    edge = block.starts[(block.starts < len(gone)) & (block.lengths > 0)]
    opens[edge] = gone[edge]
    closes[edge[edge > 0] - 1] = gone[edge[edge > 0] - 1]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    cuts = np.searchsorted(a, np.append(block.starts, len(gone)))
    rows = []
    for k, (lo, hi) in enumerate(zip(block.starts, block.ends)):
        text, spans = block.data[lo:hi], range(cuts[k], cuts[k + 1])
        kept = text[~gone[lo:hi]]
        rows.append((int(block.doc_ids[k]), hashlib.sha256(text.tobytes()).hexdigest(), int(hi - lo), int(hi - lo - len(kept)), len(spans), hashlib.sha256(kept.tobytes()).hexdigest(), [{"start": int(a[j] - lo), "end": int(b[j] - lo)} for j in spans]))
    return pd.DataFrame(rows, columns=["first_id", "sha", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def suffix_dedup(docs: DataFrame, *, length: int = 50) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end in bytes).

    Removed is each byte that lies in a `length`-byte string which also starts in a document with a smaller doc_id.

    Equal texts are first brought together: the smallest id stands for them, and the others lose all they have if it
    is `length` bytes or more. The texts then form blocks in the order of their ids. Samples at the places of a
    difference cover are ranked into classes, one bucket of the key space at a time; only suffixes with a sample whose
    class two texts share can repeat. Those suffixes go to suffix buckets by their head's hash, where one task sorts
    one bucket at a time; buckets are so many that one holds what BUCKET_TEXT bytes of text send to it. Both sorts are on
    hashes: 48 bits for samples, where a chance hit only costs time; for windows 64 bits of the whole, 16 of its last bytes and the bucket's own of its first, as only equality to a fixed depth counts, not order.

    A null text counts as empty and has nothing removed; texts are read whole, however long. A null doc_id counts as
    larger than any other (and as equal to 2^63 - 1, which stands for it). Rows with one id, of one text or of several,
    lose nothing to each other. An empty table gives no rows; other columns of docs are ignored. doc_id is an integer.
    """
    if length < 2 * PERIOD:
        raise ValueError(f"length must be {2 * PERIOD} or more")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    distinct = rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    by_id = F.col("doc_id").asc_nulls_last()
    texts = B.build(scratch, "blocks", distinct.repartitionByRange(by_id).sortWithinPartitions(by_id, "text"))
    buckets = B.bucket_count(texts, BUCKET_TEXT)
    ends = texts.select("block", F.explode(F.array(F.element_at("doc_ids", 1), F.element_at("doc_ids", -1))).alias("id")).distinct()
    spanned = bool(ends.groupBy("id").count().where("count > 1").limit(1).count())

    def send_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.rows_of(batches):
            keys, bucket, twice, _, _ = _Suffixes(block, length).samples(buckets)
            yield pa.RecordBatch.from_pandas(B.send(block.number, bucket, keys, SAMPLE_BITS, twice), preserve_index=False)

    def send_windows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({c: [] for c in ("bucket", "block", "keys", "notes", "first", "last", "flags")})
        block = B.first_block(left)
        suffixes = _Suffixes(block, length)
        keys, bucket, tails, alone, *_ = suffixes.windows(_shared_samples(suffixes, right, buckets), buckets)
        sent = B.send(block.number, bucket, keys, WINDOW_BITS, tails)
        if not spanned:
            return sent.assign(first=None, last=None, flags=None)
        flags = B.send(block.number, bucket, keys, WINDOW_BITS, alone)["notes"]
        return sent.assign(first=block.doc_ids[0], last=block.doc_ids[-1], flags=flags)

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _cut(_Suffixes(B.first_block(left), length), right, buckets)

    with scratch.small_batches():
        samples = scratch.put("samples", texts.mapInArrow(send_samples, B.SENT).repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_classes, B.ANSWER))
        sent = texts.groupBy("block").cogroup(samples.groupBy("block")).applyInPandas(send_windows, SENT)
        windows = scratch.put("windows", sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_suffix_bucket, B.ANSWER))
        both = samples.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
        schema = "first_id long, sha string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
        firsts = scratch.put("firsts", texts.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(cut, schema))
    scratch.drop("blocks", "samples", "windows")
    keyed = rows.select("doc_id", F.sha2("text", 256).alias("sha"))
    joined = keyed.join(firsts, "sha")
    own = F.coalesce("doc_id", F.lit(B.LAST_ID)) == F.col("first_id")
    all_gone = ~own & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    pick = lambda first, gone, kept: F.when(own, first).when(all_gone, gone).otherwise(kept)
    return joined.select(
        "doc_id", "n_bytes", pick(F.col("n_removed"), F.col("n_bytes"), F.lit(0).cast("long")).alias("n_removed"), pick(F.col("n_spans"), F.lit(1).cast("long"), F.lit(0).cast("long")).alias("n_spans"),
        pick(F.col("kept_sha256"), F.sha2(F.lit(""), 256), F.col("sha")).alias("kept_sha256"), pick(F.col("spans"), whole, none).alias("spans"),
    )
