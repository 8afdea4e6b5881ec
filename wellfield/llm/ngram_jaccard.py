"""Near-duplicate documents: an exact Jaccard join on word n-grams, with filters under several global token orders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import Scratch, mix64

#: Bits of a shingle hash that its frequency is counted by.
TOKEN_BITS = 48
ORDERS = np.array([0x51ED270B, 0x2545F491, 0x9E3779B1], np.uint64)
#: All orders but the first take a frequency class for up to so many classes higher, each by a hash of its own.
SHIFTS = 4
#: Classes of tokens whose counts bound the overlap of two sets from above.
CLASSES = 256
SETS = "doc_id long, n long, digest binary, tokens binary, codes binary, marks binary"
POSTINGS = "bucket int, tokens binary, rows binary, nodes binary, sizes binary, comps binary, counts binary"


def shingles(block: B.Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text: text numbers, rising, and hashes, rising within a text.

    A text of fewer words than `words` has its whole sequence as its only shingle; without words it has none."""
    data = B.LOWER[block.data]
    starts, ends = B.words(data, block.starts)
    hashes = B.run_hashes(data, starts, ends)
    text = np.searchsorted(block.ends, starts, "right")
    factors = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes) - words + 1
    docs, keys = [], []
    if n > 0:
        whole = text[:n] == text[words - 1 :]
        total = np.zeros(n, np.uint64)
        for j in range(words):
            total += hashes[j : j + n] * factors[j]
        docs, keys = [text[:n][whole]], [mix64(total[whole])]
    first, count = np.unique(text, return_index=True, return_counts=True)[1:]
    for a, c in zip(first[count < words], count[count < words]):
        total = (hashes[a : a + c] * factors[:c]).sum(dtype=np.uint64, keepdims=True)
        docs.append(text[a : a + 1])
        keys.append(mix64(total + np.uint64(int(c) * 0x632BE59BD9B4E019 % (1 << 64))))
    docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])) if len(keys) else np.zeros(0, bool)
    return docs[new], keys[new]


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n must share with any set it links with."""
    return -(-n * percent // 100)


def _frequencies(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket of shingles: floor(log2(documents that hold it)), 0 for a single one."""
    keys, sizes = B.received(frame, TOKEN_BITS)
    counts = np.frombuffer(b"".join(map(B.unpack, frame["notes"])), np.uint32)
    order, first, group = B.groups(keys)
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    return B.answer(frame, np.minimum(255, np.floor(np.log2(total))).astype(np.uint8)[group], order, sizes)


def _sets(block: B.Block, frame: pd.DataFrame, words: int, percent: int, buckets: int) -> pd.DataFrame:
    """Each document's set size; the sets, without what no other document has, of those that may link at all."""
    docs, keys = shingles(block, words)
    order, first, group = B.groups(keys)
    codes = np.zeros(len(keys), np.uint8)
    if len(keys):
        codes[order] = B.answers(frame, B.bucket_of(keys[order[first]], buckets))[group]
    n = np.bincount(docs, minlength=len(block.ends))
    common = np.bincount(docs[codes > 0], minlength=len(block.ends))
    edges = np.append(0, np.cumsum(n))
    rows = []
    for k, size in enumerate(n):
        row = (int(block.doc_ids[k]), int(size), None, None, None, None)
        if size and common[k] >= least_overlap(size, percent):
            own, code = keys[edges[k] : edges[k + 1]], codes[edges[k] : edges[k + 1]]
            tokens, code = own[code > 0], code[code > 0]
            row = (*row[:2], hashlib.blake2b(own.tobytes(), digest_size=16).digest(), tokens.tobytes(), code.tobytes(), marks(tokens, code, size, percent).tobytes())
        rows.append(row)
    return pd.DataFrame(rows, columns=["doc_id", "n", "digest", "tokens", "codes", "marks"])


def prefix(tokens: np.ndarray, codes: np.ndarray, n: int, order: int, percent: int) -> np.ndarray:
    """The places of the tokens that decide under one order, the first of the whole set in it. Of two sets that link,
    each has a prefix token of the other. Tokens that no other set has come first in every order and can't match.

    The first order is rarest first. The others raise the frequency class of a token by 0 to SHIFTS - 1, each by its own
    hash, so other tokens lead, yet no frequent one comes before much rarer ones. Equal places go by hash, too."""
    hashes = mix64(tokens ^ ORDERS[order])
    shift = (hashes >> np.uint64(32)) % np.uint64(SHIFTS) if order else np.zeros(len(tokens), np.uint64)
    ranked = np.lexsort((hashes, codes + shift.astype(np.uint8)))
    return ranked[: max(0, n - int(least_overlap(np.int64(n), percent)) + 1 - (n - len(tokens)))]


def marks(tokens: np.ndarray, codes: np.ndarray, n: int, percent: int) -> np.ndarray:
    """For each token a byte with a bit for each order under which it is a prefix token."""
    out = np.zeros(len(tokens), np.uint8)
    for o in range(len(ORDERS)):
        out[prefix(tokens, codes, int(n), o, percent)] |= np.uint8(1 << o)
    return out


def _typical(tokens: np.ndarray, codes: np.ndarray, draw: int) -> np.ndarray:
    """Of prefix tokens one of the most frequent, drawn by its hash: sets that are much alike often pick the same."""
    if not len(tokens):
        return tokens
    common = tokens[codes >= codes.max() - min(1, int(codes.max()))]
    return common[[np.argmin(mix64(common ^ mix64(np.array([draw + 1], np.uint64))))]]


def class_counts(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall in each class; two sets share at most the sum of the lesser counts. A count of 255 may stand
    for more and bounds nothing; all are 255 for sets so large that a count might not fit."""
    if len(tokens) > 20 * CLASSES:
        return np.full(CLASSES, 255, np.uint8)
    return np.minimum(255, np.bincount((mix64(tokens) % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)).astype(np.uint8)


def _slices(all_tokens: np.ndarray, codes: np.ndarray, tokens: np.ndarray, most: int) -> np.ndarray:
    """Into how many slices of about `most` documents each token's group goes, by its frequency; `all_tokens` rise."""
    return np.int64(1) << np.maximum(0, codes[np.searchsorted(all_tokens, tokens)].astype(np.int64) + 2 - most.bit_length())


def _postings(classes: DataFrame, turn: int | None, counted: bool, buckets: int, most: int) -> DataFrame:
    """Tokens by bucket, a bucket apart for each order: the prefixes, or one token of each prefix, drawn anew
    each turn. What belongs to a document goes once to each of its buckets. Typical tokens that more than `most`
    documents may hold stand for a slice of these, drawn anew each turn; such tokens of prefixes are left to _hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            node, size, comp = (c[k].to_numpy() for k in ("node", "n", "comp"))
            lists = _lists(c)
            counts = np.stack([class_counts(t) for t, _, _ in lists]) if counted else np.zeros((len(lists), 0), np.uint8)
            for o in range(len(ORDERS)):
                picked = [t[m & (1 << o) > 0] for t, _, m in lists]
                if turn is not None:
                    picked = [_typical(p, s[m & (1 << o) > 0], o + turn * len(ORDERS)) for p, (_, s, m) in zip(picked, lists)]
                row = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
                tokens = np.concatenate(picked)
                many = np.concatenate([_slices(t, s, p, most) for (t, s, _), p in zip(lists, picked)])
                if turn is None:
                    row, tokens = row[many == 1], tokens[many == 1]
                else:
                    own = mix64(node[row].astype(np.uint64) ^ mix64(np.array([turn + 1], np.uint64))) % many.astype(np.uint64)
                    tokens = np.where(many > 1, mix64(tokens ^ mix64(own + np.uint64(1))), tokens)
                if not len(tokens):
                    continue
                bucket = B.bucket_of(tokens, buckets) + o * buckets
                by = np.argsort(bucket, kind="stable")
                bucket, tokens, row = bucket[by], tokens[by], row[by]
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                out = []
                for a, b in zip(edge, np.append(edge[1:], len(bucket))):
                    rows, place = np.unique(row[a:b], return_inverse=True)
                    out.append((int(bucket[a]), tokens[a:b].tobytes(), place.astype(np.int32).tobytes(), node[rows].tobytes(), size[rows].tobytes(), comp[rows].tobytes(), counts[rows].tobytes()))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["bucket", "tokens", "rows", "nodes", "sizes", "comps", "counts"]).astype({"bucket": np.int32}), preserve_index=False)

    return classes.select("node", "n", "tokens", "codes", "marks", "comp").mapInArrow(run, POSTINGS)


def _lists(columns) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens, codes and marks of each set."""
    kinds = (("tokens", np.uint64), ("codes", np.uint8), ("marks", np.uint8))
    return list(zip(*([np.frombuffer(x.as_py(), kind) for x in columns[name]] for name, kind in kinds), strict=True))


def _hot(classes: DataFrame, counted: bool, most: int) -> DataFrame:
    """The prefix tokens that more than `most` documents may hold: a row for each of their documents with its class
    counts, or the number of documents by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, comp = (batch.column(k).to_numpy() for k in ("node", "n", "comp"))
            out = []
            for k, (t, s, m) in enumerate(_lists({name: batch.column(name) for name in ("tokens", "codes", "marks")})):
                if not (_slices(t, s, t, most) > 1).any():
                    continue
                counts = class_counts(t).tobytes() if counted else b""
                for o in range(len(ORDERS)):
                    tokens = t[m & (1 << o) > 0]
                    for token in tokens[_slices(t, s, tokens, most) > 1].view(np.int64):
                        out.append((o, int(token), int(node[k]), int(size[k]), int(comp[k]), counts))
            frame = pd.DataFrame(out, columns=["o", "token", "node", "n", "comp", "counts"]).astype({"o": np.int32, "token": np.int64, "comp": np.int64})
            if not counted:
                frame = frame.groupby(["o", "token", "comp"]).size().reset_index(name="held").astype({"held": np.int64})
            if len(frame):
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    kinds = "o int, token long, node long, n long, comp long, counts binary" if counted else "o int, token long, comp long, held long"
    return classes.select("node", "n", "tokens", "codes", "marks", "comp").mapInArrow(run, kinds)


def _mixed_hot(classes: DataFrame, most: int) -> DataFrame:
    """The hot tokens of more than one component: the largest of these, and how many slices it and the others make."""
    held = _hot(classes, False, most).groupBy("o", "token", "comp").agg(F.sum("held").alias("held"))
    held = held.groupBy("o", "token").agg(F.max_by("comp", "held").alias("largest"), F.max("held").alias("top"), F.sum("held").alias("total"))
    slices = lambda c: F.ceil(c * 2 / most).cast("int")
    return held.where("total > top").select("o", "token", "largest", slices(F.col("top")).alias("tops"), slices(F.col("total") - F.col("top")).alias("rests"))


def _sliced(classes: DataFrame, mixed: DataFrame, buckets: int, most: int, salts: int = 64) -> DataFrame:
    """Rows by bucket, in which every two documents of a hot token, but two of its largest component, meet in some part:
    each slice of the largest with each of the others, and each two of the others. A part is a pair of slices."""
    salt = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")
    spread = mixed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = _hot(classes, True, most).withColumn("salt", salt).join(spread, ["o", "token", "salt"])
    top = F.col("comp") == F.col("largest")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.when(top, F.col("tops")).otherwise(F.col("rests"))).cast("int"))
    part = lambda kind, i, j: F.xxhash64("o", "token", F.lit(kind), i.cast("int"), j.cast("int"))
    others = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.col("own")
    with_top = F.transform(others("tops"), lambda i: part(0, i, own))
    with_rest = F.transform(others("rests"), lambda j: part(1, F.least(own, j), F.greatest(own, j)))
    parts = F.when(top, F.transform(others("rests"), lambda j: part(0, own, j))).otherwise(F.concat(with_top, with_rest))
    rows = rows.withColumn("part", F.explode(parts))
    return rows.select((F.pmod(F.xxhash64("part"), F.lit(buckets)) + F.col("o") * buckets).cast("int").alias("bucket"), "part", "node", "n", "comp", "counts")


def _bucket(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """One bucket: tokens, the document of each, and the documents' nodes, sizes, components and class counts. Of sliced
    rows a part counts as the token."""
    if "part" in frame:
        counts = np.frombuffer(b"".join(frame["counts"]), np.uint8).reshape(len(frame), -1)
        return frame["part"].to_numpy().view(np.uint64), np.arange(len(frame)), *(frame[k].to_numpy() for k in ("node", "n", "comp")), counts
    token, node, size, comp = (np.frombuffer(b"".join(frame[k]), t) for k, t in (("tokens", np.uint64), ("nodes", np.int64), ("sizes", np.int64), ("comps", np.int64)))
    many = [len(x) // 8 for x in frame["nodes"]]
    row = np.concatenate([np.frombuffer(x, np.int32) + start for x, start in zip(frame["rows"], np.cumsum([0, *many[:-1]]))])
    counts = np.frombuffer(b"".join(frame["counts"]), np.uint8)
    return token, row, node, size, comp, counts.reshape(len(node), -1)


def _mixed(token: np.ndarray, row: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents sorted by token, and the starts and sizes of those groups that hold two components or more."""
    order = np.argsort(token)
    row, ranked = row[order], token[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    size, c = np.diff(np.append(first, len(token))), comp[row]
    mixed = np.minimum.reduceat(c, first) != np.maximum.reduceat(c, first)
    return row, first[mixed], size[mixed]


def _may_link(i: np.ndarray | int, j: np.ndarray, size: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The most that sets can share by their class counts, and whether that and their sizes allow a link."""
    n, m = size[i], size[j]
    least = np.minimum(counts[j], counts[i])
    shared = np.where((least == 255).any(axis=-1), np.minimum(n, m), least.sum(axis=-1, dtype=np.int64))
    return shared, (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (shared * (100 + percent) >= percent * (n + m))


def _star_pairs(percent: int, turn: int, hubs: int = 64):
    """In each group of unlike components every document with those of a few drawn hubs that it may share most with."""
    most = 1 if turn == 0 else 3

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        token, row, node, size, comp, counts = _bucket(frame)
        row, starts, sizes = _mixed(token, row, comp)
        found = [np.zeros((0, 2), np.int64)]
        for a, c in zip(starts, sizes):
            group = row[a : a + c]
            drawn = group[np.argsort(mix64(node[group].astype(np.uint64) * np.uint64(2 * turn + 1)))[:hubs]]
            for lo in range(0, c, 1024):
                i = group[lo : lo + 1024]
                shared = np.zeros((len(i), len(drawn)), np.int64)
                for k, hub in enumerate(drawn):
                    bound, may = _may_link(hub, i, size, counts, percent)
                    shared[:, k] = np.where(may & (comp[i] != comp[hub]), bound * 1000 // size[hub], 0)
                best = np.argsort(-shared, axis=1)[:, :most]
                x, k = np.repeat(np.arange(len(i)), best.shape[1]), best.ravel()
                ok = shared[x, k] > 0
                found.append(np.stack([node[i[x[ok]]], node[drawn[k[ok]]]], 1))
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pd.DataFrame({"x": pairs[:, 0], "y": pairs[:, 1]})

    return run


def _open_nodes(frame: pd.DataFrame) -> pd.DataFrame:
    """The documents that share a prefix token with another component."""
    token, row, node, _, comp, _ = _bucket(frame)
    row, starts, sizes = _mixed(token, row, comp)
    hit = np.zeros(len(node), bool)
    for a, c in zip(starts, sizes):
        hit[row[a : a + c]] = True
    return pd.DataFrame({"node": np.unique(node[hit])})


def _candidates(percent: int, buckets: int):
    """All pairs of a group that lie in different components, are of like size, and may overlap enough by their class
    counts. The group's largest component is not paired with itself, so the work is that of the smaller ones."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        token, row, node, size, comp, counts = _bucket(frame)
        row, starts, sizes = _mixed(token, row, comp)
        done: dict[int, set[int]] = {}
        for a, c in zip(starts, sizes):
            group = np.unique(row[a : a + c])
            names, which = np.unique(comp[group], return_inverse=True)
            largest = which == np.bincount(which).argmax()
            small = group[~largest]
            for k, i in enumerate(small):
                other = np.concatenate([group[largest], small[k + 1 :]])
                other = other[(comp[other] != comp[i]) & (100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i]))]
                if len(other):
                    other = other[_may_link(i, other, size, counts, percent)[1]]
                    done.setdefault(int(i), set()).update(other.tolist())
        flat = [(i, j) for i, js in done.items() for j in js]
        pairs = node[np.array(flat, np.int64).reshape(-1, 2)]
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pd.DataFrame({"x": pairs[:, 0], "y": pairs[:, 1], "o": np.full(len(pairs), int(frame["bucket"].iloc[0]) // buckets, np.int32)})

    return run


def _links(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that share a prefix token under every order, and whether they are links: only these are verified, on
    the whole sets, by 100 * intersection >= percent * union."""
    names = [("node", "x", "y"), ("n", "n", "m"), ("tokens", "s", "t"), ("marks", "p", "q")]
    every = (1 << len(ORDERS)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m = (batch.column(k).to_numpy() for k in ("x", "y", "n", "m"))
            sets = ([np.frombuffer(v.as_py(), kind) for v in batch.column(k)] for k, kind in (("s", np.uint64), ("t", np.uint64), ("p", np.uint8), ("q", np.uint8)))
            passed, links = np.zeros(len(x), bool), np.zeros(len(x), bool)
            for k, (s, t, p, q) in enumerate(zip(*sets, strict=True)):
                s0, t0 = p > 0, q > 0
                _, i, j = np.intersect1d(s[s0], t[t0], assume_unique=True, return_indices=True)
                passed[k] = len(i) and np.bitwise_or.reduce(p[s0][i] & q[t0][j]) == every
                if passed[k]:
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    links[k] = 100 * both >= percent * (n[k] + m[k] - both)
            yield pa.RecordBatch.from_arrays([pa.array(x[passed]), pa.array(y[passed]), pa.array(links[passed])], ["x", "y", "link"])

    left = classes.select(*(F.col(a).alias(b) for a, b, _ in names))
    right = classes.select(*(F.col(a).alias(c) for a, _, c in names))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "n", "m", "s", "t", "p", "q").mapInArrow(run, "x long, y long, link boolean")


def components(scratch: Scratch, name: str, edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges: the smallest node that it reaches. Each round takes the least label of
    a node's neighbours and then that label's own label; each round is a table, so lineage stays short."""
    both = scratch.put(f"{name}-edges", edges.select("x", "y").union(edges.select("y", "x")).toDF("x", "y").distinct())
    labels = scratch.put(f"{name}-0", both.select(F.col("x").alias("node"), F.col("x").alias("comp")).distinct())
    turn = 0
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("comp").alias("m"))
        new = labels.join(near, labels["node"] == near["x"]).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("comp").alias("j"))
        turn += 1
        labels = scratch.put(f"{name}-{turn}", new.join(jump, "c").select("node", "old", F.least("c", "j").alias("comp")))
        if labels.where("comp <> old").limit(1).count() == 0:
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 75, stars: int = 8, most: int = 1 << 10, report: dict | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    Documents link when the Jaccard similarity of their sets of `words`-word shingles is `percent` % or more; a
    shorter text has one shingle, a text without words none, and links with nothing.

    1. Every shingle's document frequency is counted over all documents, as a power of two. A document with too few
       shingles that another one has links with nothing and leaves here.
    2. Equal sets become one class; only classes are joined. Each has a prefix under each of three global orders.
    3. Classes that share a prefix token form a group. In up to `stars` rounds the groups of one token drawn from each
       prefix compare every class with the likeliest of a few drawn hubs, until a round finds links for less than
       one class in 500. Large groups of like texts become one component so, by a number of pairs in proportion to their size.
    4. In all groups of all prefix tokens, classes are candidates if they are not in one component already, are
       of like size, and their token counts in 256 classes allow enough overlap. Pairs must be candidates under every order.

    In 3 and 4 only pairs that share a prefix token under every order are verified, on the whole sets. As two
    sets that link share such a token under any order, no link between components is missed by 4; links inside one
    change nothing. `report` receives the pairs before and after the orders are intersected, and the links, of each step.

    A token that more than `most` documents (a power of two) may hold is hot: in step 3 its documents meet by slices drawn
    anew each round, in step 4 by pairs of slices, so that no task holds the whole group.

    Only step 4 can grow faster than the input: by the pairs of a group that are nearly alike, yet in different
    components after step 3.

    A null text has no words. Null ids count as larger than any other; rows with one id are documents of their own
    that show the same id. Ties in an order are broken by hashes that are the same for every document. Texts are read
    whole; a very long one is a block of its own. An empty table gives no rows; other columns are ignored. doc_id is
    an integer.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.rows_of(batches):
            _, keys = shingles(block, words)
            order, first, _ = B.groups(keys)
            counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
            keys = keys[order[first]]
            yield pa.RecordBatch.from_pandas(B.send(block.number, B.bucket_of(keys, buckets), keys, TOKEN_BITS, counts), preserve_index=False)

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _sets(B.first_block(left), right, words, percent, buckets)

    texts = B.build(scratch, "blocks", docs)
    buckets = B.bucket_count(texts)
    with scratch.small_batches():
        counted = scratch.put("counted", texts.mapInArrow(send, B.SENT).repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_frequencies, B.ANSWER))
        sets = scratch.put("sets", texts.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(cut, SETS))
    scratch.drop("blocks", "counted")
    able = sets.where("digest is not null")
    classes = able.groupBy("digest").agg(F.min("doc_id").alias("first_id"), *(F.first(c).alias(c) for c in ("n", "tokens", "codes", "marks")))
    classes = scratch.put("classes", classes.withColumn("node", F.monotonically_increasing_id()))
    comps, many = classes.select("node", F.col("node").alias("comp")), classes.count()
    placed = lambda: classes.join(comps, "node")
    pairs_of = lambda p, f, schema: p.groupBy("bucket").applyInPandas(f, schema)

    def linked(name: str, pairs: DataFrame) -> tuple[DataFrame, bool]:
        """Components after the pairs that prove to be links, whose ends count as their components so far; and whether
        there were many of them."""
        pairs = scratch.put(f"pairs-{name}", pairs)
        tried = scratch.put(f"tried-{name}", _links(classes, pairs, percent))
        new = tried.where("link")
        count = new.count()
        if report is not None:
            report[name] = {"pairs": pairs.count(), "under_all_orders": tried.count(), "links": count}
        if not count:
            return comps, False
        ends = new.join(comps.toDF("x", "cx"), "x").join(comps.toDF("y", "cy"), "y").where("cx <> cy")
        found = components(scratch, f"comps-{name}", ends.select(F.col("cx").alias("x"), F.col("cy").alias("y"))).toDF("comp", "least")
        merged = comps.join(found, "comp", "left").select("node", F.coalesce("least", "comp").alias("comp"))
        return scratch.put(f"placed-{name}", merged), count * 500 >= many

    with scratch.small_batches(512):
        for turn in range(stars):
            star = pairs_of(_postings(placed(), turn, True, buckets, most), _star_pairs(percent, turn), "x long, y long")
            comps, more = linked(f"star{turn}", star.distinct())
            if not more:
                break
        opened = scratch.put("open", pairs_of(_postings(placed(), None, False, buckets, most), _open_nodes, "node long").distinct())
        found = pairs_of(_postings(placed().join(opened, "node", "left_semi"), None, True, buckets, most), _candidates(percent, buckets), "x long, y long, o int")
        mixed = scratch.put("mixed", _mixed_hot(placed(), most))
        if mixed.limit(1).count():
            found = found.union(pairs_of(_sliced(placed(), mixed, buckets, most), _candidates(percent, buckets), "x long, y long, o int"))
        found = scratch.put("found", found.groupBy("x", "y").agg(F.bit_or(F.expr("1 << o")).alias("orders")))
        if report is not None:
            report["all"] = {"orders": {int(r["orders"]): r["count"] for r in found.groupBy("orders").count().collect()}}
        under_all = found.where(F.col("orders") == 2 ** len(ORDERS) - 1)
        before = (report or {}).get("all", {})
        comps, _ = linked("all", under_all.select("x", "y"))
        if report is not None:
            report["all"] |= before
    named = classes.select("node", "digest", "first_id").join(comps, "node")
    least = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "comp").select("digest", "component_id")
    alone = sets.where("digest is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = able.select("doc_id", "n", "digest").join(named, "digest").select("doc_id", "n", "component_id").union(alone)
    shown = lambda c: F.when(F.col(c) != B.LAST_ID, F.col(c))
    return out.select(shown("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), shown("component_id").alias("component_id"))
