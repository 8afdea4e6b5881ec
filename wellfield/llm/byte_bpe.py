"""Byte-level BPE: pre-tokens by a scan of transition functions, then cached pair merging."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .codepoints import LETTER, NUMBER, SEPARATOR, SPACE, classes, code_points
from .common import slices

# What a character is to the scan: letter, number, other, an apostrophe that may open a contraction of two or of three
# characters, white space inside a run (or at a text's end), the last white space before something else (not a blank,
# or a blank), and the place between texts.
L, N, O, A2, A3, W, Z, G, E = range(9)  # noqa: E741
# What has been read: a finished token, letters, numbers, others, a leading blank, a contraction that lacks one or two
# letters, white space.
DONE, IN_L, IN_N, IN_O, BLANK, ONE, TWO, IN_W = range(8)
#: Pieces that a worker remembers; past that it starts anew, which costs time only.
CACHE = 200_000
#: Pieces of more characters are merged anew in each batch, so the cache stays small whatever the texts hold.
LONGEST = 128


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a token begins, by state and symbol."""
    goes, begins = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    for symbol, state in ((L, IN_L), (N, IN_N), (O, IN_O), (A2, ONE), (A3, TWO), (W, IN_W), (Z, DONE), (G, BLANK), (E, DONE)):
        goes[:, symbol] = state
    for symbol, state in ((L, IN_L), (N, IN_N), (O, IN_O)):
        begins[[state, BLANK], symbol] = False
    for symbol in (A2, A3):  # among other symbols, or after a blank, an apostrophe is one of them
        goes[[IN_O, BLANK], symbol], begins[[IN_O, BLANK], symbol] = IN_O, False
    goes[ONE, L], goes[TWO, L] = DONE, ONE
    begins[[ONE, TWO], L] = False
    begins[IN_W, W] = False
    begins[:, E] = False
    return goes.ravel(), begins.ravel()


GOES, BEGINS = _machine()


def _symbols(codes: np.ndarray) -> np.ndarray:
    kinds = classes()[codes]
    out = np.full(len(codes), O, np.uint8)
    out[kinds == LETTER], out[kinds == NUMBER], out[kinds == SEPARATOR] = L, N, E
    after = np.append(codes[1:], 0), np.append(codes[2:], [0, 0])[: len(codes)]
    mark = codes == 0x27
    two = mark & np.isin(after[0], [ord(c) for c in "stmd"])
    three = np.zeros(len(codes), bool)
    for a, b in ("re", "ve", "ll"):
        three |= mark & (after[0] == ord(a)) & (after[1] == ord(b))
    out[two], out[three] = A2, A3
    space = kinds == SPACE
    following = np.append(kinds[1:], SEPARATOR)
    last = space & (following != SPACE) & (following != SEPARATOR)
    out[space] = W
    out[last] = Z
    out[last & (codes == 0x20)] = G
    return out


def token_starts(codes: np.ndarray, width: int = 128) -> np.ndarray:
    """Where pre-tokens begin. Each row of `width` symbols is one function from state to state, composed for all rows
    at once; the rows' functions are composed by doubling; then each row is read once more from its true state."""
    symbols = _symbols(codes)
    rows = -(-len(symbols) // width)
    grid = np.full(rows * width, E, np.uint8)
    grid[: len(symbols)] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    function = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in grid:
        function = GOES[function * np.uint8(9) + column[:, None]]
    step = 1
    while step < rows:
        earlier, later = function[:-step], function[step:]
        function = np.concatenate([function[:step], np.take_along_axis(later, earlier, 1)])
        step *= 2
    state = np.concatenate([[DONE], function[:-1, DONE]]).astype(np.uint8)
    begins = np.empty(grid.shape, bool)
    for k, column in enumerate(grid):
        at = state * np.uint8(9) + column
        begins[k], state = BEGINS[at], GOES[at]
    return np.flatnonzero(begins.T.ravel()[: len(symbols)])


class Merger:
    """Pair merging by rank for one piece of bytes, and the pieces met so far."""

    def __init__(self, ranks_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.fromiter(map(len, self.tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        get = self.ranks.get
        self.pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = get(token[:k]), get(token[k:])
                if a is not None and b is not None:
                    self.pairs[a, b] = rank
        self.decimal = [str(k) for k in range(size)]
        self.cache: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        piece = text.encode()
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        parts = [self.ranks[piece[k : k + 1]] for k in range(len(piece))]
        return tuple(self._short(parts) if len(parts) < 96 else self._long(parts))

    def _short(self, parts: list[int]) -> list[int]:
        get, never = self.pairs.get, len(self.tokens)
        scores = [get(pair, never) for pair in zip(parts, parts[1:])]
        while scores and (least := min(scores)) < never:
            k = scores.index(least)
            parts[k : k + 2] = [least]
            del scores[k]
            if k < len(scores):
                scores[k] = get((least, parts[k + 1]), never)
            if k:
                scores[k - 1] = get((parts[k - 1], least), never)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap, so a very long piece takes n log n steps."""
        get, n = self.pairs.get, len(parts)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = [(r, k, parts[k], parts[k + 1]) for k in range(n - 1) if (r := get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            j = right[k]
            if not alive[k] or parts[k] != a or j < 0 or parts[j] != b:
                continue
            parts[k], alive[j], right[k] = rank, False, right[j]
            if right[j] >= 0:
                left[right[j]] = k
            for x, y in ((left[k], k), (k, right[k])):
                if x >= 0 and y >= 0 and (r := get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p, live in zip(parts, alive) if live]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined, codes, ends = code_points(texts)
        starts = token_starts(codes)
        last = np.append(starts[1:], len(codes))
        last = np.minimum(last, ends[np.searchsorted(ends, starts)]).tolist()
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), last)]
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        new = set(pieces).difference(cache)
        for piece in new:
            cache[piece] = self.piece(piece)
        cuts = np.searchsorted(starts, ends).tolist()
        out, a = [], 0
        for b in cuts:
            out.append(np.fromiter(chain.from_iterable(map(cache.__getitem__, pieces[a:b])), np.int32))
            a = b
        for piece in new:
            if len(piece) > LONGEST:
                del cache[piece]
        return out


@lru_cache(4)
def merger(ranks_file: bytes) -> Merger:
    return Merger(ranks_file)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else [], kind))


def _encoded(bpe: Merger, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
    for part in slices(batches, "text", 1 << 19):
        ids = bpe.encode(part.column("text").fill_null("").to_pylist())
        yield part, ids, [np.cumsum(bpe.lengths[x]) for x in ids]


def _decoded(bpe: Merger, ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes that the ids stand for: token k fills those up to ends[k]."""
    lengths = bpe.lengths[ids]
    shift = np.repeat(bpe.starts[ids] - (ends - lengths), lengths)
    return bpe.bytes[shift + np.arange(len(shift))].tobytes()


def _send(df: DataFrame, path: str):
    """The rank file, read once by the driver and sent with the tasks (under 1 MB here)."""
    return df.sparkSession.sparkContext.broadcast(open(path, "rb").read())


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, ends: the token ids of the whole text, and where in its UTF-8 bytes each token ends.

    `path` names a rank file (base64 token, rank). A null text counts as empty: no ids. Long texts are encoded whole.
    Repeated rows and null ids are encoded like any other; an empty table gives no rows; other columns are ignored.
    """
    sent = _send(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, ends in _encoded(merger(sent.value), batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids, pa.int32()), _lists([x.astype(np.int32) for x in ends], pa.int32())], ["doc_id", "ids", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_kind(docs)}, ids array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded: the bytes that the ids of encode() stand for."""
    sent = _send(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merger(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = zip(part.column("ids"), part.column("ends"), strict=True)
                out = [_decoded(bpe, x.values.to_numpy(), y.values.to_numpy()) for x, y in pairs]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return tokens.select("doc_id", "ids", "ends").mapInArrow(run, f"doc_id {_kind(tokens)}, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded as by encode() and its ids decoded as by decode()
    in one pass, so that no ids leave the task; the digests are of the decimal ids joined by commas and of the bytes."""
    sent = _send(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merger(sent.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for part, ids, ends in _encoded(bpe, batches):
            texts = [",".join(map(bpe.decimal.__getitem__, x.tolist())).encode() for x in ids]
            columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array(map(sha, texts), pa.string()), pa.array([sha(_decoded(bpe, x, y)) for x, y in zip(ids, ends)], pa.string())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_kind(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
