"""Language ID by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codepoints import LETTER, classes, code_points
from .common import slices

DIMENSIONS = 1024
#: Letters share this many vectors: a to z have their own, other letters are dealt over the rest by code point.
SYMBOLS = 64
#: Distinct languages that a profile table may hold; more is an error, never a cut.
MOST_LANGUAGES = 2000
UNKNOWN = "und"


def _vectors(seed: int = 11) -> np.ndarray:
    """A random vector of -1 and 1 for each symbol; symbol 0 stands between words."""
    return np.random.default_rng(seed).integers(0, 2, (SYMBOLS, DIMENSIONS), np.int8) * 2 - 1


def bind(codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors of letter triples: each letter's vector, permuted by its place, multiplied together."""
    a, b, c = codes // (SYMBOLS * SYMBOLS), codes // SYMBOLS % SYMBOLS, codes % SYMBOLS
    return vectors[a] * np.roll(vectors, 1, axis=1)[b] * np.roll(vectors, 2, axis=1)[c]


def triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letter triples of all texts, the text of each, and whether a text has a letter. Case is folded; whatever is
    not a letter stands between words, and a run of it counts once."""
    _, codes, ends = code_points([t.lower() for t in texts])
    letter = classes()[codes] == LETTER
    small = (codes >= 97) & (codes <= 122)
    symbol = np.where(letter, np.where(small, codes - 96, 27 + codes * 2654435761 % (1 << 32) % (SYMBOLS - 27)), 0)
    text = np.searchsorted(ends, np.arange(len(codes)))
    keep = letter | np.append(True, letter[:-1])
    keep[np.append(0, ends[:-1] + 1)] = True
    has = np.zeros(len(texts), bool)
    has[text[letter]] = True
    symbol, text = symbol[keep], text[keep]
    if len(symbol) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    same = text[:-2] == text[2:]
    code = (symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]
    return code[same], text[:-2][same], has


def bundles(code: np.ndarray, group: np.ndarray, groups: int, vectors: np.ndarray, step: int = 2048) -> np.ndarray:
    """The sum of the triples' vectors for each group; whole numbers, so float32 sums are exact for up to 16 million triples."""
    seen = np.zeros(SYMBOLS**3, bool)
    seen[code] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(SYMBOLS**3, np.int64)
    place[distinct] = np.arange(len(distinct))
    at = place[code]
    order = np.argsort(at // step, kind="stable") if len(distinct) > step else np.arange(len(at))
    at, group = at[order], group[order]
    out = np.zeros((groups, DIMENSIONS), np.float64)
    for lo in range(0, len(distinct), step):
        a, b = np.searchsorted(at // step, [lo // step, lo // step + 1])
        width = min(step, len(distinct) - lo)
        counts = np.bincount(group[a:b] * width + at[a:b] - lo, minlength=groups * width).reshape(groups, width).astype(np.float32)
        out += counts @ bind(distinct[lo : lo + width], vectors).astype(np.float32)
    return out


def profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """A language's prototype is the bundle of all its documents with a lang. Tasks send one sum per language and
    dimension; the driver receives one vector per language."""
    vectors = _vectors()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            names, index = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            code, text, _ = triples(part.column("text").fill_null("").to_pylist())
            for name, row in zip(names, bundles(code, index[text], len(names), vectors)):
                sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(row.astype(np.int64))], ["lang", "k", "v"])

    rows = docs.where("lang is not null").select("lang", "text").mapInArrow(run, "lang string, k int, v long")
    rows = rows.groupBy("lang", "k").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("kv"))
    found = rows.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r["lang"]: np.array([x["v"] for x in r["kv"]], np.float64) for r in sorted(found, key=lambda r: r["lang"])}


def identify(docs: DataFrame, known: dict[str, np.ndarray], *, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with a predicted language and a score added, under `names` (columns so named are replaced); each task compares a document's bundle with the prototypes by cosine.

    Prototypes are scaled to length one and their mean is taken off, as it tells no language from another. The score
    is (1 + cosine) / 2. A text that is null or has no letter is `und` with score 0, as is all text where no language
    was learned. Ties go to the first language by name. Texts are read whole; all columns and rows of docs stay."""
    vectors, languages = _vectors(), list(known)
    table = np.array([known[n] / max(1.0, np.linalg.norm(known[n])) for n in languages]) if languages else np.zeros((0, DIMENSIONS))
    if len(languages) > 1:
        table = table - table.mean(axis=0)
    table = table / np.maximum(1e-12, np.linalg.norm(table, axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            code, text, has = triples(part.column("text").fill_null("").to_pylist())
            pred, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
            if languages and has.any():
                bundle = bundles(code, text, part.num_rows, vectors)
                cosine = np.round(bundle @ table.T / np.maximum(1e-12, np.linalg.norm(bundle, axis=1, keepdims=True)), 9)
                best = cosine.argmax(axis=1)
                pred = np.where(has, np.array(languages, object)[best], UNKNOWN)
                score = np.where(has, np.clip((1 + cosine.max(axis=1)) / 2, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred.tolist(), pa.string()), pa.array(score)], [*part.schema.names, *names])

    clean = docs.drop(*names)
    return clean.mapInArrow(run, T.StructType([*clean.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Every third document by the CRC of its id's text; a null id is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the documents that are not held out, predicted for all.

    Null or empty texts and those without a letter are `und` with score 0. Repeated rows are learned from as often as
    they come, and each is predicted. Ties go to the first language by name. Long texts are read whole. An empty table
    gives no rows; other columns of docs are ignored."""
    known = profiles(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), known)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
