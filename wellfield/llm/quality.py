"""Quality rules: counts over words and lines, and a linear-chain CRF that tells content lines from boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import mix64, slices, utf8

FEATURES = ("bias", "log_words", "symbols", "upper", "exclamations", "digits", "repeated", "sentence_end", "word_length")
#: Labelled documents that the CRF is fitted on at most: those with the smallest hash of their id.
MOST_LABELLED = 600
#: Of a labelled document at most so many consecutive lines, from a place drawn by its id, reach the driver.
MOST_LINES = 256
#: Long training sequences are fitted in stretches of so many lines.
STRETCH = 64


def _table(characters: str | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) if isinstance(c, str) else c for c in characters]] = True
    return out


SYMBOLS, UPPER, LETTERS, DIGITS, STOPS = _table("#*$%&|<>"), _table(range(65, 91)), _table([*range(65, 91), *range(97, 123)]), _table(range(48, 58)), _table(".!?\"')")
#: Bytes that continue a UTF-8 character.
CONTINUED = _table(range(0x80, 0xC0))


@dataclass
class Measured:
    """Counts per text, and the lines with a word: their text, length in characters, and features."""

    counts: dict[str, np.ndarray]
    line_text: np.ndarray
    line_size: np.ndarray
    features: np.ndarray


def _sums(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of each part's bytes are marked; parts a to b rise and do not overlap."""
    if not len(a):
        return np.zeros(0, np.int64)
    found = np.add.reduceat(np.append(mask, False), np.stack([a, b], 1).ravel(), dtype=np.int64)[::2]
    return np.where(a < b, found, 0)


def _in_repeated_triples(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words lie in a three-word window that their text has twice or more."""
    repeat = np.zeros(len(hashes), bool)
    if len(hashes) < 3:
        return repeat
    a, b, c = (mix64(np.array([k], np.uint64)) | np.uint64(1) for k in (3, 5, 7))
    key = hashes[:-2] * a
    key += hashes[1:-1] * b
    key += hashes[2:] * c
    key += mix64(text[:-2].astype(np.uint64)) if text[-1] else np.uint64(0)
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    place = order[np.append(same, False) | np.append(False, same)]
    for k in range(3):
        repeat[place[text[place] == text[place + 2]] + k] = True
    return repeat


def measure(data: np.ndarray, offsets: np.ndarray) -> Measured:
    """Counts per text and features per line. Hashes go in stretches, so memory is some 20 bytes for each byte of text, and
    120 for each word and 200 for each line where these are shorter than usual."""
    starts, ends, n = offsets[:-1], offsets[1:], len(offsets) - 1
    word_a, word_b = B.words(data, starts) if len(data) else (np.zeros(0, np.int64),) * 2
    hashes = B.run_hashes(data, word_a, word_b)
    text = np.searchsorted(ends, word_a, "right").astype(np.int32)
    del word_b
    repeats = np.bincount(text[_in_repeated_triples(hashes, text)], minlength=n)
    del hashes
    newline = np.flatnonzero(data == 10)
    line_a = np.sort(np.concatenate([starts, newline + 1]))
    line_b = np.sort(np.concatenate([newline, ends]))
    words_in = np.searchsorted(word_a, line_b) - np.searchsorted(word_a, line_a)
    line_a, line_b, words_in = line_a[words_in > 0], line_b[words_in > 0], words_in[words_in > 0]
    line_text = np.searchsorted(ends, line_a, "right")
    line_key = mix64(B.run_hashes(data, line_a, line_b) + mix64(line_text.astype(np.uint64)))
    order, first, _ = B.groups(line_key)
    again = np.ones(len(line_key), bool)
    if len(first):
        again[np.minimum.reduceat(order, first)] = False
    of_lines = lambda table: _sums(table[data], line_a, line_b)
    counts = {
        "n_words": np.bincount(text, minlength=n), "word_chars": _sums(~(CONTINUED | B.SPACES)[data], starts, ends), "n_symbols": _sums(SYMBOLS[data], starts, ends),
        "n_dup_lines": np.bincount(line_text[again], minlength=n), "n_repeat_words": repeats,
    }
    line_size, letters = of_lines(~CONTINUED), of_lines(LETTERS)
    columns = [
        np.ones(len(line_a)), np.log1p(words_in) / 4, of_lines(SYMBOLS) / words_in, of_lines(UPPER) / np.maximum(1, letters), of_lines(_table("!")) / words_in,
        of_lines(DIGITS) / np.maximum(1, line_size), again.astype(float), STOPS[data[line_b - 1]].astype(float) if len(line_b) else np.zeros(0), line_size / words_in / 10,
    ]
    return Measured(counts, line_text, line_size, np.minimum(np.stack(columns, 1), 4.0))


@dataclass
class Crf:
    """Two labels, boilerplate 0 and content 1: a content score per feature and a score per pair of labels in a row;
    `least` is the share of content from which a document is kept."""

    weights: np.ndarray
    pairs: np.ndarray
    least: float = 0.5

    def decode(self, scores: list[float]) -> list[bool]:
        """Viterbi: the best labels of a sequence of lines, given their content scores; ties go to content."""
        (t00, t01), (t10, t11) = self.pairs.tolist()
        if not scores:
            return []
        v0, v1, back = 0.0, scores[0], []
        for s in scores[1:]:
            a, b, c, d = v0 + t00, v1 + t10, v0 + t01, v1 + t11
            back.append((b >= a, d >= c))
            v0, v1 = max(a, b), max(c, d) + s
        label = v1 >= v0
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def fit_crf(sequences: list[tuple[np.ndarray, np.ndarray | int]], *, stretch: int = STRETCH, rounds: int = 120, rate: float = 0.3, ridge: float = 1e-3) -> Crf:
    """Likelihood ascent with the exact gradient from forward and backward sums, all sequences at once. A sequence has
    a label for each line, or one for all; those with boilerplate weigh as much in all as those without."""
    parts = []
    for lines, labels in sequences:
        labels = np.broadcast_to(labels, len(lines))
        parts += [(lines[a : a + stretch], labels[a : a + stretch], labels.min(initial=1)) for a in range(0, len(lines), stretch)]
    weights, pairs = np.zeros(len(FEATURES)), np.zeros((2, 2))
    if not parts:
        return Crf(np.eye(1, len(FEATURES))[0], pairs)
    x = np.zeros((len(parts), max(len(p) for p, *_ in parts), len(FEATURES)))
    y = np.zeros(x.shape[:2], int)
    for k, (p, labels, _) in enumerate(parts):
        x[k, : len(p)], y[k, : len(p)] = p, labels
    mask = np.arange(x.shape[1]) < np.array([len(p) for p, *_ in parts])[:, None]
    kind = np.array([k for *_, k in parts])
    balance = np.where(kind == 1, 0.5 / max(1, (kind == 1).sum()), 0.5 / max(1, (kind == 0).sum()))
    move, speed = np.zeros(len(FEATURES) + 4), np.zeros(len(FEATURES) + 4)
    total = (mask * balance[:, None]).sum()
    for turn in range(1, rounds + 1):
        score = np.stack([np.zeros(mask.shape), x @ weights], 2) * mask[:, :, None]
        forward = np.zeros(score.shape)
        forward[:, 0] = score[:, 0]
        for t in range(1, score.shape[1]):
            step = np.logaddexp(forward[:, t - 1, :1] + pairs[0], forward[:, t - 1, 1:] + pairs[1]) + score[:, t]
            forward[:, t] = np.where(mask[:, t : t + 1], step, forward[:, t - 1])
        backward = np.zeros(score.shape)
        for t in range(score.shape[1] - 2, -1, -1):
            ahead = backward[:, t + 1] + score[:, t + 1]
            step = np.logaddexp(pairs[:, 0] + ahead[:, :1], pairs[:, 1] + ahead[:, 1:])
            backward[:, t] = np.where(mask[:, t + 1 : t + 2], step, 0.0)
        z = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        content = np.exp(forward[:, :, 1] + backward[:, :, 1] - z[:, None]) * mask
        d_weights = np.einsum("nt,ntf->f", (y * mask - content) * balance[:, None], x)
        d_pairs = np.zeros((2, 2))
        chained = mask[:, 1:] * balance[:, None]
        for a in range(2):
            for b in range(2):
                p = np.exp(forward[:, :-1, a] + pairs[a, b] + score[:, 1:, b] + backward[:, 1:, b] - z[:, None])
                d_pairs[a, b] = (((y[:, :-1] == a) & (y[:, 1:] == b)) * chained - p * chained).sum()
        gradient = np.append(d_weights, d_pairs.ravel()) / total - ridge * np.append(weights, pairs.ravel())
        move, speed = 0.9 * move + 0.1 * gradient, 0.99 * speed + 0.01 * gradient**2
        change = rate * (move / (1 - 0.9**turn)) / (np.sqrt(speed / (1 - 0.99**turn)) + 1e-9) / np.sqrt(turn)
        weights, pairs = weights + change[:-4], pairs + change[-4:].reshape(2, 2)
    return Crf(np.round(weights, 9), np.round(pairs, 9))


def line_labels(documents: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """A label for each line, from the documents' labels. A line's own score comes from lines alone, those of good
    documents against those of bad ones. In a bad document the lines that look like those of good ones count as
    content, yet never all of them; in a good one only lines that repeat an earlier one count as boilerplate."""
    alone = fit_crf(documents, stretch=1)
    out = []
    for x, quality in documents:
        if quality:
            labels = (x[:, FEATURES.index("repeated")] == 0).astype(int)
        else:
            score = x @ alone.weights
            labels = (score > 0).astype(int)
            labels[np.argmin(score)] = 0
        out.append(labels)
    return out


def _least_share(crf: Crf, documents: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """The share of content that parts good documents from bad ones, both kinds weighing the same: of those within a
    hundredth of the best that nearest to a half."""
    share = np.array([(size * crf.decode((x @ crf.weights).tolist())).sum() / size.sum() for x, size, _ in documents])
    good = np.array([q == 1 for *_, q in documents])
    if not good.any() or good.all():
        return 0.5
    tried = np.unique(np.append((share[:, None] + np.array([0.5, 1.0])) / 2, 0.5))
    hits = np.array([((share[good] >= c).mean() + (share[~good] < c).mean()) / 2 for c in tried])
    near = tried[hits >= hits.max() - 0.01]
    return float(round(near[np.argmin(np.abs(near - 0.5))], 9))


def train(docs: DataFrame, labels: DataFrame) -> Crf:
    """Fit on up to MOST_LINES lines each of up to MOST_LABELLED documents with a quality label, as line_labels() says.

    A document with several labels counts as bad if one is; of several rows with one id the smallest text counts; null
    ids, null labels and texts without a word are left out. Without labels every line is content. The driver holds
    at most MOST_LABELLED times MOST_LINES rows of features, whatever the texts."""
    chosen = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            m = measure(*utf8(part.column("text")))
            ids, quality = part.column("doc_id").to_numpy(), part.column("quality").to_numpy()
            cuts = np.searchsorted(m.line_text, np.arange(part.num_rows + 1))
            spare = np.maximum(0, np.diff(cuts) - MOST_LINES) + 1
            lo = cuts[:-1] + (mix64(ids.astype(np.uint64)) % spare.astype(np.uint64)).astype(np.int64)
            keep = np.concatenate([np.arange(a, min(a + MOST_LINES, b)) for a, b in zip(lo, cuts[1:])])
            of = m.line_text[keep]
            yield pa.RecordBatch.from_arrays([pa.array(ids[of]), pa.array(quality[of].astype(np.int32)), pa.array(m.line_size[keep]), pa.array(list(m.features[keep]), pa.list_(pa.float64()))], ["doc_id", "quality", "size", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))
    found = texts.mapInArrow(run, "doc_id long, quality int, size long, x array<double>").toPandas()
    documents = [(np.stack(g["x"].to_list()), g["size"].to_numpy(), int(g["quality"].iloc[0] > 0)) for _, g in found.groupby("doc_id", sort=True)]
    lines = [(x, quality) for x, _, quality in documents]
    crf = fit_crf([(x, labels) for (x, _), labels in zip(lines, line_labels(lines) if lines else [])])
    return Crf(crf.weights, crf.pairs, _least_share(crf, documents)) if documents else crf


def quality_rules(docs: DataFrame, crf: Crf, *, least_content: float | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    content_share (of the characters in lines with a word).

    A document fails the base rules with fewer than 50 words, or if more than half of them lie in three-word windows
    that the text has twice. Otherwise Viterbi decoding labels its lines, and it is kept if `least_content` of it or
    more is content (where that is None, the share that was fitted). A null or empty text has no words and fails. Whole
    texts are measured, a very long one alone; rows stand for themselves; an empty table gives no rows; other columns
    are ignored.
    """
    least = crf.least if least_content is None else least_content
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            m = measure(*utf8(part.column("text")))
            scores = (m.features @ crf.weights).tolist()
            cuts = np.searchsorted(m.line_text, np.arange(part.num_rows + 1)).tolist()
            content = np.array([x for a, b in zip(cuts, cuts[1:]) for x in crf.decode(scores[a:b])], bool)
            all_size = np.bincount(m.line_text, m.line_size, part.num_rows)
            share = np.bincount(m.line_text, m.line_size * content, part.num_rows) / np.maximum(1, all_size)
            words, repeats = m.counts["n_words"], m.counts["n_repeat_words"]
            failed = (words < 50) | (100 * repeats > 50 * words)
            columns = [*(pa.array(m.counts[k].astype(np.int64)) for k in names), pa.array(failed), pa.array(~failed & (share >= least)), pa.array(share)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names, "base_failed", "kept", "content_share"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{k} long' for k in names)}, base_failed boolean, kept boolean, content_share double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
