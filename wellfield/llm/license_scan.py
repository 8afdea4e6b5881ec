"""License scans: exact seeds find candidates, bounded-error matching verifies them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices

#: Phrases whose consecutive words always give their label.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: Short notices that are searched with errors, the base phrases among them.
NOTICES = (
    *BASE,
    ("agpl-3", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "creative commons attribution license"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "creative commons zero public domain dedication"),
    ("epl-2", "eclipse public license version 2"),
    ("gpl", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl-2", "mozilla public license version 2"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: One edit for each so many characters of a notice.
CHARACTERS_PER_EDIT = 10
_KEPT = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased; words are runs of a-z, 0-9 and whatever is not ASCII."""
    return text.encode().lower().translate(_KEPT).split()


@lru_cache(8)
def _search(notices: tuple[tuple[str, str], ...], per_edit: int):
    """Seeds and matchers. With e edits allowed, a notice is cut into e + 1 pieces: e edits leave one piece intact."""
    seeds: dict[str, list[tuple[int, int]]] = {}
    matchers = []
    for k, (_, phrase) in enumerate(notices):
        edits = len(phrase) // per_edit
        cuts = [len(phrase) * j // (edits + 1) for j in range(edits + 2)]
        for a, b in zip(cuts, cuts[1:]):
            seeds.setdefault(phrase[a:b], []).append((k, a))
        matchers.append((edits, regex.compile(rf"(?b)(?<![^ ])(?=[^ ])(?:{regex.escape(phrase)}){{e<={edits}}}(?![^ ])"), len(phrase) - edits - 1))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    return automaton, matchers


def fuzzy_spans(line: str, notices=NOTICES, per_edit: int = CHARACTERS_PER_EDIT) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) of the best match in each candidate place of a line of words, overlaps joined."""
    automaton, matchers = _search(notices, per_edit)
    windows: dict[int, set[tuple[int, int]]] = {}
    for last, (length, places) in automaton.iter(line):
        for k, offset in places:
            start, edits = last + 1 - length - offset, matchers[k][0]
            # One character more on each side shows whether the match ends with a word.
            windows.setdefault(k, set()).add((max(0, start - edits - 1), min(len(line), start + len(notices[k][1]) + edits + 1)))
    return [(k, *span) for k in sorted(windows) for span in _best_first(line, windows[k], *matchers[k][1:])]


def _best_first(line: str, windows: set[tuple[int, int]], matcher: regex.Pattern, least: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of matches that do not overlap: over all windows that with the fewest edits first, of these the
    leftmost. What a match leaves of the windows it touches is searched again, so each search is as short as a window,
    however long the text."""
    waiting: list[tuple[int, int, int, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []

    def search(lo: int, hi: int) -> None:
        # Matches lie between blanks, so a window is cut to whole words; the blank before them stays, as the matcher
        # allows no insertion where its search starts.
        if lo and line[lo] != " ":
            lo = lo - 1 if line[lo - 1] == " " else line.find(" ", lo, hi) if " " in line[lo:hi] else hi
        if hi < len(line) and line[hi] != " ":
            hi = line.rfind(" ", lo, hi)
        elif hi > lo and line[hi - 1] == " ":
            hi -= 1
        if hi - lo > least and (match := matcher.search(line, lo, hi)):
            heappush(waiting, (sum(match.fuzzy_counts), *match.span(), lo, hi))

    for lo, hi in sorted(windows):
        search(lo, hi)
    found = []
    while waiting:
        edits, a, b, lo, hi = heappop(waiting)
        k = bisect_right(starts, b - 1)
        if k and ends[k - 1] > a:
            # Taken in part: what lies before and after the span that took it.
            a, b = starts[k - 1], ends[k - 1]
        else:
            found.append((a, b, edits))
            starts.insert(k, a)
            ends.insert(k, b)
        search(lo, min(hi, a))
        search(max(lo, b), hi)
    return sorted(found)


def base_places(line: bytes, phrase: str) -> list[int]:
    """The word numbers where the phrase's words stand consecutively; `line` has a blank around every word."""
    wanted, out, at, words, done = f" {phrase} ".encode(), [], line.find(f" {phrase} ".encode()), 0, 0
    while at >= 0:
        words += line.count(b" ", done, at)
        done = at
        out.append(words)
        at = line.find(wanted, at + 1)
    return out


def scan_licenses(docs: DataFrame, *, notices=NOTICES, per_edit: int = CHARACTERS_PER_EDIT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans has (label, first_word, last_word, edits) for every fuzzy match, in words from 0. The score is 1 for an
    exact base phrase, else the best match's share of characters without edit, else 0. A null or empty text has no
    words and no labels; whole texts are searched; repeated rows and null ids are searched like any other; an empty
    table gives no rows; other columns of docs are ignored.
    """
    kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))

    def one(text: str) -> tuple:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for label, phrase in BASE:
            if at := base_places(line, phrase):
                places += at
                base.add(label)
        plain = line.decode()
        spans, number, done = [], -1, 0
        for k, a, b, e in sorted(fuzzy_spans(plain, notices, per_edit), key=lambda s: s[1]):
            number, done = number + plain.count(" ", done, a), a
            spans.append((notices[k][0], number, number + plain.count(" ", a, b), e, 1 - e / len(notices[k][1])))
        labels = base | {s[0] for s in spans}
        score = 1.0 if base else max((s[4] for s in spans), default=0.0)
        own = [dict(zip(("label", "first_word", "last_word", "edits"), s[:4])) for s in spans]
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for part in slices(batches, "text"):
            rows = [one(t) for t in part.column("text").fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(zip(*rows), kinds))], ["doc_id", *names])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first_word: long, last_word: long, edits: int>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
