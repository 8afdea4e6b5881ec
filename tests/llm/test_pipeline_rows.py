"""The pipeline's dedup stages decide per row: the exact rows that remain where ids repeat or are null."""

from collections import Counter

import pytest

import corpus_pipeline

from .common import FOLD, documents, prose, rows
from .test_dedup import plain_near

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEY = lambda r: (r[0] is None, r[0] or 0)


def awkward():
    """Repeated rows, copies with a null id, two texts under one id."""
    rest = [None] * 9
    return rows() + [(t[0], t[1], "en", "a", 1, *rest) for t in [(90, prose(8, 90))] * 3 + [(None, prose(8, 90)), (None, prose(8, 91)), (None, prose(6, 500)), (None, prose(6, 500))]] + [
        (70, prose(7, 51), "en", "a", 1, *rest), (70, prose(5, 70), "en", "b", 2, *rest), (71, prose(5, 70), "en", "b", 3, *rest),
    ]


@pytest.fixture(scope="module")
def frame(spark):
    return documents(spark, awkward()).select(*COLUMNS)


def test_exact_keeps_one_row_of_each_text(spark, frame):
    best = {}
    for r in frame.collect():
        best.setdefault((r.text or "").translate(FOLD), []).append(tuple(r))
    got = [tuple(r) for r in corpus_pipeline.exact(spark, frame, "").collect()]
    assert Counter((r[1] or "").translate(FOLD) for r in got) == Counter(list(best))
    for r in got:
        same = best[(r[1] or "").translate(FOLD)]
        assert r in same and r[0] == max((s[0] for s in same if s[0] is not None), default=None)


def test_near_keeps_one_row_of_each_component(spark, frame):
    data = [tuple(r) for r in frame.collect()]
    # Numbered by id, nulls last, so that every row of the plain result is a row of its own.
    data.sort(key=lambda r: (KEY(r), str(r)))
    parts = {}
    for (k, _, c), n in plain_near([(k, r[1]) for k, r in enumerate(data)]).items():
        parts.setdefault(c, []).append(data[k])
    got = [tuple(r) for r in corpus_pipeline.near(spark, frame, "").collect()]
    assert len(got) == len(parts) and not Counter(got) - Counter(data)
    ids = lambda found: Counter(r[0] for r in found)
    assert ids(got) == ids(min(p, key=KEY) for p in parts.values())
    left = Counter(got)
    for p in parts.values():
        assert sum(left[r] > 0 for r in {r for r in p if r[0] == min(p, key=KEY)[0]}) == 1
