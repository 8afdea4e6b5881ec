"""Near duplicates between very long documents."""

import random

import numpy as np
import pytest

from wellfield.llm.ngram_jaccard import _may_link, class_counts, near_duplicates

from .common import documents


@pytest.mark.parametrize("stars", [0, 2])
def test_near_duplicates_of_long_texts(spark, stars):
    draw = random.Random(8)
    words = [f"w{draw.randrange(10**6)}" for _ in range(80_004)]
    data = [(k, " ".join(t), None, None, None, *[None] * 9) for k, t in ((1, words), (2, words[:-1] + ["end"]), (3, words[::-1]))]
    got = sorted(tuple(r) for r in near_duplicates(documents(spark, data), stars=stars).collect())
    assert got == [(1, 80_000, 1), (2, 80_000, 1), (3, 80_000, 3)]


def test_full_classes_bound_nothing():
    """A count that stands for 255 or more must not bound the overlap, whatever the other set holds."""
    one_class = np.full(256, 0, np.uint8)
    one_class[7] = 255
    large = class_counts(np.arange(1, 6_000, dtype=np.uint64))
    size, counts = np.array([400, 400, 90_000, 90_000, 400]), np.stack([one_class, one_class, large, large, np.ones(256, np.uint8)])
    shared, may = _may_link(0, np.array([1]), size, counts, 75)
    assert shared.tolist() == [400] and may.all()
    shared, may = _may_link(2, np.array([3, 4]), size, counts, 75)
    assert shared.tolist() == [90_000, 256] and may.tolist() == [True, False]
