"""Near duplicates whose shared tokens are split over slices."""

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wellfield.llm import ngram_jaccard as J

from .common import documents
from .test_dedup import plain_near


def near_copies(seed=11):
    """A large group of near copies, some chains away from it, and unlike texts with a passage in common."""
    draw, data = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(3000)]
    common, base = " ".join(draw.choices(vocabulary, k=60)), draw.choices(vocabulary, k=80)
    for k in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 3) if k < 110 else 5):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        data.append((draw.randint(0, 10**6), " ".join(words), None, None, None, *[None] * 9))
    return data + [(draw.randint(0, 10**6), common + " " + " ".join(draw.choices(vocabulary, k=draw.randint(4, 30))), None, None, None, *[None] * 9) for _ in range(60)]


@pytest.mark.parametrize("stars, most", [(0, 4), (0, 32), (2, 8), (8, 32)])
def test_near_duplicates_by_slices(spark, stars, most):
    data = near_copies()
    assert Counter(tuple(r) for r in J.near_duplicates(documents(spark, data), stars=stars, most=most).collect()) == plain_near(data)


def test_parts_are_bounded_and_whole(spark):
    """No part of a hot token holds many more than `most` documents, and all pairs but those in the largest meet."""
    import numpy as np

    most, n = 64, 600
    tokens = np.arange(1, 5, dtype=np.uint64).tobytes()
    marks = J.marks(np.frombuffer(tokens, np.uint64), np.full(4, 9, np.uint8), 4, 75).tobytes()
    frame = pd.DataFrame({"node": range(n), "n": 4, "tokens": [tokens] * n, "codes": [bytes([9] * 4)] * n, "marks": [marks] * n, "comp": [0 if k < 450 else k for k in range(n)]})
    classes = spark.createDataFrame(frame, "node long, n long, tokens binary, codes binary, marks binary, comp long")
    assert J._postings(classes, None, True, 6, most).count() == 0
    rows = J._sliced(classes, J._mixed_hot(classes, most), 6, most)
    groups = rows.where("bucket < 6").groupBy("part").agg(F.collect_list("node").alias("nodes")).collect()
    assert max(len(g.nodes) for g in groups) <= 2 * most
    met = {(a, b) for g in groups for a in g.nodes for b in g.nodes if a < b}
    assert all((a, b) in met for b in range(450, n) for a in range(b))
    stars = J._postings(classes, 1, True, 6, most).toPandas()
    token = np.frombuffer(b"".join(stars[stars["bucket"] < 6]["tokens"]), np.uint64)
    assert len(token) == n and np.unique(token, return_counts=True)[1].max() <= 2 * most


def test_links_come_through_the_orders(spark):
    """With or without hub rounds all links pass the intersected orders."""
    data = near_copies()
    draw = random.Random(2)
    shared = [f"s{k}" for k in range(60)]
    for k in range(60):  # sets that overlap by about half: candidates under some order, no links
        data.append((2_000_000 + k, " ".join(shared + [draw.choice(["a", "b"]) + str(k % 7 + j) for j in range(35)]), None, None, None, *[None] * 9))
    plain = plain_near(data)
    for stars in (0, 8):
        report = {}
        assert Counter(tuple(r) for r in J.near_duplicates(documents(spark, data), stars=stars, report=report).collect()) == plain
        assert sum(step["links"] for step in report.values()) > 0
        orders = report["all"]["orders"]
        assert report["all"]["pairs"] == orders.get(7, 0) <= sum(orders.values())
        assert all(step["links"] <= step["under_all_orders"] <= step["pairs"] for step in report.values())


def test_orders_prune():
    """Sets that share less than the threshold: each order lets some of them meet, fewer meet under all."""
    import numpy as np

    rng = np.random.default_rng(3)
    code = (rng.integers(0, 1 << 60, 1 << 16) % 6 + 1).astype(np.uint8)
    met = np.zeros(4, int)
    for _ in range(400):
        ids = rng.choice(1 << 16, 195, replace=False)
        a, b = np.sort(ids[:100]), np.sort(np.concatenate([ids[:5], ids[100:]]))  # a short passage in common
        first = [[set(x[J.prefix(mixed, code[x], len(x), o, 75)]) for x, mixed in ((a, a.astype(np.uint64)), (b, b.astype(np.uint64)))] for o in range(len(J.ORDERS))]
        hits = [bool(x & y) for x, y in first]
        met[:3] += hits
        met[3] += all(hits)
    assert met[3] < 0.85 * met[:3].min()
