"""Line dedup against a plain version, and the perfect hash."""

import hashlib
from collections import defaultdict

import numpy as np
import pyspark.sql.functions as F
import pytest

from wellfield.llm import line_dedup as L
from wellfield.llm.queries import QUERIES

from .common import FOLD, documents, empty, rows

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def plain(data, min_chars=40, min_docs=5):
    """data: (doc_id, text); every row is a document."""
    holders = defaultdict(list)
    keys = [[line.strip(WHITE).translate(FOLD) for line in (text or "").split("\n")] for _, text in data]
    for (doc, _), own in zip(data, keys):
        for key in set(own):
            holders[key].append(doc)
    out = []
    for (doc, text), own in zip(data, keys):
        kept = []
        for line, key in zip((text or "").split("\n"), own):
            ids = [x for x in holders[key] if x is not None]
            if len(key) < min_chars or len(holders[key]) < min_docs or doc == (max(ids) if ids else None):
                kept.append(line)
        out.append((doc, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(spark, data, **options):
    got = L.dedup_lines(documents(spark, data), **options)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    assert sorted(map(tuple, got.collect()), key=str) == plain([r[:2] for r in data], **options)


COMMON = "Subscribe to our newsletter for weekly updates!"


def awkward():
    """Ties, nulls, repeats within a document, lines of spaces, letters beyond ASCII at the limit of 40, long texts."""
    limit = "é" * 40
    texts = [
        f"one\n{COMMON}\ntwo", f"  {COMMON.upper()}\t\n{COMMON}", COMMON, f"{COMMON}\r\n{COMMON}\n\n", f"x\n{COMMON}", f"\n\n{COMMON}\n", None, "", "\n", " \t\n" * 50, limit, f" {limit}", limit + "\n", f"{limit}\nÉ{limit}", limit,
        "é" * 39, "é" * 39, "é" * 39, "é" * 39, "é" * 39, (COMMON + "\n") * 3000 + "end", "z" * 120_000, ("w" * 45 + "\n") * 3, "w" * 45, "W" * 45, "w" * 45, "w" * 45 + "\x0b",
    ]
    rows_ = [(k * 7 % 31, text) for k, text in enumerate(texts)]
    rows_ += [(30, COMMON), (30, COMMON), (None, COMMON), (None, f"{COMMON}\nmore"), (2**63 - 1, f"{limit}\nlast"), (-(2**63), limit)]
    return [r + ("en", "a", 1, 1, 2, "x", 3, 4, True, 5, "y", 6) for r in rows_]


def test_lines_match_the_plain_version(spark):
    check(spark, awkward())
    check(spark, rows())
    check(spark, rows(), min_chars=3, min_docs=2)


def test_lines_of_null_ids_alone(spark):
    check(spark, [(None, COMMON) + (None,) * 12] * 6)


def test_lines_of_an_empty_table(spark):
    assert L.dedup_lines(empty(spark)).collect() == []


def test_a_line_that_all_hold_goes_through_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "slices", lambda batches, column: (b.slice(k, 1) for b in batches for k in range(b.num_rows)))
    check(spark, [(k, f"own {k}\n{COMMON}") + (None,) * 12 for k in range(200)])


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = QUERIES["op11_line_dedup"](spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in want), key=str)
    assert any(r[2] for r in want)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 20_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 1 << 62, (n, 2), np.uint64)
    keys[: n // 2, 0] = 7  # many keys that differ in one half only
    keys = np.unique(keys, axis=0)
    perfect = L.PerfectHash.build(keys)
    assert sorted(perfect.slots(keys)) == list(range(len(keys)))
    if n >= 1000:
        assert len(perfect.bits) * 64 < 4.5 * n + 2000
    strangers = np.random.default_rng(n + 1).integers(1 << 62, 1 << 63, (50, 2), np.uint64)
    slots = perfect.slots(strangers)
    assert ((slots >= -1) & (slots < max(1, len(keys)))).all()


def test_an_index_tells_strangers_by_their_fingerprints(spark):
    """Documents that the index was not made from."""
    made = [(k, f"{COMMON}\nshared by some and long enough to count here") for k in range(6)]
    index = L.line_index(sent(spark, made))
    codes = L.probe(sent(spark, [(90, "a line that nobody else has, but of forty characters"), (91, COMMON)]), index, 5)
    found = [int(c) for r in codes.collect() for c in L._array(r["codes"], np.uint8)]
    assert sorted(found) == [L.KEEP, L.DROP]


def sent(spark, data):
    blocks = spark.createDataFrame(data, "doc_id long, text string").coalesce(1).mapInArrow(L._blocks, L.BLOCK)
    names = ["block", "ids", "known", "ends", "data"]

    def run(batches):
        for batch in batches:
            for row in batch.select(names).to_pylist():
                yield L._sent(L._Block(row, 40), 4)

    return blocks.mapInArrow(run, L.SENT)


def test_extra_columns_are_ignored(spark):
    frame = documents(spark).withColumn("shard", F.lit("x")).withColumn("kept_text", F.lit(1))
    assert L.dedup_lines(frame).count() == len(rows())
