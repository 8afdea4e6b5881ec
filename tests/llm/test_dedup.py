"""Exact dedup, repeated passages and near duplicates against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyspark.sql.functions as F
import pytest

from wellfield.llm import blocks as B
from wellfield.llm.exact_dedup import exact_dedup
from wellfield.llm.ngram_jaccard import near_duplicates
from wellfield.llm.suffix_dedup import COVER, PERIOD, suffix_dedup

from .common import FOLD, WORD, documents, empty, prose, rows


def plain_exact(data):
    groups = defaultdict(list)
    for r in data:
        groups[(r[1] or "").translate(FOLD)].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("content_hash", [F.md5, lambda c: F.substring(F.md5(c), 1, 1)], ids=["md5", "colliding"])
def test_exact_dedup(spark, content_hash):
    got = exact_dedup(documents(spark), content_hash=content_hash)
    assert Counter(tuple(r) for r in got.collect()) == plain_exact(rows())
    assert exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_is_native(spark):
    plan = exact_dedup(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_suffix(data, length=50):
    texts = {}
    for r in data:
        texts.setdefault((r[1] or "").encode(), []).append(r[0])
    key = lambda i: (i is None, i or 0)
    first = sorted(((min(ids, key=key), t) for t, ids in texts.items()), key=lambda x: (key(x[0]), x[1]))
    seen, own, done, last = set(), set(), {}, None
    for i, t in first:
        if i != last:  # only smaller ids count
            seen, own, last = seen | own, set(), i
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            own.add(w)
            if w in seen:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        done[i, t] = (len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    out = Counter()
    for t, ids in texts.items():
        least = min(ids, key=key)
        for i in ids:
            whole = (len(t), len(t), 1, hashlib.sha256(b"").hexdigest()) if len(t) >= length else (len(t), 0, 0, hashlib.sha256(t).hexdigest())
            out[(i, *(done[least, t] if i == least else whole))] += 1
    return out


def test_cover_aligns_any_two_places():
    pairs = {((a - b) % PERIOD) for a in COVER for b in COVER}
    assert pairs == set(range(PERIOD))


@pytest.mark.parametrize("length", [50, 64])
def test_suffix_dedup(spark, length):
    got = suffix_dedup(documents(spark), length=length).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(rows(), length)
    assert suffix_dedup(empty(spark)).count() == 0


def test_suffix_dedup_shared_passages(spark):
    draw = random.Random(3)
    passages = ["".join(draw.choices("abcdefgh \n", k=n)) for n in (49, 50, 51, 120, 4000)]
    data = [(k, "".join(draw.choice([draw.choice(passages), "".join(draw.choices("xyz ", k=draw.randint(0, 70)))]) for _ in range(6)), None, None, None, *[None] * 9) for k in range(80)]
    got = suffix_dedup(documents(spark, data)).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(data)
    spans = suffix_dedup(documents(spark, data)).select("n_removed", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("s"))
    assert all(r.n_removed == r.s for r in spans.collect())


def test_window_hashes_at_stretch_edges():
    data = np.random.default_rng(0).integers(0, 256, 1000, np.uint8)
    whole = B._polynomials(data, 50, 2, 5000)
    for n in (1, 49, 50, 51, 63, 64, 65, 127, 129, 200, 1000):
        assert (B._polynomials(data[:n], 50, 2, 64)[: max(0, n - 49)] == whole[: max(0, n - 49)]).all()
    for length in (64, 65, 128, 300, 999):
        twice = B.window_hashes(np.concatenate([data, data]), length, 1)
        assert (twice[: 1001 - length] == twice[1000 : 2001 - length]).all() and len(np.unique(twice[:1000])) == 1000


def test_patterns_that_cancel_in_a_polynomial(spark):
    """Two different texts whose difference is a Thue-Morse pattern, and the same with a true repeat."""
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    texts = ["p" * 40 + morse + "s" * 40, "p" * 40 + morse.translate(str.maketrans("ab", "ba")) + "s" * 40, "q" * 9 + "p" * 40 + morse + "s" * 40]
    data = [(k, t, *[None] * 12) for k, t in enumerate(texts)]
    got = suffix_dedup(documents(spark, data), length=1104).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(data, 1104)


@pytest.mark.parametrize("most", [1, 200, 1 << 20])
def test_rows_of_one_id_lose_nothing_to_each_other(spark, monkeypatch, most):
    """Also where the texts of one id lie in several blocks."""
    build = B.build
    monkeypatch.setattr(B, "build", lambda scratch, name, docs: build(scratch, name, docs, most))
    shared, other = prose(1, 30), prose(2, 30)
    texts = [(3, shared + " one"), (3, shared + " two"), (3, shared + " three " + other), (5, "five " + shared), (5, other + " and " + shared), (None, shared), (None, "none " + shared), (9, other), (9, other + " more"), (9, shared[:40]), (4, "z" * 60), (4, "z" * 70)]
    data = [(i, t, *[None] * 12) for i, t in texts]
    got = suffix_dedup(documents(spark, data)).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(data)


def plain_near(data, words=5):
    sets = []
    for r in data:
        w = WORD.findall((r[1] or "").translate(FOLD))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    group = list(range(len(data)))

    def top(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    least = {}
    for k, r in enumerate(data):
        least[top(k)] = min(least.get(top(k), (True, 0)), (r[0] is None, r[0] or 0))
    return Counter((r[0], len(sets[k]), None if least[top(k)][0] else least[top(k)][1]) for k, r in enumerate(data))


def test_near_duplicates(spark):
    assert Counter(tuple(r) for r in near_duplicates(documents(spark)).collect()) == plain_near(rows())
    assert near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("stars", [0, 2])
def test_near_duplicates_chains(spark, stars):
    """Copies with edits whose links form chains, between a common passage in all texts and unlike ones."""
    draw, data = random.Random(5), []
    vocabulary = [f"w{k}" for k in range(4000)]
    common = " ".join(draw.choices(vocabulary, k=30))
    for base in range(12):
        words = draw.choices(vocabulary, k=draw.randint(6, 120))
        for copy in range(draw.randint(1, 14)):
            text = " ".join(words) + (" " + common if base % 3 == 0 else "")
            data.append((draw.randint(0, 10**6), text.upper() if copy % 2 else text, None, None, None, *[None] * 9))
            words = list(words)
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
    assert Counter(tuple(r) for r in near_duplicates(documents(spark, data), stars=stars).collect()) == plain_near(data)


def test_prefixes_decide():
    from wellfield.llm.ngram_jaccard import ORDERS, prefix

    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        b = np.concatenate([a[: max(1, int(n * rng.random()))], rng.choice(1 << 40, int(rng.integers(0, 20)), replace=False).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            code = lambda x: (x % np.uint64(5) + np.uint64(1)).astype(np.uint8)
            for o in range(len(ORDERS)):
                first = lambda x: x[prefix(x, code(x), len(x), o, 75)]  # noqa: B023, E731
                assert len(np.intersect1d(first(a), first(b)))


def test_lost_text_is_whole(spark):
    """A text longer than a block stays in one piece."""
    data = [(1, prose(9, 40_000), None, None, None, *[None] * 9), (2, prose(9, 40_000) + " end", None, None, None, *[None] * 9)]
    got = suffix_dedup(documents(spark, data)).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(data)


def test_windows_with_equal_keys_are_told_apart_by_their_tails():
    from wellfield.llm.suffix_dedup import _order

    keys, tails = np.array([5, 3, 5, 5, 3, 9], np.uint64), np.array([1, 7, 2, 1, 7, 0], np.uint16)
    order, new = _order(keys, tails)
    assert [keys[k] for k in order] == sorted(keys) and new.tolist() == [True, False, True, False, True, True]
    order, new = _order(keys, tails, np.array([0, 1, 0, 0, 2, 0]))
    assert new.tolist() == [True, False, True, True, True, True]
    assert _order(keys[:0], tails[:0])[1].tolist() == []


@pytest.mark.parametrize("buckets", [7, 1000])
def test_suffix_dedup_by_many_buckets(spark, monkeypatch, buckets):
    monkeypatch.setattr(B, "bucket_count", lambda *_: buckets)
    got = suffix_dedup(documents(spark)).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == plain_suffix(rows())


def test_suffix_dedup_of_a_long_run_of_one_byte(spark):
    """All suffixes of these texts tie to the end of their windows."""
    data = [(2, "a" * 300_000, *[None] * 12), (1, "b" + "a" * 60, *[None] * 12), (3, "a" * 49, *[None] * 12)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup(documents(spark, data)).collect()}
    assert got == {1: (0, 0), 2: (300_000, 1), 3: (0, 0)}
