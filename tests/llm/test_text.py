"""Language ID, license scans, byte-level BPE and quality rules against plain versions."""

import base64
import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyspark.sql.functions as F
import pytest
import tiktoken

from wellfield.llm import language_id as L
from wellfield.llm import quality as Q
from wellfield.llm.byte_bpe import Merger, decode, digests, encode, token_starts
from wellfield.llm.codepoints import code_points
from wellfield.llm.license_scan import fuzzy_spans, scan_licenses, words_of

from .common import SCHEMA, WORD, documents, empty, prose, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"
AWKWARD = ["", " ", "  ", "\n", " \n", "\n ", "a", " a", "  a", "\n\na", "\n a", "a\n\n", "it's", "'s's", "''s", "!'s", " 's", "\n's", "'re've'll'd'm't", "'ll 'l 'r", "a1b2 3", "x's're", "１２ Ⅷ²", "  a ", "\x1c\x1d a", "漢字 かな", "é é", "😀😀 a", "\r\n\r\nq", "a" * 300, "ab" * 3000, "$%^ &*", "'S", "don'T", "\x00\x00", "'́s"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return Merger(open(PATH, "rb").read())


def test_encode_awkward(bpe, reference):
    alphabet = ["a", "B", " ", "\n", "'", "s", "l", "l", "1", "!", "é", " ", "re"]
    drawn = ["".join(alphabet[k] for k in np.random.default_rng(s).integers(0, len(alphabet), 40)) for s in range(300)]
    texts = AWKWARD + drawn
    assert [x.tolist() for x in bpe.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("width", [3, 128])
def test_scan_does_not_depend_on_rows(width):
    _, codes, _ = code_points(AWKWARD)
    assert (token_starts(codes, width) == token_starts(codes, 17)).all()


def test_long_pieces(bpe, reference):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdeé"), 2000)), "z" * 20_000]
    assert [x.tolist() for x in bpe.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_bpe_operator(spark, reference):
    tokens = encode(documents(spark), PATH)
    whole = Counter()
    for r in rows():
        ids = reference.encode_ordinary(r[1] or "")
        whole[r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in digests(documents(spark), PATH).collect()) == whole
    back = Counter((r.doc_id, bytes(r.decoded)) for r in decode(tokens, PATH).collect())
    assert back == Counter((r[0], (r[1] or "").encode()) for r in rows())
    assert all(not r.ids or r.ends[-1] == sum(len(reference.decode_single_token_bytes(i)) for i in r.ids) for r in tokens.collect())
    assert encode(empty(spark), PATH).count() == digests(empty(spark), PATH).count() == 0


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r for r in docs.collect()}
    got = L.language_id(docs).collect()
    held = [r for r in got if r.held_out and truth[r.doc_id].lang]
    assert len(got) == len(truth) and len(held) > 40
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    moved = L.language_id(docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z")))
    assert sorted(map(tuple, moved.collect())) == sorted(map(tuple, got))


def test_language_id_edges(spark):
    got = L.language_id(documents(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows() if r[0] is not None}
    assert all((r.lang_pred != "und") == letters[r.doc_id] for r in got if r.doc_id is not None)
    assert L.language_id(empty(spark)).count() == 0
    unlabelled = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.language_id(unlabelled).collect()} == {"und"}


def test_bundles_match_a_plain_sum():
    vectors = L._vectors()
    code, text, has = L.triples(["abcab", "", "zz", "Ünï co"])
    assert has.tolist() == [True, False, True, True]
    plain = np.zeros((4, L.DIMENSIONS))
    for c, t in zip(code, text):
        a, b, d = c // L.SYMBOLS**2, c // L.SYMBOLS % L.SYMBOLS, c % L.SYMBOLS
        plain[t] += vectors[a].astype(int) * np.roll(vectors[b], 1) * np.roll(vectors[d], 2)
    assert (L.bundles(code, text, 4, vectors) == plain).all()
    assert (L.bundles(code, text, 4, vectors, step=2) == plain).all()


def plain_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for label, phrase in (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")):
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark):
    extra = ["cc by nc by nc", "cc BY-NC cc by nc", "Under\nthe MIT-License under the mit license", "under the mit licenses", "Ünder the mit license", "gnu general public license"]
    data = rows() + [(900 + k, t, *[None] * 12) for k, t in enumerate(extra)]
    got = scan_licenses(documents(spark, data)).collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == Counter((r[0], *plain_licenses(r[1])) for r in data)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)
    assert scan_licenses(empty(spark)).count() == 0


@pytest.mark.parametrize("text, label, edits", [("released under teh mit license today", "mit", 2), ("the GNU Generl Public License, version 3", "gpl", 1), ("apache licens version 2 here", "apache-2", 1)])
def test_fuzzy_notices(spark, text, label, edits):
    row = scan_licenses(documents(spark, [(1, text, *[None] * 12)])).first()
    assert label in row.labels.split(",") and row.base_labels == "" and 0.8 < row.score < 1
    assert min(s.edits for s in row.spans if s.label == label) <= edits


def test_pigeonhole_finds_what_a_full_search_finds():
    import regex

    notices, rng = (("gpl", "gnu general public license"),), np.random.default_rng(4)
    matcher = regex.compile("(?b)(?<![^ ])(?:gnu general public license){e<=2}(?![^ ])")
    for _ in range(200):
        text = list("gnu general public license")
        for _ in range(int(rng.integers(0, 4))):
            text[int(rng.integers(0, len(text)))] = str(rng.choice(list("abc x")))
        line = " " + " ".join("".join(text).split()) + " "
        assert bool(fuzzy_spans(f" foo{line}bar ", notices)) == bool(matcher.search(f" foo{line}bar "))


def plain_languages(data):
    """Bundles letter by letter, prototypes, cosines: (doc_id, held out, language, score) of each row."""
    import zlib

    vectors, letter = L._vectors().astype(int), str.isalpha

    def bundle(text):
        symbols, before = [], True
        for c in (text or "").lower() + "\0":
            if letter(c):
                symbols.append(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) * 2654435761 % (1 << 32) % (L.SYMBOLS - 27))
            elif before:
                symbols.append(0)
            before = letter(c)
        total = np.zeros(L.DIMENSIONS)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            total += vectors[a] * np.roll(vectors[b], 1) * np.roll(vectors[c], 2)
        return total

    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 3 == 1
    known = {}
    for r in data:
        if r[2] is not None and not out(r[0]):
            known[r[2]] = known.get(r[2], 0) + bundle(r[1])
    names = sorted(known)
    table = np.array([known[n] / max(1.0, np.linalg.norm(known[n])) for n in names])
    table = table - table.mean(axis=0)
    table /= np.maximum(1e-12, np.linalg.norm(table, axis=1, keepdims=True))
    for r in data:
        own = bundle(r[1])
        cosine = np.round(table @ own / max(1e-12, np.linalg.norm(own)), 9)
        known_text = any(map(letter, r[1] or ""))
        yield r[0], out(r[0]), names[cosine.argmax()] if known_text else "und", round((1 + cosine.max()) / 2, 6) if known_text else 0.0


def test_language_id_is_the_plain_one(spark):
    """Repeated rows count as often as they come; nulls, texts without letters, ties and long words included."""
    data = [r for r in rows() if len(r[1] or "") < 20_000]
    got = L.language_id(documents(spark, data)).collect()
    assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 6)) for r in got) == Counter(plain_languages(data))


def test_classes_are_those_of_the_tokenizer():
    """Every code point: a letter merges with a letter before it and a number with a number, if the tokenizer sees them so."""
    from wellfield.llm.codepoints import LETTER, NUMBER, classes

    ranks = {bytes([b]): b for b in range(256)}
    for b in range(128, 256):
        ranks[b"a" + bytes([b])], ranks[b"1" + bytes([b])] = 2 * b, 2 * b + 1
    encoder = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codes = [c for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000]
    for before, kind in (("a", LETTER), ("1", NUMBER)):
        found = [encoder.encode_ordinary(before + chr(c))[0] >= 256 for c in codes]
        assert found == (classes()[codes] == kind).tolist()


def test_close_notices_with_unlike_edits_are_all_found():
    """A worse copy before or after a better one in the same window is reported, too."""
    from wellfield.llm.license_scan import NOTICES

    spans = lambda line: [(NOTICES[k][0], e) for k, _, _, e in fuzzy_spans(f" {line} ") if NOTICES[k][1] == "under the mit license"]
    assert spans("under the mxt licenze foo under the mit license") == [("mit", 2), ("mit", 0)]
    assert spans("under the mit license foo under the mxt licenze") == [("mit", 0), ("mit", 2)]
    assert spans("undr the mit license under the mit license under the mitt license") == [("mit", 1), ("mit", 0), ("mit", 1)]


def test_every_notice_is_found_with_any_edits():
    """Insertions, deletions and replacements up to the bound: the seeds miss nothing that a search of the whole line finds."""
    from wellfield.llm.license_scan import CHARACTERS_PER_EDIT, NOTICES, _search

    _, matchers = _search(NOTICES, CHARACTERS_PER_EDIT)
    rng = np.random.default_rng(8)
    for k, (_, phrase) in enumerate(NOTICES):
        edits, matcher, _ = matchers[k]
        for _ in range(12):
            text = list(phrase)
            for _ in range(int(rng.integers(0, edits + 2))):
                at, kind = int(rng.integers(0, len(text))), int(rng.integers(0, 3))
                text[at : at + (kind < 2)] = [] if kind == 0 else [str(rng.choice(list("aexyz")))]
            line = " foo " + " ".join("".join(text).split()) + " bar "
            whole = matcher.search(line)
            assert bool(whole) == any(n == k for n, *_ in fuzzy_spans(line))


def test_words_of():
    assert words_of("A-b ÀÉ_x9") == [b"a", b"b", "ÀÉ".encode(), b"x9"]


def plain_quality(text):
    text = text or ""
    w = WORD.findall(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    repeat = {k + j for k in range(len(w) - 2) if triples[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), len(w) < 50 or 100 * len(repeat) > 50 * len(w)


def test_quality_rules(spark):
    labels = spark.createDataFrame([(1, 1, 0), (10, 1, 0), (64, 0, 0), (None, 0, 0), (13, None, 0)], "doc_id long, quality int, toxic int")
    crf = Q.train(documents(spark), labels)
    got = Q.quality_rules(documents(spark), crf)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter((r[0], *plain_quality(r[1])) for r in rows())
    assert all(not (r.base_failed and r.kept) for r in got.collect())
    assert Q.quality_rules(empty(spark), crf).count() == 0
    none = Q.train(documents(spark), labels.limit(0))
    assert all(r.kept != r.base_failed for r in Q.quality_rules(documents(spark), none).collect())


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    crf = Q.train(docs, labels.where("doc_id % 2 = 0"))
    got = Q.quality_rules(docs, crf).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) >= 0.98 and sum(not r.kept for r in bad) / len(bad) >= 0.8


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(100):
        scores, pairs = rng.normal(size=int(rng.integers(1, 8))), rng.normal(size=(2, 2))
        value = lambda y: sum(s for s, v in zip(scores, y) if v) + sum(pairs[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(scores)), key=value)
        assert [int(x) for x in Q.Crf(np.zeros(1), pairs).decode(scores.tolist())] == list(best)
    assert Q.Crf(np.zeros(1), np.zeros((2, 2))).decode([]) == []


def test_crf_learns_runs():
    rng = np.random.default_rng(6)
    make = lambda y: np.column_stack([np.ones(20), rng.normal(y, 1.0, 20), *rng.normal(size=(len(Q.FEATURES) - 2, 20))])
    crf = Q.fit_crf([(make(y), y) for y in (0, 1) * 40])
    share = lambda y: np.mean([np.mean(crf.decode((make(y) @ crf.weights).tolist())) for _ in range(20)])
    assert share(1) > 0.9 and share(0) < 0.1 and crf.pairs[0, 0] + crf.pairs[1, 1] > crf.pairs[0, 1] + crf.pairs[1, 0]


def test_crf_marks_planted_boilerplate(spark):
    """Junk lines between ordinary ones are marked, the lines around them are not, and the share decides."""
    junk = ["Home | News | About | Contact | Login", "CLICK HERE!! BUY NOW!! SAVE BIG!!", "### *** $$$ &&& ### *** $$$"]
    line = lambda k: prose(k, 12).capitalize().rstrip(".") + "."
    mixed = lambda k, n: "\n".join(x for j in range(12) for x in ([line(k + j)] + ([junk[(k + j) % 3] + f" {j}"] if j < n else [])))
    data = [(k, mixed(k, 0 if k % 2 else 12), *[None] * 12) for k in range(80)] + [(1000 + k, mixed(k + 100, 5), *[None] * 12) for k in range(20)]
    docs = documents(spark, data)
    crf = Q.train(docs, spark.createDataFrame([(k, k % 2, 0) for k in range(80)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in Q.quality_rules(docs, crf).collect()}
    size = lambda lines: sum(map(len, lines))
    for k, text, *_ in data:
        lines = text.split("\n")
        bad = [x for x in lines if x.startswith(("Home", "CLICK", "###"))]
        assert got[k].content_share == pytest.approx(1 - size(bad) / size(lines), abs=0.05)
        assert k >= 1000 or got[k].kept == bool(k % 2)


def test_training_lines_are_bounded(spark):
    """Rows with one id, two labels for one id, long documents: a bounded number of lines, and the same each time."""
    data = [(1, "\n".join(f"line {k} of it." for k in range(3000)), *[None] * 12)] * 3 + [(2, "# # #\n" * 9, *[None] * 12), (2, None, *[None] * 12), (3, "", *[None] * 12)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    found = []
    keep = Q._least_share
    try:
        Q._least_share = lambda crf, documents: found.append([(len(x), q) for x, _, q in documents]) or keep(crf, documents)
        first, second = (Q.train(documents(spark, data), labels) for _ in range(2))
    finally:
        Q._least_share = keep
    assert found == [[(Q.MOST_LINES, 1), (9, 0)]] * 2 and (first.weights == second.weights).all()


@pytest.mark.parametrize("unit", ["word and another, ", "x", "a b\n"])
def test_measure_of_very_long_texts_is_bounded(unit):
    import tracemalloc

    n = 8 << 20
    data = np.resize(np.frombuffer(unit.encode(), np.uint8), n)
    tracemalloc.start()
    counts = Q.measure(data, np.array([0, n])).counts
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts["n_words"][0] == len(data.tobytes().split()) and peak < (90 if "\n" in unit else 24) * n


def test_schema_has_clashing_names():
    assert "size long" in SCHEMA and "block long" in SCHEMA


def test_license_spans_of_many_near_notices():
    """Matches are whole words, none overlaps another, and the work grows with the text, not with its square."""
    from time import process_time

    from wellfield.llm.license_scan import fuzzy_spans

    line = " " + "under the mit licence foo creative commons atribution license " * 4000
    begin = process_time()
    spans = fuzzy_spans(line)
    assert process_time() - begin < 10
    assert [s[0] for s in spans].count(0) == 4000 and {s[3] for s in spans} == {1}
    for own in ([s for s in spans if s[0] == k] for k in {s[0] for s in spans}):
        assert all(a[2] <= b[1] for a, b in zip(own, own[1:]))
    assert all(line[a - 1] == " " != line[a] and line[b] == " " != line[b - 1] for _, a, b, _ in spans)
    assert fuzzy_spans(" reative commons zero public domain dedication ")[0][1:] == (1, 46, 1)


def test_long_pieces_leave_the_cache():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        bpe = Merger(file.read())
    texts = ["word " + "ab" * 5000 + str(k) for k in range(3)] + ["ab" * 5000 + "0"]
    got = [b"".join(bpe.tokens[i] for i in ids).decode() for _ in range(2) for ids in bpe.encode(texts)]
    assert got == texts * 2 and all(len(piece) <= 128 for piece in bpe.cache) and "word" in bpe.cache
