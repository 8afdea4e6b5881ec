"""Mixing, archives and sharding against plain versions, and the pipeline's stages."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyspark.sql.functions as F
import pytest
import tiktoken

import corpus_pipeline
from wellfield.llm.mixing import _quotas, mix_sources
from wellfield.llm.queries import ORACLES, QUERIES
from wellfield.llm.sharding import shard_documents
from wellfield.llm.warc import archive_pages, export_warc, read_archive, read_pages, read_warc, records_in, write_archive

from .common import FOLD, WORD, documents, empty, rows
from .test_dedup import plain_near

SF = "/root/testdata/sf0.001"


def plain_targets(data, weights=(5, 2, 1), share=1.5, cap=2):
    sizes = defaultdict(int)
    for r in data:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, held = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        level = (total - sum(cap * sizes[s] for s in held)) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not above:
            return sizes, {s: cap * sizes[s] if s in held else level * weight[s] for s in names}
        held |= above


def plain_seats(targets, seats):
    won = [0] * len(targets)
    for _ in range(seats if sum(targets) else 0):
        k = max((k for k in range(len(targets)) if targets[k]), key=lambda k: (targets[k] / (2 * won[k] + 1), -k))
        won[k] += 1
    return won


@pytest.mark.parametrize("where", ["edges", SF])
def test_mix(spark, where):
    """Targets, every shard's quotas and every row's words against a walk along the drawn line, word by word."""
    docs = documents(spark) if where == "edges" else spark.read.parquet(f"{where}/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    sizes, targets = plain_targets(data)
    got = mix_sources(docs).collect()
    assert len(got) == len(data) and sorted(map(str, mix_sources(docs).collect())) == sorted(map(str, got))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    houses = [round(1.5 * sum(sizes.values()) * (k + 1) / (16 * 4)) for k in range(4)]
    quotas = [plain_seats([targets[s] for s in names], seats) for seats in houses]
    draw = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id")).distinct().collect()}
    rows = Counter((r.source, r.doc_id, r.size, tuple(r.shard_words)) for r in got)
    for n, s in enumerate(names):
        own = sorted((draw[i], i is None, i or 0, len(WORD.findall(t or "")), i) for i, t, _, source in data if source == s)
        line = [(k, r[4]) for k, r in enumerate(own) for _ in range(r[3])]
        words, ends = [[0] * 4 for _ in own], [min(q[n] * 16, 2 * sizes[s]) for q in quotas]
        for shard, (a, b) in enumerate(zip([0, *ends], ends)):
            for w in range(a, b):
                words[line[w % len(line)][0]][shard] += 1
        for r, w in zip(own, words):
            rows[s, r[4], r[3], tuple(w)] -= 1
        assert abs(ends[-1] - targets[s]) <= 16
    assert not any(rows.values())
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and r.taken == sum(r.shard_words) == r.passes * r.size + r.part_words <= 2 * r.size
        assert r.quotas == [q[names.index(r.source)] for q in quotas]
    assert mix_sources(empty(spark)).count() == 0


def test_mix_does_not_depend_on_the_cluster(spark):
    docs, key = documents(spark), "spark.sql.shuffle.partitions"
    first, before = sorted(map(str, mix_sources(docs).collect())), spark.conf.get(key)
    spark.conf.set(key, "13")
    try:
        assert sorted(map(str, mix_sources(docs.repartition(5)).collect())) == first
    finally:
        spark.conf.set(key, before)


def test_quotas_are_sainte_lague(spark):
    for seats, targets in ((10, [53.0, 24.0, 23.0]), (7, [1.0] * 9), (100, [0.0, 5.5, 1000.0, 3.2]), (1, [2.0, 2.0]), (57, [9.0, 9.0, 9.0, 1.0])):
        frame = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "source_rank long, target double")
        houses = [seats // 3, seats]
        found = _quotas(frame, houses).orderBy("source_rank").collect()
        assert [r.quotas for r in found] == [list(x) for x in zip(*(plain_seats(targets, h) for h in houses))]


PAGES = "page_id long, url string, html string, digest string, payload string, bytes long"


def pages():
    big = "é" * 60
    data = [(5, "http://a/", big), (2, "http://b/\r\nWARC-Type: revisit", big), (9, None, big), (3, "http://c/", "small"), (4, "http://c/", "small"), (6, "", None), (7, "http://d/", ""), (8, "u", "x" * 200_000), (1, "u", "\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n" * 9), (2, "http://b/", big)]
    return [r + ("q", "w", 1) for r in data]


def test_warc(spark, tmp_path):
    frame = spark.createDataFrame(pages(), PAGES)
    first = {}
    for i, _, html, *_ in pages():
        first[html or ""] = min(i, first.get(html or "", i))
    expected = Counter()
    for i, _, html, *_ in pages():
        body = (html or "").encode()
        again = len(body) >= 100 and first[html or ""] != i
        expected[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[html] if again else None] += 1
    write_archive(frame, str(tmp_path / "archive"))
    got = read_archive(spark, str(tmp_path / "archive"))
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == expected
    assert Counter((r.page_id, r.payload) for r in got.collect()) == Counter((r[0], r[2] or "") for r in pages())
    for r in got.collect():
        head, _, rest = r.record.partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert len(rest.encode()) == int(fields["Content-Length"]) + 4 and rest.endswith("\r\n\r\n") and fields["Content-Type"].startswith("application/http")
        assert rest == r.http + (r.payload if r.record_type == "response" else "") + "\r\n\r\n" and f"Content-Length: {r.payload_bytes}\r\n" in r.http
    read = archive_pages(frame).collect()
    assert Counter(tuple(r)[:5] for r in read) == expected
    assert Counter(r.record_sha256 for r in read) == Counter(hashlib.sha256(r.record.encode()).hexdigest() for r in got.collect())
    export_warc(got, str(tmp_path / "w"), per_file=3)
    assert len(list((tmp_path / "w").glob("part-*.gz"))) >= len(pages()) // 3
    back = read_warc(spark, str(tmp_path / "w")).collect()
    assert Counter(r.header + r.block + "\r\n\r\n" for r in back) == Counter(r.record for r in got.collect())
    with pytest.raises(ValueError, match="no record end"):
        list(records_in(back[0].header.encode() + b"short"))
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_files_are_checked(spark, tmp_path):
    """A file of which a payload has changed, and one that was cut off, end the read."""
    import gzip

    write_archive(spark.createDataFrame(pages(), PAGES), str(tmp_path / "archive"))
    export_warc(read_archive(spark, str(tmp_path / "archive")).coalesce(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*.gz")
    whole = gzip.decompress(file.read_bytes())
    assert read_pages(spark, str(tmp_path / "w")).count() == len(pages())
    for crc in (tmp_path / "w").glob(".part-*.crc"):
        crc.unlink()
    at = whole.index(b"\r\n\r\n", whole.index(b"HTTP/1.1 200 OK")) + 5
    for bad, why in ((whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :], "does not match"), (whole[:-9], "no record end")):
        file.write_bytes(gzip.compress(bad))
        with pytest.raises(Exception, match=why):
            read_pages(spark, str(tmp_path / "w")).collect()


def test_warc_refuses_a_wrong_payload(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(spark.createDataFrame(pages(), PAGES), path)
    stored = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit("!"))).collect()
    spark.createDataFrame(stored).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        read_archive(spark, path).collect()


def check_shards(got, data, shards):
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in data)
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(spark):
    got = shard_documents(documents(spark)).collect()
    check_shards(got, rows(), 24)
    import zlib

    sizes = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == sizes
    assert shard_documents(empty(spark)).count() == 0


def cut_links(got, data):
    """Of each group, the documents that are not in the shard that holds most of it."""
    text, where = {r[0]: r[1] for r in data}, defaultdict(Counter)
    for r in got:
        where[text[r.doc_id]][r.shard] += 1
    return {g: sum(c.values()) - max(c.values()) for g, c in where.items()}


def test_sharding_keeps_groups_together(spark):
    """Groups of two to nine copies, one of a third of all rows (three shards at least), and single texts."""
    data, n = [], 0
    for g in range(300):
        for _ in range(g % 9 + 1):
            data.append((n, f"group {g}", *[None] * 12))
            n += 1
    data += [(n + k, "hot", *[None] * 12) for k in range(700)]
    got = shard_documents(documents(spark, data), shards=8).collect()
    check_shards(got, data, 8)
    cut = cut_links(got, data)
    hot = Counter(r.shard for r in got if r.doc_id >= n)
    assert cut.pop("hot") <= 700 - 240 and len(hot) <= 4 and sum(cut.values()) == 0


@pytest.mark.parametrize("singles", [0, 3000])
def test_sharding_cuts_fewer_links_by_round(spark, singles):
    """1,000 groups of four: each round leaves fewer links cut, and the rounds alone, not the repair, bring them together."""
    data = [(k, f"group {k % 1000}", *[None] * 12) for k in range(4000)] + [(4000 + k, f"single {k}", *[None] * 12) for k in range(singles)]
    cuts = []
    for rounds in (0, 1, 2, 8):
        got = shard_documents(documents(spark, data), shards=8, rounds=rounds).collect()
        check_shards(got, data, 8)
        cuts.append(sum(cut_links(got, data).values()))
    assert cuts[0] > 1500 and cuts == sorted(cuts, reverse=True) and cuts[1] < cuts[0] / 2 and cuts[3] <= (0 if singles else 24)


def deals(room, n):
    """All ways to deal n documents over shards with so much room."""
    if not n:
        yield ()
    for k, r in enumerate(room):
        if n and r:
            yield from ((k, *rest) for rest in deals([x - (j == k) for j, x in enumerate(room)], n - 1))


def test_sharding_is_the_best_on_a_small_graph(spark):
    """All ways of placing a few groups in three shards of four: no way cuts fewer links."""
    texts = ["a"] * 4 + ["b"] * 3 + ["c"] * 2 + ["d", "e", "f"]
    data = [(k, t, *[None] * 12) for k, t in enumerate(texts)]
    least = min(sum(len(g) - max(Counter(g).values()) for g in (s[:4], s[4:7], s[7:9])) for s in deals([4, 4, 4], 12))
    got = shard_documents(documents(spark, data), shards=3).collect()
    check_shards(got, data, 3)
    assert sum(cut_links(got, data).values()) == least == 0


#: Names that stages use inside, as columns of the documents.
CLASHES = ("id", "size", "kept_id", "copy", "lang_pred", "score", "row", "row__", "pick", "passes", "part_words", "component_id", "keep_id", "node")


def plain_pipeline(data):
    """The rows (a tuple of doc_id, text, lang, source, n_chars and the clashing columns) after the first four stages, as
    sets of what may stay: repeats of one row can't be told apart."""
    key = lambda i: (i is None, i or 0)
    told = [r for r in data if any(c.isalpha() for c in r[1] or "")]
    best = {}
    for r in told:
        text = r[1].translate(FOLD)
        if text not in best or key(r[0])[0] < key(best[text][0])[0] or (key(r[0])[0] == key(best[text][0])[0] and key(r[0]) > key(best[text][0])):
            best[text] = r
    kept = sorted(best.values(), key=lambda r: key(r[0]))
    near = plain_near([(k, r[1]) for k, r in enumerate(kept)])
    return told, kept, [kept[k] for k, _, c in near if k == c]


def test_pipeline_edges(spark):
    """Each stage on its predecessor's rows, with every clashing column, repeated rows, null ids and texts; and empty."""
    base = documents(spark).select("doc_id", "text", "lang", "source", F.col("n_chars").cast("int").alias("n_chars"))
    frame = base.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHES))
    data = [tuple(r) for r in frame.collect()]
    told, exact, near = plain_pipeline(data)
    stages, ids = dict(corpus_pipeline.STAGES), lambda found: Counter((r[0], r[1]) for r in found)
    docs = stages["language_id"](spark, frame, "")
    assert docs.columns == frame.columns and ids(docs.collect()) == ids(told)
    docs = stages["exact_dedup"](spark, docs, "")
    assert docs.columns == frame.columns
    assert Counter((r[0], r[1].translate(FOLD)) for r in docs.collect()) == Counter((r[0], r[1].translate(FOLD)) for r in exact)
    docs = stages["ngram_jaccard"](spark, docs, "").cache()
    got = docs.collect()
    assert docs.columns == frame.columns and Counter(r[0] for r in got) == Counter(r[0] for r in near)
    mixed = stages["mix_sources"](spark, docs, "")
    after = mixed.collect()
    sizes, targets = plain_targets([tuple(r) for r in got])
    words = Counter()
    for r in after:
        assert tuple(r[5:]) == tuple(f"own {c}" for c in CLASHES) and r.n_chars == len(r.text) and any(o.doc_id == r.doc_id and o.text.startswith(r.text) for o in got)
        words[r.source] += len(WORD.findall(r.text))
    assert mixed.columns == frame.columns and all(abs(words[s] - t) <= 16 for s, t in targets.items()) and sum(sizes.values())
    assert Counter(r.doc_id for r in stages["byte_bpe"](spark, mixed, "").collect()) == Counter(r.doc_id for r in after)
    docs = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, result.fetchall()))
