"""The registered queries of the operators here, with production parameters, and SQL for those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import centroid_clusters
from .common import table
from .conversations import repair_conversations
from .exact_dedup import exact_dedup
from .mixing import mix_sources
from .byte_bpe import digests
from .language_id import language_id
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .ngram_jaccard import near_duplicates
from .quality import quality_rules, train
from .sharding import shard_documents
from .suffix_dedup import suffix_dedup
from .warc import archive_pages


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, train(docs, table(spark, sf_dir, "labels"))).drop("content_share")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


_OPERATORS = (
    op1_mix_sources, op2_exact_dedup, op3_suffix_dedup, op4_ngram_jaccard, op5_language_id, op6_license_scan, op7_byte_bpe, op8_warc, op9_quality_rules, op10_sharding,
    op11_line_dedup, op12_centroid_clustering, op13_conversation_repair,
)
QUERIES = {f.__name__: f for f in _OPERATORS}


def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256) -> str:
    """Every round as a pair of named queries: nearest centroids, then floors of their means."""
    parts = [
        f"v as (select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as x from embeddings where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dim})",
        f"c0 as (select (row_number() over (order by h, x) - 1)::int as cluster, x from (select sha256('2:' || coalesce(vec_id::varchar, '')) as h, x from v order by h, x limit {k}))",
    ]
    gap = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    for r in range(rounds + 1):
        parts.append(f"a{r} as (select v.vec_id, any_value(v.x) as x, min(({gap}, c.cluster)) as near from (select *, row_number() over () as n from v) v cross join c{r} c group by v.n, v.vec_id)")
        if r < rounds:
            means = ", ".join(f"fdiv(sum(x[{j + 1}]), count(*))::bigint" for j in range(dim))
            parts.append(f"m{r} as (select near[2] as cluster, [{means}] as x from a{r} group by 1)")
            parts.append(f"c{r + 1} as (select c.cluster, coalesce(m.x, c.x) as x from c{r} c left join m{r} m using (cluster))")
    last = f"select vec_id, near[2]::int as cluster, near[1]::bigint as distance, (sum(near[1]) over (partition by near[2]))::bigint as cluster_inertia, (sum(near[1]) over ())::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256 from a{rounds} join c{rounds} c on c.cluster = near[2]"
    return f"with {', '.join(parts)} {last}"


ORACLES = {
    "op2_exact_dedup": """
        with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(norm) as text_sha256
        from t window w as (partition by norm)""",
    "op8_warc": """
        with t as (select page_id, url, coalesce(html, '') as body from pages),
        r as (select *, strlen(body) as n, min(page_id) over (partition by body) as first_id from t),
        k as (select *, case when n >= 100 and page_id <> first_id then first_id end as other, 'HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ' || n || '\r\n\r\n' as http from r)
        select page_id, n as payload_bytes, sha256(body) as payload_digest, case when other is null then 'response' else 'revisit' end as record_type, other as refers_to,
          sha256('WARC/1.1\r\nWARC-Type: ' || case when other is null then 'response' else 'revisit' end || '\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\n'
            || case when coalesce(url, '') <> '' then 'WARC-Target-URI: ' || regexp_replace(url, '[\r\n]', ' ', 'g') || '\r\n' else '' end || 'WARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:' || sha256(body) || '\r\n'
            || case when other is null then '' else 'WARC-Refers-To: <urn:page:' || other || '>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n' end
            || 'Content-Type: application/http; msgtype=response\r\nContent-Length: ' || (strlen(http) + case when other is null then n else 0 end) || '\r\n\r\n' || http || case when other is null then body else '' end || '\r\n\r\n') as record_sha256
        from k""",
    "op11_line_dedup": """
        with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        l as (select doc_id, len(lines) as n, unnest(lines) as line, generate_subscripts(lines, 1) as place from t),
        k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
        c as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
        select doc_id, any_value(n) as n_lines, count(*) filter (where doc_id <> last) as n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by place) filter (where last is null or doc_id = last), '')) as kept_sha256
        from k left join c using (key) group by doc_id""",
    "op12_centroid_clustering": _clusters_sql(),
}
