"""One query for each operator, applied to its whole table, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir
from . import alignment, decontaminate, hosts, lines, packing, pieces, pii, simhash, spelling, substrings, token_files, toxicity, vectors


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def vocabulary() -> str:
    """Vocabulary file of the queries; the operators take any."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substrings.dedup_substrings(_read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_read(spark, sf_dir, "documents"), near=False)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write_token_files(_read(spark, sf_dir, "documents"), path, vocabulary())
    return token_files.read_token_files(spark, path)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).drop("_key")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_read(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge_urls(_read(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, sf_dir, "embeddings"))


def piece_vocabulary() -> str:
    """SentencePiece model of the queries; the operators take any BPE model with byte fallback."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_read(spark, sf_dir, "documents"), piece_vocabulary())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(_read(spark, sf_dir, "documents"), vocabulary(), piece_vocabulary())


OP1_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
win AS (SELECT item_id, array_to_string(w[i:i + 9], ' ') AS t, len(w[i:i + 9]) AS n FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT doc_id, i, ds.n, item_id FROM ds JOIN win ON win.n = ds.n AND t = array_to_string(ds.w[i:i + ds.n - 1], ' ')),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep USING (t)),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], chr(10)) AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
ord AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS p FROM ord WHERE r > 1),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY p) AS s FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0) AS n_lines, coalesce(c, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP9_SQL = r"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS rv FROM b JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
p AS (SELECT b.*, rule, rv, CASE rv WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad FROM b LEFT JOIN fit USING (page_id)),
h AS (SELECT host, regexp_replace(host, ':[0-9]*$', '') AS bare, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k FROM p GROUP BY host),
h2 AS (SELECT *, string_split(bare, '.') AS l FROM h),
hd AS (SELECT host, n, k, array_to_string(l[-2:], '.') AS two, l[-1] AS one, array_to_string(l[-3:], '.') AS three FROM h2),
hs AS (SELECT host, n, k, CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'co.nz', 'com.br', 'co.in', 'co.za') THEN three ELSE two END AS domain,
  CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'co.nz', 'com.br', 'co.in', 'co.za') THEN two ELSE one END AS suffix FROM hd),
m0 AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hs),
sx AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM hs, m0 GROUP BY suffix),
s1 AS (SELECT (1 - r) / r AS s FROM (SELECT least(greatest(coalesce(sum((k - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.99), 0.01), 0.99) AS r FROM sx)),
sp AS (SELECT suffix, (k + s * m) / (n + s) AS m FROM sx, s1),
dx AS (SELECT domain, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM hs JOIN sp USING (suffix) GROUP BY domain),
s2 AS (SELECT (1 - r) / r AS s FROM (SELECT least(greatest(coalesce(sum((k - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.99), 0.01), 0.99) AS r FROM dx)),
dp AS (SELECT domain, (k + s * m) / (n + s) AS m FROM dx, s2),
hx AS (SELECT host, n, k, m FROM hs JOIN dp USING (domain)),
s3 AS (SELECT (1 - r) / r AS s FROM (SELECT least(greatest(coalesce(sum((k - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.99), 0.01), 0.99) AS r FROM hx)),
hp AS (SELECT host, n + s + 1 AS w, (k + s * m) / (n + s) AS p FROM hx, s3)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN hp.p - 1.645 * sqrt(hp.p * (1 - hp.p) / w) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN hp USING (host)
"""

OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id != b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_decontamination": (op1_decontamination, OP1_SQL),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_substring_dedup": (op3_substring_dedup, OP3_SQL),
    "op4_personal_data": (op4_personal_data, None),
    "op5_token_files": (op5_token_files, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_line_dedup": (op7_line_dedup, OP7_SQL),
    "op8_simhash_near_dedup": (op8_simhash_near_dedup, None),
    "op9_url_filter": (op9_url_filter, OP9_SQL),
    "op10_embedding_near_dedup": (op10_embedding_near_dedup, OP10_SQL),
    "op11_sentencepiece": (op11_sentencepiece, None),
    "op12_spelling_variants": (op12_spelling_variants, None),
    "op13_token_alignment": (op13_token_alignment, None),
}
