"""The operators' queries over the whole driver tables, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import chat, codes, decontaminate, divergence, exact_dedup, langid, licenses, lines, mixing, quality, sharding, simhash, tokens
from tidewell.llm.common import docs_of

DIMS = ["source", "lang", "n_chars"]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(docs_of(spark, sf_dir))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(docs_of(spark, sf_dir))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs_of(spark, sf_dir).select("doc_id", *DIMS, (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.assign_shards(rows, DIMS, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(docs_of(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_quotes(docs_of(spark, sf_dir, "conversations"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(docs_of(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_summary(docs_of(spark, sf_dir))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_summary(docs_of(spark, sf_dir), docs_of(spark, sf_dir, "benchmark"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    model = langid.train(docs, ~held_out)
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_summary(docs_of(spark, sf_dir))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(docs_of(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(docs_of(spark, sf_dir))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(docs_of(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_licenses, op3_shards, op4_simhash, op5_chat, op6_tokens, op7_mix, op8_decontaminate, op9_language, op10_lines, op11_codes, op12_exact_dedup, op13_divergence)}

OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d
), pos AS (
  SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS n FROM pos
), rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM win, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid
), dup AS (
  SELECT rid, sum(n - 1) AS n FROM (
    SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid
), stats AS (
  SELECT d.doc_id, d.source, len(w.words)::BIGINT AS n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats
), host AS (
  SELECT source, count(*) AS n, sum(base_failed::INT)::DOUBLE AS k FROM base GROUP BY source
), sums AS (
  SELECT sum(k) / sum(n) AS p, (sum(k * k / n) - sum(k) * sum(k) / sum(n)) / sum(n) - (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * count(*) / sum(n) AS v FROM host
), prior AS (
  SELECT p, CASE WHEN v <= 0 THEN 10000.0 ELSE least(greatest(p * (1 - p) / v - 1, 1.0), 10000.0) END AS m FROM sums
), verdict AS (
  SELECT source, n, k, (k + p * m) / (n + m) > 0.5 AS bad FROM host, prior
)
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
  v.n::BIGINT AS host_docs, v.k::BIGINT AS host_failed, v.bad AS host_rejected, NOT b.base_failed AND NOT v.bad AS kept
FROM base b JOIN verdict v ON b.source IS NOT DISTINCT FROM v.source
"""

OP8_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), sized AS (
  SELECT item_id, words, least(10, len(words)) AS n FROM item WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM sized)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), spot AS (
  SELECT rid, words, s.n, unnest(range(1, len(words) - s.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sized) s WHERE len(words) >= s.n
), found AS (
  SELECT a.rid, a.i, a.n, w.item_id FROM (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS win FROM spot) a JOIN windows w ON a.n = w.n AND a.win = w.win
), hit AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found) GROUP BY rid
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT rid, doc_id, i, lines[i] AS line, translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)
), common AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), kept AS (
  SELECT l.rid, l.i, l.line, c.key IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM l LEFT JOIN common c ON l.key = c.key
)
SELECT d.doc_id, len(d.lines)::BIGINT AS n_lines, k.n_dropped, k.kept_sha256
FROM d JOIN (SELECT rid, sum(gone::INT)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM kept GROUP BY rid) k USING (rid)
"""



def _op11_sql() -> str:
    """Rounds as a chain of tables: b has the codebooks, a the nearest entries (distance * 256 + entry is least)."""
    steps = [r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT r, k AS part, v[len(v) // 4 * k + 1:len(v) // 4 * (k + 1)] AS x FROM v, (SELECT unnest(range(4)) AS k)
), b0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 256
)"""]
    for i in range(codes.ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + entry) AS d FROM p JOIN b{i} USING (part) GROUP BY r, part
)""")
        if i < codes.ROUNDS:
            steps.append(f"""m{i} AS (
  SELECT part, d % 256 AS entry, i, sum(x[i]) AS s, count(*) AS n FROM a{i}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY part, d % 256, i
), b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(f.c, b.c) AS c FROM b{i} b LEFT JOIN (
    SELECT part, entry, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS c FROM m{i} GROUP BY part, entry) f ON b.part = f.part AND b.entry = f.entry
)""")
    steps.append(f"""coded AS (
  SELECT r, string_agg(lower(printf('%02x', (d % 256)::INT)), '' ORDER BY part) AS code, sum(d // 256)::BIGINT AS error FROM a{codes.ROUNDS} GROUP BY r
)
SELECT v.vec_id, code, error, (sum(error) OVER (PARTITION BY v.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{codes.ROUNDS}) AS codebooks_sha256
FROM coded JOIN v USING (r)""")
    return ", ".join(steps)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), ranked AS (
  SELECT *, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS n,
    row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) AS place FROM d
)
SELECT doc_id, keep_id, n::BIGINT AS group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS MATERIALIZED (
  SELECT rid, lang, source, unnest(terms) AS term FROM d
), k AS MATERIALIZED (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), g AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source) LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY lang) USING (lang)
), m AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + g.v))::HUGEINT AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
  SELECT m.lang, m.term, (1 + 1000000000 * (sum(m.n) + 1) // (any_value(s.total) + any_value(s.v)))::HUGEINT AS q
  FROM m JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM g GROUP BY lang) s USING (lang) GROUP BY m.lang, m.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), term AS (
  SELECT m.lang, m.source, 'term' AS part, m.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM m JOIN l USING (lang, term) WHERE m.n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLE_SQL: dict[str, str] = {"op1_quality": OP1_SQL, "op8_decontaminate": OP8_SQL, "op10_lines": OP10_SQL, "op11_codes": _op11_sql(), "op12_exact_dedup": OP12_SQL, "op13_divergence": OP13_SQL}
