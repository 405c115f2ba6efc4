"""The registered queries of this package (name -> function of session and table folder) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import (bpe, centroids, decontaminate, divergence, pii, quality, quality_classifier, secret_scan, shards, simhash,
                           substrings, toxicity, urls)
from clicklens.llm.lineage import cut, small_batches
from clicklens.sources.tables import read_table

DOC = ("doc_id", "text")
VOCAB = "word_bpe_49k.json"
# The rules of the query: action, host, path.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    small_batches(spark)
    return read_table(spark, sf_dir, "documents", columns or DOC)


def _joined(items) -> F.Column:
    return F.sha2(F.array_join(items, ","), 256)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every proposed secret with the forest's score; the value as a digest."""
    found = secret_scan.scan(_docs(spark, sf_dir, "doc_id", "text", "source"))
    return found.select(F.col("id").alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
                        F.sha2("value", 256).alias("value_sha256"), "score", "secret")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "action string, host string, path string")
    return urls.apply_rules(read_table(spark, sf_dir, "pages", ["page_id", "url"]), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(_docs(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))
    return out.select(F.col("id").alias("doc_id"), "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str, vocab: str | None = None) -> DataFrame:
    return bpe.encode_documents(_docs(spark, sf_dir), vocab or vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def vocabulary(name: str = VOCAB) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> toxicity.Weights:
    """The model of op5 and of the pipeline: labels of held-out rows are never read."""
    docs = _docs(spark, sf_dir) if docs is None else docs
    return toxicity.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]), ~held_out())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_docs(spark, sf_dir), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_docs(spark, sf_dir)).select("doc_id", "pii")
    text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("pii")).alias("spans"),
                        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    rows = _docs(spark, sf_dir).select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("text_crc32"))
    out = shards.shard_rows(rows, 8, ["doc_id"], seed=42)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return found.select("doc_id", "n_words", decontaminate.hit_words("hit_spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        _joined(F.col("items")).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_docs(spark, sf_dir))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & F.col("good")).alias("kept"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def quality_held_out(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a model that never reads the labels of held-out rows. The statistics are read by training and scoring."""
    stats = cut(quality_classifier.statistics(_docs(spark, sf_dir)))
    model = quality_classifier.fit(stats, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]), ~quality_held_out())
    return quality_classifier.score(stats, model, threshold=0.7).select(
        F.col("id").alias("doc_id"), F.coalesce(quality_held_out("id"), F.lit(False)).alias("held_out"), "score", "predicted")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_docs(spark, sf_dir, "text", "lang", "source"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_secret_scan, op2_url_filter, op3_substring_dedup, op4_bpe, op5_toxicity, op6_pii,
                                    op7_sharding, op8_decontaminate, op9_simhash, op10_quality, op11_centroids,
                                    op12_quality_classifier, op13_source_divergence)}


_WINDOWS_13 = """
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
         FROM words, unnest(range(1, greatest(len(w) - 11, 1))) AS u(i)),
firsts AS (SELECT win, min(doc_id) AS least FROM wins GROUP BY win),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM wins JOIN firsts USING (win), unnest(range(0, 13)) AS v(k) WHERE doc_id > least),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM flat ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)"""


def _centroids_sql(k: int = 16, rounds: int = 3) -> str:
    """Plain squared distances between every vector and every centroid, round after round."""
    parts = [f"""kept AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64),
e AS (SELECT r, unnest(v) AS x, unnest(range(64)) AS i FROM kept),
first AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM kept QUALIFY k < {k}),
c0 AS (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM first)"""]
    for n in range(rounds + 1):
        parts.append(f"d{n} AS (SELECT r, k, CAST(sum((e.x - c.x) * (e.x - c.x)) AS BIGINT) AS d FROM e JOIN c{n} c USING (i) GROUP BY r, k)")
        parts.append(f"a{n} AS (SELECT r, arg_min(k, d * {k} + k) AS k, min(d) AS d FROM d{n} GROUP BY r)")
        if n < rounds:
            parts.append(f"""s{n} AS (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM e JOIN a{n} USING (r) GROUP BY k, i),
c{n + 1} AS (SELECT k, i, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{n} LEFT JOIN s{n} USING (k, i))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN (SELECT k, sha256(string_agg(x, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k) hashed ON hashed.k = a.k"""


_DIVERGENCE = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
vs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.n AS all_n, coalesce(x.n, 0) AS n FROM g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
sums AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang, source),
p AS (SELECT c.lang, c.source, term, c.n, 1 + CAST(1000000000 AS HUGEINT) * (c.n + 5) // (s.total + 5 * v) AS p,
  1 + CAST(1000000000 AS HUGEINT) * (all_n + 5) // (vs.total + 5 * v) AS q FROM c JOIN sums s USING (lang, source) JOIN vs USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)
    return {
        "op2_url_filter": f"""
WITH rules(action, r_host, r_path) AS (VALUES {rules}),
rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest)
SELECT page_id, host, path, r_host || r_path AS rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN LATERAL (
  SELECT r_host, r_path, action FROM rules
  WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  ORDER BY length(r_host) + length(r_path) DESC, length(r_host) DESC LIMIT 1) ON true""",
        "op3_substring_dedup": f"""
WITH {_WINDOWS_13.strip()}
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)""",
        "op8_decontaminate": """
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
items AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_wins AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM item_wins),
wins AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win FROM words, sizes, unnest(range(1, greatest(len(w) - m + 2, 1))) AS u(i)),
found AS (SELECT doc_id, i, m, item_id FROM wins JOIN item_wins USING (m, win)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM found, unnest(range(0, m)) AS v(k) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)""",
        "op11_centroids": _centroids_sql(),
        "op13_source_divergence": _DIVERGENCE,
    }
