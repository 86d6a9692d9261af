"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, chat, decontaminate, lexical, licenses, mixing, neardup, quality, secrets, substrings, token_counts, toxicity
from .common import held_out, table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.col("hits")
    return found.select("doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"), F.size(hits["items"]).cast("bigint").alias("n_items"), F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"), decontaminate.contaminated(hits).alias("contaminated"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{secrets.KINDS[k]}")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("bigint")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), live.alias("n_live"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_matches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    matches = F.col("licenses.matches")
    best = F.get(matches, 0)
    names = F.array_join(F.array_sort(F.transform(matches, lambda m: m["license"])), ",")
    return found.select("doc_id", F.col("licenses.n_words").alias("n_words"), F.size(matches).cast("bigint").alias("n_licenses"), names.alias("licenses"), best["license"].alias("license"), best["coverage"].alias("coverage"), best["first"].alias("first_word"), best["last"].alias("end_word"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors.filter(F.col("vec_id") % 20 == 0), vectors)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def scored(found: DataFrame, least: float) -> DataFrame:
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(quality.quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")), 0.3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(toxicity.toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")), 0.5)


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    found = chat.read_back(chat.format_chats(chat.events_of(rows)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id").drop("centroid")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_token_counts, op3_secret_scan, op4_license_scan, op5_nearest_neighbours, op6_source_mixing, op7_quality_classifier, op8_toxicity, op9_minhash_neardup, op10_chat_formatting, op11_centroid_clustering, op12_lexical_search, op13_substring_dedup)}

WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"



def clustering_sql(rounds: int = centroids.ROUNDS) -> str:
    """Lloyd's rounds, one by one: c<i> are the centroids and a<i> the assignments after i rounds."""
    parts = [
        "ints AS MATERIALIZED (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64)",
        "parts AS MATERIALIZED (SELECT vec_id, unnest(generate_series(1, 64)) AS d, unnest(v) AS x FROM ints)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, v FROM ints ORDER BY cluster LIMIT 40)",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, min_by(cluster, gap * 64 + cluster) AS cluster, min(gap) AS distance FROM "
            f"(SELECT vec_id, cluster, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(ints.v, c{i}.v)]) AS BIGINT) AS gap FROM ints, c{i}) GROUP BY vec_id)"
        )
        if i < rounds:
            parts.append(f"s{i} AS MATERIALIZED (SELECT cluster, d, sum(x) AS total, count(*) AS n FROM parts JOIN a{i} USING (vec_id) GROUP BY cluster, d)")
            mean = "CAST((total - ((total % n) + n) % n) // n AS BIGINT)"
            parts.append(f"m{i} AS MATERIALIZED (SELECT cluster, list({mean} ORDER BY d) AS v FROM s{i} GROUP BY cluster)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (cluster))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


TERMS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL = {
    "op1_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
            FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item, i, n FROM grams JOIN windows USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_source_mixing": """
WITH RECURSIVE sizes AS (SELECT coalesce('=' || source, '') AS key, sum(coalesce(strlen(text), 0)) AS bytes FROM documents GROUP BY 1),
weighted AS (SELECT key, bytes, pow(CAST(bytes AS DOUBLE), 0.5) AS weight FROM sizes),
rated AS (SELECT key, CASE WHEN bytes > 0 THEN weight * ((SELECT CAST(sum(bytes) AS DOUBLE) FROM weighted) / (SELECT sum(weight) FROM weighted)) / bytes ELSE 1.0 END AS rate FROM weighted),
pieces AS (SELECT key, rate / greatest(ceil(rate / 256), 1) AS mean, CAST(greatest(ceil(rate / 256), 1) AS INTEGER) AS many FROM rated),
cdf AS (SELECT key, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM pieces
        UNION ALL SELECT key, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 20)),
curves AS (SELECT key, list(total ORDER BY k) AS cdf FROM cdf GROUP BY key),
drawn AS (SELECT d.*, p.key, many, unnest(generate_series(1, many)) AS j FROM documents d JOIN pieces p ON p.key = coalesce('=' || d.source, '')),
counted AS (SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(cdf, lambda c: c <= CAST(CAST('0x' || md5('7|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || j)[1:13] AS BIGINT) AS DOUBLE) / 4503599627370496))) AS n
            FROM drawn JOIN curves USING (key) GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(generate_series(1, CAST(n AS BIGINT))) AS INTEGER) AS replica FROM counted WHERE n > 0""",
    "op10_chat_formatting": r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, t, CASE WHEN t = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(t)),
escaped AS (SELECT *, replace(replace(text, '\', '\s'), '<', '\l') AS body, replace(replace(replace(role, '\', '\s'), '<', '\l'), chr(10), '\n') AS head FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(15 + length(head) + length(body)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op11_centroid_clustering": clustering_sql(),
    "op12_lexical_search": f"""
WITH d AS MATERIALIZED (SELECT doc_id, {TERMS.format("coalesce(text, '')")} AS w FROM documents),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({TERMS.format("coalesce(text, '')")}) AS term FROM benchmark),
counted AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), whole),
parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part FROM counted JOIN weights USING (term), whole),
scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= 10""",
    "op13_substring_dedup": r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM starts QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS k FROM later),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS k, unnest(w) AS word FROM d),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)""",
}
