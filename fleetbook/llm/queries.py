"""The training-data operators as registered queries, with production
parameters over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.llm import counts, divergence, lines, mixing, neardup, polytope, pseudonyms, quality, secrets, tiling, topk, trie, wavelet
from fleetbook.llm.common import read
from fleetbook.session import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
MIX_POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}  # below 1 lifts small margins
MIX_FRACTION, MIX_SEED = 0.7, 1
PSEUDONYM_KEY = "fleetbook"  # a deployment passes its own secret


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    wavelet.write_shards(read(spark, sf_dir, "documents"), path, tokenizer_path(BYTE_BPE))
    return wavelet.read_documents(spark, path)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), MIX_POWERS, MIX_FRACTION, MIX_SEED)
    return mixed.withColumn("probability", F.round("probability", 6))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(read(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_shared_lines(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=75)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"), group=100, heads=6)


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_shards": op2_token_shards,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_token_counts": op4_token_counts,
    "op5_source_mixing": op5_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_line_dedup": op8_line_dedup,
    "op9_top_k_search": op9_top_k_search,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_source_divergence": op13_source_divergence,
}

BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ASCII_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 of an ASCII text, bit by bit
CRC32_SQL = ("xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split({}, '')]), "
             "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
             "lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295)")

ORACLE: dict[str, str] = {
    "op5_source_mixing": mixing.mix_sql(MIX_POWERS, MIX_FRACTION, MIX_SEED),
    "op8_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), line AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split
), keyed AS (
    SELECT *, {ASCII_LOWER_SQL.format(f"trim(line, {BLANK_SQL})")} AS key FROM line
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON f.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op9_top_k_search": """
WITH v AS (
    SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_conversation_trie": f"""
WITH turns AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
    SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS own FROM turns GROUP BY c
), shared AS (
    SELECT c, own, {CRC32_SQL.format("CAST(c AS VARCHAR)")} % 6 AS h FROM conv
), made AS (
    SELECT s.c, list_concat(coalesce(b.own[1:s.h], []), s.own[s.h + 1:]) AS path
    FROM shared s LEFT JOIN conv b ON b.c = s.c - s.c % 100
), prefix AS (
    SELECT c, unnest(range(0, len(path) + 1)) AS depth, path FROM made
), node AS (
    SELECT path[1:depth] AS path, depth, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(prefix.path) = depth), '')) AS ends_sha256
    FROM prefix GROUP BY path[1:depth], depth
), child AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY path[1:depth - 1]
), weighed AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children,
           CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * length(n.path[n.depth].text) ELSE 0 END AS saved
    FROM node n LEFT JOIN child k ON k.path = n.path
), below AS (
    SELECT path[1:d] AS path, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS d FROM weighed) GROUP BY path[1:d]
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM weighed w JOIN below b ON b.path = w.path
LEFT JOIN node p ON w.depth > 0 AND p.path = w.path[1:w.depth - 1]
""",
    "op13_source_divergence": f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({ASCII_LOWER_SQL.format("coalesce(text, '')")},
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), word AS (
    SELECT r, lang, source, unnest(terms) AS term FROM doc
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), whole AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), held AS (
    SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), grp AS (
    SELECT lang, source, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN held USING (lang, source) GROUP BY lang, source
), p AS (
    SELECT lang, source, term, coalesce(n, 0) AS n,
           CAST(1 + (1000000000 * (coalesce(n, 0) + 1)) // (total + v) AS BIGINT) AS p,
           CAST(1 + (1000000000 * (lang_n + 1)) // (lang_total + v) AS BIGINT) AS q
    FROM grp JOIN whole USING (lang) JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), item AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM item
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
