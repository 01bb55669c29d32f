"""Registered queries of the operators, on the given tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_folder, scratch_folder, table

SURROGATE_KEY = "registered query"  # a production run passes a secret of its own
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), vocabulary_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op1_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    root = scratch_folder(spark)  # goes with the session
    warc.write_monolithic(warc.records(table(spark, sf_dir, "pages"), min_bytes=0), f"{root}/monolithic")
    warc.normalise(spark, f"{root}/monolithic", f"{root}/members").write.parquet(f"{root}/archives")
    delete_folder(spark, f"{root}/monolithic")
    return warc.read_records(spark, f"{root}/members").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op4_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linkgraph import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)


def op5_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import prefix_targets, read_back

    said = "\\### Assistant: </turn> ok"
    extra = spark.sql("select -7L as conv_id, turn, role, :said as text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)",
                      args={"said": said})
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(prefix_targets(rows))


def op6_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, learn

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .surrogates import replace_entities

    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), key=SURROGATE_KEY)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_key_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import COUNTS, judge

    return judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).select(
        "doc_id", *COUNTS, "base_failed", "kept", "score")


def op11_ppm_code_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import ppm_scores

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return ppm_scores(table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_token_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .crosstok import align

    docs, _ = align(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"),
                    vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op13_vertical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hardneg import mine

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
        F.col("label")).alias("label"))
    return mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_qgram_decontamination": op1_qgram_decontamination,
    "op2_gzip_normaliser": op2_gzip_normaliser,
    "op3_sum_of_squares_packing": op3_sum_of_squares_packing,
    "op4_link_graph": op4_link_graph,
    "op5_prefix_targets": op5_prefix_targets,
    "op6_prefix_tree_join": op6_prefix_tree_join,
    "op7_viterbi_language": op7_viterbi_language,
    "op8_surrogates": op8_surrogates,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_ppm_code_length": op11_ppm_code_length,
    "op12_token_incidence": op12_token_incidence,
    "op13_vertical_scan": op13_vertical_scan,
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def _escaped(column: str, marks: str) -> str:
    for mark in marks:
        column = f"replace({column}, '{mark}', '\\{mark}')"
    return column


# The i-th group of five bits of the 160-bit hexadecimal number h, as a base32 digit.
_BASE32_DIGITS = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, {1 + 5 * (i // 4)}, 5) AS BIGINT) "
                  f">> {15 - 5 * (i % 4)}) & 31 AS INT), 1)" for i in range(32)]

ORACLE: dict[str, str] = {
    "op2_gzip_normaliser": f"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages),
digested AS (
    SELECT *, {" || ".join(_BASE32_DIGITS)} AS payload_digest
    FROM hashed),
firsts AS (SELECT h, min(page_id) AS first_id FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digested JOIN firsts USING (h)""",
    "op5_prefix_targets": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
sized AS (
    SELECT *, length('### : </turn>x') + length({_escaped("role", chr(92) + "#<:")}) + length({_escaped("text", chr(92) + "#<")}) AS size
    FROM turns),
summed AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
    FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id""",
    "op9_line_dedup": f"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
frequent AS (
    SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (k) GROUP BY doc_id""",
    "op13_vertical_scan": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
    SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
        AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10""",
}
