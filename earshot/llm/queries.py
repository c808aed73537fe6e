"""One query for each operator, in the form its users get it, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import chat, fertility, hard_negatives, host_reputation, itq, language_id, licenses, line_dedup, mixing
from earshot.llm import order_minhash, packing, spelling, warc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut into pieces that fill windows of 2048 tokens, sources at their shares."""
    return packing.pieces_digest(packing.pack(table(spark, folder, "documents")))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that three or more of them share."""
    return line_dedup.lines_digest(line_dedup.dedup_lines(table(spark, folder, "documents")))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations formatted with a loss mask and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chats_digest(chat.format_chats(turns.unionByName(chat.planted_turns(turns))))


def op4_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Quality counts, fertility and verdict of every document."""
    return fertility.quality(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "chars_per_token",
        "byte_share",
        "token_entropy",
        "reasons",
    )


def op5_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every draw of the mixture in which no source is read more than four times as often as another."""
    mixed = mixing.mix(table(spark, folder, "documents"), max_repeats=4.0)
    return mixed.select("doc_id", "source", "tokens", "weight", "epoch", "block", "place")


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(spark, folder, "documents")).drop("matches")


def op7_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as packaged archives and read back by ranges."""
    return warc.archive_pages(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return order_minhash.duplicate_classes(table(spark, folder, "documents"))


def op9_itq_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of near-equal vectors."""
    return itq.near_vectors(table(spark, folder, "embeddings"))


def op10_kneser_ney_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return language_id.identify(table(spark, folder, "documents"))


def op11_l2ap_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector has the next label instead."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_bloom_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants among the corpus's words, one run in 31 of which loses a letter first."""
    words = spelling.corpus_words(table(spark, folder, "documents"), least_chars=7, least_count=2, damage=31)
    return spelling.variants(words, ratio=10)


#: The rules of op13, as (verdict, host and path).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op13_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page's url. The given tables label documents, not pages; a label is taken as
    the outcome of the page of the same number."""
    judged = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), F.when(judged, bad).alias("bad"))
    return host_reputation.judge_urls(table(spark, folder, "pages"), outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_line_dedup,
        op3_chat_formatting,
        op4_tokeniser_fertility,
        op5_temperature_mixing,
        op6_license_scan,
        op7_warc_zip,
        op8_order_minhash,
        op9_itq_near_vectors,
        op10_kneser_ney_language_id,
        op11_l2ap_hard_negatives,
        op12_bloom_spelling_variants,
        op13_host_reputation,
    )
}

#: White space of ASCII, for trim() in SQL.
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2_SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
    FROM documents
), keyed AS (
    SELECT doc_id, i, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM lines
), common AS (
    SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, c.owner IS NOT NULL AND c.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

#: The template's control strings, escapes and merging, as the operator writes them.
OP3_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), parts AS (
    SELECT *, row_number() OVER w AS i,
           coalesce(lag(role) OVER w = role, false) AS goes_on, coalesce(lead(role) OVER w = role, false) AS more
    FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sized AS (
    SELECT *, length(replace(replace(text, '\', '\0'), '<|', '\1'))
              + CASE WHEN goes_on THEN length('<|turn|>')
                     ELSE length('<|role|><|text|>') + length(replace(replace(role, '\', '\0'), '<|', '\1')) END
              + CASE WHEN more THEN 0 ELSE length('<|end|>') END AS chars
    FROM parts
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP7_SQL = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), kept AS (
    SELECT payload, max(page_id) AS kept FROM hashed GROUP BY payload
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST((CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER),
               1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM hashed JOIN kept USING (payload)
"""

OP11_SQL = """
WITH taking AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM taking a JOIN taking r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, positive_score,
       s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 5
"""


def _level_sql(name: str, children: str) -> str:
    """Posteriors of one level: `children` with labelled, bad and the parent's mean, mu."""
    return f"""
{name}_fit AS (
    SELECT CASE WHEN more > 0 THEN 1 / greatest(1e-4, least(0.5, (square - one) / more)) - 1 ELSE 10.0 END AS s
    FROM (SELECT sum((bad - labelled * mu) * (bad - labelled * mu) / labelled) FILTER (WHERE labelled > 0) AS square,
                 sum(mu * (1 - mu)) FILTER (WHERE labelled > 0) AS one,
                 sum(mu * (1 - mu) * (labelled - 1)) FILTER (WHERE labelled > 0) AS more
          FROM {children})
), {name}_known AS (
    SELECT *, mu * s + bad AS a, (1 - mu) * s + labelled - bad AS b FROM {children}, {name}_fit
)"""


OP13_SQL = f"""
WITH parsed AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), judged AS (
    SELECT doc_id, max(CAST(coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS INTEGER)) AS bad
    FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), counted AS (
    SELECT host, count(bad) AS labelled, count(*) FILTER (WHERE bad = 1) AS bad
    FROM parsed LEFT JOIN judged ON page_id = doc_id GROUP BY host
), split AS (
    SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '[.]?(:[0-9]*)?$', ''), '.') AS p,
           regexp_matches(host, '^([0-9]+[.])+[0-9]+(:[0-9]*)?$|^\\[') AS address
    FROM counted
), wide AS (
    SELECT *, CASE WHEN regexp_matches(p[-1], '^[a-z]{{2}}$') AND len(p) > 2
                    AND p[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS width
    FROM split
), hosts AS (
    SELECT host, labelled, bad,
           CASE WHEN address THEN host ELSE array_to_string(p[greatest(len(p) - width, 1):], '.') END AS domain,
           CASE WHEN address THEN '' ELSE array_to_string(p[greatest(len(p) - width + 1, 1):], '.') END AS suffix
    FROM wide
), domains AS (
    SELECT domain, suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM hosts GROUP BY domain, suffix
), suffixes AS (
    SELECT suffix, labelled, bad, (sum(bad) OVER () + 0.5) / (sum(labelled) OVER () + 1) AS mu
    FROM (SELECT suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM domains GROUP BY suffix)
), {_level_sql("suffix", "suffixes")}, below_suffix AS (
    SELECT domains.*, a / (a + b) AS mu FROM domains JOIN suffix_known USING (suffix)
), {_level_sql("domain", "below_suffix")}, below_domain AS (
    SELECT host, h.labelled, h.bad, a / (a + b) AS mu FROM hosts h JOIN domain_known USING (domain)
), {_level_sql("host", "below_domain")}, blocked AS (
    SELECT host FROM host_known WHERE a / (a + b) - 3 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5
), rules(verdict, name, start) AS (
    VALUES {", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)}
), ruled AS (
    SELECT parsed.*, (SELECT max(struct_pack(n := length(name || start), h := length(name), rule := name || start, verdict := verdict))
                      FROM rules WHERE (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)) AS best
    FROM parsed
)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

LLM_ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_chat_formatting": OP3_SQL,
    "op7_warc_zip": OP7_SQL,
    "op11_l2ap_hard_negatives": OP11_SQL,
    "op13_host_reputation": OP13_SQL,
}
