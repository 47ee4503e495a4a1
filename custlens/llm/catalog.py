"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm import (
    chat,
    decontamination,
    exact_dedup,
    line_dedup,
    packing,
    phrases,
    prefix_trie,
    quality,
    recurrent_lm,
    ring_shards,
    secret_scan,
    simhash,
    token_files,
)
from custlens.llm.tokens import public_tokenizer
from custlens.session import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query(
    r"""WITH turns AS (
          SELECT conv_id, turn, role, text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        ordered AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
          FROM turns),
        sized AS (
          SELECT *, sum(20 + length(regexp_replace(replace(role, '\', '\\'), '(<)(/?s>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g'))
                     + length(regexp_replace(replace(text, '\', '\\'), '(<)(/?s>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')))
                    OVER (PARTITION BY conv_id ORDER BY n) AS chars,
                 n = max(n) OVER (PARTITION BY conv_id) AS complete
          FROM ordered)
        SELECT conv_id, max(n) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) FILTER (WHERE role = 'assistant' OR complete) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id"""
)
def op3_prefix_target_chat(spark, folder):
    quoted = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{quoted}'), (-1L, 1L, 'assistant', '{quoted}') AS t(conv_id, turn, role, text)")
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select(*extra.columns)
    return chat.read_back(stage(chat.examples(turns.unionAll(extra)), "chat", compression="zstd"))


@query()
def op5_ring_shards(spark, folder):
    sharded = ring_shards.shard_rows(documents(spark, folder))
    return sharded.selectExpr("doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard")


@query(
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op7_quotient_dedup(spark, folder):
    return exact_dedup.exact_groups(documents(spark, folder))


@query()
def op1_simhash_bktree(spark, folder):
    return simhash.simhash_components(documents(spark, folder))


@query()
def op4_winnowing(spark, folder):
    return decontamination.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query()
def op2_elias_fano_tokens(spark, folder):
    return token_files.read_tokens(token_files.write_tokens(documents(spark, folder), public_tokenizer("byte_bpe_50k.json")))


@query()
def op6_nnls_packing(spark, folder):
    return packing.pack(documents(spark, folder), public_tokenizer("byte_bpe_50k.json"))


@query()
def op8_bradley_terry(spark, folder):
    return quality.quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query()
def op10_grammar_secrets(spark, folder):
    return secret_scan.scan_secrets(documents(spark, folder))


@query()
def op9_recurrent_lm(spark, folder):
    return recurrent_lm.score_documents(documents(spark, folder))


@query(
    r"""WITH turns AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
        shared AS (
          SELECT conv_id, conv_id - conv_id % 100 AS base,
                 xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(unicode(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
                       lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0],
                         lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))),
                     CAST(4294967295 AS BIGINT)) % 6 AS h
          FROM (SELECT DISTINCT conv_id FROM turns)),
        rebuilt AS (
          SELECT s.conv_id, 0 AS part, t.pos, t.role, t.text FROM shared s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.h
          UNION ALL
          SELECT s.conv_id, 1, t.pos, t.role, t.text FROM shared s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h),
        digests AS (SELECT *, sha256(length(role) || ':' || role || text) AS digest FROM rebuilt),
        lists AS (
          SELECT s.conv_id, coalesce(list(d.digest ORDER BY part, pos) FILTER (WHERE d.digest IS NOT NULL), []) AS ids,
                 coalesce(list(length(d.text) ORDER BY part, pos) FILTER (WHERE d.digest IS NOT NULL), []) AS chars
          FROM shared s LEFT JOIN digests d USING (conv_id) GROUP BY 1),
        prefixes AS (
          SELECT conv_id, d AS depth, sha256(array_to_string(ids[1:d], ',')) AS key,
                 CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], ',')) END AS up,
                 CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, d = len(ids) AS ends,
                 [sha256(array_to_string(ids[1:e], ',')) FOR e IN range(0, d + 1)] AS above
          FROM lists, unnest(range(0, len(ids) + 1)) AS u(d)),
        nodes AS (
          SELECT key, any_value(up) AS up, any_value(depth) AS depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
                 any_value(chars) * (count(*) - 1) AS saved,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM prefixes GROUP BY key),
        children AS (SELECT up AS key, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
        sums AS (
          SELECT a.key, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum(saved) AS saved
          FROM (SELECT key AS node, saved, unnest(above) AS key FROM nodes) a LEFT JOIN children c ON c.key = a.node GROUP BY a.key)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON p.key = n.up"""
)
def op11_ternary_prefix_trie(spark, folder):
    return prefix_trie.conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    rf"""WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[.,;:!?
-
]')) AS piece
          FROM documents),
        lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS words FROM pieces),
        grams AS (
          SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
          FROM lists, unnest([1, 2, 3, 4]) AS u(m), unnest(range(1, len(words) - m + 2)) AS v(i)),
        f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
        found AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE m > 1 AND a >= 30),
        cuts AS (
          SELECT c.lang, c.phrase, c.a, k, p.a AS l, s.a AS r,
                 CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(p.a AS HUGEINT) + s.a) AS BIGINT) AS score
          FROM found c, unnest(range(1, c.m)) AS u(k)
          JOIN f p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1:k], ' ')
          JOIN f s ON s.lang = c.lang AND s.phrase = array_to_string(c.w[k + 1:], ' ')),
        lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
        inside AS (
          SELECT lang, array_to_string(w[i:i + m2 - 1], ' ') AS phrase, max(a) AS most
          FROM found, unnest([2, 3]) AS u(m2), unnest(range(1, m - m2 + 2)) AS v(i) WHERE m2 < m GROUP BY ALL),
        kept AS (
          SELECT lang, phrase, a, l, r, score FROM lowest LEFT JOIN inside USING (lang, phrase)
          WHERE place = 1 AND (most IS NULL OR 100 * most < 80 * a)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
)
def op12_double_array_phrases(spark, folder):
    return phrases.collocations(documents(spark, folder))


@query(
    rf"""WITH lines AS (
          SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LETTERS}) AS key
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
                FROM documents)),
        keepers AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT l.*, k.keeper IS NOT NULL AND l.doc_id <> k.keeper AS dropped FROM lines l LEFT JOIN keepers k USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id"""
)
def op13_line_bitmaps(spark, folder):
    kept = line_dedup.drop_repeated_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
