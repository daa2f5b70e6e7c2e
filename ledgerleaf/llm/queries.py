"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality_rules as rules
from .bpe import bpe_round_trip
from .chat_tools import link_tool_calls
from .embedding_dedup import embedding_dedup
from .html_extraction import main_text
from .line_dedup import line_dedup
from .lm_scoring import lm_scores
from .minhash_dedup import minhash_dedup
from .packing import pack
from .phrases import collocations
from .spelling import spelling_variants
from .substring_dedup import substring_dedup
from .warc import warc_round_trip

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_bad_lines", "kept")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings")).drop("embedding", "label")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


END_ID = 2  # follows each document's ids


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe_round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


#: What the calls below carry; the system turn may state its length.
CHAT_SCHEMAS = {
    "user": {"text": ("string", True), "turn": ("integer", True), "chars": ("integer", True)},
    "system": {"text": ("string", True), "turn": ("integer", True)},
}


def op9_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn that an assistant may answer is a call; the assistant's turn after it is its result; a call builds on that two turns before.

    By the conversation's number, calls are also spoilt: in rings, of an unknown tool, without arguments or with broken,
    incomplete and mistyped ones, and repeated; results without a call, and second results.
    """
    turns = _table(spark, sf_dir, "conversations")
    call = lambda turn: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), turn)
    kind, many = F.col("conv_id") % 8, F.col("conv_id") % 16
    good = F.to_json(F.struct("turn", "text", F.length("text").alias("chars")))
    calls = turns.where(F.coalesce(F.col("role") != "assistant", F.lit(True))).select(
        "conv_id",
        call(F.col("turn")).alias("call_id"),
        F.when((kind == 1) & (F.col("turn") == 0), call(F.lit(2))).when(F.col("turn") >= 2, call(F.col("turn") - 2)).alias("parent_id"),
        "turn",
        F.when(kind == 2, "other").otherwise(F.col("role")).alias("name"),
        F.when(kind == 3, F.lit(None))
        .when(kind == 4, F.concat(F.lit("no "), good))
        .when(kind == 5, F.to_json(F.struct("turn", F.length("text").alias("extra"))))
        .when(kind == 6, F.to_json(F.struct(F.col("turn").cast("string").alias("turn"), "text", F.lit(0.5).alias("chars"))))
        .otherwise(good)
        .alias("arguments"),
    )
    calls = calls.unionByName(calls.where(kind == 7).withColumn("turn", F.col("turn") + 100))
    results = turns.where(F.col("role") == "assistant").select("conv_id", F.when(many == 9, F.concat(F.lit("lost-"), "conv_id")).otherwise(call(F.col("turn") - 1)).alias("call_id"), "turn", F.col("text").alias("content"))
    results = results.unionByName(results.where(many == 10).withColumn("turn", F.col("turn") + 50))
    return link_tool_calls(calls, results, CHAT_SCHEMAS)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of runs of two lines or more, and of single lines of 13 words, as many as a passage of op1."""
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=13)
    return out.select("doc_id", "n_lines", "n_removed_lines", F.sha2("clean_text", 256).alias("clean_sha256"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_chat_tools": op9_chat_tools,
    "op10_line_dedup": op10_line_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_spelling": op12_spelling,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op13_phrases": r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
p AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM piece),
win AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase FROM p, unnest([1, 2, 3, 4, 5]) AS h(m), unnest(generate_series(1, len(w) - m + 1)) AS g(i)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM win GROUP BY ALL), total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE a >= 100),
cut AS (SELECT c.lang, c.phrase, c.a, n, k, l.a AS l, r.a AS r, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score FROM c, unnest(generate_series(1, c.m - 1)) AS g(k) JOIN total ON total.lang = c.lang
  JOIN c l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, k), ' ') JOIN c r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase, max(a) AS longer FROM c, unnest(generate_series(2, m - 1)) AS h(s), unnest(generate_series(1, m - s + 1)) AS g(i) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM low LEFT JOIN part USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a QUALIFY rank <= 2000""",
    "op1_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s FROM d, unnest(generate_series(1, len(w) - 12)) AS g(i)),
least AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN least USING (s), unnest(generate_series(0, 12)) AS h(j) WHERE first_doc < doc_id),
word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(generate_series(1, len(w))) AS g(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op2_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM d, unnest(generate_series(1, len(w) - 2)) AS g(i)),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM often, unnest([0, 1, 2]) AS h(j) WHERE n > 1 GROUP BY doc_id),
line AS (SELECT doc_id, x, len(x) - len(replace(x, ' ', '')) + 1 AS n, len(x) - len(regexp_replace(x, '[{rules.SYMBOLS}]', '', 'g')) AS sym
         FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)),
ok AS (SELECT doc_id, x, regexp_matches(x, '{rules.HAS_WORD}') AS worded,
         regexp_matches(x, '{rules.SENTENCE.replace("'", "''")}') AND (len(x) - len(replace(x, '|', ''))) * 5 <= n AND sym * 10 <= n
         AND NOT (NOT regexp_matches(x, '\p{{Ll}}') AND regexp_matches(x, '(\p{{Lu}}[^\p{{Lu}}]*){{8}}')) AND NOT regexp_matches(x, '{rules.BOILERPLATE}') AS good FROM line),
per AS (SELECT doc_id, count(*) FILTER (worded) - count(DISTINCT x) FILTER (worded) AS dup, count(*) FILTER (worded AND NOT good) AS bad,
         coalesce(sum(len(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))) FILTER (good), 0) AS left_chars FROM ok GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '[{rules.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols, CAST(dup AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(bad AS BIGINT) AS n_bad_lines, left_chars FROM d JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_bad_lines,
       NOT base_failed AND 1 - left_chars / greatest(word_chars, 1) <= {rules.MAX_LOSS} AS kept FROM b""",
    "op10_line_dedup": r"""
WITH line AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS x FROM documents, unnest(generate_series(1, len(string_split(text, chr(10))))) AS g(i)),
w AS (SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
pair AS (SELECT a.doc_id, a.n, a.x || chr(10) || b.x AS s FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.n = a.n + 1),
least AS (SELECT doc_id, n, min((doc_id, n)) OVER (PARTITION BY s) AS first FROM pair),
alone AS (SELECT doc_id, n, min((doc_id, n)) OVER (PARTITION BY x) AS first FROM w WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 13),
gone AS (SELECT doc_id, n + j AS n FROM least, unnest([0, 1]) AS h(j) WHERE (doc_id, n) > first UNION SELECT doc_id, n FROM alone WHERE (doc_id, n) > first),
kept AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS t FROM line l LEFT JOIN w USING (doc_id, i) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.n = w.n WHERE g.n IS NULL GROUP BY l.doc_id),
size AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(size.n, 0) AS n_lines, coalesce(lost.n, 0) AS n_removed_lines, CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS clean_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN size USING (doc_id) LEFT JOIN lost USING (doc_id)""",
    "op9_chat_tools": r"""
WITH RECURSIVE base AS (SELECT conv_id, turn, role, text, conv_id % 8 AS kind, 'c' || conv_id || '-' || turn AS call_id,
       CASE WHEN conv_id % 8 = 1 AND turn = 0 THEN 2 WHEN turn >= 2 THEN turn - 2 END AS up FROM conversations WHERE role <> 'assistant'),
ids AS (SELECT DISTINCT conv_id, turn, up FROM base),
heads AS (SELECT i.conv_id, i.turn, p.turn AS parent, i.up IS NOT NULL AND p.turn IS NULL AS parent_missing FROM ids i LEFT JOIN ids p ON p.conv_id = i.conv_id AND p.turn = i.up),
deep AS (SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM heads WHERE parent IS NULL UNION ALL SELECT h.conv_id, h.turn, d.depth + 1 FROM deep d JOIN heads h ON h.conv_id = d.conv_id AND h.parent = d.turn),
res AS (SELECT conv_id, CASE WHEN conv_id % 16 = 9 THEN 'lost-' || conv_id ELSE 'c' || conv_id || '-' || (turn - 1) END AS call_id, turn, text FROM conversations WHERE role = 'assistant'),
more AS (SELECT * FROM res UNION ALL SELECT conv_id, call_id, turn + 50, text FROM res WHERE conv_id % 16 = 10),
one AS (SELECT conv_id, call_id, count(*) AS n, min_by(text, (turn, text)) AS result, min((turn, text)) AS place FROM more GROUP BY ALL),
called AS (SELECT b.conv_id, b.call_id, b.turn, CASE WHEN kind = 2 THEN 'other' ELSE role END AS name, d.depth, CASE WHEN d.depth IS NULL THEN 'cycle' WHEN o.n > 0 THEN 'linked' ELSE 'no_result' END AS status,
         h.parent_missing, coalesce(o.n, 0) AS n_results, o.result, kind, text, b.turn AS said
       FROM base b JOIN heads h USING (conv_id, turn) LEFT JOIN deep d USING (conv_id, turn) LEFT JOIN one o ON o.conv_id = b.conv_id AND o.call_id = b.call_id),
again AS (SELECT conv_id, call_id, turn + 100, name, depth, 'repeated', parent_missing, 0, NULL, kind, text, turn FROM called WHERE kind = 7),
lost AS (SELECT m.conv_id, m.call_id, m.turn, CASE WHEN c.call_id IS NULL THEN 'orphan_result' ELSE 'further_result' END AS status, m.text FROM more m
         LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM base) c ON c.conv_id = m.conv_id AND c.call_id = m.call_id JOIN one o ON o.conv_id = m.conv_id AND o.call_id = m.call_id
         WHERE c.call_id IS NULL OR (m.turn, m.text) > o.place),
every AS (SELECT * FROM called UNION ALL SELECT * FROM again UNION ALL SELECT conv_id, call_id, turn, NULL, NULL, status, false, 0, text, NULL, NULL, NULL FROM lost),
checked AS (SELECT *, CASE WHEN status = 'orphan_result' THEN ['result: no call'] WHEN status = 'further_result' THEN ['result: not the first'] WHEN kind IN (3, 4) THEN ['arguments: not an object'] WHEN name NOT IN ('user', 'system') THEN ['unknown tool ' || name]
         WHEN kind = 5 AND name = 'user' THEN ['text: missing', 'chars: missing', 'extra: unknown'] WHEN kind = 5 THEN ['text: missing', 'extra: unknown'] WHEN kind = 6 AND name = 'user' THEN ['turn: not integer', 'chars: not integer']
         WHEN kind = 6 THEN ['turn: not integer', 'chars: unknown'] WHEN name = 'system' THEN ['chars: unknown'] ELSE CAST([] AS VARCHAR[]) END AS errors,
       CASE WHEN kind IN (3, 4) OR kind IS NULL THEN NULL WHEN kind = 5 THEN json_object('extra', length(text), 'turn', said) WHEN kind = 6 THEN json_object('chars', 0.5::DOUBLE, 'text', text, 'turn', CAST(said AS VARCHAR))
         ELSE json_object('chars', length(text), 'text', text, 'turn', said) END AS arguments,
       rank() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn, call_id) - 1 AS position FROM every)
SELECT conv_id, call_id, turn, position, name, depth, status, parent_missing, n_results, len(errors) = 0 AS valid, errors,
       CAST(json_object('arguments', arguments, 'call_id', call_id, 'conv_id', conv_id, 'depth', depth, 'name', name, 'result', result, 'status', status, 'turn', turn) AS VARCHAR) AS json FROM checked""",
}
