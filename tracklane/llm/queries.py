"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane.llm import chat, decontaminate, html_wrapper, jaccard, language, merkle, mixing, periodic, repeats, simhash, tokens, toxicity, url_filter
from tracklane.llm.common import crc32, fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: host, path and verdict of the rules that op10 judges by.
URL_RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
TOKENIZER = "word_bpe_49k.json"


def query(run):
    QUERIES[run.__name__] = run
    return run


def _held_out(folds: int, own: int):
    """Whether a document is in the fold that nothing is learned from; one without id is in none, and nothing is learned from it."""
    return F.coalesce(fold(F.col("doc_id"), folds) == own, F.lit(False)).alias("held_out")


@query
def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "found_runs", "item_runs", "coverage")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir, docs)
    scored = docs.select("doc_id", _held_out(5, 0), toxicity.toxicity(F.col("text"), model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Learned from the labelled rows of ``docs`` outside the held-out fold."""
    kept = fold(F.col("doc_id"), 5) != 0
    return toxicity.fit(docs.where(kept).select("doc_id", "text"), table(spark, sf_dir, "labels").where(kept))


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


@query
def op7_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_model(docs)
    found = docs.select("doc_id", _held_out(4, 2), language.identify(F.col("text"), model, docs).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))


def language_model(docs: DataFrame) -> language.LanguageModel:
    """Learned from the rows of ``docs`` outside the held-out fold."""
    return language.fit(docs.where((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull()))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_drop_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.drop_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


@F.pandas_udf(T.StringType())
def _with_period(text: pd.Series, seed: pd.Series) -> pd.Series:
    """From word a on, a text repeats its words from there; a and the period follow from the seed."""

    def planted(text: str, g: int) -> str:
        words = periodic.split_words(text)
        n = len(words)
        if not n:
            return text
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + [words[a + i % period] for i in range(n - a)]).decode("utf-8", "surrogatepass")

    return pd.Series([None if t is None else planted(t, int(g)) for t, g in zip(text, seed, strict=True)], dtype=object)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, code = table(spark, sf_dir, "documents"), crc32(F.col("doc_id"))
    # The function sees the texts it changes only.
    chosen = F.when(code % 10 == 0, F.col("text"))
    text = F.coalesce(_with_period(chosen, F.coalesce(F.floor(code / 10), F.lit(0))), F.col("text"))
    return periodic.collapse_runs(docs.select("doc_id", text.alias("text"))).drop("collapsed")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document proved against the root; where 5 divides crc32 of the id, the text to be proved has lost its capitals."""
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(fold(F.col("doc_id"), 5) == 0, small).otherwise(F.col("text"))
    return merkle.verify(table(spark, sf_dir, "documents"), claimed=tampered)


#: crc32 of a number's decimal digits.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: xor(x >> 1, (x & 1) * 3988292384)))"""
CRC32 = lambda key: f"xor({_CRC.format(f'CAST({key} AS VARCHAR)')}, 4294967295)"

ORACLE_SQL = {
    "op1_chat_perspectives": """
        WITH cast_of AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
        turned AS (
            SELECT c.conv_id, perspective, turn, role AS speaker,
                   CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user' END AS said_as,
                   replace(coalesce(text, ''), '<|im_', '<\\|im_') AS content
            FROM conversations c JOIN cast_of p ON c.conv_id IS NOT DISTINCT FROM p.conv_id),
        named AS (SELECT *, CASE WHEN said_as = 'user' THEN coalesce(speaker, 'unknown') END AS name FROM turned),
        headed AS (
            SELECT *, '<|im_start|>' || said_as
                      || CASE WHEN name IS NULL THEN '' ELSE ' name=' || regexp_replace(name, '[\\s<>|]+', '_', 'g') END || chr(10) AS head
            FROM named)
        SELECT conv_id, perspective, turn, speaker, said_as AS role, name, head || content || '<|im_end|>' || chr(10) AS segment,
               CASE WHEN said_as = 'assistant' THEN 1 ELSE 0 END AS mask,
               length(head) AS content_start, length(head) + length(content) AS content_end
        FROM headed""",
    "op10_url_filter": """
        WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE NULL END AS rest FROM pages),
        ended AS (
            SELECT page_id, rest, least(
                CASE WHEN strpos(rest, '/') > 0 THEN strpos(rest, '/') ELSE length(rest) + 1 END,
                CASE WHEN strpos(rest, '?') > 0 THEN strpos(rest, '?') ELSE length(rest) + 1 END,
                CASE WHEN strpos(rest, '#') > 0 THEN strpos(rest, '#') ELSE length(rest) + 1 END) AS stop
            FROM cut),
        parts AS (
            SELECT page_id, coalesce(translate(left(rest, stop - 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(split_part(split_part(substr(rest, stop), '?', 1), '#', 1), '') AS path
            FROM ended),
        rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fit AS (
            SELECT p.page_id, p.host, p.path, r_host || r_path AS rule, r_verdict,
                   row_number() OVER (PARTITION BY p.page_id ORDER BY length(r_host) + length(r_path) DESC) AS place
            FROM parts p LEFT JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path))
        SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM fit WHERE place = 1""",
    "op11_drop_repeats": """
        WITH given AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i, len(w) AS n FROM given),
        windows AS (
            SELECT doc_id, i, n, CASE WHEN i + 20 <= n THEN string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS spelled, word
            FROM words),
        met AS (SELECT *, spelled IS NOT NULL AND row_number() OVER (PARTITION BY spelled ORDER BY doc_id, i) > 1 AS late FROM windows),
        covered AS (SELECT doc_id, i, word, bool_or(late) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM met),
        kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS left_over FROM covered GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
        FROM given LEFT JOIN kept USING (doc_id)""",
    "op12_periodic_runs": f"""
        WITH given AS (
            SELECT doc_id, {CRC32("doc_id")} AS h, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
        sized AS (SELECT doc_id, h, words, len(words) AS n, h // 10 AS g FROM given),
        shaped AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
        texts AS (
            SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE words END AS w
            FROM shaped),
        spots AS (SELECT doc_id, n, w, unnest(range(1, n // 2 + 1)) AS q FROM texts),
        same AS (SELECT doc_id, q, unnest(list_filter(range(0, n - q), lambda i: w[i + 1] = w[i + q + 1])) AS i FROM spots),
        islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
        stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
        runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        left_over AS (
            SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts) t ANTI JOIN gone USING (doc_id, i) GROUP BY t.doc_id),
        digests AS (
            SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256,
                   first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS longest
            FROM runs GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
               1000 * longest.length // longest.period AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM texts LEFT JOIN digests USING (doc_id) LEFT JOIN left_over USING (doc_id)""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE tagged AS (
            SELECT doc_id, source, text, {CRC32("doc_id")} % 5 = 0 AS changed,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small
            FROM documents),
        leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN changed THEN sha256(head || coalesce(strlen(small) || ':' || small, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claim,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
            FROM tagged),
        up AS (
            SELECT 0 AS level, source, pos, n, leaf AS node FROM leaves
            UNION ALL
            SELECT level + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
            FROM up WHERE n > 1 GROUP BY level, source, pos // 16, n),
        subroots AS (
            SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS level, pos, n, subroot AS node FROM subroots
            UNION ALL
            SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16, n),
        steps AS (
            SELECT l.doc_id, u.level, coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos < l.pos >> (4 * u.level)), '') AS before,
                   coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos > l.pos >> (4 * u.level)), '') AS behind
            FROM leaves l JOIN up u ON l.source IS NOT DISTINCT FROM u.source AND u.n > 1 AND u.pos >> 4 = l.pos >> (4 * u.level + 4)
            GROUP BY l.doc_id, u.level
            UNION ALL
            SELECT l.doc_id, 100 + t.level, coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos < s.pos >> (4 * t.level)), ''),
                   coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos > s.pos >> (4 * t.level)), '')
            FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n > 1 AND t.pos >> 4 = s.pos >> (4 * t.level + 4)
            GROUP BY l.doc_id, t.level),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS step FROM steps),
        folded AS (
            SELECT doc_id, 0 AS step, claim AS node FROM leaves
            UNION ALL
            SELECT f.doc_id, s.step, sha256(before || node || behind) FROM folded f JOIN numbered s ON s.doc_id = f.doc_id AND s.step = f.step + 1),
        proofs AS (SELECT doc_id, sha256(coalesce(string_agg(before || behind, '' ORDER BY step), '')) AS proof_sha256 FROM numbered GROUP BY doc_id)
        SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.node AS verified
        FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source CROSS JOIN (SELECT node FROM top WHERE n = 1) r
        LEFT JOIN proofs p ON p.doc_id = l.doc_id
        JOIN (SELECT doc_id, arg_max(node, step) AS node FROM folded GROUP BY doc_id) f ON f.doc_id = l.doc_id""",
}
