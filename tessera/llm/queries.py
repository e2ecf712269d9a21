"""Registered queries of the operators (thin: whole table in, whole result out) and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import pu_quality
from tessera.llm.bayes_join import bayes_join
from tessera.llm.chat_rotation import chat_rotation
from tessera.llm.common import documents, word_count
from tessera.llm.cube_mix import cube_mix
from tessera.llm.html_density import html_density
from tessera.llm.lang_gru import held_out, identify, train_on
from tessera.llm.mask_search import lexical_search
from tessera.llm.merkle_manifest import merkle_manifest
from tessera.llm.pii_surrogate import pii_surrogate
from tessera.llm.quality_cascade import quality_cascade
from tessera.llm.radix_dedup import normal_bytes, radix_dedup
from tessera.llm.sp_nbest import sp_encode
from tessera.llm.suffix_dedup import suffix_dedup


#: Key of the registered query's surrogates; a user of the operator passes a secret one.
SURROGATE_KEY = b"registered query"


def op1_pii_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data and secrets replaced by surrogates."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii_surrogate(docs, SURROGATE_KEY).select(
        "doc_id", "text", "n_entities", F.array_join(F.transform("entities", lambda e: e["type"]), ",").alias("types"))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the rule cascade for every document."""
    return quality_cascade(documents(spark, sf_dir).select("doc_id", "text"), carry=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_bayes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return bayes_join(documents(spark, sf_dir)).select("doc_id", "class_id", "links", "kept")


def op4_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url", "html")
    return html_density(pages, carry=False).select("page_id", "url", "text", "n_chars")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a repeated 200-byte string covers, and the digest of the rest."""
    return suffix_dedup(documents(spark, sf_dir), carry=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from the side of every participant: digest of the rendering, and its mask."""
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    span = F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string")))
    learned = F.aggregate("mask", F.lit(0), lambda acc, m: acc + m["end"] - m["start"])
    return chat_rotation(turns).select(
        "conv_id", "perspective", "part", "piece", "start", "n_turns", F.length("text").cast("long").alias("n_chars"),
        learned.cast("long").alias("n_learned"), F.array_join(span, ",").alias("mask"),
        F.sha2("text", 256).alias("text_sha256"))


def op7_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents: class, size and survivor of every row."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "text", F.sha2(normal_bytes(F.col("text")), 256).alias("text_sha256"))
    return radix_dedup(rows, carry=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_lang_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir)
    model, langs = train_on(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, model, langs, carry=False).select("doc_id", "held_out", "lang_pred", "score")


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: words each one gives."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return cube_mix(rows).select("doc_id", "size", "source_size", "target",
                                 (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op10_sp_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best segmentation of every document (digest of its ids), scores of the N best, exact round trip."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sp_encode(docs, carry=False).select(
        "doc_id", "n_pieces", "score", F.sha2("ids", 256).alias("ids_sha256"),
        F.transform("others", lambda o: o["score"]).alias("other_scores"), "round_trip")


def op11_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return lexical_search(documents(spark, sf_dir).select("doc_id", "text"), items)


def op12_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from trusted and unlabelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = pu_quality.train_on(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return pu_quality.score_quality(rows, model, carry=False).select("doc_id", "held_out", "score", "predicted")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether what a reader found folds to the root.

    Where 3 divides the id's crc32 the reader finds the text with A-Z lower-cased.
    """
    docs = documents(spark, sf_dir)
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(altered, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    return merkle_manifest(docs, seen={"text": text}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogate": op1_pii_surrogate,
    "op2_quality_cascade": op2_quality_cascade,
    "op3_bayes_join": op3_bayes_join,
    "op4_html_density": op4_html_density,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_chat_rotation": op6_chat_rotation,
    "op7_radix_dedup": op7_radix_dedup,
    "op8_lang_gru": op8_lang_gru,
    "op9_cube_mix": op9_cube_mix,
    "op10_sp_nbest": op10_sp_nbest,
    "op11_mask_search": op11_mask_search,
    "op12_pu_quality": op12_pu_quality,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LEAF = "sha256(" + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
# the crc32 of a short text: eight shifts for each of its bytes
_CRC = """xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split({0}, '')],
        lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT FOR z IN range(8)],
            lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

_TERMS = (f"regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op2_quality_cascade": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        e AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                     [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
        pos AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
                FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM e)),
        again AS (SELECT doc_id, i FROM pos QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        cover AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
                  FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
        s AS (SELECT doc_id, len(w) AS n_words,
                     length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                     len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
                     len([x FOR x IN w IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS with_letter,
                     length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS upper_letters,
                     length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS letters,
                     len([x FOR x IN w IF regexp_matches(x, '[!?.,;:]{2}$')]) AS stopped,
                     len([x FOR x IN ls IF regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')]) AS bullets,
                     len([x FOR x IN ls IF regexp_matches(x, '([.]{3}|…)[\x20\x09-\x0D]*$')]) AS ellipses
              FROM e),
        f AS (SELECT s.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM s LEFT JOIN cover USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words
                    OR word_chars < 3 * n_words OR word_chars > 10 * n_words
                    OR 2 * n_dup_lines > n_lines OR 10 * with_letter < 8 * n_words
                    OR 2 * upper_letters > letters OR 10 * stopped > 3 * n_words
                    OR 10 * bullets > 9 * n_lines OR 10 * ellipses > 3 * n_lines) AS kept
        FROM b""",
    "op6_chat_rotation": r"""
        WITH a AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, turn // 1024 AS part,
                          replace(coalesce(text, ''), '<|', '<\|') AS body FROM conversations),
        t AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, body) - 1) // 1024 AS piece FROM a),
        p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
        h AS (SELECT t.*, perspective, '<|im_start|>'
                     || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
                             ELSE 'user name=' || regexp_replace(role, '[\x20\x09-\x0D<|>=]+', '_', 'g') END
                     || chr(10) AS head
              FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
        g AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS shown FROM h),
        s AS (SELECT *, coalesce(sum(length(shown)) OVER (
                  PARTITION BY conv_id, perspective, part, piece ORDER BY turn, role, body
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s0 FROM g),
        r AS (SELECT conv_id, perspective, part, piece, count(*) AS n_turns,
                     string_agg(shown, '' ORDER BY turn, role, body) AS text,
                     coalesce(sum(length(body) + 10) FILTER (role = perspective), 0)::BIGINT AS n_learned,
                     coalesce(string_agg(s0::BIGINT::VARCHAR || '-' || (s0::BIGINT + length(body) + 10)::VARCHAR, ','
                              ORDER BY turn, role, body) FILTER (role = perspective), '') AS mask
              FROM s GROUP BY ALL)
        SELECT conv_id, perspective, part, piece, coalesce(sum(length(text)) OVER (
                   PARTITION BY conv_id, perspective ORDER BY part, piece
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, n_turns,
               length(text) AS n_chars, n_learned, mask, sha256(text) AS text_sha256
        FROM r""",
    "op11_mask_search": f"""
        WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
        s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM n),
        p AS (SELECT term, doc_id, count(*) AS tf FROM t GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
              FROM p, s GROUP BY term),
        q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        f AS (SELECT item_id, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))))::BIGINT AS score
              FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc_id), s GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM f WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_LEAF.format(text="text")} AS leaf,
                   CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 3 = 0
                        THEN {_LEAF.format(text=f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")} END AS other
            FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                     count(*) OVER (PARTITION BY tree) AS n FROM d),
        up AS (SELECT tree, 0 AS level, i, n, leaf AS h FROM r
               UNION ALL
               SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
               FROM up WHERE n > 1 GROUP BY tree, level, i // 8, n),
        kids AS (SELECT tree, level, i // 8 AS parent, list(h ORDER BY i) AS hs FROM up WHERE n > 1 GROUP BY ALL),
        walk AS (SELECT doc_id, leaf, tree, 0 AS level, i, '' AS proof, coalesce(other, leaf) AS fold FROM r
                 UNION ALL
                 SELECT doc_id, leaf, tree, level + 1, i // 8,
                        proof || array_to_string(hs[:i % 8] || hs[i % 8 + 2:], ''),
                        sha256(array_to_string(hs[:i % 8] || [fold] || hs[i % 8 + 2:], ''))
                 FROM walk JOIN kids USING (tree, level) WHERE parent = i // 8),
        sub AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
                FROM up WHERE n = 1),
        top AS (SELECT 0 AS level, i, n, h FROM sub
                UNION ALL
                SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
                FROM top WHERE n > 1 GROUP BY level, i // 8, n),
        heads AS (SELECT level, i // 8 AS parent, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY ALL),
        done AS (SELECT w.*, sub.h AS subroot, sub.i AS spot FROM walk w JOIN sub USING (tree)
                 WHERE level = (SELECT max(level) FROM up WHERE up.tree = w.tree)),
        climb AS (SELECT doc_id, leaf, subroot, 0 AS level, spot, proof, fold FROM done
                  UNION ALL
                  SELECT doc_id, leaf, subroot, level + 1, spot // 8,
                         proof || array_to_string(hs[:spot % 8] || hs[spot % 8 + 2:], ''),
                         sha256(array_to_string(hs[:spot % 8] || [fold] || hs[spot % 8 + 2:], ''))
                  FROM climb JOIN heads USING (level) WHERE parent = spot // 8)
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
        FROM climb JOIN top USING (level) WHERE n = 1""",
    "op7_radix_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORMAL} AS t, length(coalesce(text, '')) AS n FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)""",
}
