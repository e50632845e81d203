"""One query for each operator of this folder, over whole tables, and its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import (
    decontaminate,
    langid,
    licenses,
    minhash,
    mixing,
    piecebpe,
    prefixtrie,
    preferences,
    quality,
    recompress,
    sqlchecks,
    suffixes,
    tokencounts,
    turnrepair,
)
from ridelake.llm.steps import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with a stale reply; masks as ``start:length`` lists."""
    turns = preferences.stale_replies(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    pairs = preferences.format_pairs(turns)

    def listed(mask: str) -> F.Column:
        return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"], m["length"])), ",").alias(mask)

    return pairs.select("pair_id", "n_common", "prompt", "chosen", listed("chosen_mask"), "rejected", listed("rejected_mask"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(documents(spark, sf_dir))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _judged(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    judged = quality.judge(quality.ledger(documents(spark, sf_dir)), version)
    failed = F.col("failed").bitwiseAND(F.lit(quality.mask(quality.POLICIES[version])).cast("long")).alias("failed")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed, "base_failed", "kept"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy 3, with customary bounds."""
    return _judged(spark, sf_dir, 3)


def op5_quality_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under the name it had before it became the rule."""
    return op5_quality_rules(spark, sf_dir)


def op5_quality_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy 2, for comparison: what the loose bounds let through."""
    return _judged(spark, sf_dir, 2)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = recompress.remove_repeats(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), similarity=85)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.histogram(documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return done.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after a pseudo-random damage, repaired at least cost."""
    return turnrepair.repair(turnrepair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the merges of a public vocabulary of 32,000 pieces, and decoded again."""
    import public_tokenizers

    done = piecebpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each begun with turns lent by the first of its hundred."""
    return prefixtrie.lent_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_language_id,
        op2_chat_format,
        op3_mix_sources,
        op4_suffix_dedup,
        op5_quality_rules,
        op5_quality_strict,
        op5_quality_loose,
        op6_substring_dedup,
        op7_license_scan,
        op8_near_dedup,
        op9_token_counts,
        op10_decontaminate,
        op11_conversation_repair,
        op12_sentencepiece,
        op13_prefix_trie,
    )
}

_CHAT = r"""
WITH replies AS (
  SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
  FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL),
ends AS (
  SELECT conv_id, max(turn) FILTER (back = 1) AS last, max(text) FILTER (back = 2) AS stale, count(*) > 1 AS has
  FROM replies GROUP BY conv_id),
sides AS (
  SELECT conv_id, 'chosen' AS side, turn, role, text FROM conversations JOIN ends USING (conv_id) WHERE turn <= last
  UNION ALL
  SELECT conv_id, 'rejected', turn, role, CASE WHEN turn = last THEN stale ELSE text END
  FROM conversations JOIN ends USING (conv_id) WHERE turn < last OR (turn = last AND has)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS place FROM sides),
met AS (
  SELECT conv_id, place, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS equal FROM placed GROUP BY conv_id, place),
common AS (
  SELECT conv_id, coalesce(min(place) FILTER (NOT equal), max(place) + 1) - 1 AS n_common FROM met GROUP BY conv_id),
bodies AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body, length(role) + 5 AS head
  FROM placed JOIN common USING (conv_id)),
after AS (
  SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY conv_id, side ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
  FROM bodies WHERE place > n_common),
prompts AS (
  SELECT conv_id, string_agg(body, '' ORDER BY place) AS prompt FROM bodies WHERE place <= n_common AND side = 'chosen' GROUP BY conv_id),
completions AS (
  SELECT conv_id, side, string_agg(body, '' ORDER BY place) AS body,
    coalesce(string_agg((begun + head)::VARCHAR || ':' || (length(body) - head)::VARCHAR, ',' ORDER BY place)
      FILTER (role = 'assistant'), '') AS mask
  FROM after GROUP BY conv_id, side)
SELECT c.conv_id AS pair_id, n_common::BIGINT AS n_common, coalesce(prompt, '') AS prompt,
  coalesce(a.body, '') AS chosen, coalesce(a.mask, '') AS chosen_mask,
  coalesce(r.body, '') AS rejected, coalesce(r.mask, '') AS rejected_mask
FROM common c
LEFT JOIN prompts p ON p.conv_id = c.conv_id
LEFT JOIN completions a ON a.conv_id = c.conv_id AND a.side = 'chosen'
LEFT JOIN completions r ON r.conv_id = c.conv_id AND r.side = 'rejected'
"""

_QUALITY_LOOSE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (
  SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
w AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS win FROM t, unnest(range(1, greatest(len(words) - 3, 1))) AS r(i) WHERE len(words) >= 5),
twice AS (SELECT doc_id, win FROM w GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM w JOIN twice USING (doc_id, win), range(0, 5) AS r(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM l LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (n_symbols > n_words)::BIGINT
    + 8 * (2 * n_dup_lines > n_lines)::BIGINT + 16 * (word_chars > 100 * n_words)::BIGINT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""

#: The same measurements under the bounds of policy 3.
_QUALITY_STRICT = _QUALITY_LOOSE.partition("f AS (")[0] + r"""f AS (
  SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 32 * (10 * n_symbols > n_words)::BIGINT
    + 64 * (10 * n_dup_lines > 3 * n_lines)::BIGINT + 128 * (word_chars < 3 * n_words)::BIGINT
    + 256 * (word_chars > 10 * n_words)::BIGINT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""

_SUBSTRINGS = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, list_slice(words, i, i + 12) AS win FROM t, unnest(range(1, greatest(len(words) - 11, 1))) AS r(i) WHERE len(words) >= 13),
least AS (SELECT win, min(doc_id) AS first FROM w GROUP BY win),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM w JOIN least USING (win), range(0, 13) AS r(k) WHERE first < doc_id),
lost AS (SELECT doc_id, count(*) AS n, list(i) AS places FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ')
    ELSE array_to_string(list_filter(words, lambda x, i: NOT list_contains(places, i)), ' ') END) AS kept_sha256
FROM t LEFT JOIN lost USING (doc_id)
"""

_NEAR = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE list_slice(words, i, i + 4) END AS shingle
  FROM t, unnest(range(1, greatest(len(words) - 3, 2))) AS r(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, to_) AS (
  SELECT doc_id, doc_id FROM t UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.to_),
least AS (SELECT doc_id, min(to_) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

_LEAKS = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + 9) AS win FROM b, unnest(range(1, greatest(len(words) - 8, 2))) AS r(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT len(win) AS k FROM bw),
dw AS (
  SELECT doc_id, i, list_slice(words, i, i + k - 1) AS win, k FROM d, sizes, unnest(range(1, greatest(len(words) - k + 2, 1))) AS r(i)
  WHERE len(words) >= k),
hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (win)),
words_hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, k)) AS r(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Cross-parsing, mixing by a hash, byte windows, licence templates and tokenizers are tested by brute force or against a library.
ORACLE: dict[str, str] = {
    "op2_chat_format": _CHAT,
    "op5_quality_rules": _QUALITY_STRICT,
    "op5_quality_strict": _QUALITY_STRICT,
    "op5_quality_loose": _QUALITY_LOOSE,
    "op6_substring_dedup": _SUBSTRINGS,
    "op8_near_dedup": _NEAR,
    "op10_decontaminate": _LEAKS,
    "op11_conversation_repair": sqlchecks.REPAIR,
    "op13_prefix_trie": sqlchecks.TRIE,
}
