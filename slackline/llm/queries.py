"""The operators of this package as queries on the given tables, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slackline.llm import (
    decontamination, html, jaccard, language, merkle, mixing, packing, pii, quality, resampling, secrets, sharding, trie,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measures(table(spark, folder, "documents"))


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest_rows(table(spark, folder, "documents"))


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("row")


def tokenizer() -> str:
    """Path of the public vocabulary file that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer())


@query
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest_rows(table(spark, folder, "documents"))


@query
def op6_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_similar(table(spark, folder, "documents"))


@query
def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(table(spark, folder, "pages"))


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


@query
def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


@query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


@query
def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("expected")


ORACLES["op5_secrets"] = secrets.oracle()

ORACLES["op1_quality"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS found FROM (
    SELECT rid, unnest(range(1, len(w) - 3)) AS i,
      unnest(list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j:j+4], ' '))) AS win
    FROM cut WHERE len(w) >= 5)
), repeats AS (
  SELECT rid, sum(least(5, i - before)) AS n FROM (
    SELECT rid, i, lag(i, 1, -10) OVER (PARTITION BY rid ORDER BY i) AS before
    FROM windows WHERE found > 1) GROUP BY rid
), m AS (
  SELECT doc_id, text, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i-1])) AS n_stutters,
    length(text) - length(regexp_replace(text, '\p{Lu}{2,}', '', 'g')) AS n_shouted,
    length(text) - length(regexp_replace(text, '\p{L}+', '', 'g')) AS n_letters
  FROM cut LEFT JOIN repeats USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
    OR 10 * n_stutters > 3 * n_words OR word_chars > 15 * n_words OR word_chars < 2 * n_words
    OR 10 * n_shouted > 3 * word_chars OR 2 * n_letters < word_chars) AS kept
FROM judged
"""

# CRC-32 of a decimal number: the table of its 256 remainders, then a step per character.
CRC = """
crc_steps AS (
  SELECT i, 0 AS bit, i AS v FROM range(256) AS r(i)
  UNION ALL
  SELECT i, bit + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM crc_steps WHERE bit < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE bit = 8
)"""


def crc_of(number: str) -> str:
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}),
      lambda c, b: xor(crc_table.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""


ORACLES["op11_trie"] = f"""
WITH RECURSIVE {CRC}, turns AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, said) AS p FROM turns
), convs AS (
  SELECT c, {crc_of("c")} % 4 AS h, c - c % 20 AS base FROM (SELECT DISTINCT c FROM own), crc_table
), parts AS (
  SELECT v.c, 0 AS part, o.p, o.said, o.words FROM convs v JOIN own o ON o.c = v.base AND o.p <= v.h
  UNION ALL
  SELECT v.c, 1, o.p, o.said, o.words FROM convs v JOIN own o ON o.c = v.c AND o.p > v.h
), rows AS (
  SELECT c, said, words, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM parts
), path AS (
  SELECT c, d, words, string_agg(said, '') OVER (PARTITION BY c ORDER BY d) AS k FROM rows
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
), ends AS (
  SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256 FROM (
    SELECT c, arg_max(k, d) AS k FROM path GROUP BY c) GROUP BY k
), nodes AS (
  SELECT k, any_value(d) AS depth, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs FROM path GROUP BY k
), up AS (
  SELECT n.*, left(n.k, CAST(32 * (n.depth - 1) AS INTEGER)) AS parent FROM nodes n
), kids AS (
  SELECT parent, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY parent
), full_nodes AS (
  SELECT u.*, coalesce(n_children, 0) AS n_children FROM up u LEFT JOIN kids ON kids.parent = u.k
), below AS (
  SELECT p.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM full_nodes f JOIN path p ON p.c = f.conv_id AND p.d <= f.depth GROUP BY p.k
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, f.n_convs,
  f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_nodes f JOIN below b ON b.k = f.k LEFT JOIN ends e ON e.k = f.k
LEFT JOIN nodes a ON f.depth > 0 AND a.k = f.parent
"""


def encoded_sql(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(encoded_sql(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


ORACLES["op12_merkle"] = f"""
WITH RECURSIVE {CRC}, leaves AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS tree, {leaf_sql("n_chars")} AS leaf,
    CASE WHEN {crc_of("doc_id")} % 7 = 0 THEN {leaf_sql("n_chars + 1")} END AS changed
  FROM documents, crc_table
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot FROM leaves
), levels AS (
  SELECT tree, 0 AS level, slot, leaf AS h, count(*) OVER (PARTITION BY tree) AS total FROM placed
  UNION ALL
  SELECT DISTINCT tree, level + 1, slot // 2,
    sha256(string_agg(h, '') OVER (PARTITION BY tree, slot // 2 ORDER BY slot
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), (total + 1) // 2
  FROM levels WHERE total > 1
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM levels WHERE total = 1
), tops AS (
  SELECT 0 AS level, place AS slot, subroot AS h, count(*) OVER () AS total FROM subroots
  UNION ALL
  SELECT DISTINCT level + 1, slot // 2,
    sha256(string_agg(h, '') OVER (PARTITION BY slot // 2 ORDER BY slot
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), (total + 1) // 2
  FROM tops WHERE total > 1
), way AS (
  SELECT p.id, l.level, p.slot >> l.level AS here, s.h AS sibling
  FROM placed p JOIN levels l ON l.tree = p.tree AND l.slot = p.slot >> l.level AND l.total > 1
  LEFT JOIN levels s ON s.tree = l.tree AND s.level = l.level AND s.slot = xor(l.slot, 1)
  UNION ALL
  SELECT p.id, 1000 + l.level, r.place >> l.level, s.h
  FROM placed p JOIN subroots r ON r.tree = p.tree JOIN tops l ON l.slot = r.place >> l.level AND l.total > 1
  LEFT JOIN tops s ON s.level = l.level AND s.slot = xor(l.slot, 1)
), proofs AS (
  SELECT id, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256,
    list(struct_pack(odd := here & 1, sibling := coalesce(sibling, '')) ORDER BY level) AS steps
  FROM way GROUP BY id
), folds AS (
  SELECT p.id, coalesce(changed, leaf) AS h, coalesce(steps, []) AS steps, 1 AS i FROM placed p LEFT JOIN proofs USING (id)
  UNION ALL
  SELECT id, sha256(CASE WHEN steps[i].odd = 1 THEN steps[i].sibling || h ELSE h || steps[i].sibling END), steps, i + 1
  FROM folds WHERE i <= len(steps)
)
SELECT doc_id, leaf, subroot, t.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots USING (tree) JOIN (SELECT h FROM tops WHERE total = 1) t ON true
LEFT JOIN proofs USING (id) JOIN folds f ON f.id = p.id AND f.i = len(f.steps) + 1
"""

ORACLES["op13_mixing"] = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('-' || source, '=') AS key, md5(coalesce(text, '')) AS name,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS size
  FROM documents
), sources AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS s, [3, 1, 2][(row_number() OVER (ORDER BY key) - 1) % 3 + 1] AS w FROM docs GROUP BY key
), filled AS (
  SELECT 0 AS round, key, s, w, false AS full_up FROM sources
  UNION ALL
  SELECT round + 1, key, s, w, full_up OR w * (CAST(1.5 AS DOUBLE) * sum(s) OVER () - 2 * coalesce(sum(s) FILTER (full_up) OVER (), 0))
    / greatest(1, sum(w) FILTER (NOT full_up) OVER ()) > 2 * s
  FROM filled WHERE round < (SELECT count(*) FROM sources)
), aims AS (
  SELECT key, s, CASE WHEN full_up THEN 2.0::DOUBLE * s ELSE w * ((CAST(1.5 AS DOUBLE) * sum(s) OVER ()
    - 2 * coalesce(sum(s) FILTER (full_up) OVER (), 0)) / greatest(1, sum(w) FILTER (NOT full_up) OVER ())) END AS target
  FROM filled WHERE round = (SELECT count(*) FROM sources)
), named AS (
  SELECT *, count(*) OVER (PARTITION BY key, name) AS copies FROM docs
), classes AS (
  SELECT key, copies, target, sum(size) AS words FROM named JOIN aims USING (key) WHERE size > 0 GROUP BY ALL
), rated AS (
  SELECT *, (target - 2 * coalesce(sum(words) OVER (PARTITION BY key ORDER BY copies ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(words / copies) OVER (PARTITION BY key ORDER BY copies ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM classes
), expected AS (
  SELECT *, CASE WHEN rate >= 2 * copies THEN 2.0::DOUBLE ELSE
    greatest(0, arg_min(rate, copies) FILTER (rate < 2 * copies) OVER (PARTITION BY key) / copies) END AS e
  FROM rated
), split AS (
  SELECT *, CAST(floor(e + 1e-9) AS BIGINT) AS whole, greatest(0, e - floor(e + 1e-9)) AS p FROM expected
), room AS (
  SELECT key, greatest(0, CAST(round(any_value(target)) AS BIGINT) - CAST(sum(whole * words) AS BIGINT)) AS words FROM split GROUP BY key
), drawn AS (
  SELECT n.id, n.key, n.size, room.words,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || name || ':13'), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u, p
  FROM named n JOIN split USING (key, copies) JOIN room ON room.key = n.key WHERE n.size > 0 AND p > 1e-9
), queue AS (
  SELECT id, key, size, words, row_number() OVER (PARTITION BY key ORDER BY (u / (1 - u)) * ((1 - p) / p), id) AS place FROM drawn
), taking AS (
  SELECT id, key, size, place, size <= words AS picked, words - CASE WHEN size <= words THEN size ELSE 0 END AS room
  FROM queue WHERE place = 1
  UNION ALL
  SELECT q.id, q.key, q.size, q.place, q.size <= t.room, t.room - CASE WHEN q.size <= t.room THEN q.size ELSE 0 END
  FROM taking t JOIN queue q ON q.key = t.key AND q.place = t.place + 1
)
SELECT doc_id, CAST(n.size AS BIGINT) AS size, s AS source_size, a.target, CAST(n.size * c AS BIGINT) AS taken, CAST(c AS INTEGER) AS copies
FROM (SELECT named.*, coalesce(whole, 0) + CASE WHEN picked THEN 1 ELSE 0 END AS c
  FROM named LEFT JOIN split USING (key, copies) LEFT JOIN taking USING (id)) n
JOIN aims a ON a.key = n.key
"""
