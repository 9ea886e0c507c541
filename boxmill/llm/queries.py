"""One registered query per text operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_wrapper, langid, line_dedup, neardup, packing, quality_ordinal, quality_rules, sharding, toxicity, vector_codes, whitening
from .common import crc32_of_id


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The chain's categories, from the labels: the verdict `toxic` is the last link, which is fed with the out-of-fold probability of the first.
CATEGORIES = {"toxic_prose": "toxic * quality", "toxic": "toxic"}


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades 0 (poor), 1 (good but toxic), 2 (good)."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2).alias("grade"))


#: Documents of this expected grade are kept: between poor ones near 0 and good ones, toxic near 1 or not near 2.
LEAST_EXPECTED = 1.0


def quality_model(spark: SparkSession, sf_dir: str) -> quality_ordinal.OrdinalModel:
    return quality_ordinal.train(_table(spark, sf_dir, "documents"), graded_labels(_table(spark, sf_dir, "labels")))


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_model(spark, sf_dir)
    graded = _table(spark, sf_dir, "documents").select("doc_id", quality_ordinal.grade(model, F.col("text")).alias("g"))
    return graded.select("doc_id", "g.expected_grade", F.col("g.tails")[0].alias("p_good"), F.get("g.tails", F.lit(1)).alias("p_good_and_clean"), (F.col("g.expected_grade") >= LEAST_EXPECTED).alias("kept"))


def op2_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", quality_rules.line_report(F.col("text")).alias("r")).select("doc_id", "r.*")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), CATEGORIES)
    scored = docs.select("doc_id", toxicity.score(model, F.col("text")).alias("p"))
    return scored.select("doc_id", F.col("p.toxic_prose").alias("p_toxic_prose"), F.col("p.toxic").alias("p_toxic"), (F.col("p.toxic") >= model.cuts[1]).alias("toxic"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    part = F.coalesce(crc32_of_id("doc_id"), F.lit(0)) % 4
    model = langid.train(docs.filter(part != 2))
    found = docs.select("doc_id", (part == 2).alias("held_out"), langid.identify(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_text(_table(spark, sf_dir, "pages"))


def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op11_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_shared_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    code = F.concat_ws("", F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")))
    digest = F.lit(books.digest() if books else None).cast("string")
    return vector_codes.with_label_error(coded).select("vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def op13_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, model = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    explained = F.lit(model.explained if model else []).cast("array<double>")
    each = made.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        explained[F.col("place")].alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ordinal_quality,
        op2_benchmark_passages,
        op3_line_rules,
        op4_pack,
        op5_toxicity_chain,
        op6_language,
        op7_shard,
        op8_near_duplicates,
        op9_main_text,
        op10_perspectives,
        op11_shared_lines,
        op12_vector_codes,
        op13_whitened,
    )
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# White space, separators and line endings of the line rules as SQL texts.
_SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SEPARATORS = sorted(quality_rules.SEPARATORS)
_ENDS = "".join("''" if c == "'" else "\\" + c if c in "]-\\^" else c for c in quality_rules.ENDS)


def _rounds(rounds: int) -> str:
    """n0..n<rounds>: each part with its least `64 * squared distance + entry`; c1..c<rounds>: the entries after each round."""
    near = "n{0} AS MATERIALIZED (SELECT vec_id, p.part, any_value(label) AS label, any_value(p.a) AS a, any_value(p.b) AS b, any_value(p.c) AS c, any_value(p.d) AS d, min(64 * ((p.a - e.a) * (p.a - e.a) + (p.b - e.b) * (p.b - e.b) + (p.c - e.c) * (p.c - e.c) + (p.d - e.d) * (p.d - e.d)) + entry) AS least FROM p JOIN c{0} e ON p.part = e.part GROUP BY 1, 2)"
    mean = "CAST(floor(sum({0})::DOUBLE / count(*)) AS BIGINT) AS {0}"
    moved = "c{1} AS MATERIALIZED (SELECT o.part, o.entry, " + ", ".join(f"coalesce(m.{x}, o.{x}) AS {x}" for x in "abcd") + " FROM c{0} o LEFT JOIN (SELECT part, least % 64 AS entry, " + ", ".join(mean.format(x) for x in "abcd") + " FROM n{0} GROUP BY 1, 2) m ON o.part = m.part AND o.entry = m.entry)"
    return ",\n".join([*(x for k in range(rounds) for x in (near.format(k), moved.format(k, k + 1))), near.format(rounds)])


ORACLE_SQL: dict[str, str] = {
    # The counts, then every rule on every line; a line that repeats an earlier one fails too.
    "op3_line_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM d, unnest(range(1, len(words) - 1)) r(i))),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, range(0, 3) s(k) WHERE win.n > 1 GROUP BY 1),
ln AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again, regexp_extract_all(line, '[^{_SPACES}]+') AS w,
  octet_length(encode(line)) AS bytes, length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS marks, octet_length(encode(regexp_replace(line, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))) AS letters
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ru AS (SELECT *, greatest(len(w), 1) AS n, coalesce(list_sum(list_transform(list_filter({list(quality_rules.BOILERPLATE)}, lambda p: contains(plain, ' ' || p || ' ')), lambda p: len(string_split(p, ' ')))), 0) AS phrases
  FROM (SELECT *, ' ' || regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[\x00-\x60\x7B-\x7F]+', ' ', 'g') || ' ' AS plain FROM ln)),
fl AS (SELECT *, again
  OR n > 1 AND len(list_filter(w, lambda x: list_contains({list(_SEPARATORS)}, x))) * 4 >= n AND len(list_filter(w, lambda x: list_contains({list(_SEPARATORS)}, x))) > 0
  OR marks > 1 AND marks * 5 >= n
  OR phrases > 0 AND phrases * 4 >= n
  OR letters * 2 < bytes - n + 1
  OR n >= 5 AND (len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) * 2 > n OR len(list_distinct(w)) * 3 < n AND len(list_distinct(w)) * len(list_distinct(w)) < 9 * n OR len(list_filter(range(2, n + 1), lambda i: w[i] = w[i - 1])) * 4 > n)
  OR n < 4 AND NOT regexp_matches(line, '[{_ENDS}][{_SPACES}]*$') AS failed FROM ru),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(length(line)) FILTER (failed), 0) / CAST(sum(length(line)) AS DOUBLE) AS share FROM fl GROUP BY 1),
al AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(share, 1) AS removed_share
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN per ON d.doc_id = per.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_share <= 0.5 AS kept, n_lines, n_failed_lines, removed_share FROM al""",
    # Exact similarity of all pairs that share a shingle, and the least id reachable.
    "op8_near_duplicates": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS seen FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.seen = e.a),
low AS (SELECT doc_id, min(seen) AS c FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN low ON w.doc_id = low.doc_id""",
    "op10_perspectives": r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(coalesce(role, 'unknown'), '<(\\*)\|', '<\1\\|', 'g') AS speaker, regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\1\\|', 'g') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN '<|assistant|>' || chr(10) WHEN speaker = 'system' THEN '<|system|>' || chr(10) ELSE '<|user name=' || regexp_replace(speaker, '\|(\\*)>', '|\1\\>', 'g') || '|>' || chr(10) END AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
g AS (SELECT *, head || text || chr(10) || '<|end|>' || chr(10) AS segment FROM r),
o AS (SELECT *, CAST(length(segment) AS BIGINT) AS length, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(segment) AS BIGINT) AS start FROM g)
SELECT conv_id, perspective, turn, speaker, segment, start, length, start + length(head) AS mask_start,
  CASE WHEN speaker = perspective THEN length(text) ELSE 0 END AS mask_length FROM o""",
    "op11_shared_lines": rf"""
WITH ln AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
hot AS (SELECT key, max(doc_id) AS last FROM ln WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM ln LEFT JOIN hot ON ln.key = hot.key GROUP BY 1""",
    "op12_vector_codes": f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, q.p AS part, x[4 * q.p + 1] AS a, x[4 * q.p + 2] AS b, x[4 * q.p + 3] AS c, x[4 * q.p + 4] AS d FROM v, range(16) q(p)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, a, b, c, d FROM p QUALIFY entry < 64),
{_rounds(2)},
w AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', least % 64), '' ORDER BY part) AS code, CAST(sum(least // 64) AS BIGINT) AS error FROM n2 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256 FROM w""",
}
