"""The operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataq.llm import decontaminate, exact_dedup, jaccard, masked_lm, mixing, quality, repeats, surrogates, url_filter, warc


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_mixing(spark, d):
    out = mixing.mix(_read(spark, d, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op2_warc(spark, d):
    manifest = warc.write_archives(_read(spark, d, "pages"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def fold(doc_id="doc_id"):
    """The held-out fold of a document: rows of fold 1 are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3


def op3_quality(spark, d):
    docs = _read(spark, d, "documents")
    model = quality.fit(docs, _read(spark, d, "labels"), train_where=fold() != 1)
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_exact_dedup(spark, d):
    out = exact_dedup.exact_dedup(_read(spark, d, "documents"), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_masked_lm(spark, d):
    docs = _read(spark, d, "documents")
    return masked_lm.score(docs, masked_lm.fit(docs), fitted=True).withColumnRenamed("id", "doc_id")


def op6_url_filter(spark, d):
    return url_filter.judge_urls(_read(spark, d, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_repeats(spark, d):
    return repeats.remove_repeats(_read(spark, d, "documents"), keep="none", with_text=False).withColumnRenamed("id", "doc_id")


def mixing_targets(spark, d):
    """The part of op1 that SQL can express: sizes of the sources, and their targets."""
    out = mixing.mix(_read(spark, d, "documents"))
    out = out.groupBy("source").agg(F.first("source_size").alias("source_size"), F.count(F.lit(1)).alias("docs"), F.round(F.first("target"), 3).alias("target"))
    return out.select("source", "source_size", "docs", "target")


def url_rules(spark, d):
    """The part of op6 that SQL can express: hosts, paths and rules, and the verdicts of rules."""
    out = url_filter.judge_urls(_read(spark, d, "pages"))
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("by_rule"))


def op9_surrogates(spark, d):
    out = surrogates.pseudonymise(_read(spark, d, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_entities", "text")


def op8_decontaminate(spark, d):
    out = decontaminate.decontaminate(_read(spark, d, "documents"), _read(spark, d, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", "matched")


def op10_jaccard(spark, d):
    out = jaccard.jaccard_components(_read(spark, d, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_masked_lm": op5_masked_lm,
    "op6_url_filter": op6_url_filter,
    "op7_repeats": op7_repeats,
    "op8_decontaminate": op8_decontaminate,
    "op9_surrogates": op9_surrogates,
    "op10_jaccard": op10_jaccard,
    "mixing_targets": mixing_targets,
    "url_rules": url_rules,
}

#: Base32 of a SHA-1: five hexadecimal digits are four letters.
_SHA1 = """array_to_string(list_transform(range(32), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha1(t), 5 * (k // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1, 1)), '')"""

#: Words of a text, by the ASCII spaces alone; lower-cased in A-Z alone.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "mixing_targets": f"""
WITH RECURSIVE sizes AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS w
  FROM (SELECT source, CAST(sum(len({_WORDS.format("coalesce(text, '')")})) AS BIGINT) AS source_size, count(*) AS docs FROM documents GROUP BY source) a),
-- rounds: whose share is above twice their size stop there, and the rest is shared again
rounds AS (
  SELECT 0 AS k, source, source_size, docs, w, FALSE AS capped, CAST(0 AS DOUBLE) AS share FROM sizes
  UNION ALL
  SELECT k + 1, source, source_size, docs, w, capped OR now > 2 * source_size, CASE WHEN capped THEN 2.0 * source_size ELSE now END
  FROM (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) FILTER (capped) OVER (), 0)) * w / sum(w) FILTER (NOT capped) OVER () AS now FROM rounds) r
  WHERE k <= (SELECT count(*) FROM sizes))
SELECT source, source_size, docs, round(CAST(CASE WHEN capped THEN 2.0 * source_size ELSE share END AS DOUBLE), 3) AS target FROM rounds WHERE k = (SELECT count(*) FROM sizes) + 1""",
    "url_rules": r"""
SELECT page_id, host, path, rule, CASE rule WHEN 'com/en/' THEN 'block' WHEN 'example.com/en/7' THEN 'allow' WHEN 'net/de/' THEN 'allow' WHEN 'example.net/de/8' THEN 'block' WHEN 'org/es/' THEN 'block' END AS by_rule
FROM (SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/7%' THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/de/8%' THEN 'example.net/de/8'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/en/%' THEN 'com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/de/%' THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/es/%' THEN 'org/es/' END AS rule
  FROM (SELECT page_id, translate(regexp_extract(u, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, coalesce(url, '') AS u FROM pages) x) y) z""",
    "op7_repeats": """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
places AS (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS p FROM t WHERE octet_length(b) >= 400),
windows AS (SELECT r, p, md5(array_slice(b, p + 1, p + 400)) AS w FROM places),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows SEMI JOIN twice USING (w)),
-- removed runs: starts at most 400 bytes apart
runs AS (SELECT r, min(p) AS lo, max(p) + 400 AS hi FROM (
  SELECT r, p, sum(CASE WHEN p - before <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM starts) a) b GROUP BY r, g),
gaps AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS last FROM runs),
kept AS (SELECT gaps.r, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS tail,
         string_agg(CASE WHEN lo > last THEN hex(array_slice(b, last + 1, lo)) ELSE '' END, '' ORDER BY lo) AS head FROM gaps JOIN t ON t.r = gaps.r GROUP BY gaps.r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(head || CASE WHEN tail < octet_length(b) THEN hex(array_slice(b, tail + 1, octet_length(b))) ELSE '' END) END) AS kept_sha256
FROM t LEFT JOIN kept ON t.r = kept.r""",
    "op8_decontaminate": r"""
WITH w AS (SELECT *, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') AS ws
           FROM (SELECT row_number() OVER () AS r, 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT row_number() OVER (), 'b', item_id, text FROM benchmark) a),
words AS (SELECT r, kind, id, len(ws) AS size, unnest(ws) AS word, unnest(range(len(ws))) AS at FROM w),
-- equal words by diagonal; m counts them along it
met AS (SELECT d.r AS dr, d.id AS doc_id, b.r AS br, b.id AS item_id, b.size, d.at - b.at AS diagonal, b.at AS k, row_number() OVER (PARTITION BY d.r, b.r, d.at - b.at ORDER BY b.at) AS m
        FROM (SELECT * FROM words WHERE kind = 'd') d JOIN (SELECT * FROM words WHERE kind = 'b') b ON d.word = b.word),
-- a best stretch begins and ends with an equal word: 3 for each, less 2 for each place
along AS (SELECT *, 3 * m - 2 * k + max(2 * k - 3 * m + 1) OVER (PARTITION BY dr, br, diagonal ORDER BY k) AS score FROM met),
best AS (SELECT doc_id, item_id, size, max(score) AS score, max(m) AS matched FROM along GROUP BY dr, doc_id, br, item_id, size, diagonal)
SELECT doc_id, item_id, CAST(max(score) AS INTEGER) AS score, CAST(max(matched) AS INTEGER) AS matched FROM best WHERE score >= 10 OR matched >= size - size // 6 GROUP BY doc_id, item_id""",
    "op10_jaccard": f"""
WITH RECURSIVE t AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' ')) END) AS sh FROM t),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, unnest(sh) AS g FROM s),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n_shingles) AS nx, any_value(b.n_shingles) AS ny, count(*) AS c FROM n a JOIN n b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM pairs WHERE 100 * c >= 80 * (nx + ny - c) UNION ALL SELECT y, x FROM pairs WHERE 100 * c >= 80 * (nx + ny - c)),
reach(x, y) AS (SELECT DISTINCT x, x FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id FROM s LEFT JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON doc_id = x""",
    "op2_warc": f"""
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_SHA1} AS payload_digest,
       CASE WHEN page_id = least_id OR least_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = least_id THEN NULL ELSE least_id END AS refers_to
FROM (SELECT page_id, t, min(page_id) OVER (PARTITION BY t) AS least_id FROM (SELECT page_id, coalesce(html, '') AS t FROM pages) x) y""",
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) x""",
}
