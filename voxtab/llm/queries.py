"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, decontaminate, langid, mixing, negatives, periodic, pii, quality, sharding, simhash, suffixdedup, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.removed(_table(spark, sf_dir, "documents"))
    left = F.octet_length("kept").cast("long")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - left).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.profiles(docs))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).withColumn("score", F.round("score", 6))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op11_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(e.select("vec_id", shifted.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op12_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.planted(_table(spark, sf_dir, "documents"))))


#: CRC-32 of the decimal digits of an id, as a table of one row (its 256 steps by rule) and an expression over ``doc_id``.
_CRC_TABLE = "t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps)"
_CRC_OF_ID = "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, 1 + length(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))), lambda c, b: xor(steps[1 + xor(c % 256, b)], c // 256)))"

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM s WHERE same),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM o WHERE place <= 5),
n AS (SELECT anchor_id, positive_id, s.other AS negative_id, positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS place
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10
"""

_DRAW = "-ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{s}:shard'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"
_FIRST = lambda count: f"list_position([{', '.join(_DRAW.format(s=s) for s in range(count))}], least({', '.join(_DRAW.format(s=s) for s in range(count))})) - 1"

#: Checksums of blocks of 256 bytes, counted from a text's end, are moved on by the bytes behind them (``k`` blocks, by bits ``j``) and added.
SHARDING_SQL = rf"""
WITH RECURSIVE b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
n AS (SELECT doc_id, CAST(1 + length(bytes) // 2 AS BIGINT) AS size, bytes FROM b),
p AS (SELECT doc_id, size, k, substr(bytes, greatest(0, length(bytes) - 512 * (k + 1)) + 1, least(512, length(bytes) - 512 * k)) AS part, 512 * (k + 1) >= length(bytes) AS first
      FROM (SELECT *, unnest(range((length(bytes) + 511) // 512)) AS k FROM n)),
c AS (SELECT doc_id, k, list_reduce(list_prepend(CAST(CASE WHEN first THEN 4294967295 ELSE 0 END AS BIGINT), list_transform(range(4 * length(part)), lambda i: CAST(((strpos('0123456789ABCDEF', part[1 + xor(i // 4, 1)]) - 1) >> (i % 4)) & 1 AS BIGINT))),
                                    lambda c, b: xor(c // 2, 3988292384 * (xor(c, b) % 2))) AS crc FROM p),
a AS (SELECT CAST(0 AS BIGINT) AS k, j, CAST(1 AS BIGINT) << j AS v FROM (SELECT unnest(range(32)) AS j)
      UNION ALL SELECT k + 1, j, list_reduce(list_prepend(v, range(2048)), lambda c, b: xor(c // 2, 3988292384 * (c % 2))) FROM a WHERE k < (SELECT max(k) FROM p)),
t AS (SELECT doc_id, bit_xor(v) AS crc FROM c JOIN a ON a.k = c.k AND (c.crc >> a.j) & 1 = 1 GROUP BY doc_id),
s AS (SELECT n.doc_id, size, CASE WHEN size = 1 THEN 0 ELSE xor(4294967295, coalesce(crc, 0)) END AS text_crc32 FROM n LEFT JOIN t ON t.doc_id = n.doc_id),
r AS (SELECT *, {_FIRST(8)} AS shard, {_FIRST(9)} AS grown_shard FROM s)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32)), doc_id, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INT) AS grown_shard
FROM r
"""

PERIODIC_SQL = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC_OF_ID} AS h FROM documents, t),
m AS (SELECT doc_id, w, h, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) END AS w FROM m),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM p),
k AS (SELECT doc_id, n, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2, lead(word, 3) OVER o AS w3, lead(word, 4) OVER o AS w4 FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT b.doc_id, b.i, b.i - a.i AS q FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.word = b.word AND a.w1 = b.w1 AND a.w2 = b.w2 AND a.w3 = b.w3 AND a.w4 = b.w4 WHERE b.i > a.i AND 4 * (b.i - a.i) <= a.n),
f AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
s AS (SELECT doc_id, min(i) - q AS start, count(*) + 4 + q AS length, q AS period FROM f GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM s WHERE NOT EXISTS (FROM s o WHERE o.doc_id = s.doc_id AND o.start = s.start AND o.length = s.length AND o.period < s.period)),
y AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x LEFT JOIN y ON y.doc_id = x.doc_id AND y.i = x.i WHERE y.i IS NULL GROUP BY x.doc_id),
z AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / CAST(period AS DOUBLE) DESC, start, period) AS place FROM r)
SELECT p.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
       CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM p LEFT JOIN z ON z.doc_id = p.doc_id LEFT JOIN c ON c.doc_id = p.doc_id LEFT JOIN b ON b.doc_id = p.doc_id AND b.place = 1
"""

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), coalesce(text, '')) || ':mix'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
         / greatest(0.1, 1.0 - 4.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#$%&*|!@{}[]<>\^~', ''))) / greatest(length(coalesce(text, '')), 1)) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS lim FROM s),
r AS (SELECT *, sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM w),
l AS (SELECT coalesce(max(CASE WHEN lim >= weight * (rest / open) THEN rest / open END), 0) AS level FROM r),
g AS (SELECT source, source_size, least(lim, weight * level) AS target FROM r, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, CAST(floor(e.target) AS BIGINT) - e.epochs * e.source_size AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(epochs * size + greatest(0, least(size, budget - spent)) AS BIGINT) AS taken
FROM p
"""

COVER_TREE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

WARC_SQL = """
WITH p AS (SELECT page_id, CAST(encode(coalesce(html, '')) AS BLOB) AS payload FROM pages),
h AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS digest FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', substr(digest, i, 1))]), '') AS bits FROM h),
f AS (SELECT digest, min(page_id) AS first_id FROM h GROUP BY digest)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b JOIN f USING (digest)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cover_tree": op1_cover_tree,
    "op2_suffix_array": op2_suffix_array,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_decontaminate": op9_decontaminate,
    "op10_toxicity": op10_toxicity,
    "op11_angular_negatives": op11_angular_negatives,
    "op12_rendezvous": op12_rendezvous,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {"op1_cover_tree": COVER_TREE_SQL, "op3_mixing": MIXING_SQL, "op5_warc": WARC_SQL, "op11_angular_negatives": NEGATIVES_SQL, "op12_rendezvous": SHARDING_SQL, "op13_periodic_runs": PERIODIC_SQL}
