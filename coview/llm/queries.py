"""The registered queries of the training-data operators, one per operator.

Each applies its operator, with production parameters, to a whole table and
derives the digest columns from the operator's real output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coview.llm import decontaminate as D
from coview.llm import (collocations, jaccard, langid, licenses, lm, merkle, mixing, packing, pii, quality, sharding,
                        suffixes)
from coview.llm.tables import documents, table
from coview.llm.tables import tokenizer_path


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard.join(documents(spark, sf_dir))
            .select("doc_id", "n_shingles", "component_id"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(documents(spark, sf_dir))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (licenses.scan(documents(spark, sf_dir))
            .withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")}))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(documents(spark, sf_dir))

    def count(kind: str):
        of_kind = F.filter("base", lambda s: s.startswith(f"{kind}:"))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
                        F.array_join("spans", ",").alias("spans"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.find_windows(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    hit = D.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return (langid.identify(docs, model)
            .select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return (quality.judge(docs, rules)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", _UPPER, _LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_hash(changed={"text": lowered}))
    found = merkle.manifest(table(spark, sf_dir, "documents"), keep={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return (found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                         folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_license_scans": op5_license_scans,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_pii": op9_pii,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_collocations": op11_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_mixing": op13_mixing,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS win
  FROM i, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p)
  WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT r, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS win
  FROM (SELECT r, k, w, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT r, p, dw.k AS k, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
words AS (
  SELECT r, count(DISTINCT x) AS n_hit
  FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS x FROM hits) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
"""

OP1_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + least(len(w), 5) - 1), ' ') AS g
  FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p)
  WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * i >= 75 * (nx.n + ny.n - i)),
r AS (SELECT DISTINCT x AS doc_id, x AS root FROM e
      UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(c.root, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)
"""

OP11_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?
-]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM w, (VALUES (1), (2), (3), (4)) ks(k), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i)
  GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, x.j, l.f AS l, r.f AS r,
         CAST((2000000::HUGEINT * c.f) // (l.f + r.f) AS BIGINT) AS score
  FROM c, LATERAL (SELECT unnest(generate_series(1, c.k - 1)) AS j) x
  JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, x.j), ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, x.j + 1, c.k), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT c.lang, array_to_string(list_slice(c.w, s.i, s.i + m.m - 1), ' ') AS phrase, max(c.f) AS f
  FROM c, (VALUES (2), (3)) m(m), LATERAL (SELECT unnest(generate_series(1, c.k - m.m + 1)) AS i) s
  WHERE m.m < c.k GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

#: crc32 of the decimal doc_id, bit by bit; the trees and the folds level by level
OP12_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
    list_reduce(list_concat([4294967295::BIGINT],
        [ascii(c)::BIGINT for c in string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda s, b: list_reduce(list_concat([xor(s, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text
  FROM documents),
leaf AS (
  SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':'
      || translate(text, '{_UPPER}', '{_LOWER}'), '-')) END AS h2
  FROM d),
place AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaf),
low AS (
  SELECT lang, 0 AS level, pos, n, h FROM place
  UNION ALL
  SELECT lang, level + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY lang, level, pos // 8),
subs AS (SELECT lang, level, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
         FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, n, h FROM subs
  UNION ALL
  SELECT level + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY level, pos // 8),
nodes AS (
  SELECT '.' || coalesce(lang, '') || CASE WHEN lang IS NULL THEN '?' ELSE '' END AS tree, level, pos, n, h FROM low
  UNION ALL SELECT 'top', level, pos, n, h FROM high),
steps AS (
  SELECT a.tree, a.level, a.pos,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lft,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rgt
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos),
path AS (
  SELECT place.r, i.level AS k, s.lft, s.rgt
  FROM place JOIN subs ON subs.lang IS NOT DISTINCT FROM place.lang,
       LATERAL (SELECT unnest(generate_series(0, subs.level - 1)) AS level) i
  JOIN steps s ON s.tree = '.' || coalesce(place.lang, '') || CASE WHEN place.lang IS NULL THEN '?' ELSE '' END
    AND s.level = i.level AND s.pos = place.pos >> (3 * i.level)
  UNION ALL
  SELECT place.r, subs.level + i.level, s.lft, s.rgt
  FROM place JOIN subs ON subs.lang IS NOT DISTINCT FROM place.lang,
       LATERAL (SELECT unnest(generate_series(0, (SELECT max(level) FROM high) - 1)) AS level) i
  JOIN steps s ON s.tree = 'top' AND s.level = i.level AND s.pos = subs.pos >> (3 * i.level)),
folded AS (
  SELECT r, 0 AS k, coalesce(h2, h) AS h FROM place
  UNION ALL
  SELECT f.r, f.k + 1, sha256(p.lft || f.h || p.rgt) FROM folded f JOIN path p ON p.r = f.r AND p.k = f.k),
ends AS (SELECT r, arg_max(h, k) AS h FROM folded GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(lft || rgt, '' ORDER BY k)) AS p FROM path GROUP BY r)
SELECT place.doc_id, place.h AS leaf, subs.h AS subroot, top.h AS root, coalesce(p.p, sha256('')) AS proof_sha256,
       e.h AS folded_root, e.h = top.h AS verified
FROM place JOIN subs ON subs.lang IS NOT DISTINCT FROM place.lang JOIN ends e ON e.r = place.r
LEFT JOIN proofs p ON p.r = place.r, (SELECT h FROM high WHERE n = 1) top
"""

OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), text, '')) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
level AS (
  SELECT 1.5::DOUBLE * sum(source_size) AS total, 1.5::DOUBLE * sum(source_size) AS remaining, sum(weight) AS free FROM s
  UNION
  SELECT total, total - coalesce(sum(CASE WHEN remaining * weight / free > 2 * source_size THEN 2 * source_size END), 0),
         sum(CASE WHEN remaining * weight / free > 2 * source_size THEN 0 ELSE weight END)
  FROM level, s GROUP BY total, remaining, free),
final AS (SELECT remaining, free FROM level WHERE free > 0 ORDER BY free LIMIT 1),
t AS (SELECT source, source_size, least(remaining * weight / free, CAST(2 * source_size AS DOUBLE)) AS target FROM s, final),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id NULLS FIRST, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, floor(target) - passes * source_size - before)) AS BIGINT) AS taken
FROM p
"""

ORACLE_SQL = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op6_decontamination": OP6_SQL,
    "op11_collocations": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_mixing": OP13_SQL,
}
