"""The queries of the operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import exact_dedup, fingerprints, licenses, merkle, mixing, near_dedup, packing, quality, spelling, substrings, suffix_buckets, token_counts, url_filters
from keyfold.llm.common import documents, stored


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near copies."""
    return near_dedup.near_groups(documents(spark, sf_dir)).drop("doc", "part", "more")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses it names."""
    return licenses.license_scan(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of power-of-two lengths."""
    return packing.packed(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its copies."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("row")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(*quality.labelled_sample(docs, labels))
    return quality.scored(docs, model).drop("kept")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprints.neighbour_likeness(documents(spark, sf_dir), parts)


def op7_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that stand in two places."""
    return suffix_buckets.without_repeats(documents(spark, sf_dir)).drop("kept")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of earlier ones."""
    return substrings.without_repeats(documents(spark, sf_dir)).drop("kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its words in the mix."""
    rows = stored(mixing.sampling_rows(documents(spark, sf_dir)).drop("kept"), "sampling")
    return mixing.mixed(rows).selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count before and after three edits."""
    return token_counts.edited_counts(documents(spark, sf_dir))


# The rules of the query, as its contract has them.
URL_RULES = [
    url_filters.Rule("allow", "com", "/"),
    url_filters.Rule("block", "example.com", "/en/"),
    url_filters.Rule("allow", "www.example.com", "/en/"),
    url_filters.Rule("block", "net", "/es/"),
    url_filters.Rule("block", "net", "/fr/"),
]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict, by the rules or by its template."""
    return url_filters.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest, and what its tampered text leads to."""
    return merkle.document_manifest(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the spelling that its neighbours suggest."""
    return spelling.variant_groups(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_near_dedup, op2_licenses, op3_packing, op4_exact_dedup, op5_quality, op6_fingerprints, op7_suffix_buckets, op8_substrings, op9_mixing, op10_token_counts, op11_url_filters, op12_merkle, op13_spelling)
}

EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, rowid_, n_chars_, sha256(norm) AS text_sha256 FROM (
    SELECT doc_id, row_number() OVER () AS rowid_, length(coalesce(text, '')) AS n_chars_,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents)
), g AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars_ DESC, doc_id NULLS LAST, rowid_)
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM g
"""

MIXING_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), d AS (
  SELECT doc_id, source, size, r,
         -ln((CAST('0x' || substr(md5('mix' || coalesce(':' || CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
         / (1.0 / (1.0 + abs(CASE WHEN size > 0 THEN CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS DOUBLE) / size
                             ELSE 0.0 END - 5.0))) AS k
  FROM w
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source
), fill AS (
  -- one round a step: sources above their limit stop there, the rest share what is left
  SELECT 0 AS step, source, source_size, weight, false AS full_, 0.0::DOUBLE AS target FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight, full_ OR target_ >= 3 * source_size, CASE WHEN full_ THEN target ELSE least(target_, 3 * source_size) END
  FROM (
    SELECT *, CASE WHEN full_ THEN target ELSE
             (sum(source_size) OVER () - sum(CASE WHEN full_ THEN target ELSE 0 END) OVER ())
             * weight / nullif(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER (), 0) END AS target_
    FROM fill WHERE step < (SELECT count(*) + 1 FROM s))
), goal AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM fill WHERE step = (SELECT count(*) + 1 FROM s)
), o AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN target - epochs * source_size > 0 AND ahead + size / 2.0 <= target - epochs * source_size
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents
), k AS (SELECT doc_id, ws, array_to_string(ws, ' ') AS t FROM w),
u AS (SELECT t, min(doc_id) AS node, any_value(ws) AS ws FROM k GROUP BY t),
s AS (
  SELECT node, sh, count(*) AS c FROM (
    SELECT node, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM u)
  GROUP BY node, sh
), n AS (SELECT node, sum(c) AS n FROM s GROUP BY node),
p AS (
  SELECT a.node AS x, b.node AS y, sum(least(a.c, b.c)) AS m
  FROM s a JOIN s b ON a.sh = b.sh AND a.node < b.node GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.node = x JOIN n ny ON ny.node = y WHERE 5 * m >= 4 * (nx.n + ny.n - m)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT node, node AS label FROM u UNION SELECT e.y, r.label FROM r JOIN e ON e.x = r.node),
c AS (SELECT node, min(label) AS class_id FROM r GROUP BY node),
g AS (SELECT k.doc_id, c.class_id FROM k JOIN u USING (t) JOIN c USING (node))
SELECT doc_id, class_id, CAST(count(*) OVER (PARTITION BY class_id) AS BIGINT) AS group_size, doc_id = class_id AS kept FROM g
"""

SUFFIX_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (
  -- in blocks of 200 bytes and the 199 behind, as cutting far into a text takes long
  SELECT r, n, j, substr(h, 400 * j + 1, 798) AS h FROM (SELECT r, h, length(h) // 2 AS n, unnest(range(0, (length(h) // 2 + 199) // 200)) AS j FROM w)
), p AS (
  SELECT r, 200 * j + o AS i, substr(h, 2 * o - 1, 2) AS b, CASE WHEN 200 * j + o + 199 <= n THEN md5(substr(h, 2 * o - 1, 400)) END AS k
  FROM (SELECT r, h, n, j, unnest(range(1, least(200, n - 200 * j) + 1)) AS o FROM c)
), f AS (SELECT k FROM p WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
m AS (
  SELECT p.r, p.i, p.b, bool_or(f.k IS NOT NULL) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
  FROM p LEFT JOIN f ON f.k = p.k
), s AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
         string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM (SELECT *, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS before FROM m) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM w LEFT JOIN s USING (r)
"""

SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (
  SELECT doc_id, ws[i] AS word, i, CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i+49], ' ')) END AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
), f AS (SELECT k, min(doc_id) AS first_id FROM p WHERE k IS NOT NULL GROUP BY k),
m AS (
  SELECT p.doc_id, p.i, p.word,
         bool_or(coalesce(f.first_id < p.doc_id, false)) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM p LEFT JOIN f ON f.k = p.k
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS t
  FROM m GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# crc32, bit by bit; no function of DuckDB's own does it
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], flatten([[CAST(256 + ascii(substr({0}, CAST(i AS INTEGER), 1)) AS UBIGINT),
  0, 0, 0, 0, 0, 0, 0] FOR i IN range(1, length({0}) + 1)])),
  lambda c, x: xor(xor(c, CASE WHEN x > 0 THEN x - 256 ELSE 0 END) >> 1, CASE WHEN xor(c, CASE WHEN x > 0 THEN x - 256 ELSE 0 END) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
         {_leaf_sql("t")} AS claim
  FROM (SELECT *, CASE WHEN {_CRC.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0
                       THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS t FROM documents)
), l AS (
  SELECT *, row_number() OVER (PARTITION BY encode(tree) ORDER BY doc_id NULLS LAST, leaf) - 1 AS place FROM d
), t AS (
  -- all nodes of the sources' trees, a level a step
  SELECT 0 AS lv, tree, place, leaf AS h FROM l
  UNION ALL
  SELECT any_value(lv) + 1, tree, place // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM t) WHERE n > 1 GROUP BY tree, place // 16
), tops AS (SELECT tree, max(lv) AS top FROM t GROUP BY tree),
subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM t JOIN tops USING (tree) WHERE lv = top
), u AS (
  SELECT 0 AS lv, place, subroot AS h FROM subroots
  UNION ALL
  SELECT any_value(lv) + 1, place // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY place // 16
), utop AS (SELECT max(lv) AS top, arg_max(h, lv) AS root FROM u),
runs AS (
  SELECT tree, lv, place // 16 AS run, string_agg(h, '' ORDER BY place) AS hs FROM t JOIN tops USING (tree) WHERE lv < top GROUP BY tree, lv, place // 16
), uruns AS (SELECT lv, place // 16 AS run, string_agg(h, '' ORDER BY place) AS hs FROM u, utop WHERE lv < top GROUP BY lv, place // 16),
steps AS (
  -- what stands left and right of a leaf's ancestors, from the leaf up
  SELECT l.tree, l.place, r.lv, substr(r.hs, 1, 64 * (l.place // (16 ** r.lv)::BIGINT % 16)) AS a, substr(r.hs, 64 * (l.place // (16 ** r.lv)::BIGINT % 16) + 65) AS b
  FROM l JOIN runs r ON r.tree = l.tree AND r.run = l.place // (16 ** (r.lv + 1))::BIGINT
  UNION ALL
  SELECT l.tree, l.place, o.top + r.lv, substr(r.hs, 1, 64 * (s.place // (16 ** r.lv)::BIGINT % 16)), substr(r.hs, 64 * (s.place // (16 ** r.lv)::BIGINT % 16) + 65)
  FROM l JOIN subroots s USING (tree) JOIN tops o USING (tree) JOIN uruns r ON r.run = s.place // (16 ** (r.lv + 1))::BIGINT
), proofs AS (SELECT tree, place, sha256(string_agg(a || b, '' ORDER BY lv)) AS proof FROM steps GROUP BY tree, place),
fold AS (
  SELECT tree, place, 0 AS lv, claim AS h FROM l
  UNION ALL
  SELECT f.tree, f.place, f.lv + 1, sha256(p.a || f.h || p.b) FROM fold f JOIN steps p ON p.tree = f.tree AND p.place = f.place AND p.lv = f.lv
), folded AS (SELECT tree, place, arg_max(h, lv) AS folded_root FROM fold GROUP BY tree, place)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN subroots s USING (tree) CROSS JOIN utop LEFT JOIN proofs p ON p.tree = l.tree AND p.place = l.place JOIN folded f ON f.tree = l.tree AND f.place = l.place
"""

ORACLES: dict[str, str] = {
    "op1_near_dedup": NEAR_SQL,
    "op4_exact_dedup": EXACT_SQL,
    "op7_suffix_buckets": SUFFIX_SQL,
    "op8_substrings": SUBSTRING_SQL,
    "op9_mixing": MIXING_SQL,
    "op12_merkle": MERKLE_SQL,
}
