"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import (
    bins, decontaminate, divergence, fuzzy_lines, html_region, languages, merkle, mixing, resampling, simhash, substrings,
    token_planes, weak_labels,
)
from ticketmill.llm.common import documents
from ticketmill.llm.encoding import vocabulary_path
from ticketmill.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


@query("op1_token_planes")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-planes")
    token_planes.write_ids(documents(spark, sf_dir), path, vocabulary_path(BYTE_BPE))
    return token_planes.read_documents(spark, path, digest=True)


@query("op2_html_region")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.extract(documents(spark, sf_dir, "pages"))


@query("op3_weak_labels")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.score(documents(spark, sf_dir))


@query("op4_bins")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bins.pack_documents(bins.token_lengths(documents(spark, sf_dir), vocabulary_path(BYTE_BPE)))


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


_WS = r"[\x20\x09-\x0D]+"


@query("op6_substrings", rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}'), lambda w: w <> '') AS ws FROM documents),
p AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 49], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d WHERE len(ws) >= 50)),
hit AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY w) AS first FROM p) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM hit),
per AS (SELECT doc_id, list(i) AS gs FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(ws) AS n, coalesce(len(gs), 0) AS r,
         CASE WHEN gs IS NULL THEN ws ELSE list_filter(ws, lambda w, i: NOT list_contains(gs, i)) END AS k
  FROM d LEFT JOIN per USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPLIT = f"list_filter(regexp_split_to_array({_LOWER}, '{_SEPARATORS}'), lambda w: w <> '')"


@query("op7_decontaminate", f"""
WITH b AS (SELECT item_id, {_SPLIT} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[s:s + 9], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS s FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
d AS (SELECT doc_id, {_SPLIT} AS ws FROM documents),
p AS (
  SELECT doc_id, m, s, array_to_string(ws[s:s + m - 1], ' ') AS w
  FROM (SELECT doc_id, m, ws, unnest(range(1, len(ws) - m + 2)) AS s FROM d, sizes WHERE len(ws) >= m)),
hit AS (SELECT DISTINCT p.doc_id, p.s, p.m, win.item_id FROM p JOIN win USING (m, w)),
pos AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS i FROM hit) GROUP BY doc_id),
per AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN per USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_fuzzy_lines")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs, least_words=1))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_languages")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    vocabulary = vocabulary_path(PIECES)
    model = languages.train(docs.filter(~languages.held_out(F.col("doc_id"))), vocabulary)
    found = languages.predict(docs.select("doc_id", "text"), model, vocabulary)
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_divergence")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir))


# CRC-32 of a text's UTF-8 bytes, as a fold over its bytes with the table of the polynomial.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b))"""


def _crc(hex_text: str) -> str:
    nibble = f"CAST(instr('0123456789ABCDEF', substr({hex_text}, {{}}, 1)) AS BIGINT) - 1"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length({hex_text}) // 2), "
            f"lambda i: 16 * ({nibble.format('2 * i + 1')}) + {nibble.format('2 * i + 2')})), "
            f"lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)")


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


@query("op11_merkle", f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS MATERIALIZED (
  SELECT doc_id, lang, leaf, CASE WHEN crc % 7 = 0 THEN changed ELSE leaf END AS held,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         dense_rank() OVER (ORDER BY lang IS NOT NULL, lang) - 1 AS j
  FROM (SELECT doc_id, lang, {_leaf()} AS leaf, {_leaf('n_chars + 1')} AS changed,
               {_crc("hex(encode(CAST(doc_id AS VARCHAR)))")} AS crc
        FROM documents, crc_table)),
tree AS MATERIALIZED (
  SELECT j, 0 AS lvl, i AS pos, leaf AS d, count(*) OVER (PARTITION BY j) AS n FROM leaves
  UNION ALL
  SELECT j, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM tree WHERE n > 1 GROUP BY j, lvl, pos // 2),
top AS MATERIALIZED (
  SELECT 0 AS lvl, j AS pos, d, count(*) OVER () AS n FROM tree WHERE n = 1
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT l.j, l.i, s.lvl, CASE WHEN o.d IS NULL THEN 'N' WHEN o.pos < s.pos THEN 'L' ELSE 'R' END AS side, coalesce(o.d, '') AS d
  FROM leaves l JOIN tree s ON s.j = l.j AND s.pos = l.i >> s.lvl AND s.n > 1
  LEFT JOIN tree o ON o.j = s.j AND o.lvl = s.lvl AND o.pos = xor(s.pos, 1)
  UNION ALL
  SELECT l.j, l.i, 1000 + s.lvl, CASE WHEN o.d IS NULL THEN 'N' WHEN o.pos < s.pos THEN 'L' ELSE 'R' END, coalesce(o.d, '')
  FROM leaves l JOIN top s ON s.pos = l.j >> s.lvl AND s.n > 1
  LEFT JOIN top o ON o.lvl = s.lvl AND o.pos = xor(s.pos, 1)),
proofs AS (
  SELECT j, i, list(side || d ORDER BY lvl) AS p, string_agg(d, '' ORDER BY lvl) AS all_d FROM steps GROUP BY j, i),
folded AS (
  SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, sha256(coalesce(all_d, '')) AS proof_sha256,
         list_reduce(list_prepend(held, coalesce(p, [])), lambda a, x: sha256(
           CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
  FROM leaves l LEFT JOIN proofs USING (j, i)
  JOIN (SELECT j, d FROM tree WHERE n = 1) s USING (j) CROSS JOIN (SELECT d FROM top WHERE n = 1) r)
SELECT *, folded_root = root AS verified FROM folded
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op12_mix", r"""
WITH RECURSIVE quality AS (
  SELECT doc_id, CASE WHEN coalesce(min(quality), 1) = 1 AND coalesce(max(toxic), 0) = 0 THEN 2.0 ELSE 0.5 END AS w
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || sha256('mix:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13] AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496::DOUBLE) / coalesce(w, 1.0)::DOUBLE AS draw
  FROM documents LEFT JOIN quality USING (doc_id)),
src AS MATERIALIZED (
  SELECT source, z, 2.0::DOUBLE * z AS cap, ([5, 2, 1])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS z FROM sized GROUP BY source)),
total AS (SELECT 1.5::DOUBLE * sum(z)::BIGINT AS words FROM src),
unit AS (
  SELECT 0.0::DOUBLE AS u
  UNION
  SELECT CASE WHEN free > 0 THEN greatest(u, (words - spent) / free) ELSE u END FROM (
    SELECT u, words, sum(CASE WHEN w * u > cap THEN cap ELSE 0 END) AS spent, sum(CASE WHEN w * u > cap THEN 0 ELSE w END) AS free
    FROM unit, src, total GROUP BY u, words)),
budget AS (
  SELECT source, z, least(w * u, cap) AS target FROM src, (SELECT max(u) AS u FROM unit)),
rest AS (
  SELECT source, z, target, CASE WHEN z > 0 THEN CAST(floor(target / z) AS BIGINT) ELSE 0 END AS epochs FROM budget),
drawn AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM sized)
SELECT doc_id, d.source, CAST(size AS BIGINT) AS size, z AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target + 0.5) AS BIGINT) - epochs * z - before)) AS BIGINT) AS taken, epochs
FROM drawn d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), mixing.label_weights(documents(spark, sf_dir, "labels")))


@query("op13_resample", f"""
WITH {_CRC_TABLE},
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, ws FROM (SELECT doc_id, {_SPLIT} AS ws FROM documents)),
b AS (SELECT {_SPLIT} AS ws FROM benchmark),
df AS MATERIALIZED (
  SELECT r, unnest(ws) AS f FROM d
  UNION ALL SELECT r, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM d
  UNION ALL SELECT r, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM d),
bf AS MATERIALIZED (
  SELECT unnest(ws) AS f FROM b
  UNION ALL SELECT unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM b
  UNION ALL SELECT unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM b),
bucket AS MATERIALIZED (
  SELECT f, {_crc("h")} % 10000 AS k FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)), crc_table),
s AS (SELECT k, count(*) AS s FROM df JOIN bucket USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM bf JOIN bucket USING (f) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE
                 / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (k)),
w AS (
  SELECT r, count(*) AS n_features, sum(g) AS weight FROM df JOIN bucket USING (f) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT doc_id, len(ws) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE)
              / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (r)),
turn AS (
  SELECT *, n_words >= 20 AND score IS NOT NULL AS may,
         row_number() OVER (PARTITION BY n_words >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id, weight DESC) AS place
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN may AND place <= (SELECT count(*) FROM turn WHERE may) * 5 // 100 THEN place END AS rank
FROM turn
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
