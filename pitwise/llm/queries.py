"""Registered queries of the training-data operators: key -> (spark, sf_dir) -> DataFrame.

Every query applies its operator, with production parameters, to the whole table. `ORACLES` has the
DuckDB statement of those that SQL can express; the others are held against brute force or
held-out accuracy in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitwise.llm import (
    decontam, langid, ledger, licenses, linefreq, lm, merkle, mixing, quality, sharding, simhash, trie, wrappers,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


@query
def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(table(spark, sf_dir, "documents"))


# The rule of the mix as one statement: the level is where the sorted limits meet the rest of the budget.
ORACLES["op6_mix_sources"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
fill AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS rk,
         sum(source_size) OVER () AS goal, 3.0 * source_size / weight AS own_level,
         coalesce(sum(3.0 * source_size) OVER below, 0) AS full_below,
         sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS open_weight
  FROM per
  WINDOW below AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (
  SELECT arg_min((goal - full_below) / open_weight, rk) FILTER (WHERE (goal - full_below) / open_weight <= own_level) AS level
  FROM fill),
targets AS (SELECT source, source_size, least(3.0 * source_size, level * weight)::DOUBLE AS target FROM per, lvl),
rated AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         length(bin(s.size)) || ':' || substr(bin(s.size), 1, 4) AS stratum,
         CAST('0x' || substr(md5('mix-1:' || coalesce(s.source, '\N') || ':' || length(bin(s.size)) || ':' || substr(bin(s.size), 1, 4)),
                             1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u,
         md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), '\N') || ':' || md5(coalesce(s.text, '\N'))) AS number
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
strata AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY low DESC, stratum DESC) AS rk FROM (
    SELECT source, stratum, any_value(u) AS u, any_value(rate - floor(rate)) AS f, count(*) AS n, sum(size)::BIGINT AS words,
           min(size) AS low FROM rated GROUP BY source, stratum)),
shares AS (  -- from the largest stratum down: documents taken, and the words that are still missing
  SELECT source, 0::BIGINT AS rk, NULL::VARCHAR AS stratum, 0::BIGINT AS more, 0.0::DOUBLE AS missing FROM strata GROUP BY source
  UNION ALL
  SELECT x.source, x.rk, x.stratum, x.take, x.missing + x.f * x.words - x.take * (x.words::DOUBLE / x.n) FROM (
    SELECT t.*, h.missing, least(greatest(floor(CASE WHEN words > 0 THEN (f * words + missing) / (words::DOUBLE / n) ELSE f * n END
                                                + u), 0), n)::BIGINT AS take
    FROM shares h JOIN strata t ON t.source IS NOT DISTINCT FROM h.source AND t.rk = h.rk + 1) x),
limits AS (
  SELECT r.source, r.stratum, max(number) AS last
  FROM (SELECT *, row_number() OVER (PARTITION BY source, stratum ORDER BY number) AS place FROM rated) r
  JOIN shares h ON r.source IS NOT DISTINCT FROM h.source AND r.stratum = h.stratum AND place <= more
  GROUP BY r.source, r.stratum),
taken AS (
  SELECT r.*, CAST(floor(rate) + CASE WHEN number <= last THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM rated r LEFT JOIN limits l ON r.source IS NOT DISTINCT FROM l.source AND r.stratum = l.stratum)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM taken
"""


@query
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.line_rules(table(spark, sf_dir, "documents"))


@query
def op4_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op5_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op9_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@query
def op11_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.secrets(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.grafted_trie(table(spark, sf_dir, "conversations"))


ORACLES["op3_line_frequency"] = r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT row_id, source, text AS of_text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM docs),
normal AS (
  SELECT *, regexp_replace(array_to_string(regexp_extract_all(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' '),
           '[0-9]+', '0', 'g') AS plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM lines),
counted AS (SELECT source, plain, count(DISTINCT of_text) AS n FROM normal WHERE words > 0 GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM docs GROUP BY source),
boiler AS (
  SELECT c.source, c.plain FROM counted c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n > 10 AND c.n > 0.01 * h.n),
gone AS (
  SELECT n.row_id, sum(n.words) AS removed FROM normal n JOIN boiler b
    ON n.plain = b.plain AND n.source IS NOT DISTINCT FROM b.source
  GROUP BY n.row_id),
dups AS (
  SELECT row_id, sum(k - 1) AS n FROM (SELECT row_id, line, count(*) AS k FROM normal WHERE words > 0 GROUP BY ALL)
  GROUP BY row_id),
bag AS (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
win AS (
  SELECT row_id, pos, array_to_string(w[pos:pos + 4], ' ') AS g
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS pos FROM bag WHERE len(w) >= 5)),
twice AS (SELECT row_id, pos FROM win QUALIFY count(*) OVER (PARTITION BY row_id, g) > 1),
again AS (
  SELECT row_id, count(DISTINCT word) AS n FROM (SELECT row_id, unnest(range(pos, pos + 5)) AS word FROM twice)
  GROUP BY row_id),
base AS (
  SELECT d.row_id, d.doc_id, len(b.w)::BIGINT AS n_words, length(array_to_string(b.w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(u.n, 0)::BIGINT AS n_dup_lines,
         coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(g.removed, 0)::BIGINT AS removed_words
  FROM docs d JOIN bag b USING (row_id) LEFT JOIN dups u USING (row_id) LEFT JOIN again a USING (row_id)
  LEFT JOIN gone g USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept,
       removed_words
FROM base
"""

_TEMPLATE_VALUES = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in licenses.TEMPLATES.items())
ORACLES["op7_license_scan"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
cut AS (SELECT *, string_split(text, chr(10)) AS lines, regexp_split_to_array(text, '\n[ \t\r]*\n') AS blocks FROM docs),
units AS (
  SELECT row_id, doc_id, 'line' AS unit, unnest(range(len(lines))) AS unit_no, unnest(lines) AS part FROM cut
  UNION ALL
  SELECT * FROM (SELECT row_id, doc_id, 'block' AS unit, unnest(range(len(blocks))) AS unit_no, unnest(blocks) AS part FROM cut)
  WHERE contains(part, chr(10))
  UNION ALL
  SELECT row_id, doc_id, 'text', 0, text FROM cut WHERE len(blocks) > 1),
worded AS (SELECT row_id, doc_id, unit, unit_no, regexp_extract_all(part, '[0-9a-z]+') AS w FROM units),
grams AS (
  SELECT DISTINCT row_id, doc_id, unit, unit_no, w[i] || ' ' || w[i + 1] AS g
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM worded WHERE len(w) > 1)),
sizes AS (SELECT row_id, unit, unit_no, count(*) AS n FROM grams GROUP BY ALL),
templates(license, body) AS (VALUES """ + _TEMPLATE_VALUES + r"""),
tw AS (
  SELECT license, regexp_extract_all(
           translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z]+') AS w
  FROM templates),
tg AS (SELECT DISTINCT license, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM tw)),
ts AS (SELECT license, count(*) AS n FROM tg GROUP BY license),
shared AS (
  SELECT row_id, doc_id, unit, unit_no, license, count(*) AS k FROM grams JOIN tg USING (g) GROUP BY ALL),
scored AS (
  SELECT s.*, 2.0 * k / (z.n + t.n) AS dice
  FROM shared s JOIN sizes z USING (row_id, unit, unit_no) JOIN ts t USING (license)),
best AS (
  SELECT doc_id, unit, unit_no::INTEGER AS unit_no, license, dice::DOUBLE AS dice FROM scored WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY row_id, unit, unit_no ORDER BY dice DESC, license) = 1),
placed AS (
  SELECT row_id, doc_id, i AS pos, w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT row_id, doc_id, w, unnest(range(0, len(w) - 1)) AS i
        FROM (SELECT row_id, doc_id, regexp_extract_all(text, '[0-9a-z]+') AS w FROM docs) WHERE len(w) > 1)),
hits AS (
  SELECT p.*, t.license, z.n,
         coalesce(pos - lag(pos) OVER (PARTITION BY row_id, t.license ORDER BY pos) > greatest(2, z.n // 8), true)::INTEGER AS fresh
  FROM placed p JOIN tg t USING (g) JOIN ts z USING (license)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY row_id, license ORDER BY pos) AS run FROM hits),
spans AS (
  SELECT row_id, doc_id, license, n, min(pos) AS start, max(pos) AS stop, count(DISTINCT g) AS k
  FROM runs GROUP BY row_id, doc_id, license, n, run HAVING count(DISTINCT g) >= 0.8 / 1.2 * n),
measured AS (
  SELECT s.row_id, s.doc_id, s.license, s.start, s.stop, 2.0 * s.k / (count(DISTINCT p.g) + s.n) AS dice
  FROM spans s JOIN placed p ON p.row_id = s.row_id AND p.pos BETWEEN s.start AND s.stop
  GROUP BY s.row_id, s.doc_id, s.license, s.start, s.stop, s.k, s.n),
outer_spans AS (
  SELECT * FROM (SELECT *, max(stop) OVER (PARTITION BY row_id ORDER BY start, stop DESC, dice DESC, license
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
                 FROM measured WHERE dice >= 0.8)
  WHERE reached IS NULL OR stop > reached)
SELECT * FROM best
UNION ALL
SELECT doc_id, 'span', start::INTEGER, license, dice::DOUBLE FROM outer_spans
"""

# CRC-32 of the decimal digits of an id, bit by bit (DuckDB has no such function).
_CRC32 = """CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST({id} AS VARCHAR), '')]),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) AS BIGINT)"""


def _secret_oracle() -> str:
    """Positions of matches: lengths of the texts between them and of the matches before."""
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    parts = []
    for i, rule in enumerate(ledger.RULES):
        pattern = (assign if rule.kind == "assign" else rule.pattern).replace("'", "''")
        parts.append(f"""
  SELECT row_id, '{rule.kind}' AS kind, {i} AS place, {rule.least} AS least, string_split_regex(text, '{pattern}') AS gaps,
         regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {rule.group}) AS inner_hits
  FROM docs WHERE regexp_matches(text, '{pattern}')""")
    return r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (""" + "\n  UNION ALL".join(parts) + r"""),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut),
spans AS (
  SELECT row_id, kind, place, start, start + length(hits[i]) AS stop
  FROM (SELECT *, CAST(list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN hits[1:i - 1]]), 0)
                       AS BIGINT) AS start FROM each)
  WHERE length(inner_hits[i]) >= least),
told AS (
  SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (WHERE place < 3) AS base
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       sha256(text) AS blob
FROM docs LEFT JOIN told USING (row_id)
"""


ORACLES["op11_secret_ledger"] = _secret_oracle()

_FIELDS = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
                      for c in merkle.FIELDS)
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER () AS row_id, sha256(""" + _FIELDS + r""") AS leaf,
         CASE WHEN """ + _CRC32.format(id="doc_id") + r""" % 3 = 0
              THEN sha256(""" + _FIELDS.replace("text", _LOW) + r""") END AS forged
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp, count(*) OVER (PARTITION BY lang) AS n
  FROM docs),
nodes(grp, level, pos, n, digest) AS (
  SELECT grp, 0, pos, n, leaf FROM ranked
  UNION ALL
  SELECT grp, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY grp, level, pos // 8, n),
subroots AS (SELECT grp, digest FROM nodes WHERE n = 1),
upper(level, pos, n, digest) AS (
  SELECT 0, grp, count(*) OVER (), digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1
  GROUP BY level, pos // 8, n),
steps AS (  -- the nodes of a leaf's runs, its own included, level by level up to the root
  SELECT r.row_id, n.level, n.pos, n.digest, n.pos = r.pos // CAST(pow(8, n.level) AS BIGINT) AS own
  FROM ranked r JOIN nodes n ON n.grp = r.grp AND n.n > 1 AND n.pos // 8 = r.pos // CAST(pow(8, n.level + 1) AS BIGINT)
  UNION ALL
  SELECT r.row_id, 1000 + u.level, u.pos, u.digest, u.pos = r.grp // CAST(pow(8, u.level) AS BIGINT)
  FROM ranked r JOIN upper u ON u.n > 1 AND u.pos // 8 = r.grp // CAST(pow(8, u.level + 1) AS BIGINT)),
pairs AS (
  SELECT row_id, level, dense_rank() OVER (PARTITION BY row_id ORDER BY level) AS step,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE NOT own AND pos < own_pos), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE NOT own AND pos > own_pos), '') AS after
  FROM (SELECT *, max(pos) FILTER (WHERE own) OVER (PARTITION BY row_id, level) AS own_pos FROM steps)
  GROUP BY row_id, level),
proofs AS (SELECT row_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof, max(step) AS n_steps FROM pairs GROUP BY row_id),
folded(row_id, step, node) AS (
  SELECT row_id, 0::BIGINT, coalesce(forged, leaf) FROM docs
  UNION ALL
  SELECT f.row_id, f.step + 1, sha256(p.before || f.node || p.after)
  FROM folded f JOIN pairs p ON p.row_id = f.row_id AND p.step = f.step + 1)
SELECT r.doc_id, r.leaf, s.digest AS subroot, root.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
       f.node AS folded_root, f.node = root.digest AS verified
FROM ranked r JOIN subroots s USING (grp) JOIN (SELECT digest FROM upper WHERE n = 1) root ON true
LEFT JOIN proofs p USING (row_id)
JOIN folded f ON f.row_id = r.row_id AND f.step = coalesce(p.n_steps, 0)
"""

ORACLES["op13_conversation_trie"] = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie) - 1 AS pos
  FROM (SELECT *, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tie
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT DISTINCT c, """ + _CRC32.format(id="c") + r""" % 9 AS h FROM turns),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, pos) AS d, role, text
  FROM (SELECT v.c, 1 AS side, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.pos < v.h
        UNION ALL
        SELECT v.c, 2, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h)),
prefixes AS (
  SELECT c, 0 AS d, '' AS key, '' AS up, 0 AS size FROM convs
  UNION ALL
  SELECT c, d, sha256(string_agg(one, '') OVER so_far), coalesce(nullif(coalesce(string_agg(one, '') OVER earlier, ''), ''), ''),
         strlen(text)
  FROM (SELECT *, sha256(sha256(role) || sha256(text)) AS one FROM rebuilt)
  WINDOW so_far AS (PARTITION BY c ORDER BY d), earlier AS (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
keyed AS (SELECT c, d, key, CASE WHEN up = '' THEN '' ELSE sha256(up) END AS up, size FROM prefixes),
lengths AS (SELECT c, max(d) AS n FROM keyed GROUP BY c),
nodes AS (
  SELECT d, key, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         count(*) FILTER (WHERE d = n) AS n_ends, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n) AS ends
  FROM keyed JOIN lengths USING (c) GROUP BY d, key),
below AS (  -- every node under (or equal to) a prefix of its smallest member
  SELECT a.d, a.key, sum((n.n_convs - 1) * n.size) AS saved, count(*) FILTER (WHERE n.n_ends = n.n_convs) AS leaves
  FROM nodes n JOIN keyed a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.d, a.key),
children AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.key = n.key LEFT JOIN children k ON k.d = n.d AND k.key = n.key
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.key = n.up
"""
