"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from recfold.llm import ann as D1
from recfold.llm import decontaminate as D6
from recfold.llm import lattice_lm as D10
from recfold.llm import merkle as D11
from recfold.llm import minhash_forest as D13
from recfold.llm import mixing as D4
from recfold.llm import pii as D9
from recfold.llm import simhash as D8
from recfold.llm import spelling as D12
from recfold.llm import suffix_dedup as D7
from recfold.llm import toxicity as D3
from recfold.llm import warc as D5
from recfold.llm import wrappers as D2

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark, d: str, name: str):
    return spark.read.parquet(f"{d}/{name}.parquet")


SQL_6 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM grams),
hits AS (
  SELECT p.doc_id, p.i, p.k, g.item_id FROM (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
      SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw CROSS JOIN lens WHERE len(w) >= k)) p
  JOIN grams g ON g.k = p.k AND g.g = p.g),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(x.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(x.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN words x ON x.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id"""


@register("op6_benchmark_decontamination", SQL_6)
def op6(spark, d):
    return D6.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op8_simhash_near_dedup")
def op8(spark, d):
    return D8.report(table(spark, d, "documents"))


@register("op10_lattice_likelihood")
def op10(spark, d):
    return D10.score(table(spark, d, "documents"))


SQL_5 = """
WITH p AS (SELECT page_id, url, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to, p.url
FROM p LEFT JOIN f ON f.digest = p.digest"""


@register("op5_warc_normaliser", SQL_5)
def op5(spark, d):
    return D5.round_trip(table(spark, d, "pages"))


@register("op7_suffix_array_dedup")
def op7(spark, d):
    return D7.report(table(spark, d, "documents"))


@register("op3_toxicity_string_kernel")
def op3(spark, d):
    return D3.report(table(spark, d, "documents"), table(spark, d, "labels"))


@register("op9_pii_surrogates")
def op9(spark, d):
    return D9.replace_all(table(spark, d, "documents"), count="n_entities")


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items())) + f" ELSE {D4.DEFAULT} END"


def _share_sql(name: str, level: int) -> str:
    """The split of one level of the tree, from ``up`` budgets, as CTEs."""
    path, node = D4.LEVELS[:level], D4.LEVELS[level]
    part = "PARTITION BY " + (", ".join(path) if path else "1")
    keys = ", ".join([*path, node])
    join = f"JOIN given{level - 1} USING ({', '.join(path)})" if path else "CROSS JOIN root"
    return f"""
n{level} AS (
  SELECT * FROM (SELECT {keys}, CAST(sum(cap) AS HUGEINT) AS cap, CAST(max(w_{node}) AS HUGEINT) AS w FROM caps GROUP BY {keys}) {join}),
p{level} AS (
  SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s
  FROM n{level} WINDOW o AS ({part} ORDER BY CASE WHEN w > 0 THEN CAST(cap AS DOUBLE) / CAST(w AS DOUBLE) END NULLS LAST, {node})),
f{level} AS (SELECT *, w > 0 AND cap * s <= (budget - c) * w AS is_full FROM p{level}),
r{level} AS (SELECT *, budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part}) AS rest,
                    sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({part}) AS free FROM f{level}),
g{level} AS (SELECT *, CASE WHEN is_full THEN cap WHEN free > 0 THEN (rest * w) // free ELSE 0 END AS lo FROM r{level}),
given{level} AS (
  SELECT {keys}, lo + CASE WHEN NOT is_full AND w > 0 AND
      sum(CASE WHEN NOT is_full AND w > 0 THEN 1 ELSE 0 END) OVER ({part} ORDER BY {node} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      <= rest - sum(CASE WHEN NOT is_full AND w > 0 THEN lo ELSE 0 END) OVER ({part}) THEN 1 ELSE 0 END AS budget
  FROM g{level}),"""


SQL_4 = rf"""
WITH d AS (
  SELECT *, coalesce(lang, '') AS l, coalesce(source, '') AS s, len(regexp_extract_all(coalesce(text, ''), '{D4.TOKEN}')) AS n_tokens,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
              ELSE 'domain' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 3 AS VARCHAR) END AS domain,
         coalesce(CAST(doc_id AS VARCHAR), '#' || md5(coalesce(text, ''))) AS k FROM documents),
leaves AS (SELECT domain, l AS lang, s AS source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
caps AS (SELECT *, tokens * {D4.MAX_EPOCHS} AS cap, {_case("domain", D4.DOMAIN_WEIGHTS)} AS w_domain,
                {_case("lang", D4.LANG_WEIGHTS)} AS w_lang, 1 AS w_source FROM leaves),
root AS (SELECT least(sum(tokens) * {D4.BUDGET[0]} // {D4.BUDGET[1]}, sum(cap)) AS budget FROM caps),
{"".join(_share_sql("g", i) for i in range(3))}
plan AS (SELECT *, CAST(budget // tokens AS INT) AS epochs, budget % tokens AS rest FROM leaves JOIN given2 USING (domain, lang, source) WHERE tokens > 0),
o AS (SELECT d.*, p.epochs, p.rest, md5('{D4.SEED}/' || p.epochs || '/' || d.k) AS h
      FROM d JOIN plan p ON p.domain = d.domain AND p.lang = d.l AND p.source = d.s),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM o),
stops AS (SELECT domain, l, s, min(h) AS stop FROM c WHERE upto > rest GROUP BY ALL)
SELECT o.doc_id, o.domain, o.lang, o.source, CAST(o.n_tokens AS BIGINT) AS n_tokens,
       unnest(range(0, CAST(o.epochs + CASE WHEN o.rest > 0 AND (t.stop IS NULL OR o.h < t.stop) THEN 1 ELSE 0 END AS BIGINT)))::INT AS epoch
FROM o LEFT JOIN stops t ON t.domain = o.domain AND t.l = o.l AND t.s = o.s"""


@register("op4_hierarchical_mixing", SQL_4)
def op4(spark, d):
    return D4.report(table(spark, d, "documents"))


@register("op2_wrapper_main_text")
def op2(spark, d):
    return D2.extract(table(spark, d, "pages"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


@register("op1_rotated_bit_codes")
def op1(spark, d):
    return D1.report(table(spark, d, "embeddings"))


def _crc32_sql(codes: str) -> str:
    """CRC-32 of a list of byte values."""
    bit = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {bit}), 4294967295::BIGINT)"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWERED = f"translate(text, '{D11.UPPER}', '{D11.LOWER}')"
_DIGITS = "list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: ascii(c)::BIGINT)"
#: Levels of a tree in the SQL form: enough for 16 ** 8 leaves.
SQL_LEVELS = 8


def _levels_sql(name: str, key: str) -> str:
    """CTEs of all levels of the trees over ``{name}0 (key, i, m, d)``: runs of each level, and the level above."""
    out = []
    for k in range(SQL_LEVELS):
        out.append(f"""
{name}_run{k} AS (SELECT {key}, i // {D11.FAN} AS r, any_value(m) AS m, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY ALL),
{name}{k + 1} AS (SELECT {key}, r AS i, (m + {D11.FAN - 1}) // {D11.FAN} AS m,
                         CASE WHEN m > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}_run{k}),""")
    return "".join(out)


def _paths_sql(name: str, key: str, at: str, start: str) -> str:
    """CTEs that take every document from level to level: the siblings' text and the folded hash grow."""
    out, before = [], start
    for k in range(SQL_LEVELS):
        rest = f"r.ds[1:p.{at} % {D11.FAN}], r.ds[p.{at} % {D11.FAN} + 2:]"
        left, right = rest.split(", ")
        out.append(f"""
{name}_path{k} AS (
  SELECT p.* REPLACE (p.{at} // {D11.FAN} AS {at}, p.proof || array_to_string(list_concat({left}, {right}), '') AS proof,
                      CASE WHEN r.m > 1 THEN sha256(array_to_string({left}, '') || p.folded || array_to_string({right}, '')) ELSE p.folded END AS folded)
  FROM {before} p JOIN {name}_run{k} r ON r.{key} = p.{key} AND r.r = p.{at} // {D11.FAN}),""")
        before = f"{name}_path{k}"
    return "".join(out)


SQL_11 = f"""
WITH d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS s, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_crc32_sql(_DIGITS)} % 5 = 0 THEN {_leaf_sql(_LOWERED)} ELSE {_leaf_sql("text")} END AS changed FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                    count(*) OVER (PARTITION BY s) AS m, dense_rank() OVER (ORDER BY s) - 1 AS t FROM d),
low0 AS (SELECT t, i, m, leaf AS d FROM numbered),
{_levels_sql("low", "t")}
high0 AS (SELECT 0 AS g, t AS i, count(*) OVER () AS m, d FROM low{SQL_LEVELS}),
{_levels_sql("high", "g")}
p0 AS (SELECT doc_id, leaf, 0 AS g, t, i, t AS ti, '' AS proof, changed AS folded FROM numbered),
{_paths_sql("low", "t", "i", "p0")}
{_paths_sql("high", "g", "ti", f"low_path{SQL_LEVELS - 1}")}
done AS (SELECT p.doc_id, p.leaf, l.d AS subroot, h.d AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root
         FROM high_path{SQL_LEVELS - 1} p JOIN low{SQL_LEVELS} l ON l.t = p.t CROSS JOIN high{SQL_LEVELS} h)
SELECT *, folded_root = root AS verified FROM done"""


@register("op11_merkle_multiproof", SQL_11)
def op11(spark, d):
    return D11.report(table(spark, d, "documents"))


_CODES = (f"flatten([list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda c: ascii(c)::BIGINT), "
          "flatten(list_transform(string_split(run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, (ord(c) - 64)::BIGINT] END))])")
SQL_12 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '{D12.WORD}')) AS run FROM documents) GROUP BY ALL),
hashed AS MATERIALIZED (SELECT run, c, {_crc32_sql(_CODES)} AS h FROM runs),
w AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n, length(word) AS len FROM (
    SELECT CASE WHEN h % {D12.DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= {D12.MIN_LENGTH} GROUP BY word HAVING sum(c) >= {D12.MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, n, len, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(len)) AS i FROM w)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {D12.RATIO} * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= {D12.RATIO} * w.n THEN b.other_n END AS form_n FROM w LEFT JOIN best b USING (word)),
far AS (SELECT word, word AS at FROM formed UNION SELECT far.word, f.form FROM far JOIN formed f ON f.word = far.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, far.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN far USING (word) JOIN formed e ON e.word = far.at AND e.form IS NULL"""


@register("op12_spelling_variants", SQL_12)
def op12(spark, d):
    return D12.report(table(spark, d, "documents"))


SQL_13 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^ 	-]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM texts),
sized AS MATERIALIZED (SELECT doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sized x ON x.doc_id = a.doc_id JOIN sized y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {D13.PERCENT} * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN least USING (doc_id)"""


@register("op13_lsh_forest", SQL_13)
def op13(spark, d):
    return D13.report(table(spark, d, "documents"))
