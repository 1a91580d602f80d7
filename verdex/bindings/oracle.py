"""DuckDB SQL for the registered queries, written from the semantics and not from the Spark code.

Paragraphs are a list fold here (a regex scan there), stems a join with the rule table (a CASE
expression there), ranks one window (two steps there), neighbours a full distance table.
"""

from __future__ import annotations

from verdex.bindings.queries import FIRST_YEAR, FLAGS, FOLDS, LAST_YEAR, PAGE_HITS, REPEATS, TERMS
from verdex.functions.stem_rules import STEPS
from verdex.operators.catalogue import CATALOGUE_FIELDS, DATE_COLUMNS
from verdex.sources.pages import FLAG_FIELDS

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_CODES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS_CHARS = " || ".join(f"chr({c})" for c in WS_CODES)
TERM_LIST = "[" + ", ".join(f"'{t}'" for t in TERMS) + "]"
YEARS = f"range({FIRST_YEAR}, {LAST_YEAR + 1})"


def strip(c: str) -> str:
    return f"trim({c}, {WS_CHARS})"


def matched(c: str) -> str:
    return f"array_to_string(list_filter({TERM_LIST}, lambda t: contains(lower({c}), lower(t))), ', ')"


# Common table expressions -----------------------------------------------------------------------

PARAGRAPHS = f"""
sentences AS (
  SELECT doc_id, list_filter(list_transform(
    string_split(regexp_replace(text, '[{WS}]+', ' ', 'g'), '.'), lambda s: trim(s)), lambda s: s <> '') AS ss
  FROM documents),
steps AS (
  SELECT doc_id, list_prepend({{'done': []::VARCHAR[], 'cur': ''}},
    list_transform(ss, lambda s: {{'done': []::VARCHAR[], 'cur': s}})) AS st FROM sentences),
folded AS (
  SELECT doc_id, list_reduce(st, lambda a, b:
    CASE WHEN length(CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || '. ' || b.cur END) >= 300
      THEN {{'done': list_append(a.done, CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || '. ' || b.cur END || '.'), 'cur': ''}}
      ELSE {{'done': a.done, 'cur': CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || '. ' || b.cur END}} END) AS f
  FROM steps),
lists AS (
  SELECT doc_id, CASE WHEN f.cur <> '' THEN list_append(f.done, f.cur || '.') ELSE f.done END AS ps FROM folded),
paras AS (
  SELECT doc_id, CAST(generate_subscripts(ps, 1) - 1 AS INTEGER) AS pos, unnest(ps) AS paragraph FROM lists)"""


def tokens_cte(source: str = "documents", id: str = "doc_id") -> str:
    """toks(id, toks): normalised tokens per row."""
    return f"""
toks AS (
  SELECT {id}, list_filter(string_split_regex(
    regexp_replace(lower(text), '[^a-zA-Zà-úÀ-Ú{WS}]', '', 'g'), '[{WS}]+'), lambda t: t <> '') AS toks
  FROM {source})"""


def rules_values() -> str:
    rows = []
    for number, rules in enumerate(STEPS.values()):
        for place, r in enumerate(rules):
            exceptions = "[" + ", ".join(f"'{w}'" for w in r.exceptions) + "]::VARCHAR[]"
            rows.append(f"({number}, {place}, '{r.suffix}', {r.min_stem}, '{r.replacement}', {exceptions})")
    return ", ".join(rows)


def stem_cte() -> str:
    """stems(token, stem) for the distinct tokens of `toks`."""
    parts = [
        f"rules(step, place, suffix, least, put, exc) AS (VALUES {rules_values()})",
        "s0 AS (SELECT token, token AS w, false AS done FROM (SELECT DISTINCT unnest(toks) AS token FROM toks))",
    ]
    # Step order: plural, feminine, augmentative, adverb, noun; then verb and vowel if unchanged.
    for i, (step, when) in enumerate(
        [(0, "ends_with(w, 's')"), (1, "ends_with(w, 'a')"), (2, "true"), (3, "true"),
         (4, "true"), (5, "NOT done"), (6, "NOT done")]
    ):
        done = "coalesce(n, w) <> w" if step == 4 else ("done OR coalesce(n, w) <> w" if step > 4 else "false")
        parts.append(f"""
h{i} AS (
  SELECT s.w AS key, arg_min(left(s.w, length(s.w) - length(suffix)) || put, place) AS n
  FROM (SELECT DISTINCT w FROM s{i}) s JOIN rules ON step = {step} AND ends_with(s.w, suffix)
    AND length(s.w) >= length(suffix) + least AND NOT list_contains(exc, s.w)
  GROUP BY s.w),
s{i + 1} AS (
  SELECT token, CASE WHEN {when} THEN coalesce(n, w) ELSE w END AS w,
    CASE WHEN {when} THEN {done} ELSE done END AS done
  FROM s{i} LEFT JOIN h{i} ON key = w)""")
    parts.append("stems AS (SELECT token, w AS stem FROM s7)")
    return ", ".join(parts)


def grams_cte(source: str = "toks", id: str = "doc_id") -> str:
    """cells(id, term): one row per 1- or 2-gram occurrence."""
    return f"""
words AS (
  SELECT {id}, regexp_extract_all(array_to_string(toks, ' '), '[a-zà-öø-ú]{{2,}}') AS ws FROM {source}),
cells AS (
  SELECT {id}, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term
  FROM words)"""


def vocab_cte(cells: str, n_rows: str, id: str = "doc_id", size: int = 1500) -> str:
    return f"""
vocab AS (
  SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx, ln((1 + nr) / (1 + n_docs)) + 1 AS idf
  FROM (
    SELECT term, count(*) AS n_total, count(DISTINCT {id}) AS n_docs, {n_rows} AS nr
    FROM {cells} GROUP BY term HAVING count(DISTINCT {id}) <= 0.95 * {n_rows}
    ORDER BY n_total DESC, term LIMIT {size}))"""


def tfidf_cte(cells: str, id: str = "doc_id") -> str:
    return f"""
weighed AS (
  SELECT {id}, term, count(*) * any_value(idf) AS w FROM {cells} JOIN vocab USING (term) GROUP BY {id}, term),
tfidf AS (SELECT {id}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id})) AS value FROM weighed)"""


def deviations(source: str, n_rows: str) -> str:
    return f"""
devs AS (
  SELECT term, sqrt(c / n * v + c / n * (1 - c / n) * m * m) AS sd
  FROM (SELECT term, count(*) AS c, var_pop(value) AS v, avg(value) AS m, {n_rows} AS n FROM {source} GROUP BY term))"""


N_DOCS = "(SELECT count(*) FROM documents)"
UNSTEMMED = f"{tokens_cte()}, {grams_cte()}, {vocab_cte('cells', N_DOCS)}"

LABELLED = """
labelled AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'Sim' ELSE 'Não' END AS label, quality, toxic FROM labels)"""

RESULTS = """
results AS (
  SELECT o_orderdate AS data, o_orderpriority AS classe, n_name AS relator, CAST(year(o_orderdate) AS INTEGER) AS ano
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderdate IS NOT NULL)"""

SHIPMENTS = "shipments AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano FROM lineitem WHERE l_shipdate IS NOT NULL)"

SPINE = f"spine AS (SELECT CAST(unnest({YEARS}) AS INTEGER) AS ano)"


def top(col: str, k: int, source: str = "results") -> str:
    return f"""
top AS (
  SELECT {col}, CAST(row_number() OVER (ORDER BY n DESC, {col}) - 1 AS INTEGER) AS place
  FROM (SELECT {col}, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY {col})
  QUALIFY place < {k})"""


CONFUSION_SUMS = """
count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label <> 1 AND prediction = 1) AS fp,
count(*) FILTER (label = 1 AND prediction <> 1) AS fn, count(*) FILTER (label <> 1 AND prediction <> 1) AS tn"""

METRIC_SQL = """
round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision_sim,
round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
round((CASE WHEN tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END
  + CASE WHEN tn + fp + fn = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fp + fn) END)
  / (CAST(tp + fp + fn > 0 AS INTEGER) + CAST(tn + fp + fn > 0 AS INTEGER)), 6) AS f1_macro"""

EVENT_SCORES = """
scores AS (
  SELECT event_type AS model, user_id % 10 AS fold, round(avg(value), 5) AS score FROM events GROUP BY ALL),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY fold ORDER BY score) + (tied - 1) / 2 AS r
  FROM (SELECT *, count(*) OVER (PARTITION BY fold, score) AS tied FROM scores))"""

TEST_SCORES = """
tested AS (
  SELECT event_type AS model, round(avg(value), 6) AS accuracy, round(avg(value * value), 6) AS precision_sim,
    round(avg(sqrt(abs(value))), 6) AS f1_macro
  FROM events GROUP BY event_type)"""

PAGED = f"paged AS (SELECT *, event_id // {PAGE_HITS} AS page FROM events)"


def catalogue_sql() -> str:
    given = {
        "id": "CAST(event_id AS VARCHAR)",
        "titulo": "event_type",
        "base": "'events'",
        "score": "value",
        "relator_processo": "CAST(user_id AS VARCHAR)",
        "julgamento_data": "date_trunc('second', ts)",
        "publicacao_data": "CAST(CAST(ts AS DATE) AS TIMESTAMP)",
        **{flag: f"event_type = '{kind}'" for flag, kind in FLAGS.items()},
        "ministro_facet": "CASE WHEN event_type = 'click' THEN event_type || '; ' || user_id ELSE event_type END",
        "ementa_texto": "CASE WHEN length(body) > 1000 THEN left(body, 1000) || '...' ELSE body END",
    }
    cols = []
    for name in CATALOGUE_FIELDS:
        kind = "BOOLEAN" if name in FLAG_FIELDS else "TIMESTAMP" if name in DATE_COLUMNS else "VARCHAR"
        cols.append(f"{given.get(name, f'CAST(NULL AS {kind})')} AS {name}")
    body = "trim(repeat(props || ' ', CAST(least(120, user_id) AS INTEGER)))"
    return f"SELECT {', '.join(cols)} FROM (SELECT *, {body} AS body FROM events)"


def html_sql() -> str:
    c = "html"
    for block in ("<!--.*?-->", *(rf"<{t}\b.*?</{t}>" for t in ("script", "style", "nav", "footer"))):
        c = f"regexp_replace({c}, '{block}', ' ', 'gis')"
    c = f"regexp_replace({c}, '<[^>]*>', ' ', 'gs')"
    return strip(f"regexp_replace({c}, '[{WS}]+', ' ', 'g')")


def profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type, "
        f"count({c}) AS non_null, count(*) AS rows FROM {table}"
        for i, (c, t) in enumerate(columns.items(), start=1)
    )


def fold_sql(k: int, repeats: int) -> str:
    return f"""
folds AS (
  SELECT CAST(repeat AS INTEGER) AS repeat, doc_id, label, CAST((row_number() OVER (
    PARTITION BY repeat, label ORDER BY md5((repeat + 42) || ':' || doc_id)) - 1) % {k} AS INTEGER) AS fold
  FROM labelled, (SELECT unnest(range(0, {repeats})) AS repeat))"""


def knn_sql(k: int = 3) -> str:
    return f"""
WITH rows AS (
  SELECT doc_id AS row_id, CAST(quality AS DOUBLE) AS label, text FROM labels JOIN documents USING (doc_id)),
split AS (
  SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id))
    <= ceil(0.25 * count(*) OVER (PARTITION BY label)) AS is_test FROM rows),
{tokens_cte('rows', 'row_id')},
{stem_cte()},
placed AS (SELECT row_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS place FROM toks),
stemmed AS (SELECT row_id, list(stem ORDER BY place) AS toks FROM placed JOIN stems USING (token) GROUP BY row_id),
{grams_cte('stemmed', 'row_id')},
seen AS (SELECT cells.* FROM cells JOIN split USING (row_id) WHERE NOT is_test),
{vocab_cte('seen', '(SELECT count(*) FROM split WHERE NOT is_test)', 'row_id')},
{tfidf_cte('cells', 'row_id')},
known AS (SELECT tfidf.* FROM tfidf JOIN split USING (row_id) WHERE NOT is_test),
{deviations('known', '(SELECT count(*) FROM split WHERE NOT is_test)')},
scaled AS (
  SELECT row_id, term, CASE WHEN sd > 1e-9 THEN value / sd ELSE value END AS x, is_test
  FROM tfidf JOIN devs USING (term) JOIN split USING (row_id)),
norms AS (SELECT row_id, coalesce(sum(x * x), 0) AS nn FROM split LEFT JOIN scaled USING (row_id) GROUP BY row_id),
dots AS (
  SELECT a.row_id AS q, b.row_id AS t, sum(a.x * b.x) AS dot
  FROM scaled a JOIN scaled b ON a.term = b.term AND a.is_test AND NOT b.is_test GROUP BY ALL),
pairs AS (
  SELECT q.row_id AS q, t.row_id AS t, t.label,
    round(greatest(nq.nn + nt.nn - 2 * coalesce(dot, 0), 0), 9) AS squared
  FROM split q JOIN split t ON q.is_test AND NOT t.is_test
  JOIN norms nq ON nq.row_id = q.row_id JOIN norms nt ON nt.row_id = t.row_id
  LEFT JOIN dots ON dots.q = q.row_id AND dots.t = t.row_id),
votes AS (
  SELECT q, avg(label) AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY squared, t) AS nth FROM pairs) WHERE nth <= {k} GROUP BY q)
SELECT row_id, label, CAST(p > 0.5 AS DOUBLE) AS prediction, round(greatest(p, 1 - p), 6) AS confidence
FROM split JOIN votes ON q = row_id WHERE is_test"""


def cascade_sql() -> str:
    """The selection cascade, one group of table expressions per metric.

    Rivals are told by the published 5 % critical values of the Nemenyi test for 2 to 5 models;
    chi-square tails are closed forms for 2, 3 and 4 degrees of freedom.
    """
    metrics = {
        "precision_sim": "round(avg(value + 6.0 * least(length(event_type), 6)), 5)",
        "accuracy": "max(value)",
        "f1_macro": "min(value)",
    }
    parts = [
        f"""cv AS (SELECT event_type AS model, user_id % 10 AS block, {', '.join(f'{sql} AS {m}' for m, sql in metrics.items())}
        FROM events GROUP BY ALL)""",
        "c0 AS (SELECT DISTINCT event_type AS model FROM events)",
        "critical(k, q) AS (VALUES (2, 1.960), (3, 2.343), (4, 2.569), (5, 2.728))",
        TEST_SCORES,
    ]
    traces = []
    for i, metric in enumerate(metrics, start=1):
        parts.append(f"""
n{i} AS (SELECT count(*) AS k FROM c{i - 1}),
t{i} AS (
  SELECT block, model, {metric} AS score, count(*) OVER (PARTITION BY block, {metric}) AS tied,
    rank() OVER (PARTITION BY block ORDER BY {metric}) + (count(*) OVER (PARTITION BY block, {metric}) - 1) / 2 AS r
  FROM cv JOIN c{i - 1} USING (model)),
m{i} AS (SELECT model, avg(r) AS mr, sum(r) AS sr, avg(score) AS mean, count(*) AS n FROM t{i} GROUP BY model),
f{i} AS (
  SELECT k, max(n) AS n, sum(sr * sr) AS ss, (SELECT sum(tied * tied - 1) FROM t{i}) AS ties FROM m{i}, n{i} GROUP BY k),
x{i} AS (
  SELECT k, CASE WHEN k > 2 AND ties < n * k * (k * k - 1)
    THEN (12 / (n * k * (k + 1)) * ss - 3 * n * (k + 1)) / (1 - ties / (n * k * (k * k - 1))) END AS x FROM f{i}),
p{i} AS (
  SELECT CASE k WHEN 3 THEN exp(-x / 2) WHEN 5 THEN exp(-x / 2) * (1 + x / 2)
    WHEN 4 THEN sqrt(2 * x / pi()) * exp(-x / 2) + 1 - sqrt(2 / pi()) * (
      SELECT sum(exp((2 * i + 1) * ln(sqrt(greatest(x, 1e-300))) - l - x / 2))
      FROM (SELECT i, sum(ln(2 * i + 1)) OVER (ORDER BY i) AS l FROM (SELECT unnest(range(0, 300)) AS i))) END AS p
  FROM x{i}),
b{i} AS (SELECT model AS best, mr AS best_rank FROM m{i} ORDER BY round(mean, 12) DESC, model LIMIT 1),
c{i} AS (
  SELECT model FROM m{i}, b{i}, n{i}, p{i} JOIN critical ON true
  WHERE critical.k = n{i}.k AND (p IS NULL OR p >= 0.05 OR model = best
    OR abs(mr - best_rank) / sqrt(n{i}.k * (n{i}.k + 1) / (6.0 * n)) < q)
  UNION SELECT model FROM c{i - 1} WHERE (SELECT k FROM n{i}) = 1)""")
        traces.append(f"""SELECT CAST({i} AS INTEGER) AS step, '{metric}' AS metric, round((SELECT p FROM p{i}), 6) AS p_value, model
        FROM c{i} WHERE (SELECT k FROM n{i}) > 1""")
    last = len(metrics)
    traces.append(f"""SELECT * FROM (SELECT CAST({last + 1} AS INTEGER), 'test accuracy', CAST(NULL AS DOUBLE), model
        FROM tested JOIN c{last} USING (model) WHERE (SELECT count(*) FROM c{last}) > 1 ORDER BY accuracy DESC, model LIMIT 1)""")
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(traces)}"


ORACLE: dict[str, str] = {
    "ingest_hits": f"""WITH {PAGED}
        SELECT unnest(['invalid JSON', 'no result.hits.hits']) AS reason, count(DISTINCT page) AS n FROM paged""",
    "merge_pages": f"""WITH {PAGED}
        SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY event_id) - 1 AS INTEGER) AS pos,
          CAST(event_id AS VARCHAR) AS id, value AS score FROM paged""",
    "hits_audit": f"""WITH {PAGED}
        SELECT count(DISTINCT page) AS pages, count(*) + count(*) FILTER (event_type = 'error') AS declared,
          count(*) AS actual, count(*) FILTER (event_type = 'error') AS missing FROM paged""",
    "catalogue": catalogue_sql(),
    "positional_load": """SELECT c_custkey AS label, c_name AS nome_pdf, c_nationkey AS termos_encontrados,
        c_mktsegment AS text FROM customer WHERE c_mktsegment IS NOT NULL""",
    "labelled_only": """SELECT o_orderstatus AS label, o_orderkey AS nome_pdf, o_custkey AS termos_encontrados,
        o_orderpriority AS text FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IN ('F', 'O')""",
    "resolve_columns": f"""WITH {RESULTS}
        SELECT ano || '|' || classe || '|' || relator AS k, count(*) AS n FROM results GROUP BY ALL""",
    "yearly_counts_b": f"WITH {SHIPMENTS} SELECT ano, count(*) AS n FROM shipments GROUP BY ano",
    "extract_text": f"SELECT page_id, {html_sql()} AS text FROM pages",
    "fold_pages": f"""SELECT conv_id, {strip("string_agg(text, chr(10) ORDER BY turn)")} AS text
        FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""",
    "list_to_string": """SELECT p_partkey,
          CASE WHEN p_size < 40 THEN j END AS joined, j AS from_variant
        FROM (SELECT *, p_name || CASE WHEN p_size < 25 THEN '; ' || p_brand ELSE '' END || '; ' || p_size AS j FROM part)""",
    "clean_text": f"SELECT doc_id, {strip('translate(text, chr(10) || chr(13), chr(32) || chr(32))')} AS text FROM documents",
    "truncate_text": """SELECT doc_id, CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS text
        FROM documents""",
    "coerce_dates": """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O')
        THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS julgamento_data FROM orders""",
    "select_present": "SELECT c_name, c_nationkey, c_mktsegment FROM customer",
    "head": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "profile": profile_sql("orders", {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}),
    "label_encode": """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label_index,
        o_orderpriority AS decoded FROM orders""",
    "normalise_tokens": f"WITH {tokens_cte()} SELECT doc_id, array_to_string(toks, ' ') AS tokens FROM toks",
    "term_match": f"SELECT * FROM (SELECT doc_id, {matched('text')} AS terms FROM documents) WHERE terms <> ''",
    "search_any": f"SELECT doc_id FROM documents WHERE {matched('text')} <> ''",
    "paragraphs": f"WITH {PARAGRAPHS} SELECT doc_id, pos, paragraph FROM paras",
    "dedup_prefix": f"""WITH {PARAGRAPHS} SELECT doc_id, pos, paragraph FROM paras
        QUALIFY row_number() OVER (PARTITION BY doc_id, left(paragraph, 100) ORDER BY pos) = 1""",
    "term_paragraphs": f"""WITH {PARAGRAPHS}, found AS (SELECT *, {matched('paragraph')} AS terms FROM paras)
        SELECT doc_id, pos, terms, paragraph FROM found WHERE terms <> ''
        QUALIFY row_number() OVER (PARTITION BY doc_id, left(paragraph, 100) ORDER BY pos) = 1""",
    "stem_vocab": f"WITH {tokens_cte()}, {stem_cte()} SELECT token, stem FROM stems",
    "ngrams": f"""WITH {tokens_cte()}, {grams_cte()}
        SELECT term, count(*) AS n_total, count(DISTINCT doc_id) AS n_docs FROM cells GROUP BY term""",
    "tfidf_top_terms": f"""WITH {UNSTEMMED}
        SELECT term, CAST(idx AS INTEGER) AS idx, n_total, n_docs, round(idf, 6) AS idf FROM vocab""",
    "tfidf_terms": f"WITH {UNSTEMMED}, {tfidf_cte('cells')} SELECT doc_id, term, round(value, 6) AS value FROM tfidf",
    "scale_features": f"""WITH {UNSTEMMED}, {tfidf_cte('cells')}, {deviations('tfidf', N_DOCS)}
        SELECT doc_id, term, round(CASE WHEN sd > 1e-9 THEN value / sd ELSE value END, 6) AS value
        FROM tfidf JOIN devs USING (term)""",
    "missing_files": """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "extra_files": """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "catalogue_audit": """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "duplicate_stats": """SELECT count(*) AS total, count(DISTINCT text) + max(CAST(text IS NULL AS INTEGER)) AS distinct_values,
        count(*) - count(DISTINCT text) - max(CAST(text IS NULL AS INTEGER)) AS duplicates FROM documents""",
    "duplicate_rows": """SELECT doc_id, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS preview,
        count(*) OVER (PARTITION BY text) AS copies FROM documents WHERE text IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY text) > 1""",
    "value_counts": "SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand",
    "label_share": f"""WITH {LABELLED}
        SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM labelled GROUP BY label""",
    "top_k": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 8",
    "year_spine": f"""WITH {RESULTS}, {SPINE}
        SELECT spine.ano, count(results.ano) AS n FROM spine LEFT JOIN results USING (ano) GROUP BY spine.ano""",
    "compare_years": f"""WITH {RESULTS}, {SHIPMENTS}, {SPINE}
        SELECT ano, (SELECT count(*) FROM results r WHERE r.ano = s.ano) AS n_a,
          (SELECT count(*) FROM shipments p WHERE p.ano = s.ano) AS n_b FROM spine s""",
    "crosstab_top": f"""WITH {RESULTS}, {top('relator', 6)}, years AS (SELECT DISTINCT ano FROM results)
        SELECT y.ano, place, t.relator, count(r.ano) AS n FROM years y CROSS JOIN top t
        LEFT JOIN results r ON r.ano = y.ano AND r.relator = t.relator GROUP BY ALL""",
    "crosstab_pct": f"""WITH {RESULTS}, {top('relator', 6)}
        SELECT ano, relator, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ano), 6) AS pct
        FROM results JOIN top USING (relator) GROUP BY ano, relator""",
    "crosstab_t": f"""WITH {RESULTS}, {top('relator', 6)}, {SPINE}
        SELECT t.relator, CAST(s.ano - {FIRST_YEAR} AS INTEGER) AS place, CAST(s.ano AS VARCHAR) AS ano, count(r.ano) AS n
        FROM top t CROSS JOIN spine s LEFT JOIN results r ON r.ano = s.ano AND r.relator = t.relator GROUP BY ALL""",
    "report_top_class": """SELECT p_brand AS classe, count(*) AS n FROM part GROUP BY p_brand
        ORDER BY n DESC, p_brand LIMIT 8""",
    "report_top_rapporteur": f"""WITH {RESULTS}
        SELECT relator, count(*) AS n FROM results GROUP BY relator ORDER BY n DESC, relator LIMIT 15""",
    "report_rapporteur_year": f"""WITH {RESULTS}, {top('relator', 6)}, {SPINE}
        SELECT s.ano, place, t.relator, count(r.ano) AS n FROM spine s CROSS JOIN top t
        LEFT JOIN results r ON r.ano = s.ano AND r.relator = t.relator GROUP BY ALL""",
    "report_class_pct": f"""WITH {RESULTS}, {top('classe', 4)}, {SPINE}, n AS (
          SELECT s.ano, place, t.classe, count(r.ano) AS n FROM spine s CROSS JOIN top t
          LEFT JOIN results r ON r.ano = s.ano AND r.classe = t.classe GROUP BY ALL)
        SELECT ano, place, classe, round(CASE WHEN sum(n) OVER (PARTITION BY ano) = 0 THEN 0.0
          ELSE 100.0 * n / sum(n) OVER (PARTITION BY ano) END, 6) AS pct FROM n""",
    "report_class_heat": f"""WITH {RESULTS}, {top('classe', 4)}, {SPINE}
        SELECT t.classe, CAST(s.ano - {FIRST_YEAR} AS INTEGER) AS place, CAST(s.ano AS VARCHAR) AS ano, count(r.ano) AS n
        FROM top t CROSS JOIN spine s LEFT JOIN results r ON r.ano = s.ano AND r.classe = t.classe GROUP BY ALL""",
    "stratified_split": f"""WITH {LABELLED}
        SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id))
          <= ceil(0.25 * count(*) OVER (PARTITION BY label)) AS is_test FROM labelled""",
    "fold_table": f"WITH {LABELLED}, {fold_sql(10, 5)} SELECT * FROM folds",
    "class_weights": f"""WITH {LABELLED}
        SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
        FROM labelled GROUP BY label""",
    "confusion": """SELECT quality, count(*) FILTER (toxic = 0) AS predicted_0, count(*) FILTER (toxic = 1) AS predicted_1
        FROM labels GROUP BY quality""",
    "binary_metrics": f"""WITH s AS (SELECT {CONFUSION_SUMS} FROM (SELECT quality AS label, toxic AS prediction FROM labels))
        SELECT {METRIC_SQL} FROM s""",
    "class_report": """WITH per AS (
          SELECT c AS name, sum(CAST(quality = c AND toxic = c AS INTEGER)) AS hit,
            sum(CAST(toxic = c AS INTEGER)) AS called, sum(CAST(quality = c AS INTEGER)) AS support
          FROM labels, (SELECT unnest([0, 1]) AS c) GROUP BY c),
        m AS (
          SELECT CAST(name AS VARCHAR) AS name, CASE WHEN called = 0 THEN 0.0 ELSE hit / called END AS precision,
            CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS recall,
            CASE WHEN called + support = 0 THEN 0.0 ELSE 2 * hit / (called + support) END AS f1,
            CAST(support AS BIGINT) AS support, hit FROM per),
        a AS (
          SELECT name, precision, recall, f1, support FROM m
          UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM m
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM m)
        SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
          CAST(support AS BIGINT) AS support FROM a""",
    "fold_metrics": f"""WITH {LABELLED}, {fold_sql(FOLDS, REPEATS)}, pred AS (
          SELECT d.source AS model, repeat, fold, quality AS label, toxic AS prediction
          FROM folds JOIN labels USING (doc_id) JOIN documents d USING (doc_id)),
        s AS (SELECT model, repeat, fold, {CONFUSION_SUMS} FROM pred GROUP BY ALL)
        SELECT model, repeat, fold, {METRIC_SQL} FROM s""",
    "grid_summary": f"""WITH {EVENT_SCORES}, m AS (
          SELECT model, avg(score) AS a, stddev_pop(score) AS s FROM scores GROUP BY model)
        SELECT model, round(a, 6) AS mean_score, round(s, 6) AS std_score,
          CAST(rank() OVER (ORDER BY round(a, 12) DESC) AS INTEGER) AS rank FROM m""",
    "model_summary": f"""WITH {TEST_SCORES}, f AS (
          SELECT event_type AS model, user_id % 10 AS fold, round(avg(value + 6.0 * least(length(event_type), 6)), 5) AS p, max(value) AS a FROM events GROUP BY ALL),
        cv AS (SELECT model, avg(a) AS a, avg(p) AS p FROM f GROUP BY model)
        SELECT model, round(a, 6) AS cv_accuracy, round(p, 6) AS cv_precision_sim, accuracy AS test_accuracy,
          precision_sim AS test_precision_sim, f1_macro AS test_f1_macro FROM cv LEFT JOIN tested USING (model)""",
    "model_comparison": f"""WITH {TEST_SCORES}
        SELECT model, 'accuracy' AS metric, accuracy AS score FROM tested
        UNION ALL SELECT model, 'precision_sim', precision_sim FROM tested""",
    "friedman_stat": f"""WITH {EVENT_SCORES}, k AS (
          SELECT count(DISTINCT model) AS k, count(DISTINCT fold) AS n FROM ranked),
        sums AS (SELECT sum(s * s) AS ss FROM (SELECT sum(r) AS s FROM ranked GROUP BY model)),
        ties AS (SELECT coalesce(sum(t * t * t - t), 0) AS t FROM (SELECT count(*) AS t FROM scores GROUP BY fold, score)),
        x AS (SELECT k, n, (12 / (n * k * (k + 1)) * ss - 3 * n * (k + 1)) / (1 - t / (n * k * (k * k - 1))) AS x
          FROM k, sums, ties)
        SELECT k AS items, n AS blocks, round(x, 6) AS statistic, round(exp(-x / 2) * (1 + x / 2), 6) AS p_value FROM x""",
    # The p-value integrates pdf(z) * (cdf(z) - cdf(z - s))^(k - 1); the cdf is its power series.
    "nemenyi_q": f"""WITH {EVENT_SCORES}, m AS (SELECT model, avg(r) AS r, count(*) AS n FROM ranked GROUP BY model),
        pairs AS (
          SELECT a.model AS item_a, b.model AS item_b, k, abs(a.r - b.r) / sqrt(k * (k + 1) / (6.0 * a.n)) AS q
          FROM m a CROSS JOIN m b CROSS JOIN (SELECT count(*) AS k FROM m)),
        shifts AS (SELECT DISTINCT k, q, q * sqrt(2) AS s FROM pairs),
        grid AS (SELECT unnest(range(-900, 901)) / 100.0::DOUBLE AS z),
        points AS (SELECT DISTINCT x FROM (SELECT z AS x FROM grid UNION ALL SELECT z - s FROM grid, shifts) WHERE x <> 0),
        coef AS (SELECT i, sum(ln(2 * i + 1)) OVER (ORDER BY i) AS l FROM (SELECT unnest(range(0, 300)) AS i)),
        cdf AS (
          SELECT x, CASE WHEN x < -12 THEN 0.0 ELSE
            0.5 + sign(x) * sum(exp((2 * i + 1) * ln(abs(x)) - l - x * x / 2)) / sqrt(2 * pi()) END AS c
          FROM points, coef GROUP BY x),
        p AS (
          SELECT s.q, 1 - any_value(k) * 0.01 * sum(exp(-z * z / 2) / sqrt(2 * pi())
            * pow(coalesce(a.c, 0.5) - coalesce(b.c, 0.5), k - 1)) AS p
          FROM shifts s CROSS JOIN grid LEFT JOIN cdf a ON a.x = z LEFT JOIN cdf b ON b.x = z - s.s GROUP BY s.q)
        SELECT item_a, item_b, round(pairs.q, 6) AS q, round(CASE WHEN pairs.q = 0 THEN 1.0 ELSE p END, 6) AS p_value
        FROM pairs JOIN p ON p.q = pairs.q""",
    "select_model": cascade_sql(),
    "clf_knn": knn_sql(),
    "term_index_match": """WITH words AS (
  SELECT DISTINCT unnest(regexp_split_to_array(text, '[ /.]+')) AS w FROM (SELECT text FROM benchmark UNION ALL SELECT url FROM pages)),
found AS (SELECT doc_id, w FROM documents JOIN words ON length(w) >= 4 AND contains(lower(text), lower(w)))
SELECT doc_id, count(*) AS n_terms, md5(string_agg(w, chr(10) ORDER BY encode(w))) AS terms_md5 FROM found GROUP BY doc_id""",
    "fold_vocabularies": f"""WITH {LABELLED}, {fold_sql(10, 5)}, {tokens_cte()}, {grams_cte()},
per_row AS (SELECT doc_id, term, count(*) AS n FROM cells GROUP BY doc_id, term),
per_fold AS (
  SELECT repeat, fold, term, sum(n) AS n, count(*) AS docs FROM per_row JOIN folds USING (doc_id) GROUP BY repeat, fold, term),
totals AS (SELECT repeat, term, sum(n) AS n, sum(docs) AS docs FROM per_fold GROUP BY repeat, term),
held AS (SELECT repeat, fold, count(*) AS held FROM folds GROUP BY repeat, fold),
sizes AS (SELECT repeat, fold, (SELECT count(*) FROM labelled) - held AS n_rows FROM held),
left_over AS (
  SELECT s.repeat, s.fold, s.n_rows, t.term, t.n - coalesce(p.n, 0) AS n, t.docs - coalesce(p.docs, 0) AS docs
  FROM sizes s JOIN totals t USING (repeat) LEFT JOIN per_fold p ON p.repeat = s.repeat AND p.fold = s.fold AND p.term = t.term),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY repeat, fold ORDER BY n DESC, encode(term)) AS place
  FROM left_over WHERE n > 0 AND docs <= 0.95 * n_rows)
SELECT repeat, fold, size, count(*) AS n_terms, n_rows, CAST(min(n) AS BIGINT) AS least_count,
  md5(string_agg(term, ' ' ORDER BY place)) AS terms_md5
FROM ranked, (SELECT CAST(unnest([1500, 2000, 3000]) AS INTEGER) AS size) WHERE place <= size GROUP BY repeat, fold, size, n_rows""",
    "positives_with_metadata": """SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
}
ORACLE["report_year"] = ORACLE["year_spine"]
ORACLE["report_compare"] = ORACLE["compare_years"]
