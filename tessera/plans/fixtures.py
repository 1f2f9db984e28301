"""Inputs for each operator group, derived from the driver tables.

Each derivation is one SQL text that both Spark and DuckDB run unchanged, so both engines see
identical inputs. ``{orders}``-style placeholders are filled with DataFrames in Spark
(``spark.sql(text, orders=df)``) and with view names in DuckDB. Every derived table grows with
the table it reads; none is a fixed hand-made list.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# One corpus row per order: id = o_orderkey, one of twelve templates chosen by o_orderkey % 12
# (a 12-row table joined on that key), parameter $v = o_custkey % 50 so exact and near copies
# occur, $w = o_custkey % 7.
CORPUS_SQL = """
SELECT o.o_orderkey AS id,
  replace(t.d, '$v', CAST(o.o_custkey % 50 AS STRING)) AS description,
  CASE WHEN t.k = 11 AND o.o_custkey % 7 = 0 THEN chr(9) || '  '
       ELSE replace(t.q, '$v', CAST(o.o_custkey % 50 AS STRING)) END AS query,
  replace(t.s, '$w', CAST(o.o_custkey % 7 AS STRING)) AS source
FROM {orders} o
JOIN (VALUES
  (0, 'Find user $v', 'MATCH (u:User) WHERE u.name = ''user$v'' RETURN u', 'https://example.org/q/$w/'),
  (1, 'list   computers $v', 'match (c:computer) where c.owner = "c$v" return c.name', 'https://example.org/c/$w/#'),
  (2, 'Find user $v', 'MATCH  (u:User)' || chr(10) || 'WHERE u.name = ''user$v''   RETURN u', 'https://example.org/q/$w/'),
  (3, '  Find user $v' || chr(10), 'MATCH (U:USER) WHERE U.NAME = ''USER$v'' RETURN U', '  '),
  (4, 'Get' || chr(160) || 'paths $v', 'MATCH p=(u:User)-[:MemberOf*1..3]->(g:Group) WHERE g.name = ''G$v'' RETURN p', 'author $w'),
  (5, 'Show shortest $v', 'MATCH p=shortestPath((u:User {name:''u$v''})-[*1..]->(d:Domain)) OPTIONAL MATCH (u)-[:AdminTo]->(c:Computer) WITH u, COUNT(c) AS n, COLLECT(c.name) AS names RETURN u.name, n, names', 'https://example.org/s/$w'),
  (6, 'return change $v', 'MATCH (n:User {name:''u$v''}) SET n.owned = true RETURN n', 'https://example.org/s/$w'),
  (7, 'Create node $v', 'CREATE (n:Computer {name:''c$v''})', NULL),
  (8, '   ', 'MATCH (g:GPO) RETURN g.name LIMIT $v', 'https://example.org/s/$w'),
  (9, NULL, 'MATCH (o:OU)-[:Contains]->(c:Container) RETURN o, c', 'https://example.org/s/$w'),
  (10, 'Broken $v', 'MATCH (n:CertTemplate {name:''x$v'' RETURN [n.name', 'https://example.org/s/$w'),
  (11, 'Prose $v', 'look up names =~ ''abc$v.*'' // note http://example.org/x' || chr(9), 'https://example.org/s/$w')
) AS t(k, d, q, s) ON o.o_orderkey % 12 = t.k
"""

# The second corpus: documents (description = first line, query = whole text).
DOC_CORPUS_SQL = """
SELECT doc_id AS id,
       CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1)
            ELSE text END AS description,
       text AS query,
       source
FROM {documents}
"""

# One model response per corpus row, shaped by id % 7; one row in 23 got none.
RESPONSES_SQL = """
SELECT c.id AS case_id,
  CASE c.id % 7
    WHEN 0 THEN '<query>' || c.query || '</query>'
    WHEN 1 THEN '<think>first' || chr(10) || 'second <query>no</query>' || chr(10) || '</think>'
             || chr(10) || '<query>' || chr(10) || '   ' || c.query || '  ' || chr(10) || chr(10) || '</query>'
    WHEN 2 THEN 'Answer:' || chr(10) || chr(10) || '<b>' || chr(10) || '  ' || c.query || chr(10)
             || 'tags.extra' || chr(10) || '   '
    WHEN 3 THEN 'ERROR: timeout'
    WHEN 4 THEN replace(replace(upper(c.query), ' ', '  '), '''', '"')
    WHEN 5 THEN 'MATCH p=(u:User)-[:MemberOf*1..3]->(g:Group) WHERE g.name = ''G' || CAST(c.id % 50 AS STRING) || ''' RETURN p'
    ELSE '</think> stray </query> then <query>' || c.query
  END AS raw_response,
  CAST(c.id % 100 AS DOUBLE) / 100 AS generation_time
FROM {corpus} c
WHERE c.query IS NOT NULL AND c.id % 23 <> 5
"""

# Result records of a truth run and a generated run per case, from all line items; the generated
# run differs by changed quantities, and some runs failed.
RESULT_RECORDS_SQL = """
SELECT {case_col} AS case_id, 'truth' AS side,
       l_returnflag, l_linestatus, l_quantity
FROM {lineitem} WHERE {case_col} % 17 <> 0
UNION ALL
SELECT {case_col} AS case_id, 'generated' AS side,
       l_returnflag, l_linestatus, CASE WHEN l_quantity > 45 THEN l_quantity + 50 ELSE l_quantity END AS l_quantity
FROM {lineitem} WHERE {case_col} % 19 <> 0
"""

# One header per (case, side): success flag, error text, raw record count.
RESULT_HEADERS_SQL = """
SELECT k.case_id, s.side,
       NOT ((s.side = 'truth' AND k.case_id % 17 = 0) OR (s.side = 'generated' AND k.case_id % 19 = 0)) AS success,
       CASE WHEN s.side = 'truth' AND k.case_id % 17 = 0 THEN 'Neo4j Error: timeout'
            WHEN s.side = 'generated' AND k.case_id % 19 = 0 THEN 'Neo4j Error: syntax'
       END AS error,
       COALESCE(r.n, 0) AS record_count
FROM (SELECT DISTINCT {case_col} AS case_id FROM {lineitem}) k
CROSS JOIN (SELECT 'truth' AS side UNION ALL SELECT 'generated' AS side) s
LEFT JOIN (SELECT case_id, side, COUNT(*) AS n FROM {records} rr GROUP BY case_id, side) r
  ON r.case_id = k.case_id AND r.side = s.side
"""

# One query run per event: HTTP status by event_id % 9, body by event type.
RUN_LOG_SQL = """
SELECT event_id AS run_id,
  'Event ' || event_type || ' of user ' || CAST(user_id AS STRING) AS description,
  CASE WHEN event_id % 11 = 0 THEN 'MATCH (n:User RETURN n'
       WHEN event_id % 13 = 0 THEN 'MATCH (n:Computer) WHERE n.name = ''404'' RETURN n'
       ELSE 'MATCH (n:User) WHERE n.uid = ' || CAST(user_id AS STRING) || ' RETURN n' END AS query,
  CASE event_id % 9 WHEN 1 THEN 401 WHEN 2 THEN 403 WHEN 3 THEN 404 WHEN 4 THEN 429
                    WHEN 5 THEN 500 WHEN 6 THEN 502 ELSE 200 END AS status_code,
  CASE event_type
    WHEN 'view' THEN '{"data": ' || props || '}'
    WHEN 'click' THEN '{}'
    WHEN 'purchase' THEN '{"errors": [{"message": "resource not found"}]}'
    WHEN 'error' THEN '{"errors": [{"message": "Invalid input ' || CAST(user_id AS STRING) || '"}, {"message": "line 1"}]}'
    ELSE '<html>' || repeat('busy ', 120) || '</html>'
  END AS body,
  abs(value) AS execution_time,
  abs(value) / 1000.0 AS validation_time
FROM {events}
"""

# Validation outcomes per corpus row: online check skipped / passed / failed by id % 3.
VALIDATION_SQL = """
SELECT c.id, c.description, c.query, c.source,
  CASE c.id % 3 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END AS online_ok,
  CASE WHEN c.id % 3 = 2 THEN 'Neo.ClientError.Statement.SyntaxError: invalid input' END AS online_error,
  o.o_totalprice / 1e6 AS execution_time
FROM {corpus} c JOIN {orders} o ON o.o_orderkey = c.id
"""

# One trace per user turn that an assistant turn follows: the whole answer is the reasoning, its
# first line the query.
TRACES_SQL = """
SELECT CAST(u.conv_id AS STRING) || ':' || CAST(u.turn AS STRING) AS id, u.text AS description,
  CASE WHEN instr(a.text, chr(10)) > 0 THEN substr(a.text, 1, instr(a.text, chr(10)) - 1) ELSE a.text END AS query,
  'conv' || CAST(u.conv_id AS STRING) AS source, a.text AS reasoning_trace,
  CAST('2024-01-31 00:00:00' AS TIMESTAMP) AS generated_at
FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


# Keys of the tables whose derived rows carry heavy per-row text work; these are dealt over more
# partitions where the session asks for it.
_TEXT_KEYS = {"orders": "o_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..sources.corpus_io import spread

    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, _TEXT_KEYS[name]) if name in _TEXT_KEYS else df


def _spark_text(text: str, names: set[str]) -> str:
    """Escape every brace except ``{name}`` placeholders that name a frame."""
    out, last = [], 0
    for m in _PLACEHOLDER.finditer(text):
        if m.group(1) in names:
            out.append(text[last:m.start()].replace("{", "{{").replace("}", "}}"))
            out.append(m.group(0))
            last = m.end()
    out.append(text[last:].replace("{", "{{").replace("}", "}}"))
    return "".join(out)


def run_sql(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    """Run a fixture SQL text in Spark; unresolved placeholders read driver tables."""
    args = dict(frames)
    for name in _PLACEHOLDER.findall(text):
        if name not in args and name in TABLES:
            args[name] = table(spark, sf_dir, name)
    return spark.sql(_spark_text(text, set(args)), **args)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, CORPUS_SQL)


def doc_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, DOC_CORPUS_SQL)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, RESPONSES_SQL, corpus=corpus(spark, sf_dir))


def result_records(spark: SparkSession, sf_dir: str, case_col: str = "l_suppkey") -> DataFrame:
    return run_sql(spark, sf_dir, RESULT_RECORDS_SQL.replace("{case_col}", case_col))


def result_headers(spark: SparkSession, sf_dir: str, case_col: str = "l_suppkey") -> DataFrame:
    recs = result_records(spark, sf_dir, case_col)
    return run_sql(spark, sf_dir, RESULT_HEADERS_SQL.replace("{case_col}", case_col), records=recs)


def validation_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, VALIDATION_SQL, corpus=corpus(spark, sf_dir))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, RUN_LOG_SQL)


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, TRACES_SQL)


# ---- DuckDB side: the same texts as CTEs over the pre-registered views ----------------------

def duck_cte(**texts: str) -> str:
    """``WITH name AS (sql), ...`` where each text's placeholders name views or earlier CTEs."""
    parts, known = [], set(TABLES)
    for name, text in texts.items():
        sub = _PLACEHOLDER.sub(lambda m: m.group(1) if m.group(1) in known else m.group(0), text)
        parts.append(f"{name} AS ({sub})")
        known.add(name)
    return "WITH " + ",\n".join(parts) + "\n"


def duck_corpus() -> dict[str, str]:
    return {"corpus": CORPUS_SQL}


def duck_validation() -> dict[str, str]:
    return {"corpus": CORPUS_SQL, "vin": VALIDATION_SQL}


def duck_responses() -> dict[str, str]:
    return {"corpus": CORPUS_SQL, "responses": RESPONSES_SQL}


def duck_results(case_col: str = "l_suppkey") -> dict[str, str]:
    return {
        "records": RESULT_RECORDS_SQL.replace("{case_col}", case_col),
        "headers": RESULT_HEADERS_SQL.replace("{case_col}", case_col),
    }
