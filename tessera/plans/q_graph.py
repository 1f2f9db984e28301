"""Registered queries for groups K, L, N and the graph parts of G and I."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cleaning as FC
from ..operators import graph_match as GM
from ..operators import graph_profile as GP
from ..operators import overlap as OV
from ..operators import patterns as PT
from ..operators import responses as ORS
from ..operators import result_compare as RC
from ..operators import runs as OR
from . import fixtures as X
from . import graph_fixture as G
from .q_text import SYSTEM_PROMPT
from .registry import d6, d_syntax, joined, r6, register

# ---------------------------------------------------------------- K: run log
_RUNS = X.duck_cte(runs=X.RUN_LOG_SQL) + f"""
, c AS (SELECT *, json_valid(body) AS jv FROM runs)
, c2 AS (SELECT *, CASE WHEN jv THEN json_extract(body, '$.errors') IS NOT NULL ELSE FALSE END AS he,
         CASE WHEN jv THEN json_extract_string(body, '$.errors[*].message') END AS msgs FROM c)
, cl AS (SELECT *,
   CASE WHEN status_code = 429 THEN 'Rate limit exceeded (HTTP 429)' WHEN status_code = 401 THEN 'Unauthorized (HTTP 401)'
        WHEN status_code = 403 THEN 'Forbidden (HTTP 403)' WHEN status_code = 500 THEN 'Internal Server Error (HTTP 500)'
        WHEN status_code <> 200 THEN 'HTTP Error: ' || status_code WHEN NOT jv THEN 'JSONDecodeError'
        WHEN NOT he THEN NULL WHEN list_contains(msgs, 'resource not found') THEN 'No matches found for query ''' || query || ''''
        ELSE 'Error in query ''' || query || '''. Please fix and try again.' END AS error,
   CASE WHEN status_code = 429 THEN 'Too many requests. Please wait and try again later.'
        WHEN status_code = 401 THEN 'Request not authorized. Check API token and permissions.'
        WHEN status_code = 403 THEN 'Access to the resource is forbidden.'
        WHEN status_code = 500 THEN 'The server encountered an internal error.'
        WHEN status_code <> 200 THEN left(body, 500)
        WHEN NOT jv THEN 'Failed to parse API response as JSON. Status: ' || status_code || '. Response text (first 200 chars): ' || left(body, 200)
        WHEN NOT he OR list_contains(msgs, 'resource not found') THEN NULL
        ELSE array_to_string(list_transform(msgs, lambda m: '''' || m || ''''), chr(10)) END AS details,
   CASE WHEN jv THEN (CASE WHEN json_type(body) = 'OBJECT' THEN len(json_keys(body)) = 0
                           WHEN json_type(body) = 'ARRAY' THEN json_array_length(body) = 0 ELSE FALSE END)
        ELSE FALSE END AS empty
   FROM c2)
, st AS (SELECT *, len({d_syntax('query')}) = 0 AS syn,
   CASE WHEN len({d_syntax('query')}) > 0 THEN 'syntax_failed'
        WHEN error IS NOT NULL AND contains(error, '404') THEN 'success_no_data'
        WHEN error IS NOT NULL THEN 'failed' WHEN empty THEN 'success_no_data' ELSE 'success' END AS run_status FROM cl)
"""


def _classified(spark, sf_dir):
    return OR.classify_response(X.run_log(spark, sf_dir))


def _runs(spark, sf_dir):
    return OR.run_status(_classified(spark, sf_dir))


@register("classify_response", "K", _RUNS + "SELECT run_id, error, details FROM cl")
def q_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("run_id", "error", "details")


@register("run_status", "K", _RUNS + "SELECT run_id, run_status FROM st")
def q_run_status(spark, sf_dir):
    return _runs(spark, sf_dir).select("run_id", "run_status")


@register("run_statistics", "K", _RUNS + f"""
SELECT COUNT(*) AS total_queries, count_if(run_status = 'syntax_failed') AS syntax_failed,
  count_if(run_status <> 'syntax_failed') AS executed, count_if(run_status IN ('success', 'success_no_data')) AS successful,
  count_if(run_status = 'failed') AS failed,
  {d6("avg(execution_time) FILTER (WHERE run_status <> 'syntax_failed')")} AS avg_execution_time,
  {d6("min(execution_time) FILTER (WHERE run_status <> 'syntax_failed')")} AS min_execution_time,
  {d6("max(execution_time) FILTER (WHERE run_status <> 'syntax_failed')")} AS max_execution_time,
  {d6('avg(validation_time)')} AS avg_validation_time FROM st""")
def q_run_stats(spark, sf_dir):
    s = OR.run_statistics(_runs(spark, sf_dir))
    return s.select(*[r6(c).alias(c) if c.startswith(("avg", "min", "max")) else c for c in s.columns])


@register("failed_runs", "K", _RUNS + f"""
, n AS (SELECT *, row_number() OVER (ORDER BY run_id) AS query_number FROM st)
SELECT CAST(query_number AS BIGINT) AS query_number, description AS query_description, query AS query_text,
  'Error: ' || error || CASE WHEN details IS NOT NULL THEN chr(10) || 'Details: ' || details ELSE '' END AS error_message,
  {d6('execution_time')} AS execution_time, CASE WHEN syn THEN 'passed' ELSE 'not_checked' END AS syntax_validation
FROM n WHERE run_status = 'failed'""")
def q_failed_runs(spark, sf_dir):
    f = OR.failed_runs(_runs(spark, sf_dir))
    return f.withColumn("execution_time", r6("execution_time"))


@register("response_preview", "K", _RUNS + """
SELECT run_id, CASE WHEN length(j) > 200 THEN left(j, 200) || '...' ELSE j END AS preview
FROM (SELECT run_id, array_to_string(list_transform(regexp_extract_all(body, '"(?:[^"\\\\]|\\\\.)*"|[^"\\s,:]+|[,:]'),
        lambda t: CASE WHEN t IN (',', ':') THEN t || ' ' ELSE t END), '') AS j
      FROM st WHERE run_status = 'success') x""")
def q_preview(spark, sf_dir):
    r = _runs(spark, sf_dir).filter(F.col("run_status") == "success")
    return r.select("run_id", OR.preview("body").alias("preview"))


# ---------------------------------------------------------------- L: graph profile
def _g(spark, sf_dir):
    return G.nodes(spark, sf_dir), G.edges(spark, sf_dir)


_NPROPS = G.DUCK_GRAPH + """
, np AS (SELECT l.label, p.key FROM nlab l JOIN nprop p ON p.id = l.id)
"""


@register("node_labels", "L", G.DUCK_GRAPH + "SELECT DISTINCT label FROM nlab")
def q_labels(spark, sf_dir):
    return GP.node_labels(G.nodes(spark, sf_dir))


@register("relationship_types", "L", G.DUCK_GRAPH + "SELECT DISTINCT type AS rel_type FROM edge")
def q_rel_types(spark, sf_dir):
    return GP.relationship_types(G.edges(spark, sf_dir))


@register("property_keys", "L", G.DUCK_GRAPH + "SELECT key AS property_key FROM nprop UNION SELECT key FROM eprop")
def q_prop_keys(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GP.property_keys(n, e)


@register("node_properties", "L", _NPROPS + """
SELECT l.label, coalesce(array_to_string(list_sort(list(DISTINCT np.key)), ', '), '') AS properties
FROM (SELECT DISTINCT label FROM nlab) l LEFT JOIN np ON np.label = l.label GROUP BY l.label""")
def q_node_props(spark, sf_dir):
    return GP.node_properties(G.nodes(spark, sf_dir)).select("label", joined("properties", ", ").alias("properties"))


@register("node_properties_sample", "L", G.DUCK_GRAPH + """
, s AS (SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(id), id) AS rn
        FROM nlab) t WHERE rn <= 100)
SELECT s.label, coalesce(array_to_string(list_sort(list(DISTINCT p.key) FILTER (WHERE p.key IS NOT NULL)), ', '), '') AS properties
FROM s LEFT JOIN nprop p ON p.id = s.id GROUP BY s.label""")
def q_node_props_sample(spark, sf_dir):
    p = GP.node_properties(G.nodes(spark, sf_dir), sample=100)
    return p.select("label", joined("properties", ", ").alias("properties"))


_RELPROPS = """
SELECT t.rel_type, coalesce(array_to_string(list_sort(list(DISTINCT p.key) FILTER (WHERE p.key IS NOT NULL)), ', '), '') AS properties
FROM (SELECT DISTINCT type AS rel_type FROM edge) t LEFT JOIN eprop p ON p.type = t.rel_type GROUP BY t.rel_type"""


@register("relationship_properties", "L", G.DUCK_GRAPH + _RELPROPS)
def q_rel_props(spark, sf_dir):
    return GP.relationship_properties(G.edges(spark, sf_dir)).select("rel_type", joined("properties", ", ").alias("properties"))


_D_SUMMARY = _NPROPS + f"""
, nps AS (SELECT l.label AS name, list_sort(list(DISTINCT np.key) FILTER (WHERE np.key IS NOT NULL)) AS props
          FROM (SELECT DISTINCT label FROM nlab) l LEFT JOIN np ON np.label = l.label GROUP BY l.label)
, rps AS (SELECT t.rel_type AS name, list_sort(list(DISTINCT p.key) FILTER (WHERE p.key IS NOT NULL)) AS props
          FROM (SELECT DISTINCT type AS rel_type FROM edge) t LEFT JOIN eprop p ON p.type = t.rel_type GROUP BY t.rel_type)
, pk AS (SELECT key AS name FROM nprop UNION SELECT key FROM eprop)
, summ AS (SELECT 'node_label' AS kind, name, props FROM nps UNION ALL SELECT 'relationship_type', name, props FROM rps
           UNION ALL SELECT 'property_key', name, [] FROM pk)
, txt AS (SELECT
   '## Node Labels and Properties:' || chr(10)
   || (SELECT string_agg('- ' || name || CASE WHEN len(props) > 0 THEN ': ' || array_to_string(props, ', ') ELSE '' END, chr(10) ORDER BY name) FROM nps)
   || chr(10) || chr(10) || '## Relationship Types and Properties:' || chr(10)
   || (SELECT string_agg('- ' || name || CASE WHEN len(props) > 0 THEN ': ' || array_to_string(props, ', ') ELSE '' END, chr(10) ORDER BY name) FROM rps)
   || chr(10) || chr(10) || '## All Property Keys:' || chr(10)
   || (SELECT string_agg(name, ', ' ORDER BY name) FROM pk) AS schema_text)
"""


@register("schema_summary", "L", _D_SUMMARY + "SELECT kind, name, array_to_string(coalesce(props, []), ', ') AS properties FROM summ")
def q_schema_summary(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GP.schema_summary(n, e).select("kind", "name", joined("properties", ", ").alias("properties"))


def _schema_text(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GP.render_schema(GP.schema_summary(n, e))


@register("render_schema", "L", _D_SUMMARY + "SELECT schema_text FROM txt")
def q_render(spark, sf_dir):
    return _schema_text(spark, sf_dir)


@register("node_count", "L", G.DUCK_GRAPH + "SELECT COUNT(DISTINCT id) AS node_count FROM nlab")
def q_node_count(spark, sf_dir):
    return GP.node_count(G.nodes(spark, sf_dir))


@register("prompt_with_schema", "G", _D_SUMMARY + X.duck_cte(**X.duck_corpus()).replace("WITH ", ", ", 1) + f"""
SELECT id AS case_id, '{SYSTEM_PROMPT}' || chr(10) || chr(10) || '# Neo4j Database Schema' || chr(10) || chr(10)
  || 'The Neo4j database has the following schema:' || chr(10) || chr(10) || (SELECT schema_text FROM txt) || chr(10) || chr(10)
  || 'Use this schema information when generating Cypher queries to ensure you reference the correct node labels, '
  || 'relationship types, and properties.' AS system_prompt
FROM corpus WHERE description IS NOT NULL AND query IS NOT NULL""")
def q_prompt_schema(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("description").isNotNull() & F.col("query").isNotNull())
    w = ORS.with_schema(c.select(F.col("id").alias("case_id")), SYSTEM_PROMPT, _schema_text(spark, sf_dir))
    return w.select("case_id", "system_prompt")


# ---------------------------------------------------------------- I1: graph values as records
@register("graph_value_record", "I", G.DUCK_GRAPH + """
, nl AS (SELECT id, list_sort(list(label)) AS labels FROM nlab GROUP BY id)
, np AS (SELECT id, map_from_entries(list_sort(list((key, value)))) AS props FROM nprop GROUP BY id)
SELECT nl.id, to_json(struct_pack(labels := labels, properties := coalesce(props, MAP {}), type := 'node')) AS record
FROM nl LEFT JOIN np ON np.id = nl.id""")
def q_graph_value_record(spark, sf_dir):
    r = G.nodes(spark, sf_dir).select("id", RC.node_record(F.col("labels"), F.col("props")).alias("v"))
    return RC.canonical_record(r.select("id", "v.*"), ["type", "labels", "properties"]).select("id", "record")


# ---------------------------------------------------------------- N: graph questions
_CUST_BUILDING = "SELECT id FROM nprop WHERE key = 'segment' AND value = 'BUILDING' AND id LIKE 'c%'"


def _building(nodes):
    return GM.match_nodes(nodes, "Customer", F.try_element_at("props", F.lit("segment")) == "BUILDING")


@register("match_nodes", "N", G.DUCK_GRAPH + _CUST_BUILDING)
def q_match_nodes(spark, sf_dir):
    return _building(G.nodes(spark, sf_dir)).select("id")


@register("expand", "N", G.DUCK_GRAPH + f"""
SELECT b.id, e.dst AS other FROM ({_CUST_BUILDING}) b JOIN edge e ON e.src = b.id AND e.type = 'PLACED'""")
def q_expand(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GM.expand(_building(n).select("id"), e, "PLACED").select("id", "other")


@register("expand_both", "N", G.DUCK_GRAPH + """
SELECT 'n' || n_nationkey AS id, other FROM nation JOIN (
  SELECT src AS node, dst AS other FROM edge WHERE type = 'NEXT' UNION ALL SELECT dst, src FROM edge WHERE type = 'NEXT') d
ON d.node = 'n' || n_nationkey""")
def q_expand_both(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GM.expand(GM.match_nodes(n, "Nation").select("id"), e, "NEXT", "both").select("id", "other")


# Reach is walked once per distinct place that customers are in; the number of customers there is
# joined to it, so no customer-place pairs are listed.
_WALK = G.DUCK_GRAPH.replace("WITH ", "WITH RECURSIVE ", 1) + """
, ge AS (SELECT DISTINCT src, dst FROM edge WHERE type IN ('IN', 'NEXT'))
, st AS (SELECT dst AS start, COUNT(*) AS customers FROM edge WHERE type = 'IN' AND src LIKE 'c%' GROUP BY dst)
, walk(start, node, hops, path) AS (
    SELECT start, start, 0, [start] FROM st
    UNION ALL
    SELECT w.start, ge.dst, w.hops + 1, list_append(w.path, ge.dst) FROM walk w JOIN ge ON ge.src = w.node WHERE w.hops < 4)
"""


def _customer_places(edges):
    """(id, customers): each place with customers, once."""
    return (edges.filter((F.col("type") == "IN") & F.col("src").startswith("c")).groupBy(F.col("dst").alias("id"))
            .agg(F.count(F.lit(1)).alias("customers")))


def _with_customers(reach, places):
    return reach.join(places.withColumnRenamed("id", "start"), "start")


@register("expand_var", "N", _WALK + """
SELECT w.start, node AS "end", CAST(min(hops) AS BIGINT) AS hops, max(customers) AS customers
FROM walk w JOIN st ON st.start = w.start WHERE hops >= 1 GROUP BY w.start, node""")
def q_expand_var(spark, sf_dir):
    e = G.edges(spark, sf_dir)
    p = _customer_places(e)
    return _with_customers(GM.expand_var(p, e, ["IN", "NEXT"], min_hops=1, max_hops=4), p)


@register("expand_var_from_2", "N", _WALK + """
SELECT start, node AS "end", CAST(min(hops) AS BIGINT) AS hops FROM walk WHERE hops >= 2 GROUP BY start, node""")
def q_expand_var_2(spark, sf_dir):
    e = G.edges(spark, sf_dir)
    return GM.expand_var(_customer_places(e), e, ["IN", "NEXT"], min_hops=2, max_hops=4)


@register("expand_var_unbounded", "N", G.DUCK_GRAPH.replace("WITH ", "WITH RECURSIVE ", 1) + """
, ge AS (SELECT DISTINCT src, dst FROM edge WHERE type IN ('IN', 'NEXT'))
, reach(start, node) AS (
    SELECT src, dst FROM ge WHERE src IN (SELECT dst FROM edge WHERE type = 'IN' AND src LIKE 'c%')
    UNION SELECT r.start, ge.dst FROM reach r JOIN ge ON ge.src = r.node)
SELECT start, node AS "end" FROM reach""")
def q_expand_var_all(spark, sf_dir):
    e = G.edges(spark, sf_dir)
    return GM.expand_var(_customer_places(e), e, ["IN", "NEXT"], max_hops=None).select("start", "end")


# Each customer's orders form a chain; the places form cycles: both from their first nodes, to any depth.
@register("reach_doubling", "N", G.DUCK_GRAPH.replace("WITH ", "WITH RECURSIVE ", 1) + """
, f AS (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY o_custkey)
, ge AS (SELECT DISTINCT src, dst FROM edge WHERE type = 'NEXT')
, reach(start, node) AS (SELECT src, dst FROM ge WHERE src IN ('n0', 'n7') UNION SELECT r.start, ge.dst FROM reach r JOIN ge ON ge.src = r.node)
SELECT 'o' || first AS start, 'o' || o_orderkey AS "end" FROM orders JOIN f USING (o_custkey) WHERE o_orderkey > first
UNION ALL SELECT start, node FROM reach""")
def q_reach_doubling(spark, sf_dir):
    chain = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    name = lambda c: F.concat(F.lit("o"), c.cast("string"))
    o = X.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.lead("o_orderkey").over(chain).alias("then"),
                                                F.lag("o_orderkey").over(chain).isNull().alias("first"))
    e = (o.filter("then IS NOT NULL").select(name(F.col("o_orderkey")).alias("src"), name(F.col("then")).alias("dst"), F.lit("THEN").alias("type"))
         .unionByName(G.edges(spark, sf_dir).filter("type = 'NEXT'").select("src", "dst", "type")))
    starts = o.filter("first").select(name(F.col("o_orderkey")).alias("id")).unionByName(
        G.nodes(spark, sf_dir).filter(F.col("id").isin("n0", "n7")).select("id"))
    return GM.reach_doubling(starts, e)


# Least hops per (start, node) by a recursion over distinct rows, as long as there are nodes; then
# only steps that come one hop nearer are walked, so no walk is listed that is not a shortest path.
def _d_walk(steps: str, starts: str, distinct: bool = False) -> str:
    """CTE ``walk(start, node, hops, path, types)``: all shortest walks over ``steps`` SQL (src, dst, type)."""
    return G.DUCK_GRAPH.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, ge AS ({"SELECT DISTINCT src, dst, NULL AS type FROM (" + steps + ")" if distinct else steps})
, far(start, node, hops) AS (
    SELECT id, id, 0 FROM ({starts}) s
    UNION SELECT f.start, ge.dst, f.hops + 1 FROM far f JOIN ge ON ge.src = f.node WHERE f.hops < (SELECT COUNT(DISTINCT dst) FROM ge))
, best AS (SELECT start, node, min(hops) AS h FROM far GROUP BY start, node)
, walk(start, node, hops, path, types) AS (
    SELECT id, id, 0, [id], CAST([] AS VARCHAR[]) FROM ({starts}) s
    UNION ALL
    SELECT w.start, ge.dst, w.hops + 1, list_append(w.path, ge.dst), list_append(w.types, ge.type)
    FROM walk w JOIN ge ON ge.src = w.node JOIN best b ON b.start = w.start AND b.node = ge.dst AND b.h = w.hops + 1)
"""


_PLACES = "SELECT DISTINCT dst AS id FROM edge WHERE type = 'IN' AND src LIKE 'c%'"
_REGIONS = "SELECT id FROM nlab WHERE label = 'Region'"
_OUT = "SELECT src, dst, type FROM edge WHERE type IN ('IN', 'NEXT') AND src LIKE 'n%'"
_BACK = "SELECT dst AS src, src AS dst, type FROM edge WHERE type IN ('IN', 'NEXT') AND src LIKE 'n%'"
_SP = _d_walk(_OUT, _PLACES, distinct=True)


@register("shortest_path", "N", _SP + f"""
SELECT start, node AS "end", CAST(hops AS BIGINT) AS hops, array_to_string(min(path), '>') AS path FROM walk
WHERE hops > 0 AND node IN ({_REGIONS}) GROUP BY start, node, hops""")
def q_shortest(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    s = GM.shortest_path(_customer_places(e), GM.match_nodes(n, "Region").select("id"), e, ["IN", "NEXT"], max_hops=None)
    return s.withColumn("path", joined("path", ">"))


@register("all_shortest_paths", "N", _SP + f"""
SELECT start, node AS "end", CAST(hops AS BIGINT) AS hops, array_to_string(path, '>') AS path FROM walk
WHERE hops > 0 AND node IN ({_REGIONS})""")
def q_all_shortest(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    s = GM.all_shortest_paths(_customer_places(e), GM.match_nodes(n, "Region").select("id"), e, ["IN", "NEXT"], max_hops=None)
    return s.withColumn("path", joined("path", ">"))


@register("shortest_path_counts", "N", _SP + """
SELECT start, node AS "end", CAST(hops AS BIGINT) AS hops, COUNT(*) AS n_paths FROM walk WHERE hops > 0 GROUP BY start, node, hops""")
def q_shortest_counts(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    c = GM.shortest_path_counts(_customer_places(e), GM.match_nodes(n, "Place").select("id"), e, ["IN", "NEXT"], max_hops=None)
    return c.withColumn("n_paths", F.col("n_paths").cast("long"))


@register("optional_expand", "N", G.DUCK_GRAPH + """
SELECT 'c' || c_custkey AS id, e.dst AS other FROM customer LEFT JOIN edge e ON e.src = 'c' || c_custkey AND e.type = 'PLACED'""")
def q_optional(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    return GM.expand(GM.match_nodes(n, "Customer").select("id"), e, "PLACED", optional=True).select("id", "other")


@register("with_having", "N", G.DUCK_GRAPH + """
SELECT src AS node, COUNT(DISTINCT dst) AS degree FROM edge WHERE type = 'PLACED' GROUP BY src HAVING COUNT(DISTINCT dst) > 12""")
def q_with_having(spark, sf_dir):
    return GM.degree_filter(G.edges(spark, sf_dir), "PLACED", 12)


@register("union_matches", "N", G.DUCK_GRAPH + """
SELECT id FROM nlab WHERE label = 'Place'
UNION SELECT id FROM nprop WHERE id LIKE 's%' AND key = 'acctbal' AND CAST(value AS DOUBLE) > 5000""")
def q_union(spark, sf_dir):
    n = G.nodes(spark, sf_dir)
    a = GM.match_nodes(n, "Place").select("id")
    b = GM.match_nodes(n, "Supplier", F.try_element_at("props", F.lit("acctbal")).cast("double") > 5000).select("id")
    return GM.union_matches(a, b)


@register("unwind", "N", G.DUCK_GRAPH + "SELECT id, label FROM nlab")
def q_unwind(spark, sf_dir):
    return GM.unwind(G.nodes(spark, sf_dir), "labels", "label").select("id", "label")


@register("case_label", "N", """
SELECT 'c' || c_custkey AS id, CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'positive'
       ELSE 'non_positive' END AS tier FROM customer""")
def q_case_label(spark, sf_dir):
    c = GM.match_nodes(G.nodes(spark, sf_dir), "Customer")
    bal = F.try_element_at("props", F.lit("acctbal")).cast("double")
    tier = F.when(bal > 5000, "high").when(bal > 0, "positive").otherwise("non_positive")
    return c.select("id", tier.alias("tier"))


@register("collect_group", "N", G.DUCK_GRAPH + """
SELECT s.src AS node, s.dst AS target, g.group_size FROM edge s
JOIN (SELECT src, COUNT(*) AS group_size FROM edge GROUP BY src) g ON g.src = s.src""")
def q_collect(spark, sf_dir):
    e = G.edges(spark, sf_dir)
    return GM.collect_group(e.select(F.col("src").alias("node"), "dst"), "node", "dst", "target")


@register("count_group", "N", G.DUCK_GRAPH + "SELECT dst AS target, COUNT(*) AS count FROM edge GROUP BY dst")
def q_count_group(spark, sf_dir):
    return GM.count_group(G.edges(spark, sf_dir).select(F.col("dst").alias("target")), "target")


AS_OF = "2024-01-31 00:00:00"


@register("recent_window", "N", f"""
SELECT event_id FROM events WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}'""")
def q_recent(spark, sf_dir):
    return GM.recent(X.table(spark, sf_dir, "events"), "ts", 7, AS_OF).select("event_id")


@register("off_hours", "N", """
SELECT event_id, CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'night' END AS reason FROM events
WHERE dayofweek(ts) IN (0, 6) OR hour(ts) < 8 OR hour(ts) >= 20""")
def q_off_hours(spark, sf_dir):
    return GM.off_hours(X.table(spark, sf_dir, "events"), "ts").select("event_id", "reason")


@register("regex_match", "N", "SELECT 'p' || p_partkey AS id FROM part WHERE regexp_full_match(p_name, 'blue .*')")
def q_regex(spark, sf_dir):
    n = GM.match_nodes(G.nodes(spark, sf_dir), "Part")
    return n.filter(GM.regex_match(F.try_element_at("props", F.lit("name")), "blue .*")).select("id")


@register("first_n", "N", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_first_n(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return GM.first_n(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10).select("o_orderkey", "o_totalprice")


@register("churn", "N", f"""
SELECT user_id, COUNT(*) AS n_events FROM events WHERE event_type IN ('signup', 'purchase')
  AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND ts <= TIMESTAMP '{AS_OF}'
GROUP BY user_id HAVING COUNT(*) > 3""")
def q_churn(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return GM.churn(e, "user_id", "ts", ["signup", "purchase"], "event_type", 30, 3, AS_OF)


@register("identical_targets", "N", G.DUCK_GRAPH + """
, s AS (SELECT src AS node, string_agg(DISTINCT dst, ',' ORDER BY dst) AS tset FROM edge WHERE type = 'SUPPLIED_BY' GROUP BY src)
, g AS (SELECT tset, COUNT(*) AS group_size, min(node) AS group_first FROM s GROUP BY tset HAVING COUNT(*) > 1)
SELECT s.node, g.group_size, g.group_first FROM s JOIN g ON g.tset = s.tset""")
def q_identical(spark, sf_dir):
    return GM.identical_targets(G.edges(spark, sf_dir), "SUPPLIED_BY")


def _prop(key: str):
    return F.try_element_at("props", F.lit(key))


# ---------------------------------------------------------------- N: questions with several conditions
# without a right of their own, but with control over something that has it
@register("pattern_control", "N", G.DUCK_GRAPH + """
SELECT DISTINCT p.src AS customer, s.dst AS supplier FROM edge p JOIN edge s ON s.src = p.dst AND s.type = 'SUPPLIED_BY'
WHERE p.type = 'PLACED' AND p.src IN (SELECT id FROM nprop WHERE key = 'segment' AND value = 'MACHINERY')
  AND s.dst IN (SELECT id FROM nprop WHERE id LIKE 's%' AND key = 'acctbal' AND CAST(value AS DOUBLE) > 9000)
  AND p.src NOT IN (SELECT x.src FROM edge x JOIN edge y ON y.src = x.dst AND y.type = 'IN' AND y.dst = 'r1' WHERE x.type = 'IN')""")
def q_pattern_control(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    nodes = [PT.Node("customer", "Customer", _prop("segment") == "MACHINERY"), PT.Node("order", "Order"),
             PT.Node("supplier", "Supplier", _prop("acctbal").cast("double") > 9000), PT.Node("nation", "Nation"),
             PT.Node("region", "Region", F.col("id") == "r1")]
    rels = [PT.Rel("customer", "order", "PLACED"), PT.Rel("order", "supplier", "SUPPLIED_BY"),
            PT.Rel("customer", "nation", "IN", absent=True), PT.Rel("nation", "region", "IN")]
    return PT.match_pattern(n, e, nodes, rels, ["supplier"])


# a right in one place and none of another kind
@register("pattern_persistence", "N", G.DUCK_GRAPH + """
, big AS (SELECT e.src FROM edge e JOIN nprop ON nprop.id = e.dst AND key = 'size' AND TRY_CAST(value AS INT) >= 48 WHERE e.type = 'CONTAINS')
, brand AS (SELECT e.src FROM edge e JOIN nprop ON nprop.id = e.dst AND key = 'brand' AND value = 'Brand#11' WHERE e.type = 'CONTAINS')
SELECT 'o' || o_orderkey AS "order" FROM orders
WHERE 'o' || o_orderkey IN (SELECT src FROM big) AND 'o' || o_orderkey NOT IN (SELECT src FROM brand)""")
def q_pattern_persistence(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    nodes = [PT.Node("order", "Order"), PT.Node("big", "Part", _prop("size").cast("int") >= 48),
             PT.Node("brand", "Part", _prop("brand") == "Brand#11")]
    return PT.match_pattern(n, e, nodes, [PT.Rel("order", "big", "CONTAINS"), PT.Rel("order", "brand", "CONTAINS", absent=True)])


# one entity with two relationships of different kinds, both partners listed
@register("pattern_two_branches", "N", G.DUCK_GRAPH + """
SELECT DISTINCT c.src AS "order", c.dst AS part, s.dst AS supplier FROM edge c JOIN edge s ON s.src = c.src AND s.type = 'SUPPLIED_BY'
WHERE c.type = 'CONTAINS' AND c.dst IN (SELECT id FROM nprop WHERE key = 'size' AND value = '7' AND id LIKE 'p%')
  AND s.dst IN (SELECT src FROM edge WHERE type = 'IN' AND dst = 'n3' AND src LIKE 's%')""")
def q_pattern_two_branches(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    nodes = [PT.Node("order"), PT.Node("part", "Part", _prop("size") == "7"), PT.Node("supplier", "Supplier"),
             PT.Node("nation", None, F.col("id") == "n3")]
    rels = [PT.Rel("order", "part", "CONTAINS"), PT.Rel("order", "supplier", "SUPPLIED_BY"), PT.Rel("supplier", "nation", "IN")]
    return PT.match_pattern(n, e, nodes, rels, ["part", "supplier"])


# a property of the entity and a relationship into it
@register("pattern_property_and_link", "N", G.DUCK_GRAPH + """
SELECT DISTINCT o.dst AS "order", c.src AS customer FROM edge o JOIN edge c ON c.type = 'IN' AND c.src = o.src
WHERE o.type = 'PLACED' AND c.dst IN (SELECT src FROM edge WHERE type = 'NEXT' AND dst = 'n5')
  AND o.dst IN (SELECT id FROM nprop WHERE key = 'priority' AND value = '1-URGENT')""")
def q_pattern_property(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    nodes = [PT.Node("order", "Order", _prop("priority") == "1-URGENT"), PT.Node("customer", "Customer"), PT.Node("nation", "Nation"),
             PT.Node("next", "Place", F.col("id") == "n5")]
    rels = [PT.Rel("order", "customer", "PLACED", "in"), PT.Rel("customer", "nation", "IN"), PT.Rel("nation", "next", "NEXT")]
    return PT.match_pattern(n, e, nodes, rels, ["customer"])


_SHARED = G.DUCK_GRAPH + """
, d AS (SELECT DISTINCT src AS node, dst AS target FROM edge WHERE type = 'SUPPLIED_BY')
, s AS (SELECT node, COUNT(*) AS n, string_agg(target, ',' ORDER BY target) AS tset FROM d GROUP BY node)
, g AS (SELECT tset, min(node) AS class, COUNT(*) AS class_size FROM s GROUP BY tset)
"""
SHARED_PERCENT = 60


@register("shared_targets", "N", _SHARED + f"""
, r AS (SELECT d.node, d.target, s.n FROM d JOIN s USING (node) JOIN g ON g.class = s.node)
, p AS (SELECT x.node AS a, y.node AS b, x.n AS n_a, y.n AS n_b, COUNT(*) AS n_both FROM r x JOIN r y
        ON x.target = y.target AND x.node < y.node AND 100 * least(x.n, y.n) >= {SHARED_PERCENT} * greatest(x.n, y.n)
        GROUP BY ALL)
SELECT * FROM p WHERE 100 * n_both >= {SHARED_PERCENT} * (n_a + n_b - n_both)""")
def q_shared_targets(spark, sf_dir):
    return OV.shared_targets(G.edges(spark, sf_dir), "SUPPLIED_BY", percent=SHARED_PERCENT)[0]


@register("shared_targets_members", "N", _SHARED + """
SELECT s.node, s.n, g.class, g.class_size FROM s JOIN g USING (tset)""")
def q_shared_targets_members(spark, sf_dir):
    return OV.target_classes(OV.target_sets(G.edges(spark, sf_dir), "SUPPLIED_BY"))


@register("duplicate_property", "N", """
, m AS (SELECT 'p' || p_partkey AS id, p_name AS value FROM part)
SELECT m.id, m.value, g.group_size FROM m JOIN (SELECT value, COUNT(*) AS group_size FROM m GROUP BY value HAVING COUNT(*) > 1) g
ON g.value = m.value""".replace("\n, m AS", "WITH m AS", 1))
def q_dup_prop(spark, sf_dir):
    return GM.duplicate_property(G.nodes(spark, sf_dir), "Part", "name").select("id", "value", "group_size")


@register("graph_value_record_rel", "I", G.DUCK_GRAPH + """
, le AS (
  SELECT src, dst, type, MAP {} AS props FROM edge WHERE type NOT IN ('PLACED', 'CONTAINS')
  UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, 'PLACED', MAP {'date': strftime(o_orderdate, '%Y-%m-%d')} FROM orders
  UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey, 'CONTAINS',
    map_from_entries([('line', CAST(l_linenumber AS VARCHAR)), ('quantity', CAST(l_quantity AS VARCHAR))]) FROM lineitem)
SELECT src, dst, to_json(struct_pack(properties := props, rel_type := type, type := 'relationship')) AS record FROM le""")
def q_graph_value_record_rel(spark, sf_dir):
    r = G.edges(spark, sf_dir).select("src", "dst", RC.rel_record(F.col("type"), F.col("props")).alias("v"))
    return RC.canonical_record(r.select("src", "dst", "v.*"), ["type", "rel_type", "properties"]).select("src", "dst", "record")


def _d_path_records(walk: str) -> str:
    """Records of the paths in CTE ``one(pid, start, end, path, types)``, built by ``walk``."""
    return walk + """
, nl AS (SELECT id, list_sort(list(label)) AS labels FROM nlab GROUP BY id)
, np2 AS (SELECT id, map_from_entries(list_sort(list((key, value)))) AS props FROM nprop GROUP BY id)
, steps AS (SELECT pid, unnest(path) AS node, unnest(generate_series(1, len(path))) AS pos FROM one)
, nrec AS (SELECT s.pid, list(struct_pack(labels := nl.labels, properties := coalesce(np2.props, MAP {}), type := 'node') ORDER BY s.pos) AS nodes
           FROM steps s JOIN nl ON nl.id = s.node LEFT JOIN np2 ON np2.id = s.node GROUP BY s.pid)
SELECT start, "end", to_json(struct_pack(length := len(types), nodes := nodes,
    relationships := list_transform(types, lambda t: struct_pack(properties := MAP {}, rel_type := t, type := 'relationship')),
    type := 'path')) AS record
FROM one JOIN nrec ON nrec.pid = one.pid"""


def _d_one(steps: str, starts: str, ends: str, every: bool = True) -> str:
    """CTE ``one``: shortest walks between starts and ends, relationship types kept; or the least of each pair."""
    return _d_walk(steps, starts) + f"""
, one AS (SELECT row_number() OVER () AS pid, start, node AS "end", path, types FROM (
    SELECT *, row_number() OVER (PARTITION BY start, node ORDER BY path, types) AS rn FROM walk WHERE node IN ({ends})) c
    {'' if every else 'WHERE rn = 1'})
"""


def _path_records(walks, n):
    p = RC.path_records(walks, n).select("start", "end", "path_value.*")
    return RC.canonical_record(p, ["type", "length", "nodes", "relationships"]).select("start", "end", "record")


@register("graph_value_record_path", "I", _d_path_records(_d_one(_OUT, _PLACES, _REGIONS, every=False)))
def q_graph_value_record_path(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    w = GM.shortest_walks(_customer_places(e), GM.match_nodes(n, "Region").select("id"), e, ["IN", "NEXT"], max_hops=None, every=False)
    return _path_records(w, n)


@register("graph_value_record_paths_all", "I", _d_path_records(_d_one(_OUT, _PLACES, "SELECT id FROM nlab WHERE label = 'Place'")))
def q_graph_value_record_paths_all(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    w = GM.shortest_walks(_customer_places(e), GM.match_nodes(n, "Place").select("id"), e, ["IN", "NEXT"], max_hops=None)
    return _path_records(w, n)


@register("graph_value_record_paths_in", "I", _d_path_records(_d_one(_BACK, _REGIONS, _PLACES)))
def q_graph_value_record_paths_in(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    w = GM.shortest_walks(GM.match_nodes(n, "Region").select("id"), _customer_places(e), e.filter(F.col("src").startswith("n")),
                          ["IN", "NEXT"], max_hops=None, direction="in")
    return _path_records(w, n)


@register("graph_value_record_paths_both", "I", _d_path_records(_d_one(_OUT + " UNION ALL " + _BACK, _PLACES, _REGIONS)))
def q_graph_value_record_paths_both(spark, sf_dir):
    n, e = _g(spark, sf_dir)
    w = GM.shortest_walks(_customer_places(e), GM.match_nodes(n, "Region").select("id"), e.filter(F.col("src").startswith("n")),
                          ["IN", "NEXT"], max_hops=None, direction="both")
    return _path_records(w, n)
