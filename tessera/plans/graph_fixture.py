"""A property graph derived from the TPC-H-style tables.

Nodes: Customer, Order, Part, Supplier, Nation (+Place), Region (+Place), ids ``c1``, ``o7`` ...
Edges: PLACED (customer -> order), CONTAINS (order -> part, one per line item), SUPPLIED_BY
(order -> supplier, one per line item), IN (customer/supplier -> nation, nation -> region) and
NEXT (nation i -> nations (3i + 1) mod 25 and (i + 7) mod 25: a cyclic set; 12 loops to itself).
Property values are text; a negative balance leaves the key out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import table

def _empty() -> F.Column:
    return F.create_map().cast("map<string,string>")


def _props(*pairs) -> F.Column:
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    cust = t("customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.array(F.lit("Customer")).alias("labels"),
        _props(("name", F.col("c_name")), ("segment", F.col("c_mktsegment")),
               ("acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")))).alias("props"))
    orders = t("orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.array(F.lit("Order")).alias("labels"),
        _props(("status", F.col("o_orderstatus")), ("priority", F.col("o_orderpriority")),
               ("date", F.date_format("o_orderdate", "yyyy-MM-dd")),
               ("totalprice", F.col("o_totalprice").cast("string"))).alias("props"))
    part = t("part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.array(F.lit("Part")).alias("labels"),
        _props(("name", F.col("p_name")), ("brand", F.col("p_brand")), ("type", F.col("p_type")),
               ("size", F.col("p_size").cast("string"))).alias("props"))
    supp = t("supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.array(F.lit("Supplier")).alias("labels"),
        _props(("name", F.col("s_name")),
               ("acctbal", F.when(F.col("s_acctbal") > 0, F.col("s_acctbal").cast("string")))).alias("props"))
    nation = t("nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
        F.array(F.lit("Nation"), F.lit("Place")).alias("labels"), _props(("name", F.col("n_name"))).alias("props"))
    region = t("region").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"),
        F.array(F.lit("Region"), F.lit("Place")).alias("labels"), _props(("name", F.col("r_name"))).alias("props"))
    return cust.unionByName(orders).unionByName(part).unionByName(supp).unionByName(nation).unionByName(region)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    o = t("orders")
    li = t("lineitem")
    n = t("nation")
    placed = o.select(k("c", "o_custkey").alias("src"), k("o", "o_orderkey").alias("dst"), F.lit("PLACED").alias("type"),
                      _props(("date", F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("props"))
    contains = li.select(k("o", "l_orderkey").alias("src"), k("p", "l_partkey").alias("dst"), F.lit("CONTAINS").alias("type"),
                         _props(("quantity", F.col("l_quantity").cast("string")),
                                ("line", F.col("l_linenumber").cast("string"))).alias("props"))
    supplied = li.select(k("o", "l_orderkey").alias("src"), k("s", "l_suppkey").alias("dst"),
                         F.lit("SUPPLIED_BY").alias("type"), _empty().alias("props"))
    c_in = t("customer").select(k("c", "c_custkey").alias("src"), k("n", "c_nationkey").alias("dst"))
    s_in = t("supplier").select(k("s", "s_suppkey").alias("src"), k("n", "s_nationkey").alias("dst"))
    n_in = n.select(k("n", "n_nationkey").alias("src"), k("r", "n_regionkey").alias("dst"))
    ins = c_in.unionByName(s_in).unionByName(n_in).select("src", "dst", F.lit("IN").alias("type"), _empty().alias("props"))
    nk = F.col("n_nationkey")
    nxt = n.select(k("n", "n_nationkey").alias("src"),
                   F.explode(F.array((nk * 3 + 1) % 25, (nk + 7) % 25)).alias("to")).select(
        "src", F.concat(F.lit("n"), F.col("to").cast("string")).alias("dst"), F.lit("NEXT").alias("type"), _empty().alias("props"))
    return placed.unionByName(contains).unionByName(supplied).unionByName(ins).unionByName(nxt)


# DuckDB: the same graph in long form.
DUCK_GRAPH = """
WITH nlab AS (
  SELECT 'c' || c_custkey AS id, 'Customer' AS label FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'Order' FROM orders
  UNION ALL SELECT 'p' || p_partkey, 'Part' FROM part
  UNION ALL SELECT 's' || s_suppkey, 'Supplier' FROM supplier
  UNION ALL SELECT 'n' || n_nationkey, 'Nation' FROM nation
  UNION ALL SELECT 'n' || n_nationkey, 'Place' FROM nation
  UNION ALL SELECT 'r' || r_regionkey, 'Region' FROM region
  UNION ALL SELECT 'r' || r_regionkey, 'Place' FROM region
), nprop AS (
  SELECT 'c' || c_custkey AS id, 'name' AS key, c_name AS value FROM customer
  UNION ALL SELECT 'c' || c_custkey, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT 'c' || c_custkey, 'acctbal', CAST(c_acctbal AS VARCHAR) FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 'o' || o_orderkey, 'status', o_orderstatus FROM orders
  UNION ALL SELECT 'o' || o_orderkey, 'priority', o_orderpriority FROM orders
  UNION ALL SELECT 'o' || o_orderkey, 'date', strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT 'o' || o_orderkey, 'totalprice', CAST(o_totalprice AS VARCHAR) FROM orders
  UNION ALL SELECT 'p' || p_partkey, 'name', p_name FROM part
  UNION ALL SELECT 'p' || p_partkey, 'brand', p_brand FROM part
  UNION ALL SELECT 'p' || p_partkey, 'type', p_type FROM part
  UNION ALL SELECT 'p' || p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT 's' || s_suppkey, 'name', s_name FROM supplier
  UNION ALL SELECT 's' || s_suppkey, 'acctbal', CAST(s_acctbal AS VARCHAR) FROM supplier WHERE s_acctbal > 0
  UNION ALL SELECT 'n' || n_nationkey, 'name', n_name FROM nation
  UNION ALL SELECT 'r' || r_regionkey, 'name', r_name FROM region
), edge AS (
  SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst, 'PLACED' AS type FROM orders
  UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey, 'CONTAINS' FROM lineitem
  UNION ALL SELECT 'o' || l_orderkey, 's' || l_suppkey, 'SUPPLIED_BY' FROM lineitem
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'IN' FROM customer
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'IN' FROM supplier
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'IN' FROM nation
  UNION ALL SELECT 'n' || n_nationkey, 'n' || ((n_nationkey * 3 + 1) % 25), 'NEXT' FROM nation
  UNION ALL SELECT 'n' || n_nationkey, 'n' || ((n_nationkey + 7) % 25), 'NEXT' FROM nation
), eprop AS (
  SELECT 'PLACED' AS type, 'date' AS key FROM orders
  UNION ALL SELECT 'CONTAINS', 'quantity' FROM lineitem
  UNION ALL SELECT 'CONTAINS', 'line' FROM lineitem
)
"""
