"""Projections of the driver's tables onto the domain's records, and their SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.operators.edges import read_pair_edges


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs: id, length, coverage, cluster."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 100).alias("length"), F.col("p_retailprice").alias("coverage"), F.col("p_brand").alias("cluster"))


PARTS = "parts AS (SELECT p_partkey AS id, p_size * 100 AS length, p_retailprice AS coverage, p_brand AS cluster FROM part)"


def edges(spark: SparkSession, sf_dir: str, support: int = 1) -> DataFrame:
    """Contig pairs of one order: c1, c2, o1, o2, dist, std, support."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    pairs = read_pair_edges(lines, "l_orderkey", "l_linenumber", "l_partkey", ["l_quantity"])
    e = pairs.groupBy("c1", "c2").agg(F.count("*").alias("support"), F.min(F.col("l_quantity_2") - F.col("l_quantity_1")).cast("int").alias("dist"))
    e = e.filter(F.col("support") >= support)
    return e.withColumns({"std": (F.col("support") + 4).cast("int"), "o1": F.when(F.col("dist") % 2 == 0, "+").otherwise("-"), "o2": F.when(F.col("c1") % 2 == 0, "+").otherwise("-")})


EDGES = """pairs AS (SELECT least(a.l_partkey, b.l_partkey) AS c1, greatest(a.l_partkey, b.l_partkey) AS c2, b.l_quantity - a.l_quantity AS dq
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_partkey <> b.l_partkey),
edges AS (SELECT c1, c2, support, dist, CAST(support + 4 AS INT) AS std, CASE WHEN dist % 2 = 0 THEN '+' ELSE '-' END AS o1, CASE WHEN c1 % 2 = 0 THEN '+' ELSE '-' END AS o2
  FROM (SELECT c1, c2, count(*) AS support, CAST(min(dq) AS INT) AS dist FROM pairs GROUP BY 1, 2))"""

SPAN = 31 * 86_400


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment starts: id, pos (seconds since 2024-01-01), sample."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), (F.unix_seconds(F.col("ts").cast("timestamp_ltz")) - 1704067200).alias("pos"), F.col("event_type").alias("sample"))


HITS = "hits AS (SELECT user_id AS id, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS pos, event_type AS sample FROM events)"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals: ref, s, e (days), id."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ref"), day.alias("s"), (day + F.col("l_quantity").cast("int")).alias("e"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_extendedprice").alias("price"))


SPANS = "spans AS (SELECT l_suppkey AS ref, CAST(datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS s, CAST(datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) + CAST(l_quantity AS INT) AS e, l_orderkey * 10 + l_linenumber AS id, l_extendedprice AS price FROM lineitem)"

ISLANDS = """ordered AS (SELECT ref, s, e, price, max(e) OVER (PARTITION BY ref ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
marked AS (SELECT *, sum(CASE WHEN reach IS NULL OR reach + {step} < s THEN 1 ELSE 0 END) OVER (PARTITION BY ref ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM ordered),
islands AS (SELECT ref, island, min(s) AS "start", max(e) AS "end", count(*) AS n FROM marked GROUP BY 1, 2)"""


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaffold children: scaffold, contig, ori, length, in the order of (pos, contig, supp, price)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scaffold"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("contig"), F.col("l_suppkey").alias("supp"), F.col("l_extendedprice").alias("price"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("ori"), F.col("l_quantity").cast("int").alias("length"))


ORDER = ["line", "contig", "supp", "price"]
CHILDREN = "children AS (SELECT l_orderkey AS scaffold, l_linenumber AS line, l_partkey AS contig, l_suppkey AS supp, l_extendedprice AS price, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS ori, CAST(l_quantity AS INT) AS length FROM lineitem)"


def vector_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs a < b of vectors of one label and 1 - cosine, six decimals."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    v = v.withColumn("norm", norm)
    a, b = (v.select("label", F.col("vec_id").alias(k), F.col("v").alias(f"v{k}"), F.col("norm").alias(f"n{k}")) for k in "ab")
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return a.join(b, "label").filter("a < b").select("a", "b", "label", F.round(1 - dot / (F.col("na") * F.col("nb")), 6).alias("dist"))


DISTANCES = """dists AS (SELECT x.vec_id AS a, y.vec_id AS b, x.label AS label, round(1 - list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) / (sqrt(list_dot_product(x.embedding::DOUBLE[], x.embedding::DOUBLE[])) * sqrt(list_dot_product(y.embedding::DOUBLE[], y.embedding::DOUBLE[]))), 6) AS dist
  FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id)"""
