"""Queries of iterative, greedy and solver operators, with SQL where recursion can say them; tests hold the others against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.operators import bundles, intervals, scaffold, strain, trees
from contigloom.operators import edges as ed
from contigloom.plans import flat
from contigloom.plans import tables as t
from contigloom.runtime import keep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: SQL of sequential folds, which run in tasks of Python.
FOLDS: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


ORACLES["overlap_resolution"] = f"""WITH RECURSIVE {t.CHILDREN}, a AS (SELECT scaffold, line, contig, supp, price, line * 20 AS s, line * 20 + length AS e, CAST(floor(price * 100 / length) AS BIGINT) AS score, row_number() OVER (PARTITION BY scaffold ORDER BY line, contig, supp, price) AS rn FROM children),
f AS (SELECT scaffold, rn, rn AS k, e, score, true AS fresh FROM a WHERE rn = 1 UNION ALL
  SELECT a.scaffold, a.rn, CASE WHEN f.e - 5 < a.s OR a.score > f.score THEN a.rn ELSE f.k END, CASE WHEN f.e - 5 < a.s OR a.score > f.score THEN a.e ELSE f.e END, CASE WHEN f.e - 5 < a.s OR a.score > f.score THEN a.score ELSE f.score END, f.e - 5 < a.s
  FROM f JOIN a ON a.scaffold = f.scaffold AND a.rn = f.rn + 1),
g AS (SELECT scaffold, k, coalesce(lead(fresh) OVER (PARTITION BY scaffold ORDER BY rn), true) AS last FROM f), w AS (SELECT DISTINCT scaffold, k FROM g WHERE last)
SELECT a.scaffold, line, contig, supp, price, s, e, score, k IS NOT NULL AS kept, false AS conflict FROM a LEFT JOIN w ON a.scaffold = w.scaffold AND a.rn = k"""

ORACLES["subgraphs"] = f"""WITH RECURSIVE {t.EDGES}, {t.PARTS}, x AS (SELECT e.*, c1 || CASE WHEN p.length > 4000 THEN CASE o1 WHEN '+' THEN ':r' ELSE ':l' END ELSE '' END AS va, c2 || CASE WHEN q.length > 4000 THEN CASE o2 WHEN '+' THEN ':l' ELSE ':r' END ELSE '' END AS vb
  FROM edges e JOIN parts p ON p.id = c1 JOIN parts q ON q.id = c2 WHERE support >= 3), {flat.COMPONENTS.format(a="va", b="vb", edges="x")},
m AS (SELECT u, min(label) AS subgraph FROM lab GROUP BY 1) SELECT c1, c2, support, dist, std, o1, o2, subgraph FROM x JOIN m ON u = va"""


_LIBS = """d AS (SELECT l_suppkey % 50 AS c1, '+' AS o1, l_partkey % 20 AS c2, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS o2, CAST(l_quantity * 10 AS BIGINT) AS dist, CAST(l_linenumber * 20 AS BIGINT) AS std, l_returnflag AS lib FROM lineitem)"""


def _medians(keys: str) -> str:
    """CTEs r, b: the edges that are left before each bundle, and the bundles around their medians."""
    return f"""r({keys}, n, x) AS (SELECT {keys}, 1, list(struct_pack(d := dist::DOUBLE, s := std::DOUBLE) ORDER BY dist, std) FROM d GROUP BY {keys}
  UNION ALL SELECT {keys}, n + 1, list_filter(x, lambda e: abs(e.d - x[len(x) // 2 + 1].d) > 6 * x[len(x) // 2 + 1].s) FROM r WHERE len(list_filter(x, lambda e: abs(e.d - x[len(x) // 2 + 1].d) > 6 * x[len(x) // 2 + 1].s)) > 0),
i AS (SELECT {keys}, n, list_filter(x, lambda e: abs(e.d - x[len(x) // 2 + 1].d) <= 6 * x[len(x) // 2 + 1].s) AS x FROM r),
b AS (SELECT {keys}, n AS bundle, CAST(floor(list_sum(list_transform(x, lambda e: e.d / (e.s * e.s))) / list_sum(list_transform(x, lambda e: 1 / (e.s * e.s))) + 0.5) AS BIGINT) AS dist,
  greatest(1, CAST(floor(1 / sqrt(list_sum(list_transform(x, lambda e: 1 / (e.s * e.s)))) + 0.5) AS BIGINT)) AS std, len(x)::BIGINT AS size FROM i)"""


FOLDS["median_seed_bundles"] = f"WITH RECURSIVE {_LIBS}, {_medians('c1, o1, c2, o2')} SELECT * FROM b"

FOLDS["super_bundles"] = f"""WITH RECURSIVE {_LIBS}, {_medians('c1, o1, c2, o2, lib')},
q(c1, o1, c2, o2, total, x) AS (SELECT c1, o1, c2, o2, sum(size), list(struct_pack(d := dist::DOUBLE, s := std::DOUBLE, n := size) ORDER BY std, dist, size) FROM b GROUP BY 1, 2, 3, 4
  UNION ALL SELECT c1, o1, c2, o2, total, list_filter(x[:-2], lambda e: abs(e.d - x[-1].d) >= 6 * x[-1].s) FROM q WHERE len(list_filter(x[:-2], lambda e: abs(e.d - x[-1].d) >= 6 * x[-1].s)) > 0),
k AS (SELECT c1, o1, c2, o2, total, list_append(list_filter(x[:-2], lambda e: abs(e.d - x[-1].d) < 6 * x[-1].s), x[-1]) AS x FROM q)
SELECT c1, o1, c2, o2, CAST(floor(round(list_sum(list_transform(x, lambda e: e.d / (e.s * e.s))) / list_sum(list_transform(x, lambda e: 1 / (e.s * e.s))), 6) + 0.5) AS BIGINT) AS dist,
  greatest(1, CAST(floor(1 / sqrt(list_sum(list_transform(x, lambda e: 1 / (e.s * e.s)))) + 0.5) AS BIGINT)) AS std, CAST(list_sum(list_transform(x, lambda e: e.n)) AS BIGINT) AS size, len(x)::BIGINT AS members
FROM k WHERE list_sum(list_transform(x, lambda e: e.n)) >= 5 AND list_sum(list_transform(x, lambda e: e.n)) * 2 > total"""

FOLDS["seed_bundles_desc"] = f"""WITH RECURSIVE {_LIBS}, e AS (SELECT c1, c2, o1 || ':' || o2 AS ori, dist::DOUBLE AS d, row_number() OVER (PARTITION BY c1, c2, o1, o2 ORDER BY dist DESC) AS rn FROM d),
f(c1, c2, ori, rn, x) AS (SELECT c1, c2, ori, rn, [struct_pack(s := d, t := d, n := 1::BIGINT)] FROM e WHERE rn = 1
  UNION ALL SELECT f.c1, f.c2, f.ori, e.rn, CASE WHEN len(list_filter(x, lambda b: abs(d - b.s) <= 6 * (abs(b.s) * 0.1 + 50))) = 0 THEN list_append(x, struct_pack(s := d, t := d, n := 1::BIGINT))
    ELSE list_transform(x, lambda b, i: CASE WHEN i = list_position(list_transform(x, lambda c: abs(d - c.s) <= 6 * (abs(c.s) * 0.1 + 50)), true) THEN struct_pack(s := b.s, t := b.t + d, n := b.n + 1) ELSE b END) END
  FROM f JOIN e ON e.c1 = f.c1 AND e.c2 = f.c2 AND e.ori = f.ori AND e.rn = f.rn + 1),
l AS (SELECT c1, c2, ori, arg_max(x, rn) AS x FROM f GROUP BY 1, 2, 3), u AS (SELECT c1, c2, ori, unnest(x) AS b, generate_subscripts(x, 1) AS i FROM l),
w AS (SELECT *, row_number() OVER (PARTITION BY c1, c2 ORDER BY b.n DESC, ori, i) AS k FROM u)
SELECT c1, c2, ori, CAST(trunc(b.t / b.n) AS BIGINT) AS dist, CAST(trunc(abs(b.t / b.n) * 0.1 + 50) AS BIGINT) AS std, b.n AS support FROM w WHERE k = 1"""

FOLDS["gap_correction"] = """WITH s(step) AS (VALUES (250), (500), (750), (1000)), g AS (SELECT unnest(range(0, 391)) AS gap), n AS (SELECT unnest(range(120, 481)) AS ins),
p AS (SELECT step, gap, ins, exp(-0.5 * ((ins - 300.0) / 30.0) ** 2) * CASE WHEN ins - gap - 99 > 0 THEN least(greatest(least(ins - gap - 99, 2 * step - (ins - gap - 99)), 0), step) ELSE 0 END AS w FROM s, g, n),
t AS (SELECT step, gap, gap + 300.0 - sum(ins * w) / sum(w) AS est FROM p GROUP BY 1, 2 HAVING sum(w) > 0),
m AS (SELECT step, gap, max(est) OVER (PARTITION BY step ORDER BY gap) AS est FROM t),
e AS (SELECT l_orderkey, l_linenumber, l_quantity * 4 AS dist, l_partkey % 900 + 100 AS min_len FROM lineitem),
c AS (SELECT DISTINCT dist, CASE WHEN min_len <= 250 THEN 250 WHEN min_len <= 500 THEN 500 WHEN min_len <= 750 THEN 750 ELSE 1000 END AS step FROM e),
o AS (SELECT dist, c.step, count(*) FILTER (est < dist) AS lo, count(*) FILTER (est <= dist) AS hi, arg_min(gap, (abs(est - dist), gap)) FILTER (est IS NOT NULL) AS near FROM c JOIN m ON m.step = c.step GROUP BY 1, 2)
SELECT e.*, CAST(CASE WHEN hi > lo THEN floor((lo + hi - 1) / 2.0 + 0.5) ELSE near END AS BIGINT) AS real_gap FROM e JOIN o ON o.dist = e.dist AND o.step = CASE WHEN min_len <= 250 THEN 250 WHEN min_len <= 500 THEN 500 WHEN min_len <= 750 THEN 750 ELSE 1000 END"""

FOLDS["dendrogram_merges"] = f"""WITH RECURSIVE {t.EDGES}, {flat.RATES},
w AS (SELECT c1, c2, max(CASE WHEN greatest(a.rate, b.rate) = 0 THEN 0 ELSE (greatest(a.rate, b.rate) - least(a.rate, b.rate)) / greatest(a.rate, b.rate) END) AS weight FROM edges JOIN rates a ON c1 = a.id JOIN rates b ON c2 = b.id AND a.sample = b.sample WHERE support >= 3 GROUP BY 1, 2),
e AS (SELECT *, row_number() OVER (ORDER BY weight, c1, c2) AS rn FROM w), v AS (SELECT c1 AS v FROM e UNION SELECT c2 FROM e),
f(rn, lab, la, lb, weight, size) AS (SELECT 0::BIGINT, (SELECT map_from_entries(list((v, v))) FROM v), NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, NULL::BIGINT
  UNION ALL SELECT e.rn, CASE WHEN lab[c1] = lab[c2] THEN lab ELSE map_from_entries(list_transform(map_entries(lab), lambda x: (x.key, CASE WHEN x.value = greatest(lab[c1], lab[c2]) THEN least(lab[c1], lab[c2]) ELSE x.value END))) END,
    CASE WHEN lab[c1] <> lab[c2] THEN least(lab[c1], lab[c2]) END, CASE WHEN lab[c1] <> lab[c2] THEN greatest(lab[c1], lab[c2]) END, e.weight, CASE WHEN lab[c1] <> lab[c2] THEN len(list_filter(map_values(lab), lambda x: x = lab[c1] OR x = lab[c2])) END
  FROM f JOIN e ON e.rn = f.rn + 1),
z AS (SELECT lab FROM f ORDER BY rn DESC LIMIT 1)
SELECT z.lab[la] AS component, CAST(row_number() OVER (PARTITION BY z.lab[la] ORDER BY rn) AS INT) AS merge, la AS "left", lb AS "right", round(weight, 6) AS weight, CAST(size AS INT) AS size FROM f, z WHERE la IS NOT NULL"""


_MEET = "lab[c1] <> lab[c2] AND len(list_intersect(refs[lab[c1]], refs[lab[c2]])) > 0"
FOLDS["super_clusters_greedy"] = f"""WITH RECURSIVE {t.EDGES}, {flat.RATES},
w AS (SELECT c1, c2, max(CASE WHEN greatest(a.rate, b.rate) = 0 THEN 0 ELSE (greatest(a.rate, b.rate) - least(a.rate, b.rate)) / greatest(a.rate, b.rate) END) AS weight FROM edges JOIN rates a ON c1 = a.id JOIN rates b ON c2 = b.id AND a.sample = b.sample WHERE support >= 3 GROUP BY 1, 2),
e AS (SELECT *, row_number() OVER (ORDER BY weight, c1, c2) AS rn FROM w), v AS (SELECT p_partkey AS v, [p_type, p_brand] AS r FROM part WHERE p_partkey IN (SELECT c1 FROM e UNION SELECT c2 FROM e)),
f(rn, lab, refs) AS (SELECT 0::BIGINT, (SELECT map_from_entries(list((v, v))) FROM v), (SELECT map_from_entries(list((v, r))) FROM v)
  UNION ALL SELECT e.rn, CASE WHEN {_MEET} THEN map_from_entries(list_transform(map_entries(lab), lambda x: (x.key, CASE WHEN x.value = greatest(lab[c1], lab[c2]) THEN least(lab[c1], lab[c2]) ELSE x.value END))) ELSE lab END,
    CASE WHEN {_MEET} THEN map_from_entries(list_transform(map_entries(refs), lambda x: (x.key, CASE WHEN x.key = least(lab[c1], lab[c2]) THEN list_intersect(refs[lab[c1]], refs[lab[c2]]) ELSE x.value END))) ELSE refs END
  FROM f JOIN e ON e.rn = f.rn + 1),
z AS (SELECT lab FROM f ORDER BY rn DESC LIMIT 1)
SELECT p_partkey AS cluster, coalesce(z.lab[p_partkey], p_partkey) AS super_cluster FROM part, z"""


def _distances(spark, sf):
    """Edge distances of one library per return flag: c1, o1, c2, o2, dist, std, lib."""
    li = t.table(spark, sf, "lineitem")
    return li.select((F.col("l_suppkey") % 50).alias("c1"), F.lit("+").alias("o1"), (F.col("l_partkey") % 20).alias("c2"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("o2"),
        (F.col("l_quantity") * 10).cast("long").alias("dist"), (F.col("l_linenumber") * 20).cast("long").alias("std"), F.col("l_returnflag").alias("lib"))


@query
def median_seed_bundles(spark, sf):
    return bundles.bundle_pairs(_distances(spark, sf))


@query
def seed_bundles_desc(spark, sf):
    return bundles.bundle_long(_distances(spark, sf).withColumn("ori", F.concat_ws(":", "o1", "o2")))


@query
def super_bundles(spark, sf):
    per_lib = bundles.bundle_pairs(_distances(spark, sf), by=[*bundles.ENDS, "lib"]).drop("bundle")
    return bundles.super_bundles(per_lib)


@query
def gap_correction(spark, sf):
    e = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 4).alias("dist"), (F.col("l_partkey") % 900 + 100).alias("min_len"))
    return bundles.correct_gap(e, 300.0, 30.0, 50, [250, 500, 750, 1000])


@query
def overlap_resolution(spark, sf):
    a = t.children(spark, sf).withColumns({"s": F.col("line") * 20, "e": F.col("line") * 20 + F.col("length"), "score": F.floor(F.col("price") * 100 / F.col("length"))})
    return intervals.overlap_resolution(a.select("scaffold", *t.ORDER, "s", "e", "score"), "scaffold", "s", "e", "score", t.ORDER, overlap=5)


def _weighted(spark, sf):
    return ed.relative_rate_distance(t.edges(spark, sf, 3), flat._rates(spark, sf))


@query
def dendrogram_merges(spark, sf):
    return trees.single_linkage_tree(_weighted(spark, sf)).withColumn("weight", F.round("weight", 6))


def _model_windows(spark, sf):
    """Three windows per contig and sample from the quantities of its lines."""
    li = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("contig"), F.col("l_linestatus").alias("sample"), (F.col("l_linenumber") % 3).alias("win"), "l_quantity")
    w = li.groupBy("contig").pivot("sample", ["F", "O"]).agg(*(F.coalesce(F.sum(F.when(F.col("win") == i, F.col("l_quantity"))), F.lit(0.0)).cast("int").alias(str(i)) for i in range(3)))
    rows = [F.struct(F.lit(s).alias("sample"), F.array(*(F.coalesce(F.col(f"{s}_{i}"), F.lit(0)) for i in range(3))).alias("counts")) for s in ("F", "O")]
    return w.select("contig", F.explode(F.array(*rows)).alias("x")).select("contig", "x.sample", "x.counts", F.lit(1020).alias("length"))


@query
def model_cut(spark, sf):
    return trees.cut_tree(_weighted(spark, sf), _model_windows(spark, sf), 340, 2.0, 50.0)


@query
def super_clusters_greedy(spark, sf):
    refs = t.table(spark, sf, "part").select(F.col("p_partkey").alias("cluster"), F.array("p_type", "p_brand").alias("refs"))
    return trees.super_clusters(_weighted(spark, sf), refs)


def _subgraphs(spark, sf):
    e = keep(t.edges(spark, sf, 3), "edges")
    return trees.border_subgraphs(e, t.parts(spark, sf), bound=4000)


@query
def subgraphs(spark, sf):
    return _subgraphs(spark, sf)


@query
def scaffold_order(spark, sf):
    return scaffold.order_scaffolds(_subgraphs(spark, sf), t.parts(spark, sf), k=60)


@query
def gap_sizes_qp(spark, sf):
    c = t.children(spark, sf).withColumn("pos", F.row_number().over(Window.partitionBy("scaffold").orderBy(*t.ORDER)))
    one = c.withColumn("_n", F.count("*").over(Window.partitionBy("scaffold", "contig"))).filter("_n = 1").select("scaffold", "pos", "contig", (F.col("length") * 10).alias("length"))
    return scaffold.gap_sizes(one, t.edges(spark, sf, 2))


@query
def strain_peeling(spark, sf):
    w = flat._windows(spark, sf, sample=False).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("win", "n"))).alias("w"))
    rows = w.select((F.col("id") % 5).alias("species"), F.col("id").alias("contig"), F.lit(30 * 340).alias("length"), F.transform("w", lambda x: x["n"]).alias("counts"))
    return strain.peel_strains(rows, 340, 5.0, low=5_000, high=20_000)
