"""Groups, pruning and repeated queries of the Voronoi join."""

import numpy as np

from contigloom.llm import voronoi_knn

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, is_query, k=5):
    best = {}
    first = {}
    ints = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows]
    for i, x in ints:
        if is_query(i) and (i not in first or x.tobytes() < first[i].tobytes()):
            first[i] = x
    for q, x in first.items():
        best[q] = [(i, int(x @ y)) for i, y in ints if i != q]
        best[q] = sorted(best[q], key=lambda t: (-t[1], t[0]))[:k]
    return sorted((q, r + 1, i, s) for q, own in best.items() for r, (i, s) in enumerate(own))


def clusters(n=1500, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim)) * 20
    return [(i, [float(x) for x in centres[i % 10] + rng.normal(size=dim)]) for i in range(n)]


def test_several_groups_give_the_exact_result(spark):
    rows = clusters()
    d = spark.createDataFrame(rows, SCHEMA)
    parts = voronoi_knn.Parts(d, lambda c: c % 7 == 0, 5, "vec_id", "embedding", 256.0)
    assert parts.n_groups == 8 and parts.queries.select("g").distinct().count() > 3
    assert sorted(map(tuple, voronoi_knn.top_k(d, lambda c: c % 7 == 0).collect())) == brute(rows, lambda i: i % 7 == 0)


def test_bounds_prune_clustered_data(spark):
    d = spark.createDataFrame(clusters(), SCHEMA)
    parts = voronoi_knn.Parts(d, lambda c: c % 7 == 0, 5, "vec_id", "embedding", 256.0)
    full = parts.queries.select("g", "qb").distinct().count() * parts.n
    assert parts.data.count() < 0.6 * full  # rows that are sent, against a copy for every group
    met = parts.queries.join(parts.data.groupBy("g", "qb", "c", "rb").count(), ["g", "qb", "c", "rb"]).agg({"count": "sum"}).first()[0]
    assert met < 0.4 * parts.n_queries * parts.n  # products that are worked out, against all


def test_small_blocks_and_repeated_queries(spark, monkeypatch):
    for name, n in (("QUERY_BLOCK", 16), ("ROW_BLOCK", 50), ("STEP", 33), ("MOST_PIVOTS", 60)):
        monkeypatch.setattr(voronoi_knn, name, n)
    rows = clusters(700, 4) + [(14, [1.0, -2.0, 0.0, 5.0]), (14, [9.0, 9.0, 9.0, 9.0]), (21, [0.0] * 4)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, lambda i: i % 7 == 0)
    for _ in range(2):
        assert sorted(map(tuple, voronoi_knn.top_k(d, lambda c: c % 7 == 0).collect())) == want


def test_queries_match_their_sql(spark):
    import duckdb

    from contigloom.llm import queries

    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("op6_fair_mix", "op7_voronoi_knn", "op9_near_dedup"):
        cur = c.execute(queries.ORACLES[name])
        names = [x[0] for x in cur.description]
        df = queries.QUERIES[name](spark, sf)
        assert sorted(df.columns) == sorted(names)
        assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == sorted(cur.fetchall(), key=str)
