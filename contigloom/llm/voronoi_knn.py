"""Exact top-k inner products by a Voronoi join.

A bounded number of rows serve as pivots. Rows belong to the cell of their nearest pivot, queries to the group of their nearest pivot among the first few.
Cells are summed up by radius, groups by radius and by the least k-th score that their queries reach with a bounded number of probe rows; by the
Cauchy-Schwarz inequality a row goes to a group, and a query to a cell, only if it may still reach that score. What is left is solved in
blocks of bounded size, and the blocks' best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.runtime import keep, ship, tidy

#: Pivots: a quarter of the square root of the number of rows, between these bounds; probes: eight times that root, between these.
LEAST_PIVOTS, MOST_PIVOTS, LEAST_PROBES, MOST_PROBES = 48, 4096, 64, 4096
#: Rows of a block on either side; few queries are parted in GROUPS groups, of QUERIES at least, many in one for every block of them.
QUERY_BLOCK, ROW_BLOCK, GROUPS, QUERIES = 2048, 8192, 8, 4
#: Rows whose bounds against all groups or cells are worked out at once.
STEP = 512


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """id and v (floor(scale * x) of each component); rows with a null key, a null vector, or null or non-finite components are left out."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return rows.filter(F.col(key).isNotNull() & v.isNotNull()).filter(~bad).select(F.col(key).alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), "<i8").reshape(len(parts), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating-point matrix products where these are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if top < 2.0**52 else a @ b.T


def best(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best rows, ties to smaller ids, rows of its own id left out."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    found = []
    for at in range(0, len(queries), 256):
        s = products(queries[at : at + 256], rows)
        own = q_ids[at : at + 256, None] == ids[None, :]
        n = min(k + int(own.sum(1).max(initial=0)), len(ids))
        tie = len(ids) - 1 - np.arange(len(ids))
        if float(np.abs(s).max(initial=0)) * len(ids) < 2.0**62:
            top = np.argpartition(-(s * len(ids) + tie), n - 1, axis=1)[:, :n]
        else:
            top = np.argsort(-s, axis=1, kind="stable")[:, :n]
        r = np.repeat(np.arange(len(s)), n)
        c = top.ravel()
        fine = ~own[r, c]
        found.append((q_ids[at : at + 256][r[fine]], ids[c[fine]], s[r[fine], c[fine]]))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _padded(lists: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim), np.int64)
    size = np.diff(lists.offsets.to_numpy())
    at = np.arange(len(size)).repeat(size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[at] = lists.flatten().to_numpy()
    return out


def _may_reach(x: np.ndarray, centres: np.ndarray, far: np.ndarray, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, centre) pairs whose inner product with some point at most `far` from the centre may come up to `reached`, which broadcasts."""
    bound = x @ centres.T + np.sqrt((x**2).sum(1))[:, None] * far
    return np.nonzero(bound + np.abs(bound) * 2e-9 + 1e-6 >= reached)


class Parts:
    """The join before it is solved: queries and data, each with (g, qb, c, rb, id, v): a query or row for every block of its group and cell that it must meet there."""

    def __init__(self, rows: DataFrame, is_query, k: int, key: str, vector: str, scale: float):
        spark = rows.sparkSession
        ship(spark)
        raw = integer_vectors(rows, key, vector, scale).select(F.col("id").cast("long").alias("id"), "v")
        self.vectors = vectors = keep(raw.withColumn("asks", is_query(F.col("id"))), "vectors")
        summary = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.count_if("asks").alias("queries")).first()
        self.n, self.n_queries, self.dim = summary["n"], summary["queries"], max(1, summary["dim"] or 0)
        if not self.n_queries:
            return
        root, dim = math.isqrt(self.n), self.dim
        n_pivots, n_probes = min(MOST_PIVOTS, max(LEAST_PIVOTS, root // 4)), min(MOST_PROBES, max(LEAST_PROBES, 8 * root))
        picked = vectors.orderBy(F.xxhash64("id", F.lit(3)), "id", "v").limit(max(n_pivots, n_probes)).collect()
        ids, probes = np.array([r["id"] for r in picked]), np.array([r["v"] + [0] * (dim - len(r["v"])) for r in picked], np.float64)
        self.n_groups = n_groups = int(min(len(picked), n_pivots, max(1, min(GROUPS, self.n_queries // QUERIES), self.n_queries // QUERY_BLOCK)))
        held = spark.sparkContext.broadcast((ids, probes, probes[:n_pivots]))  # of a bounded number of rows

        def assign(batches):
            ids, probes, p = held.value
            for whole in batches:
                for at in range(0, whole.num_rows, STEP):
                    b = whole.slice(at, STEP)
                    v = _padded(pa.concat_arrays([b.column(1)]), dim)
                    x, own, asks = v.astype(np.float64), b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
                    far = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (p**2).sum(1)[None, :] - 2 * x @ p.T, 0))
                    cell, group = far.argmin(1), far[:, :n_groups].argmin(1)
                    reached = np.full(len(own), -math.inf)
                    if len(ids) >= k and asks.any():
                        s = np.where(own[asks, None] == ids[None, :], -math.inf, x[asks] @ probes.T)
                        reached[asks] = np.partition(s, -k, axis=1)[:, -k]
                    r = np.arange(len(own))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0), pa.array([y.tobytes() for y in v], pa.binary()), b.column(2), pa.array(cell.astype(np.int32)), pa.array(far[r, cell]), pa.array(group.astype(np.int32)), pa.array(far[r, group]), pa.array(reached)],
                        names=["id", "v", "asks", "cell", "cell_far", "grp", "grp_far", "reached"],
                    )

        self.assigned = assigned = keep(vectors.mapInArrow(tidy(assign), "id long, v binary, asks boolean, cell int, cell_far double, grp int, grp_far double, reached double"), "assigned")
        # a query id that repeats is the one whose vector is first
        asked = assigned.filter("asks").groupBy("id").agg(F.min(F.struct("v", "grp", "grp_far", "reached")).alias("q")).select("id", "q.*")
        # of a row for each pivot at most
        cells = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("cell_far").alias("far")).orderBy("cell").collect()
        groups = asked.groupBy("grp").agg(F.count("*").alias("n"), F.max("grp_far").alias("far"), F.min("reached").alias("reached")).orderBy("grp").collect()
        c_id, c_far = np.array([r["cell"] for r in cells]), np.array([r["far"] for r in cells])
        g_id, g_far, g_need = np.array([r["grp"] for r in groups]), np.array([r["far"] for r in groups]), np.array([r["reached"] for r in groups])
        c_blocks, g_blocks = np.ones(n_pivots, np.int64), np.ones(n_pivots, np.int64)
        c_blocks[c_id] = [math.ceil(r["n"] / ROW_BLOCK) for r in cells]
        g_blocks[g_id] = [math.ceil(r["n"] / QUERY_BLOCK) for r in groups]

        def send(centre_ids, far, needs, own_blocks, other_blocks, names):
            """Rows of (id, v, own part, salt, reached or null) to the parts of the other side that they must meet, one copy for each of its blocks."""

            def run(batches):
                p = held.value[2][centre_ids]
                for whole in batches:
                    for at in range(0, whole.num_rows, STEP):
                        b = whole.slice(at, STEP)
                        part = b.column(2).to_numpy()
                        block = b.column(3).to_numpy() % own_blocks[part]
                        need = needs if needs is not None else b.column(4).to_numpy()[:, None]
                        r, c = _may_reach(_matrix(b.column(1)).astype(np.float64), p, far, need)
                        n = other_blocks[centre_ids[c]]
                        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        r, c = np.repeat(r, n), np.repeat(centre_ids[c], n)
                        sides = [pa.array(x.astype(np.int32)) for x in (c, which, part[r], block[r])]
                        yield pa.RecordBatch.from_arrays([*sides, b.column(0).take(pa.array(r)), b.column(1).take(pa.array(r))], names=names)

            return tidy(run)

        place = "g int, qb int, c int, rb int, id long, v binary"
        other = "c int, rb int, g int, qb int, id long, v binary"
        salt = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)).alias("salt")
        self.data = assigned.select("id", "v", "cell", salt).mapInArrow(send(g_id, g_far, g_need, c_blocks, g_blocks, ["g", "qb", "c", "rb", "id", "v"]), place)
        self.queries = asked.select("id", "v", "grp", salt, "reached").mapInArrow(send(c_id, c_far, None, g_blocks, c_blocks, ["c", "rb", "g", "qb", "id", "v"]), other)


def top_k(rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of every row for which the column is_query(id) holds.

    Candidates are all rows but those of the query's own id; scores are integer inner products of the scaled components, ties go to the smaller id.
    Rows with null keys, null vectors, or null or non-finite components take no part; vectors of other lengths than the longest count as
    filled up with zeros; repeated query ids are one query (the least in byte order of its vector), repeated rows are candidates each. With fewer candidates
    than k all are returned; an empty table gives an empty result. Cells and groups of any size are cut into blocks by a hash of the id.
    """
    parts = Parts(rows, is_query, k, key, vector, scale)
    if not parts.n_queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def solve(q: pa.Table, d: pa.Table) -> pa.Table:
        empty = not (q.num_rows and d.num_rows)
        out = (np.zeros(0, np.int64),) * 3 if empty else best(_matrix(q["v"]), q["id"].to_numpy(), _matrix(d["v"]), d["id"].to_numpy(), k)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    unit = ["g", "qb", "c", "rb"]
    local = parts.queries.groupBy(*unit).cogroup(parts.data.groupBy(*unit)).applyInArrow(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


#: The same for 5 neighbours of the ids divisible by 50, by all products.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
