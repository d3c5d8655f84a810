"""Graph operators over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.runtime import drop, keep, ship, tidy

#: Arcs (an edge is two) that one task may finish, some 16 MB.
LOCAL_ARCS = 1 << 20


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices in order, the smallest vertex that each one reaches) over edges u - v."""
    names, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = codes[: len(u)], codes[len(u) :]
    label = np.arange(len(names))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[x] != label[y]
        x, y = x[open_], y[open_]
    return names, names[label]


def _in_one_task(arcs: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            u, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1))
            names, component = smallest_reachable(u, v)
            types = held[0].column(0).type
            for at in range(0, len(names), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 65_536], types) for x in (names, component)], names=["vertex", "component"])

    return arcs.filter("u < v").repartition(1).mapInArrow(tidy(run), f"vertex {kind}, component {kind}")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, local_arcs: int = LOCAL_ARCS) -> DataFrame:
    """vertex and component (its smallest vertex) of every vertex that an edge names.

    Distinct arcs are counted first; up to local_arcs of integer or string vertices are finished in one task. Of more, minimum labels travel along the edges and then jump to their own label's label, so the rounds grow with the
    logarithm of a path's length. Each round's labels are a table in the shared folder: lineage stays
    short and a lost executor costs one round at most. Nothing is collected but the number of changed labels. Hubs
    are safe: messages are pre-aggregated and the joins are plain equi-joins that adaptive execution may split.
    Null ends and loops add no edge; repeated edges change nothing.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    known = e.filter("u is not null and v is not null")
    both = keep(known.filter("u <> v").union(known.filter("u <> v").select("v", "u")).distinct(), "arcs")
    kind = both.schema["u"].dataType.simpleString()
    if kind in ("int", "bigint", "string") and both.count() <= local_arcs:
        ship(edges.sparkSession)
        labels = keep(_in_one_task(both, kind), "labels")
    else:
        labels = _spread(both, rounds)
    drop(both)
    lone = known.filter("u = v").select(F.col("u").alias("vertex")).distinct().join(labels.select("vertex"), "vertex", "left_anti")
    return labels.union(lone.select("vertex", F.col("vertex").alias("component")))


def _spread(both: DataFrame, rounds: int) -> DataFrame:
    """Labels by rounds over the whole table of arcs."""
    labels = keep(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("vertex"), F.least("u", "m").alias("component")), "labels")
    for _ in range(rounds):
        sent = both.join(labels.withColumnRenamed("vertex", "v"), "v").groupBy("u").agg(F.min("component").alias("m"))
        near = labels.join(sent, F.col("vertex") == F.col("u"), "left").select("vertex", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        up = labels.select(F.col("vertex").alias("c"), F.col("component").alias("top"))
        new = keep(near.join(up, "c", "left").select("vertex", F.least("c", "top").alias("component"), "old"), "labels")
        done = new.filter("component <> old").limit(1).count() == 0
        drop(labels)
        labels = new.drop("old")
        labels._kept_path = new._kept_path
        if done:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
