"""Group-wise folds and global numbers without a task per group and without a task of all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.runtime import keep, ship


def map_groups(df: DataFrame, by: list[str], order: list[str], fn: Callable[[tuple, dict[str, np.ndarray]], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that fn(keys, columns) gives for every group, its rows sorted by order.

    Keys are hashed to tasks and sorted there, and a task runs through its groups batch by batch: thousands of small groups cost one Arrow stream, and a task
    holds one group and one batch. Rows with a null key are left out.
    """
    ship(df.sparkSession)
    known = df.dropna(subset=by)
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        out_names = [c.split()[0].strip("`") for c in schema.split(",")]

        def solved(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            columns = {c: rows[c].to_numpy() for c in names}
            keys = [columns[c] for c in by]
            out: list[tuple] = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]):
                out.extend(fn(tuple(k[s] for k in keys), {c: v[s:e] for c, v in columns.items()}))
            return pd.DataFrame(out, columns=out_names)

        def starts_of(rows: pd.DataFrame) -> np.ndarray:
            new = np.zeros(len(rows), bool)
            new[0] = True
            for c in by:
                v = rows[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return np.flatnonzero(new)

        for batch in batches:
            if not len(batch):
                continue
            starts = starts_of(batch)
            same = bool(held) and all(held[-1][c].iloc[-1] == batch[c].iloc[0] for c in by)
            if same and len(starts) == 1:
                held.append(batch)
                continue
            cut = starts[-1]  # the last group may go on in the next batch
            done = pd.concat([*held, batch.iloc[:cut]], ignore_index=True) if held or cut else None
            if done is not None and len(done):
                yield solved(done, starts_of(done))
            held = [batch.iloc[cut:]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield solved(rows, starts_of(rows))

    return known.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(run, schema)


def numbered(df: DataFrame, order: list, name: str = "number") -> DataFrame:
    """df with the place of each row (from 1) in a total order.

    The rows are range-sorted and written once; places within a task are shifted by the tasks' counts, of which one row per task passes a window.
    """
    at = F.monotonically_increasing_id()
    rows = keep(df.orderBy(*order).withColumns({"_task": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}), "numbered")
    tasks = rows.groupBy("_task").agg(F.count("*").alias("_n"))
    before = tasks.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    return rows.join(before, "_task").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_task", "_at", "_before")
