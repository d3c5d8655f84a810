"""External programs, one process for each row, as many at once as there are tasks."""

from __future__ import annotations

import subprocess
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from contigloom.runtime import ship


def run_for_each(items: DataFrame, key: str, arguments: list[str], stdin: str | None = None, seconds: int = 3600) -> DataFrame:
    """key, status, out and err of a program run once for each row of items.

    '{column}' in an argument stands for the row's value; stdin names a column whose text the program reads. A program that takes longer than
    seconds is ended and has status -1; null values are empty texts. A lost executor's rows are run again, so programs should leave nothing
    behind but their output.
    """
    ship(items.sparkSession)
    kind = dict(items.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                values = {c: "" if v is None else str(v) for c, v in row.items()}
                try:
                    p = subprocess.run([a.format(**values) for a in arguments], input=values[stdin] if stdin else None, capture_output=True, text=True, timeout=seconds, check=False)
                    out.append((row[key], p.returncode, p.stdout, p.stderr))
                except subprocess.TimeoutExpired:
                    out.append((row[key], -1, "", f"ended after {seconds} s"))
            yield pd.DataFrame(out, columns=[key, "status", "out", "err"])

    return items.mapInPandas(run, f"`{key}` {kind}, status int, out string, err string")
