"""Registry of the queries over the driver's tables and their oracle SQL."""

from __future__ import annotations

from contigloom.plans import files, flat, more, solved

QUERIES: dict = {**flat.QUERIES, **files.QUERIES, **more.QUERIES, **solved.QUERIES}
ORACLES: dict = {**flat.ORACLES, **files.ORACLES, **more.ORACLES, **solved.ORACLES}
FOLD_ORACLES: dict = {**solved.FOLDS, **more.FOLDS}
FLAGSHIP = "final_cluster_table"
