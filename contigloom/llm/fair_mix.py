"""Source mixing to target weights by weighted fair queueing, in DataFrame functions.

Each source serves its documents in the order of a hash, up to `most` times over. A copy's virtual finish time is the source's
tokens up to its end divided by the source's target weight (its share of the budget), so all sources have spent their targets when the virtual
clock has spent the budget. Copies are globally range-sorted by finish time and cut where the budget ends: what began before that is
taken, up to the word the budget ends at, or, if only whole copies are taken, those that the budget holds in the order of their finish.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.llm.chunks import unused
from contigloom.runtime import keep, passing

WEIGHTS = (5.0, 2.0, 1.0)
#: Rows that one (source, bucket) window holds at most on average.
BUCKET_ROWS = 4_000
SPACES = r"[\x20\x09-\x0D]+"
SEED = 17


def n_words(text):
    """Number of runs of other characters than the six ASCII white-space ones; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), ""))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Adds target to (source, source_size), one row per source.

    Sources in code-point order, null last, take the weights in turn. Targets share the sum of all sizes by weight; none is above most * source_size, and what that
    leaves over is shared among the others by weight, until none is above: the water level over caps divided by weights.
    """
    all_sources = Window.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(all_sources) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, from_here = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    s = s.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    level = F.first("level", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(level, F.lit(math.inf)) * F.col("weight")).alias("target"))


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """row, key, source, size, order (60 bits of a hash of the key) and same (a hash of the text) of every row, as a table in the shared folder."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    order = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")
    size = n_words(F.col(text)).cast("long")
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"), size.alias("size"), order.alias("order"), F.xxhash64(text).alias("same"))
    return keep(named, "sized")


def mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sources, sequence) from sized() rows: (source, source_size, target), and the mix
    (row, source, copy, finish, taken) in the order it is served, range-partitioned and sorted by finish.

    Totals before a document are summed in two steps, over buckets of the order and inside one bucket, so a source of a third of all
    rows is spread over many tasks. Documents of size 0 are never taken; ties of the order go by key, text and row; a document
    is taken most times at most. At the time the budget is spent, each source is within one copy. That copy is taken in part or, if
    whole, as a whole as long as the budget lasts, the copies that finish first before the others.
    """
    bits = max(6, math.ceil(math.log2(max(1, rows.count()) / BUCKET_ROWS + 1)))
    name = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    r = rows.filter("size > 0").withColumn("name", name).withColumn("bucket", F.shiftright("order", 60 - bits))
    sums = keep(r.groupBy("name", "source", "bucket").agg(F.sum("size").alias("n")), "bucket_sums")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = keep(targets(per_source, weights, most), "targets")
    base = sums.withColumn("base", F.sum("n").over(Window.partitionBy("name").orderBy("bucket")) - F.col("n")).drop("n")
    base = base.join(F.broadcast(goal) if goal.count() <= 10_000 else goal, base["source"].eqNullSafe(goal["source"])).select("name", "bucket", "base", "source_size", "target")
    inside = Window.partitionBy("name", "bucket").orderBy("order", "key", "same", "row").rowsBetween(Window.unboundedPreceding, -1)
    r = r.join(base, ["name", "bucket"]).withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    copies = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("copy")).withColumn("start", F.col("start") + F.col("copy") * F.col("source_size"))
    served = copies.withColumn("taken", F.least(F.col("size"), F.round("target").cast("long") - F.col("start"))).filter("taken > 0")
    served = served.withColumn("finish", (F.col("start") + F.col("size")) / F.col("target"))
    if whole:
        served = _whole(served)
    served = served.select("row", "source", "copy", "finish", "taken", "order")
    return goal, served.repartitionByRange("finish", "order", "copy").sortWithinPartitions("finish", "order", "copy").drop("order")


def _whole(served: DataFrame) -> DataFrame:
    """The copies that the budget holds, as a whole. Those cut by the end of the budget are one for each source; what all sources have left for them is dealt to them in
    the order of their finish, and the last is taken if more than half of it is held."""
    cut = served.filter("taken < size")
    by_finish = Window.orderBy("finish", "order", "copy", "row")
    left = F.sum("taken").over(Window.partitionBy())
    before = F.sum("size").over(by_finish) - F.col("size")
    held = keep(cut.select("row", "copy", (2 * (left - before) > F.col("size")).alias("held")), "held")
    out = served.join(F.broadcast(held) if held.count() <= 100_000 else held, ["row", "copy"], "left")
    return out.filter((F.col("taken") == F.col("size")) | F.col("held")).withColumn("taken", F.col("size"))


def mixed_sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """key, size, source_size, target and taken (words the mix takes, repeats counted) of every row.

    Null texts have size 0 and are not taken; a null source is a source of its own; repeated rows are rows of their own; extra columns are left out.
    An empty table gives an empty result.
    """
    rows = sized(docs, key, text, source)
    goal, sequence = mix(rows)
    took = keep(sequence, "mix").groupBy("row").agg(F.sum("taken").alias("taken"))
    goal = goal.select(F.col("source").alias("_source"), "source_size", "target")
    out = rows.join(F.broadcast(goal) if goal.count() <= 10_000 else goal, F.col("source").eqNullSafe(F.col("_source"))).join(took, "row", "left")
    return out.select(F.col("key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def _copies(rows: DataFrame, sequence: DataFrame, mark: str) -> DataFrame:
    """The sequence with what tells a document: key, hash of the text and source. Equal rows share the copies that the mix took of them."""
    served = sequence.select("row", "finish", "copy", "taken").join(rows, "row")
    return served.select(*(F.col(c).alias(f"{mark}_{c}") for c in ("key", "same", "source", "row", "finish", "copy", "size", "taken")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars", whole: bool = False) -> DataFrame:
    """The documents of the mix, a row per copy, with the columns of docs, in the order of their virtual finish times.

    If whole, every copy is a whole document. Else the copy that a source's target ends in holds as many words as are left of it, single-spaced. Rows are
    told apart by key and text, so null and repeated keys are rows like others; equal rows of one key are served as often as the mix names any of them.
    Empty and null texts are not taken; an empty table gives none. The join shuffles the texts once, at every size: a mix names most documents;
    the global range sort shuffles them once more.
    """
    lasting: list[DataFrame] = []
    with passing(lasting):
        rows = sized(docs, key, text, source)
        mark = unused(docs.columns, "_mix")
        copies = keep(_copies(rows, mix(rows, whole=whole)[1], mark), "mix")
        repeated = rows.groupBy("key", "same", "source").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() > 0
        lasting.append(copies)
    same = F.xxhash64(text).eqNullSafe(F.col(f"{mark}_same")) & F.col(key).eqNullSafe(F.col(f"{mark}_key")) & F.col(source).cast("string").eqNullSafe(F.col(f"{mark}_source"))
    named = docs.dropDuplicates([key, text, source]) if repeated else docs
    out = named.join(copies.hint("merge"), same)
    if not whole:
        words = F.array_remove(F.split(F.col(text), SPACES), "")
        cut = F.when(F.col(f"{mark}_taken") < F.col(f"{mark}_size"), F.array_join(F.slice(words, F.lit(1), F.col(f"{mark}_taken").cast("int")), " ")).otherwise(F.col(text))
        out = out.withColumn(text, cut)
        if length in docs.columns:
            out = out.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return out.repartitionByRange(f"{mark}_finish", f"{mark}_row", f"{mark}_copy").sortWithinPartitions(f"{mark}_finish", f"{mark}_row", f"{mark}_copy").select(docs.columns)


#: The same in SQL: sizes, targets by the water level over caps divided by weights, and what up to three rounds over a source take.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, text,
    CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS ord
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
g AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap), 'inf'::DOUBLE) * weight) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS goal,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.text) - d.size AS BIGINT) AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size)) + greatest(0, least(size, goal - start - 2 * source_size)) AS BIGINT) AS taken
FROM p
"""
