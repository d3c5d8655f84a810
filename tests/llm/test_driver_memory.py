"""What the driver holds: the classifier is fitted in a task, and freed memory goes back."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from contigloom import runtime
from contigloom.llm import toxicity


def labelled(spark, rows: int, words: int, letters: int):
    """Documents of words of a length each, every other one toxic, and their labels."""
    word = F.concat(F.when(F.col("doc_id") % 2 == 0, "awful").otherwise("fine"), (F.col("doc_id") % 5).cast("string"), F.repeat(F.lit("x"), letters))
    ids = spark.range(rows).withColumnRenamed("id", "doc_id")
    return ids.withColumn("text", F.array_join(F.array_repeat(word, words), " ")), ids.withColumn("toxic", (F.col("doc_id") % 2 == 0).cast("int"))


def test_texts_of_the_fit_do_not_reach_the_driver(spark):
    docs, labels = labelled(spark, 100, 500, 2000)
    size = toxicity.fit_sample(docs, labels, "doc_id", "toxic", 4000).join(docs, "doc_id").agg(F.sum(F.octet_length("text"))).first()[0]
    assert size > 50 << 20
    tracemalloc.start()
    model = toxicity.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.embed) == 1 << 17 and peak < size


def test_a_task_fits_the_model_of_the_same_rows(spark):
    docs, labels = labelled(spark, 200, 20, 3)
    picked = toxicity.fit_sample(docs, labels, "doc_id", "toxic", 60)
    rows = docs.join(picked, "doc_id").orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id", "text").collect()
    here, there = toxicity.fit([r["text"].encode() for r in rows], np.array([r["_label"] for r in rows])), toxicity.train(docs, labels, most_rows=60)
    assert len(rows) == 60 and np.array_equal(here.embed, there.embed) and np.array_equal(here.out, there.out) and here.base == there.base
    assert toxicity.train(docs.limit(0), labels).base == toxicity.constant_model().base


def test_the_driver_gives_freed_heap_back(spark):
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    held = spark._jvm.java.lang.StringBuilder(1 << 30)
    grown = heap.totalMemory()
    held.trimToSize()
    runtime.trim_driver(spark, 0.0)
    assert heap.totalMemory() < grown - (500 << 20)
