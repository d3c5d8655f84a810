"""Toxicity scores by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its prefixes. Filters of widths 1, 2 and 3 run over a
text's words, each filter's largest response is kept, and a logistic layer scores them. The first embedding dimension
starts from the log-odds of its bucket in the training texts; everything is then trained by gradient steps
(Adagrad). Decision thresholds are calibrated by language on all labelled rows outside the held-out fifth that the fit left out;
the score itself never sees the language.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from contigloom.llm.chunks import slices, unused
from contigloom.runtime import keep, ship, tidy

WIDTHS = (1, 2, 3)
#: Lengths of the hashed prefixes.
PREFIXES = (3, 4, 5, 6)
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def buckets(word: bytes, n: int) -> list[int]:
    """Hash buckets of a word and of its proper prefixes; absent prefixes give bucket 0, whose embedding is zero."""
    w = word.decode("utf-8", "replace").lower()
    parts = [w, *((w[:k] + "*") if len(w) > k else "" for k in PREFIXES)]
    return [xxhash.xxh32_intdigest(p.encode()) % (n - 1) + 1 if p else 0 for p in parts]


@dataclass
class Model:
    embed: np.ndarray  # (buckets, dim)
    filters: dict[int, np.ndarray]  # width -> (width, dim, filters)
    bias: np.ndarray  # (len(WIDTHS) * filters)
    out: np.ndarray
    base: float
    thresholds: dict[str, float] = field(default_factory=dict)
    fit_keys: DataFrame | None = None  # the keys of the rows it was fitted on

    def plain(self) -> Model:
        """What tasks need of it."""
        return replace(self, fit_keys=None)

    def responses(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to each filter at each of its places."""
        x = self.embed[np.array([buckets(w, len(self.embed)) for w in words])].sum(1)
        return np.concatenate([x @ self.filters[w][k] for w in WIDTHS for k in range(w)], 1).astype(np.float32)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.base
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scorer:
    """Scores texts; the responses of words are held in a table of a fixed number of rows, emptied when it is full."""

    #: Rows of word responses that are worked on at once.
    STEP = 8192

    def __init__(self, model: Model, most: int = 32_768):
        self.model, self.most = model, most
        self.n_filters = model.filters[1].shape[2]
        self._clear(most)

    def _clear(self, rows: int) -> None:
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((rows + 1, self.n_filters * sum(WIDTHS)), np.float32)
        self.used = 1  # row 0 is padding

    def _add(self, new: list[bytes]) -> None:
        if self.used + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((len(new), self.table.shape[1]), np.float32)])
        for i in range(0, len(new), self.STEP):
            part = new[i : i + self.STEP]
            self.table[self.used : self.used + len(part)] = self.model.responses(part)
            self.known.update(zip(part, range(self.used, self.used + len(part))))
            self.used += len(part)

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Largest responses over one text."""
        return self.pooled_all([words])[0]

    def pooled_all(self, split: list[list[bytes]]) -> np.ndarray:
        """Largest responses over each whole text. The texts' words follow one another with two paddings between; places are taken in
        blocks that overlap by the largest width, and a text's blocks are merged by maximum."""
        known, f = self.known, self.n_filters
        size = np.array([len(w) + 2 for w in split])
        first = np.cumsum(size) - size
        ids = np.zeros(int(size.sum()) + 2, np.int32)
        for at, words in zip(first.tolist(), split):
            ids[at + 2 : at + 2 + len(words)] = [known[w] for w in words]
        best = np.full((len(split), f * len(WIDTHS)), -np.inf, np.float32)
        for at in range(0, len(ids) - 2, self.STEP):
            g = self.table[ids[at : at + self.STEP + 2]]
            n = len(g) - 2
            low, high = np.searchsorted(first, at, "right") - 1, np.searchsorted(first, at + n)
            starts, col = np.maximum(first[low:high] - at, 0), 0
            for i, w in enumerate(WIDTHS):
                r = g[:n, col : col + f]
                for k in range(1, w):
                    r = r + g[k : k + n, col + k * f : col + (k + 1) * f]
                own = best[low:high, i * f : (i + 1) * f]
                np.maximum(own, np.maximum.reduceat(r, starts, axis=0), out=own)
                col += w * f
        return best

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        split = [words_of(t) for t in texts]
        words = set().union(*split)
        new = [w for w in words if w not in self.known]
        if self.used + len(new) > len(self.table) and self.used > 1:
            self._clear(self.most)
            new = list(words)
        self._add(new)
        return self.model.score(self.pooled_all(split).astype(np.float64))


def constant_model(n_filters: int = 1) -> Model:
    return Model(np.zeros((2, 1)), {w: np.zeros((w, 1, n_filters)) for w in WIDTHS}, np.zeros(len(WIDTHS) * n_filters), np.zeros(len(WIDTHS) * n_filters), -30.0)


def fit(texts: list[bytes], labels: np.ndarray, n_buckets: int = 1 << 17, dim: int = 12, n_filters: int = 12, epochs: int = 6, rate: float = 0.05, seed: int = 5) -> Model:
    """Train on the given texts; a constant score of nearly 0 when they lack a class."""
    labels = np.asarray(labels)
    if len(set(labels.tolist())) < 2:
        return constant_model()
    rng = np.random.default_rng(seed)
    split = [words_of(t) for t in texts]
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(set().union(*split)))}
    parts = np.zeros((len(vocabulary) + 1, 1 + len(PREFIXES)), np.int64)
    for w, i in vocabulary.items():
        parts[i] = buckets(w, n_buckets)
    docs = [np.concatenate([[0, 0], np.fromiter((vocabulary[w] for w in s), np.int32, len(s)), [0, 0]]).astype(np.int32) for s in split]
    kinds = [tuple(x.astype(np.int32) for x in np.unique(ids, return_inverse=True)) for ids in docs]  # a text's distinct words, and where they stand
    count = np.zeros((2, n_buckets))
    for (own, _), y in zip(kinds, labels):
        count[int(y), np.unique(parts[own])] += 1
    odds = np.log((count[1] + 0.5) / ((labels == 1).sum() + 1)) - np.log((count[0] + 0.5) / ((labels == 0).sum() + 1))
    embed = rng.normal(0, 0.02, (n_buckets, dim))
    embed[:, 0] = np.where(count.sum(0) >= 3, np.clip(odds, -4, 4) / 8, 0)
    embed[0] = 0
    filters = {w: rng.normal(0, 0.2, (w, dim, n_filters)) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0, : n_filters // 2] = 1.0 / w
    n = len(WIDTHS) * n_filters
    bias, out, base = np.zeros(n), rng.normal(0, 0.1, n) + 0.1, np.array(-0.5)
    dense = {**{("w", w): filters[w] for w in WIDTHS}, "bias": bias, "out": out, "base": base}
    seen = {k: np.full(v.shape, 1e-3) for k, v in dense.items()}
    seen_embed = np.full(n_buckets, 1e-3)
    weight = {y: len(labels) / (2.0 * (labels == y).sum()) for y in (0, 1)}
    for epoch in range(epochs):
        for i in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // 16)):
            grad = {k: np.zeros_like(v) for k, v in dense.items()}
            touched, pulls = [], []
            for d in i:
                ids, y = docs[d], int(labels[d])
                own, where = kinds[d]
                x = embed[parts[own]].sum(1)[where]
                m, tops, pooled = len(ids) - 2, [], []
                for w in WIDTHS:
                    r = sum(x[k : k + m] @ filters[w][k] for k in range(w))
                    tops.append(r.argmax(0))
                    pooled.append(r.max(0))
                pre = np.concatenate(pooled) + bias
                h = np.maximum(pre, 0)
                p = 1 / (1 + np.exp(-np.clip(h @ out + base, -30, 30)))
                g = (p - y) * weight[y]
                grad["out"] += g * h
                grad["base"] += g
                gh = np.where(pre > 0, g * out, 0)
                grad["bias"] += gh
                for a, w in enumerate(WIDTHS):
                    part = gh[a * n_filters : (a + 1) * n_filters]
                    live = np.flatnonzero(part)
                    for k in range(w):
                        at = ids[tops[a][live] + k]
                        grad["w", w][k][:, live] += x[tops[a][live] + k].T * part[live]
                        touched.append(at)
                        pulls.append((filters[w][k][:, live] * part[live]).T)
            for k, v in dense.items():
                g = grad[k] / len(i) + 1e-4 * v
                seen[k] += g * g
                v -= rate * g / np.sqrt(seen[k])
            if touched and len(at := np.concatenate(touched)):
                rows = parts[at].ravel()
                pull = np.repeat(np.concatenate(pulls) / len(i), parts.shape[1], 0)
                unique, inverse = np.unique(rows, return_inverse=True)
                g = np.zeros((len(unique), dim))
                np.add.at(g, inverse.ravel(), pull)
                seen_embed[unique] += (g * g).mean(1)
                embed[unique] -= rate * 0.3 * g / np.sqrt(seen_embed[unique])[:, None]
                embed[0] = 0
    return Model(embed.astype(np.float32), {w: f.astype(np.float32) for w, f in filters.items()}, bias, out, float(base))


def fit_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, most_rows: int) -> DataFrame:
    """key and _label of the rows for the fit: at most most_rows of labelled keys outside the held-out fifth and outside every tenth by a hash, half of each class
    in the order of a hash. A key that is labelled twice counts as toxic if any label says so; null keys and labels are left out."""
    known = learnable(labels, key, label).filter(F.pmod(F.xxhash64(F.lit(13), key), F.lit(10)) != 0)
    picked = None
    for y in (0, 1):
        side = known.filter(F.col("_label") == y).orderBy(F.xxhash64(F.lit(7), key), key).limit(most_rows // 2)
        picked = side if picked is None else picked.union(side)
    return picked


def learnable(labels: DataFrame, key: str, label: str) -> DataFrame:
    """key and _label of labelled rows outside the held-out fifth (crc32 of the key as text mod 5 is 0)."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_label"))
    return known.filter(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = 4000, least_rows: int = 8) -> Model:
    """Fit on a sample of labelled rows outside the held-out fifth, see fit_sample(); most_rows bounds it, whatever the size of the tables.

    Sampled texts are whole, however long; null and empty ones are texts of no words. Of documents that share a key, all are taken. Fewer than
    least_rows rows of a class tell nothing that holds for other texts: the model then says nearly 0 for every text. The texts meet in one task, which
    fits the model; the driver gets the model alone, of a fixed size.
    """
    spark = docs.sparkSession
    ship(spark)
    picked = keep(fit_sample(docs, labels, key, label, most_rows), "fit_keys")
    plain = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for b in batches:
            texts += b.column(0).cast(pa.binary()).to_pylist()
            y += b.column(1).to_pylist()
        if min(y.count(0), y.count(1)) >= least_rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, np.array(y, np.int64)))], pa.binary())], names=["model"])

    order = [F.xxhash64(F.lit(11), key), key, "_text"]
    rows = plain.join(F.broadcast(picked), key).repartition(1).sortWithinPartitions(*order).select("_text", "_label")
    found = rows.mapInArrow(tidy(run), "model binary").collect()
    model = pickle.loads(found[0]["model"]) if found else constant_model()
    model.fit_keys = picked
    return model


def calibrated(model: Model, scored: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", lang: str = "lang", score: str = "score", least: int = 20, bins: int = 1000) -> Model:
    """The model with a threshold for each language: of best F1 on all labelled rows outside the held-out fifth that the fit left out.

    scored has a row's key, language and score. Such rows are counted by language, score in `bins` steps and class; the cut of best F1, in the middle
    of the widest gap of scores, is found by windows over those counts, and one row per language reaches the driver. Languages with fewer than
    `least` such rows, or without both classes, keep 0.5, as does a null language. Tables without the column get no thresholds.
    """
    if lang not in scored.columns:
        return model
    rest = learnable(labels, key, label).join(F.broadcast(model.fit_keys.select(key)), key, "left_anti")
    rows = scored.select(key, F.col(lang).alias("_lang"), F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).alias("_bin")).filter("_lang is not null").join(rest, key)
    counts = rows.groupBy(F.col("_lang").alias("lang"), F.col("_bin").alias("bin")).agg(F.count("*").alias("n"), F.sum("_label").alias("toxic"))
    own = Window.partitionBy("lang")
    above = own.orderBy(F.col("bin").desc())
    seen = counts.select("lang", "bin", F.lead("bin").over(above).alias("below"), F.sum("toxic").over(above).alias("caught"), F.sum("n").over(above).alias("called"), F.sum("toxic").over(own).alias("all"), F.sum("n").over(own).alias("rows"))
    seen = seen.filter((F.col("rows") >= least) & (F.col("all") > 0) & (F.col("all") < F.col("rows")))
    f1 = 2 * F.col("caught") / (F.col("called") + F.col("all"))
    cut = (F.col("bin") + F.coalesce("below", F.col("bin") - 1) + 1) / (2.0 * bins)
    best = seen.groupBy("lang").agg(F.max_by(cut, F.struct(f1, F.col("bin") - F.coalesce("below", "bin"), "bin")).alias("cut"))
    return replace(model, thresholds={r["lang"]: float(r["cut"]) for r in best.collect()})


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a column of scores of the whole texts; one Arrow pass, no shuffle. Null and empty texts get the score of no words."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model.plain())  # of a fixed size
    at_text, names = docs.columns.index(text), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            for b in slices(batch, at_text):
                scores = scorer([t or b"" for t in b.column(at_text).cast(pa.binary()).to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=names)

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row's whole text; see with_scores()."""
    return with_scores(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), model, "_text").select(F.col("_key").alias(key), "score")


def reject(docs: DataFrame, model: Model, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """docs without the rows whose score reaches the threshold of their language (0.5 for languages without one).

    Given labels, all rows are scored once into a table in the shared folder, from which the thresholds are calibrated first. Null and empty texts get the score
    of no words; a null language has the threshold 0.5; repeated rows and null keys are judged like others, an empty table stays empty; all columns are kept.
    """
    name = unused(docs.columns, "_score")
    scored = with_scores(docs, model, text, name)
    if labels is not None:
        scored = keep(scored, "scored")
        model = calibrated(model, scored, labels, key=key, lang=lang, score=name)
    limit = F.lit(0.5)
    if model.thresholds and lang in docs.columns:
        known = F.create_map(*(F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair))
        limit = F.coalesce(F.try_element_at(known, F.col(lang)), limit)
    return scored.filter(F.col(name) < limit).select(docs.columns)
