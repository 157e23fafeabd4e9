"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Lower-cased texts become counts of hashed character pairs and triples (``FEATURES`` cells), times
the inverse document frequency over all training documents, at unit length. The classifier is
trained with follow-the-regularised-leader and elastic-net penalties on a bounded sample of
training documents, as many per language, and its confidence is then calibrated by a temperature
fitted on a part of the sample that training has not seen.

What is bounded, and by which parameter: the feature space (``FEATURES``), so document frequencies
are one number per cell; and the labelled rows the classifier is fitted on (``sample_rows``). All
training documents count for document frequencies, and every document is predicted on its whole
text. Texts stay in their scan partitions; only cell counts and the sample move.

A null text, or one without a letter, is ``und`` with score 0. So is every text where there is
nothing to learn from. Null doc ids are never learnt from and not held out. Repeated rows and
further columns are fine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plantlake.llm.common import give_back, lean

FEATURES = 1 << 15
UNKNOWN = "und"
_SLICE = 1 << 20
#: Rows that a task predicts and passes on at once.
ROWS = 256


def cell_counts(text: str) -> np.ndarray:
    """How often each cell's pairs and triples occur in the text."""
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, max(len(text) - 1, 1), _SLICE):  # slices overlap by the two letters that a triple looks ahead
        c = np.frombuffer(text[at:at + _SLICE + 2].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        n = min(_SLICE, len(c))
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
        for h in (two[:n], three[:n]):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(h >> np.uint32(17), minlength=FEATURES)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights (features, classes) by follow-the-regularised-leader over ``(cells, values, class)``.
    The last feature is the constant."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(zs, ns):
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((beta + np.sqrt(ns)) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            cells, values, own = rows[r]
            values = values.astype(np.float64)
            w = weights(zs := z[cells], ns := n[cells])
            error = softmax(values @ w)
            error[own] -= 1
            g = values[:, None] * error
            more = ns + g * g
            z[cells] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[cells] = more
    return weights(z, n)


def temperature(logits: np.ndarray, own: np.ndarray) -> float:
    """Divisor of the logits with the least log loss, by golden-section search."""
    def loss(t):
        x = logits / np.exp(t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(own)), own]).mean())

    a, b, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def recognised(self, text: str | None, score: float, above_chance: float) -> bool:
        """Whether a text has letters and its score goes the share ``above_chance`` of the way from an even
        guess to certainty. With fewer than two languages letters are all there is to ask for."""
        if not has_letter(text):
            return False
        n = len(self.languages)
        return n < 2 or score >= (1 + above_chance * (n - 1)) / n

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        cells, values = scaled(cell_counts(text), self.idf)
        p = softmax(values @ self.weights[cells] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def scaled(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells in use and their TF-IDF values at unit length, with the constant at the end."""
    cells = np.flatnonzero(counts)
    values = counts[cells] * idf[cells]
    length = np.sqrt((values * values).sum())
    return np.append(cells, FEATURES), np.append(values / (length or 1.0), 1.0)


def fit(labelled: DataFrame, sample_rows: int = 3000, held: float = 0.2) -> Model:
    """Learn from the columns ``key`` (any; picks the sample), ``text`` and ``lang`` of all rows
    where both text and language are there."""
    rows = labelled.where("text is not null and lang is not null").select(F.xxhash64("key").alias("pick"), F.col("text").cast("string").alias("text"),
                                                                        F.col("lang").cast("string").alias("lang"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(FEATURES), np.zeros((FEATURES + 1, 0)), 1.0)

    def frequencies(batches):
        seen = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen += cell_counts(text.as_py()) > 0
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(seen[cells], pa.int64())], names=["cell", "docs"])

    found = rows.select("text").mapInArrow(lean(frequencies), "cell int, docs long").groupBy("cell").agg(F.sum("docs").alias("docs")).toArrow()  # one row per cell at most
    docs = np.zeros(FEATURES)
    docs[found.column("cell").to_numpy()] = found.column("docs").to_numpy()
    idf = np.log((1 + sum(sizes.values())) / (1 + docs)) + 1

    languages = sorted(sizes)
    quota = max(1, sample_rows // len(languages))
    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, 1.25 * quota / sizes[name])))])
    picked = rows.where((F.pmod("pick", F.lit(1 << 30)) / F.lit(float(1 << 30))) <= F.try_element_at(share, F.col("lang")))

    def sparse(batches):
        for batch in batches:
            for pick, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                cells, values = scaled(cell_counts(text), idf)
                yield pa.RecordBatch.from_arrays([pa.array([pick]), pa.array([lang]), pa.array([cells.astype("<i4").tobytes()]),
                                                  pa.array([values.astype("<f4").tobytes()])], names=["pick", "lang", "cells", "values"])

    sample = picked.mapInArrow(lean(sparse), "pick long, lang string, cells binary, values binary").orderBy("pick", "lang", "cells").limit(sample_rows).toArrow()
    data = [(np.frombuffer(c.as_buffer(), "<i4"), np.frombuffer(v.as_buffer(), "<f4"), languages.index(lang.as_py()))
            for c, v, lang in zip(*(sample.column(name) for name in ("cells", "values", "lang")))]  # views of the table
    cut = int(len(data) * held)
    weights = train(data[cut:], len(languages))
    heat = temperature(np.array([v.astype(np.float64) @ weights[c] for c, v, _ in data[:cut]]), np.array([y for _, _, y in data[:cut]])) if cut else 1.0
    del found, sample, data
    give_back()
    return Model(languages, idf, weights, heat)


def predict(docs: DataFrame, model: Model, text: str = "text", above_chance: float | None = None) -> DataFrame:
    """``docs`` with the columns ``lang_pred`` and ``score``, and ``recognised`` if ``above_chance`` is given.
    All other columns pass through."""
    place, asked = docs.columns.index(text), above_chance is not None
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           *([T.StructField("recognised", T.BooleanType())] if asked else [])])

    def run(batches):
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            texts = batch.column(place).to_pylist()
            found = [model.predict(x) for x in texts]
            more = [pa.array([model.recognised(x, s, above_chance) for x, (_, s) in zip(texts, found)], pa.bool_())] if asked else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f for f, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()), *more],
                                             names=[*batch.schema.names, "lang_pred", "score", *(["recognised"] if asked else [])])

    return docs.mapInArrow(lean(run), schema)


def remainder(doc_id: Column, by: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by))


def identified(docs: DataFrame, folds: int = 3, held_fold: int = 1, sample_rows: int = 3000, keep: tuple[str, ...] = (),
               above_chance: float | None = None) -> DataFrame:
    """Learn from the folds other than ``held_fold`` and predict every document:
    ``(doc_id, *keep, held_out, lang_pred, score[, recognised])``."""
    fold = remainder(docs["doc_id"], folds)
    model = fit(docs.where(fold != held_fold).select(docs["doc_id"].alias("key"), "text", "lang"), sample_rows)
    named = ["doc_id", *keep, F.coalesce(fold == held_fold, F.lit(False)).alias("held_out")]
    if "text" in keep and docs.schema["text"].dataType == T.StringType():
        return predict(docs.select(*named), model, "text", above_chance)  # the text goes to the task once
    return predict(docs.select(*named, docs["text"].cast("string").alias("__text")), model, "__text", above_chance).drop("__text")
