"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates of all orders (here of a
token given the one before it, and alone) and a uniform one. Mixture weights depend on how often
the context occurs (buckets of its count by powers of two) and are learned by
expectation-maximisation on counts held out from training: one fold of the training documents is
deleted from all counts while weights are learned, then estimates use the whole training part.

Counts of n-grams come from ``exchange``: every shard of texts sends each distinct n-gram once
with its counts, and gets the corpus counts back, so the vocabulary is never broadcast and a
frequent word loads no bucket more than a rare one. What grows with the corpus stays in Spark; the driver
sees totals, and a table of (context bucket, probability of each order in eighths of an octave)
with the number of held-out tokens in each cell, whose size those ranges bound.

N-grams are identified by 64-bit hashes. A null text is empty and has just the end token. Rows
with a null doc id are scored, but never learned from nor held out. Repeated doc ids and further
columns are fine; with no training documents every token has probability 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantlake.llm.char_language import remainder
from plantlake.llm.common import crc_of_id, from_ipc, strings
from plantlake.llm.exchange import SENT_SQL, answered, buckets_for, combined, send, shards
from plantlake.llm.spans import mixed, span_hashes, words

U = np.uint64
END = U(0x5851F42D4C957F2D)
STEPS, ROUNDS = 8, 40


class _Tokens:
    """N-gram hashes of a shard's documents, each closed by the end token."""

    def __init__(self, payload: bytes, order: int, folds: int, held: int, tuning: int):
        batch = from_ipc(payload)
        self.doc_ids = batch.column("doc_id")
        crc = [crc_of_id(d) for d in self.doc_ids.to_pylist()]
        fold = np.array([-1 if c is None else c % folds for c in crc], np.int64)
        buf, starts, ends, first = words(strings(batch.column("text")), lower=True)
        self.sizes = np.diff(first) + 1
        self.doc = np.repeat(np.arange(len(crc)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        token = np.full(len(self.doc), END)
        token[np.arange(len(starts)) + np.repeat(np.arange(len(crc)), np.diff(first))] = span_hashes(buf, starts, ends)
        self.grams = [token]
        for k in range(2, order + 1):
            before = np.empty_like(token)
            before[1:] = self.grams[-1][:-1]
            before[self.first] = mixed(np.array([k], U))[0]  # nothing before the text
            self.grams.append(mixed(before * U(0x9E3779B97F4A7C15) + token))
        self.held_out = fold == held
        self.learned, self.tuned = ((fold >= 0) & ~self.held_out)[self.doc], (fold == tuning)[self.doc]


class _Counts:
    """Corpus counts for every token of a shard."""

    def __init__(self, tokens: _Tokens, found: dict[int, list[np.ndarray]], docs: int, deleted_docs: int, deleted: bool):
        self.count, self.context = [], []
        total_docs = docs - (deleted_docs if deleted else 0)
        for level, gram in enumerate(tokens.grams, 1):
            _, index = np.unique(gram, return_inverse=True)
            count = (found[level][0] - (found[level][1] if deleted else 0))[index]
            self.count.append(count)
            if level < len(tokens.grams):
                context = np.empty_like(count)
                context[1:] = count[:-1]
                context[tokens.first] = total_docs
                self.context.append(context)

    def probabilities(self, total: int, vocabulary: int) -> list[np.ndarray]:
        """Estimates by order, from the uniform one up."""
        out = [np.full(len(self.count[0]), 1.0 / (vocabulary + 1))]
        for count, context in zip(self.count, [np.full(len(self.count[0]), total), *self.context]):
            out.append(np.divide(count, context, out=np.zeros(len(count)), where=context > 0))
        return out

    def buckets(self) -> np.ndarray:
        context = self.context[-1] if self.context else self.count[0] * 0
        return np.floor(np.log2(context + 1.0)).astype(np.int64)


def weights_by_bucket(cells: list[tuple[int, list[float], int]], orders: int) -> np.ndarray:
    """Mixture weights (bucket, order from uniform up) by expectation-maximisation over
    ``(bucket, probabilities, tokens)``. Buckets without tokens get the weights learned over all."""
    def learned(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = np.full(orders + 1, 1.0 / (orders + 1))
        for _ in range(ROUNDS):
            share = w * p
            share /= share.sum(axis=1, keepdims=True)
            w = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), 1e-7)
            w /= w.sum()
        return w

    out = np.full((64, orders + 1), 1.0 / (orders + 1))
    if cells:
        bucket = np.array([b for b, _, _ in cells])
        p, n = np.array([x for _, x, _ in cells]), np.array([n for _, _, n in cells], np.float64)
        out[:] = learned(p, n)
        for b in np.unique(bucket):
            own = bucket == b
            out[b] = learned(p[own], n[own])
    return out


def scored(docs: DataFrame, order: int = 2, folds: int = 10, held: int = 0, tuning: int = 1) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.
    Documents whose crc32 by ``folds`` leaves ``held`` are not learned from; those that leave
    ``tuning`` teach the mixture weights first."""
    fold = remainder(docs["doc_id"], folds)
    part = docs.select(fold.alias("f")).agg(F.count(F.when(F.col("f") != held, 1)).alias("docs"), F.count(F.when(F.col("f") == tuning, 1)).alias("tuned")).first()
    texts = shards(docs.select("doc_id", "text"), ["doc_id"], lambda r: int(r["doc_id"] is not None and crc_of_id(r["doc_id"]) % folds == tuning), "lm-texts")
    buckets = buckets_for((texts.agg(F.sum("n")).first()[0] or 0) // 8)

    def ask(batches):
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = _Tokens(payload, order, folds, held, tuning)
                for level, gram in enumerate(tokens.grams, 1):
                    distinct, index = np.unique(gram, return_inverse=True)
                    counts = [np.bincount(index, w, len(distinct)).astype(np.int64) for w in (tokens.learned, tokens.tuned)]
                    yield send(level, number, distinct, counts, buckets)

    def total(level, index, distinct, values):
        sums = [np.bincount(index, v, len(distinct)).astype(np.int64) for v in values]
        return sums, [sums[0].sum(), sums[1].sum(), (sums[0] > 0).sum()]

    kinds = [np.int64, np.int64]
    counts = combined(texts.select("shard", "payload").mapInArrow(ask, SENT_SQL), kinds, total, "lm-counts")
    seen = counts.where("shard = -1 and level = 1").agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).cast("long") for i in range(3)]).first()
    n_all, n_tuned, vocabulary = seen

    cell = pa.schema([("bucket", pa.int32()), ("places", pa.list_(pa.int32())), ("n", pa.int64())])

    def cells(number, kind, payload, found):
        tokens = _Tokens(payload, order, folds, held, tuning)
        got = _Counts(tokens, found, part.docs, part.tuned, deleted=True)
        p = got.probabilities(n_all - n_tuned, vocabulary)[1:]
        with np.errstate(divide="ignore"):
            places = [np.where(x > 0, np.rint(-STEPS * np.log2(np.maximum(x, 1e-300))), -1).astype(np.int32) for x in p]
        rows = np.stack([got.buckets().astype(np.int32), *places], axis=1)
        distinct, n = np.unique(rows, axis=0, return_counts=True)
        return [pa.RecordBatch.from_arrays([pa.array(distinct[:, 0]), pa.array(distinct[:, 1:].tolist(), pa.list_(pa.int32())), pa.array(n)], schema=cell)]

    tuning_cells = answered(texts.where("kind = 1"), counts.where("pmod(shard, 4) = 1"), cells, kinds, "bucket int, places array<int>, n long", cell)
    table = tuning_cells.groupBy("bucket", "places").agg(F.sum("n").alias("n")).collect()
    weights = weights_by_bucket([(r.bucket, [1.0 / (vocabulary + 1), *(0.0 if q < 0 else 2.0 ** (-q / STEPS) for q in r.places)], r.n) for r in table], order)

    fields = [("doc_id", texts_id_type(docs)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
              ("base_score", pa.float64()), ("score", pa.float64())]
    result = pa.schema(fields)

    def score(number, kind, payload, found):
        tokens = _Tokens(payload, order, folds, held, tuning)
        got = _Counts(tokens, found, part.docs, part.tuned, deleted=False)
        mixture = weights[got.buckets()]
        p = sum(mixture[:, k] * x for k, x in enumerate(got.probabilities(n_all, vocabulary)))
        base = np.log10((got.count[0] + 0.1) / (n_all + 0.1 * (vocabulary + 1)))
        sums = [np.add.reduceat(x, tokens.first) for x in ((got.count[0] > 0).astype(np.int64), base, np.log10(p))]
        n = len(tokens.sizes)
        return [pa.RecordBatch.from_arrays([tokens.doc_ids.cast(fields[0][1]), pa.array(tokens.held_out), pa.array(tokens.sizes.astype(np.int64)), pa.array(sums[0]),
                                            pa.array(np.full(n, n_all, np.int64)), pa.array(sums[1]), pa.array(sums[2])], schema=result)]

    id_kind = dict(docs.dtypes)["doc_id"]
    return answered(texts, counts, score, kinds, f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", result)


def texts_id_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)
