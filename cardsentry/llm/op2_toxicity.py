"""Toxicity by multiple-instance learning over sentences.

A document is a bag of sentences; the document's score is the noisy-or of its
sentences.  A sentence's evidence is what its word features add to that of a
sentence without any (``evidence``), so a text does not become toxic by its
number of sentences.  Only document labels are known: the model maximizes
their likelihood under the same noisy-or that scores texts, so the sentence
scores come out of training and locate the offending sentences.

The model is fitted in one task on a bounded, seeded sample of labelled
documents (``MAX_TOXIC`` and ``MAX_CLEAN``); scoring covers every whole text.
Features are 64-bit fingerprints of a lower-cased word and of its beginnings;
labels, language, source and id are not features.

Defined cases: a null or empty text, or one without words, scores 0; without
toxic and clean labelled rows every score is 0; a label row without a value is
ignored and of repeated label rows the largest counts; of repeated documents
the one with the smallest text is the example; rows that repeat an id are
scored on their own; an empty table gives an empty result; other columns pass
through ``score`` unless they clash with an output column, which then replaces
them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StructType

from .common import byte_view, chunk_rows, free_names, lower, mix, powers, prefix_hash, starts_of, word_bounds
from .common import _BASE_INVERSE

#: Bounds of the labelled sample that the model is fitted on.
MAX_TOXIC, MAX_CLEAN = 2000, 4000
#: Bytes of a word's beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6)
#: Documents of the sample that must hold a feature; features kept by size of weight.
MIN_DOCS, MAX_FEATURES = 4, 50_000
#: Least likelihood-ratio statistic between a feature and the label.
MIN_ASSOCIATION = 16.0
EPOCHS, RATE, MOMENTUM, SHRINK = 150, 6.0, 0.8, 3e-5
#: Further steps if toxic documents of the sample stay under the threshold (Adam: a rare feature moves as far as a frequent one).
RARE_EPOCHS, RARE_RATE, MEAN, SQUARE = 300, 0.1, 0.9, 0.99
THRESHOLD = 0.5
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
BITS = 1 << 22


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def features(offsets: np.ndarray, data: np.ndarray):
    """Per word: its feature fingerprints (one row per kind), sentence number, and text number.

    Also the start and end byte of every sentence that has words.
    """
    small = lower(data)
    starts, ends, first = word_bounds(offsets, small, "alnum")
    prefix = prefix_hash(small)
    inverse = powers(len(data), _BASE_INVERSE)
    kinds = [mix((prefix[ends] - prefix[starts]) * inverse[starts])]
    for n, size in enumerate(BEGINNINGS):
        cut = np.minimum(starts + size, ends)
        kinds.append(mix((prefix[cut] - prefix[starts]) * inverse[starts] + np.uint64(n + 1)))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    border = np.concatenate(([0], np.cumsum(_ENDS[data], dtype=np.int64)))[starts] if len(starts) else starts
    at = starts_of(border + text * (len(data) + 1))
    sentence = np.zeros(len(starts), np.int64)
    sentence[at[1:]] = 1
    sentence = np.cumsum(sentence)
    last = np.append(at[1:], len(starts)) - 1
    return np.stack(kinds), sentence, text, at, (starts[at], ends[last] if len(at) else starts)


def _softplus(z):
    return np.logaddexp(0, z)


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def evidence(z, b):
    """Evidence -log(1 - p) of sentences with logit ``z``, beyond that of the bias alone."""
    return np.maximum(_softplus(z) - _softplus(b), 0)


def association(docs, toxic, n, n_toxic):
    """Likelihood-ratio statistic of features held by ``docs`` texts, ``toxic`` of them toxic."""
    total = np.zeros(len(docs))
    for cell, row, column in ((toxic, docs, n_toxic), (docs - toxic, docs, n - n_toxic),
                              (n_toxic - toxic, n - docs, n_toxic), (n - docs - n_toxic + toxic, n - docs, n - n_toxic)):
        expected = np.maximum(row * column / n, 1e-12)
        total += np.where(cell > 0, cell * np.log(np.maximum(cell, 1) / expected), 0)
    return 2 * total


def fit(offsets: np.ndarray, data: np.ndarray, toxic: np.ndarray):
    """Feature fingerprints (sorted), their weights and the bias."""
    keys, sent_of, doc_of, sent_doc, n_sent = [], [], [], [], 0
    for i, j in chunk_rows(offsets):
        k, s, t, at, _ = features(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]])
        keys.append(k.ravel())
        sent_of.append(np.tile(s + n_sent, len(k)).astype(np.int32))
        doc_of.append(np.tile(t + i, len(k)).astype(np.int32))
        sent_doc.append(t[at] + i)
        n_sent += len(at)
    none = np.zeros(0, np.uint64), np.zeros(0, np.float32), -40.0
    if not n_sent or toxic.all() or not toxic.any():
        return none
    keys, sent_of, doc_of = np.concatenate(keys), np.concatenate(sent_of), np.concatenate(doc_of)
    sent_doc = np.concatenate(sent_doc)
    order = np.lexsort((sent_of, keys))
    keys, sent_of, doc_of = keys[order], sent_of[order], doc_of[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (sent_of[1:] != sent_of[:-1])
    keys, sent_of, doc_of = keys[fresh], sent_of[fresh], doc_of[fresh]
    at = starts_of(keys)
    column = np.zeros(len(keys), np.int64)
    column[at[1:]] = 1
    column = np.cumsum(column)
    new_doc = np.ones(len(keys), np.int64)
    new_doc[1:] = (keys[1:] != keys[:-1]) | (doc_of[1:] != doc_of[:-1])
    label = toxic.astype(bool)
    in_docs = np.add.reduceat(new_doc, at)
    in_toxic = np.add.reduceat(new_doc * label[doc_of], at)
    held = (in_docs >= MIN_DOCS) & (association(in_docs, in_toxic, len(label), label.sum()) >= MIN_ASSOCIATION)
    vocabulary = keys[at][held]
    if not len(vocabulary):
        return none
    place = np.cumsum(held) - 1
    use = held[column]
    column, sent = place[column[use]], sent_of[use]
    by_sentence = np.argsort(sent, kind="stable")
    column, sent = column[by_sentence].astype(np.int32), sent[by_sentence]
    n, w, b = len(vocabulary), np.zeros(len(vocabulary)), -6.0
    speed, n_docs = np.zeros(n + 1), len(label)
    by_doc = label[sent_doc]
    size = np.bincount(sent_doc, minlength=n_docs)

    def gradient(w, b):
        """Of the weights and the bias, and each document's evidence."""
        z = b + np.bincount(sent, weights=w[column], minlength=n_sent)
        p, rest = _logistic(z), _logistic(b)
        # Without evidence the pull of a toxic document has no bound: take that of sentences at the bias.
        seen = np.bincount(sent_doc, weights=evidence(z, b), minlength=n_docs)
        total = np.maximum(seen, size * _softplus(b) + 1e-12)
        # A toxic document pulls each sentence up by its share of the noisy-or.
        g = np.where(by_doc, -1 / np.expm1(np.minimum(total, 700))[sent_doc], 1.0) * (z >= b)
        grad = np.append(np.bincount(column, weights=(g * p)[sent], minlength=n), (g * (p - rest)).sum() / 10) / n_docs
        grad[:-1] += SHRINK * w
        return grad, seen

    for _ in range(EPOCHS):
        # steps follow the gradient's size: what many documents share is learned first
        speed = MOMENTUM * speed - RATE * gradient(w, b)[0]
        w, b = w + speed[:-1], min(b + speed[-1], -4.0)
    missed = label & (gradient(w, b)[1] < -np.log1p(-THRESHOLD))
    # What few documents share has hardly moved.  Features that tell the missed documents from the
    # clean ones go on, by steps of the same size for every feature.
    held_by = np.sort(column.astype(np.int64) * n_docs + sent_doc[sent])
    held_by = held_by[starts_of(held_by)]
    in_missed = np.bincount(held_by // n_docs, weights=missed[held_by % n_docs], minlength=n)
    in_rest = in_missed + np.bincount(held_by // n_docs, weights=~label[held_by % n_docs], minlength=n)
    n_missed, n_rest = missed.sum(), missed.sum() + (~label).sum()
    rare = (in_missed * n_rest > in_rest * n_missed) & (in_missed >= MIN_DOCS)
    rare &= association(in_rest, in_missed, n_rest, n_missed) >= MIN_ASSOCIATION
    mean, square = np.zeros(n), np.zeros(n)
    for step in range(1, RARE_EPOCHS * rare.any() + 1):
        grad = np.where(rare, gradient(w, b)[0][:-1], 0)
        mean, square = MEAN * mean + (1 - MEAN) * grad, SQUARE * square + (1 - SQUARE) * grad ** 2
        w = w - RARE_RATE * (mean / (1 - MEAN ** step)) / (np.sqrt(square / (1 - SQUARE ** step)) + 1e-9)
    keep = np.argsort(-np.abs(w), kind="stable")[:MAX_FEATURES]
    keep = np.sort(keep[np.abs(w[keep]) > 1e-3])
    return vocabulary[keep], w[keep].astype(np.float32), float(b)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)``: the bounded labelled sample, chosen by a hash of the id."""
    labels = labels.select("doc_id", "toxic")
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    pick = lambda value, n: (known.filter(F.col("toxic") == value)
                             .orderBy(F.xxhash64("label_id"), "label_id").limit(n))
    chosen = pick(1, MAX_TOXIC).union(pick(0, MAX_CLEAN))  # at most MAX_TOXIC + MAX_CLEAN rows: broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return (rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
            .groupBy("label_id", "toxic").agg(F.min("text").alias("text")))


def train(docs: DataFrame, labels: DataFrame):
    """The model ``(fingerprints, weights, bias)``, at most MAX_FEATURES of them."""
    def run(batches):
        tables = [pa.RecordBatch.from_arrays([b.column("text"), b.column("toxic")], ["text", "toxic"]) for b in batches]
        if not tables:
            return
        whole = pa.Table.from_batches(tables)
        offsets, data = byte_view(whole.column("text"))
        keys, w, b = fit(offsets, data, whole.column("toxic").to_numpy().astype(bool))
        yield pa.RecordBatch.from_pydict({"keys": pa.array([keys.tobytes()], pa.binary()),
                                          "w": pa.array([w.tobytes()], pa.binary()),
                                          "b": pa.array([b], pa.float64())})

    rows = (sample(docs, labels).filter(F.col("text").isNotNull()).repartition(1).sortWithinPartitions("label_id")
            .select("text", "toxic").mapInArrow(run, "keys binary, w binary, b double").collect())
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), -40.0
    return np.frombuffer(rows[0]["keys"], np.uint64), np.frombuffer(rows[0]["w"], np.float32), rows[0]["b"]


class Scorer:
    """Scores texts with a model; a bit set skips most words without a weight."""

    def __init__(self, model):
        self.keys, self.weights, self.bias = model
        self.bits = np.zeros(BITS, bool)
        self.bits[(self.keys & np.uint64(BITS - 1)).astype(np.int64)] = True

    def __call__(self, offsets, data):
        """Per text its score; per sentence ``(text, start, end, score)``."""
        n = len(offsets) - 1
        kinds, sentence, text, at, (begin, end) = features(offsets, data)
        z = np.full(len(at), self.bias)
        if len(self.keys) and len(at):
            row, word = np.nonzero(self.bits[(kinds & np.uint64(BITS - 1)).astype(np.int64)])
            found = kinds[row, word]
            place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            real = self.keys[place] == found
            place, sent = place[real], sentence[word[real]]
            pair = np.sort(sent * len(self.keys) + place)
            pair = pair[starts_of(pair)]  # a feature counts once in a sentence
            z += np.bincount(pair // len(self.keys), weights=self.weights[pair % len(self.keys)], minlength=len(at))
        spread = np.bincount(text[at], weights=evidence(z, self.bias), minlength=n) if len(at) else np.zeros(n)
        return -np.expm1(-spread), (text[at] if len(at) else text, begin, end, _logistic(z))


def score(docs: DataFrame, model, locate: bool = False) -> DataFrame:
    """Every row with ``score`` and, on request, its ``offending`` sentences.

    ``offending`` lists ``(start, end, score)`` of the sentences that alone reach
    the threshold, in UTF-8 bytes of the text.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # at most MAX_FEATURES weights
    rows = docs.drop("score", "offending")
    names, (whole,) = rows.columns, free_names(docs.columns, "text")

    def run(batches):
        scorer = Scorer(held.value)
        for batch in batches:
            offsets, data = byte_view(batch.column(whole))
            for i, j in chunk_rows(offsets):
                base = offsets[i]
                s, (text, begin, end, p) = scorer(offsets[i:j + 1] - base, data[base:offsets[j]])
                columns = [batch.column(c).slice(i, j - i) for c in names] + [pa.array(s)]
                if locate:
                    bad = np.flatnonzero(p >= THRESHOLD)
                    local = offsets[i:j] - base
                    lists = np.searchsorted(text[bad], np.arange(j - i + 1))
                    columns.append(pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(begin[bad] - local[text[bad]]), pa.array(end[bad] - local[text[bad]]), pa.array(p[bad])],
                        ["start", "end", "score"])))
                yield pa.RecordBatch.from_arrays(columns, names + ["score"] + ["offending"] * locate)

    schema = StructType(rows.schema.fields).add("score", DoubleType())
    if locate:
        schema = schema.add("offending", DataType.fromDDL("array<struct<start:bigint,end:bigint,score:double>>"))
    return rows.withColumn(whole, F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows that are not held out, score every row."""
    return score(docs, train(docs, labels), locate=True)
