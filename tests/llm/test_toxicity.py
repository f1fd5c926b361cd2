import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cardsentry.llm import op2_toxicity as op2
from cardsentry.llm.common import byte_view


def corpus(n=400):
    rng = random.Random(11)
    vocab = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "r", "st", "lk")]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(1, 8))]
        toxic = int(i % 4 == 0)
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["Zorkface", "zorkhead", "grubber"])
        docs.append((i, ". ".join(sentences) + ".", i))
        labels.append((i, 0, toxic))
    return docs, labels


def test_held_out_documents_and_sentences(spark):
    docs, labels = corpus()
    extra = [(9000, None, 1), (9001, "", 1), (9002, "...", 1), (None, "you grubber", 1), (9003, "ban " * 60000 + ". zorkhead", 1),
             (3, "a second text", 1)]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string, score long")
    lab = spark.createDataFrame(labels + [(1, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = op2.classify(d, lab).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: t for i, _, t in labels}
    by = {(r.doc_id, r.text): r for r in got}
    for i, text, _ in docs:
        if zlib.crc32(str(i).encode()) % 5 == 0:
            r = by[i, text]
            assert (r.score >= 0.5) == bool(truth[i])
            for s in r.offending:
                assert any(w in text.encode()[s.start:s.end].lower() for w in (b"zork", b"grubber"))
            assert bool(r.offending) == bool(truth[i])
    assert by[9000, None].score == by[9001, ""].score == by[9002, "..."].score == 0
    assert by[9003, extra[4][1]].score > 0.5 and by[None, "you grubber"].score > 0.5
    assert all(0 <= r.score <= 1 for r in got)


def test_no_labels_or_rows(spark):
    docs, labels = corpus(8)
    d = spark.createDataFrame(docs, "doc_id long, text string, x long")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.score < 1e-6 for r in op2.classify(d, none).collect())
    clean = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("toxic", F.lit(0))
    assert all(r.score < 1e-6 for r in op2.classify(d, clean).collect())
    assert op2.classify(d.limit(0), clean).collect() == []


def test_clean_text_of_many_sentences(spark):
    docs, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = op2.train(spark.createDataFrame(docs, "doc_id long, text string, x long"), lab)
    clean = ". ".join(f"ban dest gilk {i % 7}" for i in range(20000))
    rows = [(0, clean), (1, "new words\n" * 20000), (2, clean + ". you grubber"), (3, "zorkhead! " + clean)]
    got = {r.doc_id: r.score for r in op2.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[0] < 0.01 and got[1] < 0.01 and got[2] >= 0.5 and got[3] >= 0.5


def plain_sentences(text):
    """Per sentence with words: its set of features (kind, word or beginning)."""
    for part in re.split(r"[.!?\n]", text):
        found = {(0, w) for w in re.findall("[a-z0-9]+", part.lower())}
        if found:
            yield found | {(size, w[:size]) for _, w in found for size in op2.BEGINNINGS}


def plain_fit(texts, labels):
    """The model in plain Python: ``{feature: weight}`` and the bias."""
    docs = [list(plain_sentences(t)) for t in texts]
    n, n_toxic, held = len(docs), sum(labels), {}
    for sentences, y in zip(docs, labels):
        for f in set().union(*sentences):
            a, b = held.get(f, (0, 0))
            held[f] = a + 1, b + y
    w = {}
    for f, (a, b) in held.items():
        cells = ((b, a, n_toxic), (a - b, a, n - n_toxic), (n_toxic - b, n - a, n_toxic), (n - a - n_toxic + b, n - a, n - n_toxic))
        ratio = 2 * sum(c * math.log(c * n / (row * col)) for c, row, col in cells if c)
        if a >= op2.MIN_DOCS and ratio >= op2.MIN_ASSOCIATION:
            w[f] = 0.0
    docs = [[[f for f in s if f in w] for s in d] for d in docs]
    speed, bias, bias_speed = dict.fromkeys(w, 0.0), -6.0, 0.0
    soft, logistic = lambda z: math.log1p(math.exp(z)), lambda z: 1 / (1 + math.exp(-z))
    for _ in range(op2.EPOCHS):
        grad, bias_grad = dict.fromkeys(w, 0.0), 0.0
        for sentences, y in zip(docs, labels):
            logits = [bias + sum(w[f] for f in s) for s in sentences]
            total = max(sum(max(soft(z) - soft(bias), 0) for z in logits), len(logits) * soft(bias) + 1e-12)
            pull = -1 / math.expm1(total) if y else 1.0
            for z, s in zip(logits, sentences):
                if z >= bias:
                    bias_grad += pull * (logistic(z) - logistic(bias)) / 10 / n
                    for f in s:
                        grad[f] += pull * logistic(z) / n
        for f in w:
            speed[f] = op2.MOMENTUM * speed[f] - op2.RATE * (grad[f] + op2.SHRINK * w[f])
        bias_speed = op2.MOMENTUM * bias_speed - op2.RATE * bias_grad
        w, bias = {f: w[f] + speed[f] for f in w}, min(bias + bias_speed, -4.0)
    return w, bias


def test_equals_plain_python(spark):
    docs, labels = corpus(300)
    truth = {i: t for i, _, t in labels}
    learn = [(t, truth[i]) for i, t, _ in docs if zlib.crc32(str(i).encode()) % 5]
    w, bias = plain_fit(*zip(*learn))
    got = op2.classify(spark.createDataFrame(docs, "doc_id long, text string, x long"),
                       spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(w) > 3
    texts = {i: t for i, t, _ in docs}
    for r in got:
        logits = [bias + sum(w.get(f, 0) for f in s) for s in plain_sentences(texts[r.doc_id])]
        total = sum(max(math.log1p(math.exp(z)) - math.log1p(math.exp(bias)), 0) for z in logits)
        assert abs(r.score + math.expm1(-total)) < 1e-3
        assert len(r.offending) == sum(z >= 0 for z in logits)


def test_rare_words_beside_a_frequent_one():
    rng = random.Random(3)
    vocab = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "r", "st", "lk")]
    rare = [f"{a}{b}{c}x" for a in "zkv" for b in "aeiou" for c in ("rt", "mm", "pf", "tt")]

    def text(word):
        sentences = [" ".join(rng.choice(vocab) for _ in range(8)) for _ in range(60)]
        sentences[rng.randrange(60)] += f" {word}" if word else ""
        return ". ".join(sentences)

    def rows(n):
        words = [("grubber" if i % 6 == 0 else rng.choice(rare)) if i % 3 == 0 else "" for i in range(n)]
        return byte_view(pa.chunked_array([pa.array([text(w) for w in words])])), np.array([bool(w) for w in words])

    (offsets, data), toxic = rows(4800)
    scorer = op2.Scorer(op2.fit(offsets, data, toxic))
    (offsets, data), toxic = rows(600)
    found = scorer(offsets, data)[0] >= op2.THRESHOLD
    assert found[toxic].mean() > 0.9 and not found[~toxic].any()
