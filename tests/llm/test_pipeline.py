import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontamination import brute as contaminated
from test_jaccard import brute as classes, shingles
from test_secrets import weak
from test_mixing import water_fill

from cardsentry.llm import op2_toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so") for b in ("ba", "de", "fi", "gu", "ho", "ja", "ke")]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    items = [(i, text(20)) for i in range(8)]
    docs, labels = [], []
    for i in range(300):
        t, toxic = text(rng.randrange(8, 80)), int(i % 5 == 0)
        if toxic:
            t += ". " + rng.choice(["zorkface", "zorkhead"]) + " " + text(3)
        elif i % 7 == 1 and docs:
            t = docs[rng.randrange(len(docs))][1] + " " + text(1)
        elif i % 11 == 3:
            t += " " + items[i % 8][1]
        elif i % 13 == 2:
            t += " password=" + "q" * 14
        docs.append((i, t, "en", ["a", "b", None, "c"][i % 4], len(t)))
        labels.append((i, 0, int("zork" in t)))
    docs += [(400, None, None, "a", None), (401, "", "x", "b", 0), (401, "", "x", "b", 0), (402, "w " * 5000, "x", "a", 1),
             (2, docs[2][1], "en", "a", 1)]
    return docs, labels, items


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs, labels, items = corpus
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_against_its_reference(spark, corpus, folder):
    docs, labels, items = corpus
    now = spark.read.parquet(f"{folder}/documents.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        out = stage(spark, now, folder)
        after = rows(out)
        if name != "mixing":
            assert out.columns == COLUMNS.replace(",", "").split()[::2]
        if name == "toxicity":
            toxic = {i for i, _, t in labels if t}
            assert {r[0] for r in after} == {r.doc_id for r in before} - toxic
        elif name == "near_duplicates":
            known = classes([(r.doc_id, r.text) for r in before])
            assert len(after) == len({c for _, n, c in known if n}) + sum(not n for _, n, _ in known)
            assert {r[0] for r in after if shingles(r[1])} == {c for _, n, c in known if n}
        elif name == "decontamination":
            bad = {x[0] for x in contaminated([(r.doc_id, r.text) for r in before], items) if x[-1]}
            assert bad and {r[0] for r in after} == {r.doc_id for r in before} - bad
        elif name == "secrets":
            assert len(after) == len(before)
            assert any(weak(r.text or "") for r in before) and not any(weak(r[1] or "") for r in after)
            assert all(r[4] == (None if r[1] is None else len(r[1])) for r in after)
        else:
            sizes = {}
            for r in before:
                sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
            order = sorted(sizes, key=lambda s: (s is None, s))
            goal = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
            got = {r.source: r.t for r in out.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
            assert all(abs(got[s] - goal[s]) <= 1 for s in got)
        path = f"{folder}/out-{name}"
        out.write.mode("overwrite").parquet(path)
        now = spark.read.parquet(path)
    assert rows(corpus_pipeline.run(spark, folder)) == rows(now)


def test_empty_documents(spark, corpus, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).collect() == []
    assert op2_toxicity.THRESHOLD == 0.5
