"""Every operator on tables whose other columns bear the operators' own helper names, and on rows without an id."""

import random

import pytest
from pyspark.sql import functions as F

from cardsentry.llm import (op1_ctw, op2_toxicity, op3_mixing, op4_suffixes, op5_jaccard, op6_secrets, op7_recompression,
                            op8_topk, op9_decontamination, op10_warc, op11_whitening, op12_minhash, op13_clustering)

NAMES = """p s part_start _key _part _begin __key __part __tie __ahead __source __p __start __id __print __text __own __spans
label_id toxic id print key node n g root least first copies comp sig bits x w w0 m cell range slot rank payload digest bytes
is_page parts linked block held ids kind apex component_id n_shingles doc item vec words piece counts name side band tile""".split()


def clashing(df):
    return df.select(*df.columns, *[F.lit("z").alias(c) for c in NAMES if c not in df.columns])


def documents(spark, ids=True):
    rng = random.Random(2)
    words = "alpha beta gamma delta vile epsilon zeta eta theta iota kappa".split()
    rows = []
    for i in range(40):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(30))) + (" password = abcdef123456789 http://a.b/c" if i % 9 == 0 else "")
        rows.append((i if ids else None, None if i == 13 else text if i % 4 else rows[i - 1][1] if i else "x", "en", "ab"[i % 2], i))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta vile"), (3, None)], "item_id long, text string")


def vectors(spark):
    rng = random.Random(1)
    return spark.createDataFrame([(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(60)], "vec_id long, embedding array<float>")


def pages(spark):
    return spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 7}</p>") for i in range(30)], "page_id long, url string, html string")


ON_DOCUMENTS = {
    "op1": lambda d: op1_ctw.score(d),
    "op2": lambda d: op2_toxicity.classify(d, clashing(labels(d.sparkSession))),
    "op3": lambda d: op3_mixing.mix(d),
    "op4": lambda d: op4_suffixes.dedup(d),
    "op5": lambda d: op5_jaccard.classes(d),
    "op5_kept": lambda d: op5_jaccard.one_of_each(d),
    "op6": lambda d: op6_secrets.report(d),
    "op6_redact": lambda d: op6_secrets.redact(d),
    "op7": lambda d: op7_recompression.dedup(d),
    "op9": lambda d: op9_decontamination.report(d, clashing(benchmark(d.sparkSession))),
    "op9_clean": lambda d: op9_decontamination.clean(d, clashing(benchmark(d.sparkSession))),
    "op12": lambda d: op12_minhash.classes(d),
}
ON_OTHERS = {
    "op8": (vectors, lambda v: op8_topk.top_k(v, v.filter("vec_id % 20 = 0"))),
    "op10": (pages, lambda p: op10_warc.round_trip(p)),
    "op11": (vectors, lambda v: op11_whitening.whiten(v).drop("whitened")),
    "op13": (vectors, lambda v: op13_clustering.cluster(v)),
}


def rows_of(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("name", [*ON_DOCUMENTS, *ON_OTHERS])
def test_helper_names_as_other_columns(spark, name):
    make, run = (documents, ON_DOCUMENTS[name]) if name in ON_DOCUMENTS else ON_OTHERS[name]
    plain = run(make(spark))
    other = run(clashing(make(spark)))
    columns = [f"`{c}`" for c in plain.columns]
    assert rows_of(other, columns) == rows_of(plain, columns)
    passed = [c for c in NAMES if c in other.columns and c not in plain.columns]
    assert all(set(r) == {"z"} for r in other.select(*passed).collect()) if passed else True


@pytest.mark.parametrize("name", ["op3", "op5", "op5_kept", "op6", "op6_redact", "op12"])
def test_rows_without_an_id(spark, name):
    df = documents(spark, ids=False)
    n = ON_DOCUMENTS[name](df).count()
    assert n <= 40 if name == "op5_kept" else n == 40


def test_near_copies_without_an_id_are_one_class(spark):
    rng, base = random.Random(4), [f"b{i}" for i in range(300)]
    rows = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(300)] = f"u{i}"
        rows.append((None, " ".join(w)))
    df = spark.createDataFrame(rows + [(5, "other words of a row that has an id")], "doc_id long, text string")
    assert op5_jaccard.one_of_each(df).count() == 2
    assert {r.component_id for r in op5_jaccard.classes(df).collect()} == {None, 5}


def test_time_of_the_secret_scan_follows_the_findings(spark):
    import time

    def seconds(n):
        text = " ".join(f"{i:016x} AKIA{i:08d}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        t = time.time()
        row = op6_secrets.report(df).first()
        assert row.n_hex == n and len(op6_secrets.redact(df).first().text) == len(text) - n * (16 + 12) + 2 * n * 8
        return time.time() - t

    seconds(10)
    small, large = seconds(5_000), seconds(20_000)
    assert large < 4 * 1.5 * small + 5


def test_archives_do_not_depend_on_partitions_or_runs(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(op10_warc, "SMALL_BYTES", 40_000)
    rng = random.Random(8)
    rows = [(rng.randrange(1 << 40) if i % 10 else None, f"http://h/{i}", f"<p>{rng.randrange(900)}</p>" * rng.randrange(40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for k, parts in enumerate((2, 7)):
        folder = tmp_path / str(k)
        (folder).mkdir()
        (folder / "_temporary-9-9-9").write_bytes(b"left by a lost attempt")
        (folder / "pages-000099-00000.warc.gz").write_bytes(b"unlisted")
        manifest = op10_warc.write(df.repartition(parts), f"file://{folder}", roll_bytes=20_000)
        files = {f.name: hashlib.sha1(f.read_bytes()).hexdigest() for f in folder.iterdir() if f.is_file()}
        listed = sorted(map(tuple, manifest.collect()))
        assert sorted(files) == [f for f, *_ in listed] and [files[f] for f, *_ in listed] == [r[3] for r in listed]
        found.append(listed)
    assert found[0] == found[1] and len({f.split("-")[1] for f, *_ in found[0]}) > 8
    assert sum(r[1] for r in found[0]) == 3000
