"""Each stage against a plain version on its own input, and the whole run."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from test_decontaminate import plain as plain_benchmark
from test_exact_dedup import plain as plain_copies
from test_jaccard import edited
from test_jaccard import plain as plain_near


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    rng, rows = random.Random(8), []
    items = [(i, prose(20)) for i in range(5)]
    for i in range(160):
        text = prose(rng.randrange(15, 60))
        if i % 4 == 0:
            text = f"{text} idiot {prose(3)} moron"
        if i % 9 == 1:
            text = f"{text} {rng.choice(items)[1]}"
        rows.append((len(rows), text))
        if i % 5 == 2:
            rows += [(len(rows), text + " "), (len(rows) + 1, edited(rng, text, 1))]
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "  ")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int("idiot" in (t or ""))) for i, t in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_alone(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clean = ids(P.toxic(spark, docs, path))
    toxic = {i for i, t in rows if "idiot" in (t or "")}
    assert len(toxic - set(clean)) >= 0.9 * len(toxic) and len(set(clean) - toxic) >= 0.95 * (len(rows) - len(toxic))
    assert ids(P.copies(spark, docs, path)) == [r[0] for r in plain_copies(rows) if r[3]]
    assert ids(P.near_copies(spark, docs, path)) == sorted(i for i, _, c in plain_near(rows) if i == c)
    assert ids(P.benchmark_free(spark, docs, path)) == [i for i, n, hit, _ in plain_benchmark(rows, items) if not (hit and 20 * hit >= n)]
    for stage in (P.toxic, P.copies, P.near_copies, P.benchmark_free):
        assert stage(spark, docs, path).columns == P.COLUMNS


def kept(spark, stage, folder, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r.doc_id, r.text) for r in stage(spark, docs, folder).collect()), key=str)


def test_rows_that_repeat_or_lack_an_id(spark, folder, prose):
    """Rows are kept and dropped for their own text, whatever id they carry."""
    path, _, items = folder
    x, y, z = prose(40), prose(40), prose(40)
    assert kept(spark, P.copies, path, [(0, x), (1, x), (1, y)]) == sorted([(0, x), (1, y)], key=str)
    assert kept(spark, P.copies, path, [(1, x), (1, x), (None, x), (None, y), (None, y), (2, y.replace(" ", "  "))]) == sorted([(1, x), (2, y.replace(" ", "  "))], key=str)
    assert kept(spark, P.copies, path, [(None, z), (None, z), (3, x)]) == sorted([(None, z), (3, x)], key=str)
    near = f"{x} end"
    assert kept(spark, P.near_copies, path, [(0, x), (1, near), (1, y)]) == sorted([(0, x), (1, y)], key=str)
    assert len(kept(spark, P.near_copies, path, [(1, x), (1, near), (1, x), (2, y), (None, y + " end")])) == 2
    assert kept(spark, P.near_copies, path, [(-5, near), (4, x), (None, z), (None, None), (7, None)]) == sorted([(-5, near), (None, z), (None, None), (7, None)], key=str)
    dirty = f"{prose(3)} {items[0][1]}"
    assert kept(spark, P.benchmark_free, path, [(1, dirty), (1, y), (None, dirty), (None, z), (2, None), (2, None)]) == sorted([(1, y), (None, z), (2, None), (2, None)], key=str)
    toxic = " ".join(["idiot moron"] * 20)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    odd = spark.createDataFrame([(5000, toxic, "en", "s", 1), (5000, y, "en", "s", 1), (None, toxic, "en", "s", 1), (None, None, "en", "s", 0)], docs.schema)
    left = {(r.doc_id, r.text) for r in P.toxic(spark, docs.union(odd), path).collect()}
    assert (5000, y) in left and (None, None) in left and (5000, toxic) not in left and (None, toxic) not in left


def test_whole_run_packs_what_the_stages_keep(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path)
    kept = ids(docs)
    pieces = P.run(spark, path)
    assert sorted({r["doc_id"] for r in pieces.collect()}) == kept and 0 < len(kept) < len(rows)
    done = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r["n"] == r["all"] for r in done)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
