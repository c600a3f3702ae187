"""The corpus pipeline's stages on planted cases, and the registered queries of
the subpackage that SQL can express."""

import random
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from opslake.llm import catalog
from tests.conftest import SF_SMALL

WORDS = [f"w{i}x" for i in range(400)]


def test_stages_on_planted_documents(spark, tmpdir_fresh):
    rng = random.Random(11)
    rows, clean = [], []

    def add(text, source="s1", lang="en"):
        rows.append((len(rows), text, lang, source, len(text) if text is not None else None))
        return len(rows) - 1

    for i in range(60):
        clean.append(add(" ".join(rng.choices(WORDS, k=rng.randint(1, 150))), source=f"s{i % 3}"))
    base = rng.choices(WORDS, k=200)
    near = [add(" ".join(base)), add(" ".join([*base[:100], "other", *base[101:]])), add(" ".join([*base, "tail"]))]
    exact = [add("some text here"), add("some  text\nhere "), add("sometext here")]
    gone = [add(None), add(""), add("1234 !!")]
    path = f"{tmpdir_fresh}/documents.parquet"
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(path)
    docs, ids = spark.read.parquet(path), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmpdir_fresh)
        out.write.parquet(f"{tmpdir_fresh}/{name}")
        docs = spark.read.parquet(f"{tmpdir_fresh}/{name}")
        ids[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name != "best_fit_packing":
            assert docs.columns == df.columns
    everything = {r[0] for r in rows}
    assert set(ids["language_id"]) == everything - set(gone)
    assert set(ids["exact_dedup"]) == everything - set(gone) - {exact[0], exact[2]}
    left = set(ids["exact_dedup"]) - set(near[1:])
    assert set(ids["ngram_jaccard_join"]) == left and set(clean) <= left
    assert set(ids["temperature_mixing"]) == left and set(ids["best_fit_packing"]) == left
    # the packed pieces hold each draw of the mix once
    draws = ids["temperature_mixing"]
    firsts = Counter(r.doc_id for r in docs.where("piece = 0").collect())
    assert firsts == draws
    again = corpus_pipeline.run(spark, tmpdir_fresh)
    assert again.select("doc_id", "piece", "start", "length", "ids_crc32").exceptAll(
        docs.select("doc_id", "piece", "start", "length", "ids_crc32")).count() == 0


def _run(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, folder)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_of_an_empty_table(spark, tmpdir_fresh):
    out = _run(spark, tmpdir_fresh, [], DOCUMENTS)
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


def test_pipeline_of_a_mass_of_repeated_rows(spark, tmpdir_fresh):
    rng = random.Random(2)
    text = " ".join(rng.choices(WORDS, k=40))
    rows = [(7, text, "en", "hot", 1)] * 1500 + [(8, text + "  ", "en", "hot", 1)] * 500
    rows += [(100 + i, " ".join(rng.choices(WORDS, k=30)), "en", f"s{i % 2}", 1) for i in range(30)]
    rows += [(None, " ".join(rng.choices(WORDS, k=25)), "en", None, None)] * 3 + [(9, None, None, None, None)] * 20
    out = _run(spark, tmpdir_fresh, rows, DOCUMENTS).collect()
    ids = Counter(r.doc_id for r in out if r.piece == 0)
    # the longer copy stays, once for each pass of its source
    assert set(ids) == {8, None, *range(100, 130)} and max(ids.values()) <= 2


def test_pipeline_with_columns_of_clashing_names(spark, tmpdir_fresh):
    rng = random.Random(3)
    names = ["_lang", "_lang_score", "_lang_lettered", "_sha", "_chars", "_nth", "_key", "_source", "_copy", "_tokens", "_pass", "_block",
             "_place", "_part", "_row", "component_id", "class_id", "h", "n", "bits", "score", "length", "piece", "link", "bucket"]
    rows = [(i, " ".join(rng.choices(WORDS, k=30)), "en", "s", 1, *range(len(names))) for i in range(20)]
    schema = DOCUMENTS + ", " + ", ".join(f"{n} long" for n in names)
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmpdir_fresh}/documents.parquet")
    docs = spark.read.parquet(f"{tmpdir_fresh}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmpdir_fresh)
        out.write.parquet(f"{tmpdir_fresh}/{name}")
        docs = spark.read.parquet(f"{tmpdir_fresh}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert {tuple(r)[5:] for r in docs.collect()} == {tuple(range(len(names)))}
    assert {r.doc_id for r in docs.collect()} == set(range(20))


def test_language_stage_keeps_documents_of_an_unlabelled_table(spark, tmpdir_fresh):
    texts = ["some words", "einige Worte", "漢字", None, "", "1234 !!"]
    rows = [(i, t, None, "s", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert sorted(r.doc_id for r in stage(spark, docs, tmpdir_fresh).collect()) == [0, 1, 2]


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    want = con.sql(catalog.ORACLE[name])
    columns = want.columns
    got = catalog.QUERIES[name](spark, SF_SMALL).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_other_queries_cover_their_table(spark, name):
    got = catalog.QUERIES[name](spark, SF_SMALL)
    key, source = next((k, t) for k, t in (("page_id", "pages"), ("vec_id", "embeddings"), ("doc_id", "documents")) if k in got.columns)
    ids = {r[0] for r in got.select(key).collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{SF_SMALL}/{source}.parquet").select(key).collect()}


def test_native_operators_run_no_python(spark):
    for name in ("op3_secret_scan", "op6_url_filter", "op7_exact_dedup"):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
