"""Learned operators by held-out accuracy, the pipeline stage by stage, and the registered queries against SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import differences, duck_rows, spark_rows
from tierweave.llm import language_id, toxicity
from tierweave.llm.common import table
from tierweave.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    import duckdb

    made = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return made


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert differences(spark_rows(QUERIES[name](spark, FOLDER)), duck_rows(connection, ORACLE[name])) is None


def test_languages_are_told_apart(spark):
    truth = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
    got = QUERIES["op4_rank_order_profiles"](spark, FOLDER).collect()
    out = [r for r in got if r.held_out]
    assert len(got) == len(truth) and np.mean([truth[r.doc_id] == r.lang_pred for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_cases(spark):
    rows = [(1, None), (2, ""), (3, "12 !? ..."), (4, "das ist ein haus"), (4, "das ist ein haus")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("score", F.lit(1))
    labelled = spark.createDataFrame([("das haus ist ein haus", "de"), ("the house is a house", "en"), (None, "xx"), ("abc", None)], "text STRING, lang STRING")
    known = language_id.profiles(labelled)
    assert sorted(known) == ["de", "en"]
    got = sorted((r.doc_id, r.lang_pred) for r in language_id.identify(docs, known).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de")]
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), known).count() == 0


def test_rank_order_by_hand():
    letters = language_id._letters()
    grams = language_id.ngrams("ab A", letters)
    code = lambda s: sum((1 if c == "_" else ord(c)) * (1 << 21) ** k for k, c in enumerate(reversed(s)))
    assert sorted(grams.tolist()) == sorted(map(code, ["a", "b", "a", "_a", "ab", "b_", "_a", "a_", "_ab", "ab_", "_a_"]))
    assert language_id.ranked(grams, 2).tolist() == sorted([code("a"), code("_a")])


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(2)
    n, words = 600, 6
    x = rng.integers(0, 3, (n, words)).astype(float)
    score = x @ np.array([2.0, 1.0, 0, 0, 0, 0]) + rng.logistic(size=n) * 0.3
    grades = np.digitize(score, [1.5, 3.5])
    row, at = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(grades, row, at, x[row, at], words, np.bincount(grades, minlength=3) / n)
    assert thresholds[0] < thresholds[1] and weights[0] > weights[1] > abs(weights[2:]).max()
    predicted = np.digitize(x @ weights, thresholds)
    assert np.mean(predicted == grades) > 0.85


def test_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels").where("toxic IS NOT NULL")
    learned, held = labels.where("doc_id % 3 != 0"), labels.where("doc_id % 3 = 0")
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, toxicity.severity_labels(learned))
    scored = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in held.collect()}
    assert np.mean([scored[i].toxic == bool(t) for i, t in truth.items()]) > 0.9
    assert all(0 <= r.expected_severity <= 2 for r in scored.values())
    empty = docs.limit(0)
    assert toxicity.score_toxicity(empty, model).count() == 0
    none = toxicity.train(docs, toxicity.severity_labels(labels.limit(0)))
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id BIGINT, text STRING").withColumn("grade", F.lit("x"))
    assert {r.toxic for r in toxicity.score_toxicity(odd, none).collect()} == {False}


def test_pipeline_stages(spark):
    shared = " ".join(f"the word{i} and that" for i in range(40))
    secret = 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"'
    rows = [
        (1, f"{shared} alpha", "en", "a", 0), (2, f"{shared}  alpha", "en", "b", 0), (2, f"{shared}  alpha", "en", "b", 0),
        (3, None, "en", "a", 0), (4, "", None, None, 0), (5, "1234 !!", "en", "a", 0),
        (6, f"das ist ein Haus und {secret} steht hier", "de", "c", 0), (None, "the lost one", "en", "a", 0),
        (7, "this is the clean text of a page and it stays", "en", "a", 44),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").withColumn("kept", F.lit(1))
    left = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == docs.columns
            docs = out.cache()
        left.append(sorted(r.doc_id for r in out.select("doc_id").collect()))
    assert left[0] == [1, 2, 2, 6, 7] and left[1] == left[2] == left[3] == left[4] == [1, 6, 7]
    texts = {r.doc_id: r for r in docs.collect()}
    assert "[secret]" in texts[6].text and "9233a8" not in texts[6].text and texts[6].n_chars == len(texts[6].text)
    assert texts[7].text == rows[-1][1] and texts[7].n_chars == 44


def test_pipeline_on_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def test_entry_without_the_package(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(corpus_pipeline.__file__).parent
    shutil.copytree(top / "tierweave", tmp_path / "tierweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries())[:1], any(re for re in e.queries() if re.startswith('op1_')))"], cwd=tmp_path, capture_output=True, text=True)
    assert "False" in said.stdout, said.stderr
