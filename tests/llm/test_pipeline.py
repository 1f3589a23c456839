import hashlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from muster.llm import language, near_dup, quality
from muster.llm.common import in_training, written
from muster.llm.queries import QUERIES
from test_line_dedup import plain as plain_lines
from test_near_dup import plain as plain_components
from test_packing import check_sequences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), "test"))
    return docs


def texts(frame):
    return {row["doc_id"]: row["text"] for row in frame.collect()}


def test_registered():
    names = contract.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)) and "pipeline" in names


def test_columns(stages):
    assert all(frame.columns == stages[0].columns for frame in stages[1:-1])


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(stages[0], labels.where(in_training("doc_id")))
    before, after = texts(stages[0]), texts(stages[1])
    want = {doc_id: text for doc_id, text in before.items() if model.score([text])[0][0] >= quality.THRESHOLD}
    assert after == want and 0 < len(after) < len(before)


def test_language_stage(spark, stages):
    labeller = language.Labeller(language.train(stages[1].where(in_training("doc_id"))))
    want = {}
    for doc_id, text in texts(stages[1]).items():
        [(lang, score, _)] = labeller.label([text])
        if lang != language.UNDETERMINED and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            want[doc_id] = text
    assert texts(stages[2]) == want and len(want) > 0.9 * stages[1].count()


def test_line_stage(stages):
    want = {doc_id: kept for doc_id, kept, _, _ in plain_lines(list(texts(stages[2]).items()), 10)}
    assert texts(stages[3]) == want
    assert all(row["n_chars"] == len(row["text"]) for row in stages[3].collect())


def test_near_copies_stage(stages):
    pairs = list(texts(stages[3]).items())
    assert set(texts(stages[4])) == {doc_id for doc_id, _, _, kept in plain_components(pairs, near_dup.SHINGLE_WORDS) if kept}


def test_packing_stage(stages):
    rows = stages[5].collect()
    check_sequences(rows, 4096)
    assert {row["doc_id"] for row in rows} == set(texts(stages[4]))


def test_run_is_the_stages(spark, stages):
    def digest(frame):
        rows = frame.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
        return hashlib.sha256(repr(sorted(tuple(row) for row in rows)).encode()).hexdigest()

    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages[5])


def test_stages_of_odd_documents(spark, documents):
    pairs = [(1, None), (2, ""), (None, "The same words of the house are here."), (3, "a " * 50_000), (3, "1 2 3"), (4, "x\n" * 5000)]
    for docs in (documents(pairs), documents(pairs).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()


def test_queries_have_ids(spark):
    assert set(QUERIES) <= set(contract.queries())
