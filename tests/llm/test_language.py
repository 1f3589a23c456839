from itertools import product

import numpy as np
from pyspark.sql import functions as F

from muster.llm import language
from muster.llm.common import in_training
from muster.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COUNTS = [
    *((word, "en", 50) for word in "the and of this house water bread street with from".split()),
    *((word, "de", 50) for word in "der die und haus wasser brot strasse mit von nicht".split()),
    *((word, "ru", 50) for word in "и дом вода хлеб улица не из".split()),
]


def plain_viterbi(scores, price):
    best = [(s, [i]) for i, s in enumerate(scores[0])]
    for row in scores[1:]:
        best = [
            max(((value - (price if path[-1] != i else 0) + s, [*path, i]) for value, path in best), key=lambda x: x[0])
            for i, s in enumerate(row)
        ]
    return max(best, key=lambda x: x[0])


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(3)
    scores = [draw.normal(0, 4, (n, 3)).astype(np.float32) for n in (1, 5, 2, 30, 0, 30, 7)]
    for row, path in zip(scores, language.viterbi(scores, 3.0)):
        assert len(path) == len(row)
        if len(row):
            value = sum(row[i, s] for i, s in enumerate(path)) - 3.0 * (np.diff(path) != 0).sum()
            assert abs(value - plain_viterbi(row, 3.0)[0]) < 1e-3


def test_many_languages():
    counts = [(f"{first}{second}", f"l{at:03}", 9) for at, (first, second) in enumerate(product("abcdefghijklmnopqrst", "qrstuvwxyz"))]
    found = labels([" ".join([word] * 6) for word, _, _ in counts], language.Model(counts))
    assert [lang for lang, _, _ in found] == [lang for _, lang, _ in counts] and len(counts) == 200


def labels(texts, model=None):
    return language.Labeller(model or language.Model(COUNTS)).label(texts)


def test_spans_of_mixed_text():
    text = "the house and the water of this street der brot und die strasse mit haus nicht"
    [(lang, score, spans)] = labels([text])
    assert [span[0] for span in spans] == ["en", "de"] and spans[0][1:] == (0, 7) and spans[1][1:] == (8, 15)
    assert lang == "de" and 0 < score < 0.7
    assert labels(["the house"])[0][:2] == ("en", labels(["the house"])[0][1])


def test_scripts_narrow_the_languages():
    model = language.Model(COUNTS)
    assert labels(["улицей"], model)[0][0] == "ru"
    scores = model.scores("hausen")
    assert scores[model.languages.index("ru")] == -2 * language.WORST


def test_odd_texts():
    found = labels([None, "", " \n", "123 !?", "x" * 100_000, "haus " * 30_000, "日本語"])
    assert [lang for lang, _, _ in found[:4]] == ["und"] * 4 and [score for _, score, _ in found[:4]] == [0.0] * 4
    assert found[5][0] == "de" and all(0 <= score <= 1 for _, score, _ in found)
    assert labels(["the"], language.Model([]))[0] == ("und", 0.0, [])


def test_words_with_combining_marks(spark):
    hindi, marathi, accented = "नमस्ते दुनिया यह है", "माझे घर आहे मोठे", "e\u0301te\u0301 de\u0301ja\u0300 vu"
    rows = [(1, hindi, "hi"), (2, marathi, "mr"), (3, accented, "fr")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.words) == {*hindi.split(), *marathi.split(), *accented.split()}
    found = labels([hindi, marathi, accented], model)
    assert [(lang, spans) for lang, _, spans in found] == [(lang, [(lang, 0, n)]) for lang, n in (("hi", 3), ("mr", 3), ("fr", 2))]


def test_texts_without_a_letter():
    assert [found[:2] for found in labels(["\u00bd \u00b2", "\u0301\u0301", "1\u0301 _", "\u0664"])] == [("und", 0.0)] * 4


def test_rows_and_columns(documents):
    frame = documents([(1, "the house"), (1, "the house"), (None, None), (2, "der und die")])
    model = language.Model(COUNTS)
    rows = frame.select("*", language.label_language(F.col("text"), model).alias("found")).collect()
    assert sorted(row["found"]["lang"] for row in rows) == ["de", "en", "en", "und"]
    assert documents([]).select(language.label_language(F.col("text"), model)).collect() == []


def test_training_without_documents(documents):
    frame = documents([(1, None), (None, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert language.train(frame).languages == []


def test_training_takes_a_bounded_number(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").where(in_training("doc_id"))
    small, all_ = language.train(documents, 100, 50), language.train(documents)
    assert len(small.words) <= 200 < len(all_.words)


def test_training_takes_some_of_every_language(spark):
    """The frequent language's share of the sample is less than one in two million."""
    many = spark.range(2_100_000).select(F.col("id").alias("doc_id"), F.lit("haus").alias("text"), F.lit("de").alias("lang"))
    few = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("house").alias("text"), F.lit("en").alias("lang"))
    assert language.train(many.union(few), 2).languages == ["de", "en"]


def test_words_are_kept_by_language(spark):
    rows = [(1, "able bake cake dart east", "en"), (2, "zug zwei", "de")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_words=2)
    assert sorted(model.words) == ["able", "bake", "zug", "zwei"]


def test_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(row["lang"] == row["lang_pred"] for row in rows) / len(rows) > 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)
