import pytest
from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.functions.text import register_token_count
from lakeline.operators import features as ft
from lakeline.operators import keyed
from lakeline.plans.features import STOP_WORDS
from lakeline.sources import files

LINES = ["Hello world", "Hello java", "Hello scala", "Hello hadoop", "Hello spark",
         "Hello Python I like Python"]


def split(spark, column, text):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(column(F.col("text"))).first()[0]


@pytest.mark.parametrize("line, words", [
    ("", [""]), ("   ", []), ("a b  ", ["a", "b"]), (" a", ["", "a"]), ("a  b", ["a", "", "b"]),
    ("a\tb c", ["a\tb", "c"]), (None, None),
])
def test_words(spark, line, words):
    assert split(spark, tx.words, line) == words


@pytest.mark.parametrize("text, lines", [
    ("", []), ("a", ["a"]), ("a\n", ["a"]), ("a\n\n", ["a", ""]), ("\n", [""]),
    ("a\r\nb\rc\nd", ["a", "b", "c", "d"]), ("a\r\n", ["a"]),
])
def test_lines(spark, text, lines):
    assert split(spark, tx.lines, text) == lines


def test_lines_as_the_file_reader_cuts_them(spark, tmp_path):
    text = "a b\r\n\r\nc\nd\n"
    (tmp_path / "t.txt").write_bytes(text.encode())
    read = [row.value for row in files.read_text_lines(spark, str(tmp_path)).collect()]
    assert read == split(spark, tx.lines, text)


def test_word_count_of_file(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("\n".join(LINES))
    counts = keyed.word_count(files.read_text_lines(spark, str(tmp_path)), "value").collect()
    assert [(r.word, r.n) for r in counts] == [
        ("world", 1), ("spark", 1), ("scala", 1), ("like", 1), ("java", 1), ("hadoop", 1),
        ("Python", 2), ("I", 1), ("Hello", 6),
    ]


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", ""],), ([],), (["x"],)], "t array<string>")
    rows = df.select(tx.term_counts(F.col("t")).alias("c")).collect()
    assert [tuple(e) for e in rows[0].c] == [("", 1), ("a", 1), ("b", 2)]
    assert rows[1].c is None
    assert [tuple(e) for e in rows[2].c] == [("x", 1)]


def test_tokenizers(spark):
    df = spark.createDataFrame(
        [(0, "Hi I heard about Spark"), (2, "Logistic,regression,models,are,neat"), (3, None)],
        "id int, sentence string",
    )
    tokens = [r.tokens for r in ft.tokenize(df, "sentence").orderBy("id").collect()]
    assert tokens == [["hi", "i", "heard", "about", "spark"],
                      ["logistic,regression,models,are,neat"], []]
    cut = [r.tokens for r in ft.regex_tokenize(df, "sentence").orderBy("id").collect()]
    assert cut[1] == ["logistic", "regression", "models", "are", "neat"] and cut[2] == []
    found = ft.regex_tokenize(df, "sentence", pattern=r"\w+", gaps=False).orderBy("id").collect()
    assert found[0].tokens == tokens[0]
    name = register_token_count(spark)
    counted = ft.tokenize(df, "sentence").orderBy("id").select(F.expr(f"{name}(tokens) AS n"))
    assert [r.n for r in counted.collect()] == [5, 1, 0]


def test_stop_words(spark):
    df = spark.createDataFrame(
        [(0, ["I", "saw", "the", "red", "balloon"]), (1, ["Mary", "had", "a", "little", "lamb"])],
        "id int, raw array<string>",
    )
    kept = [r.filtered for r in ft.remove_stop_words(df, "raw").orderBy("id").collect()]
    assert kept == [["saw", "red", "balloon"], ["Mary", "little", "lamb"]]
    assert ft.default_stop_words() == STOP_WORDS


def test_ngrams(spark):
    df = spark.createDataFrame([(["Hi", "I", "heard"],), (["one"],)], "words array<string>")
    assert [r.ngrams for r in ft.ngrams(df, "words").collect()] == [["Hi I", "I heard"], []]


def test_hashed_weights(spark):
    df = spark.createDataFrame(
        [(0, "I go OK OK"), (1, "you are spark"), (2, "First you go go start")],
        "id int, sentence string",
    )
    tf = ft.hashing_tf(ft.tokenize(df, "sentence"), "tokens")
    first = ft.fit_idf(tf, "tf").transform(tf).orderBy("id").first()["tf_idf"]
    assert sorted(round(v, 4) for v in first.values) == [0.2877, 0.6931, 1.3863]


def test_tf_idf_equals_library(spark):
    df = spark.createDataFrame(
        [(0, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["b"]), (3, [])], "id int, t array<string>"
    )
    ours = {(r.id, r.term): round(r.weight, 9) for r in ft.tf_idf(df, "id", "t").collect()}
    model = ft.count_vectorizer_of(spark, ["a", "b", "c"], "t", "tf")
    counts = model.transform(df)
    theirs = {}
    for row in ft.fit_idf(counts, "tf").transform(counts).collect():
        for slot, value in zip(row.tf_idf.indices, row.tf_idf.values):
            theirs[(row.id, model.vocabulary[slot])] = round(float(value), 9)
    assert ours == theirs


def test_count_vectors(spark):
    df = spark.createDataFrame(
        [(0, ["a", "b", "c"]), (1, ["a", "b", "b", "c", "a"])], "id int, words array<string>"
    )
    expected = {(0, "a", 1), (0, "b", 1), (0, "c", 1), (1, "a", 2), (1, "b", 2), (1, "c", 1)}
    fitted = ft.fit_count_vectorizer(df, "id", "words", vocab_size=3, min_df=2)
    assert fitted.vocabulary == ["a", "b", "c"]
    for model in (fitted, ft.count_vectorizer_of(spark, ["a", "b", "c"], "words")):
        rows = ft.count_rows(model.transform(df), "id", "counts", model.vocabulary)
        assert {tuple(r) for r in rows.collect()} == expected


def test_term_index_equals_the_library(spark):
    words = [f"w{(i * i) % 37}" for i in range(400)]
    df = spark.createDataFrame(
        [(i, words[i: i + i % 9]) for i in range(0, 400, 3)] + [(1000, []), (1001, None), (1002, ["unknown"])],
        "id int, words array<string>").repartition(5)
    index = ft.fit_count_vectorizer(df, "id", "words", vocab_size=None, min_df=2)
    terms = [r.term for r in index.terms.orderBy("pos").collect()]
    assert [r.pos for r in index.terms.orderBy("pos").collect()] == list(range(index.size)) and len(terms) == index.size
    small = ft.fit_count_vectorizer(df, "id", "words", vocab_size=1000, min_df=2)
    assert terms == small.vocabulary and "unknown" not in terms
    theirs = {r.id: r.counts for r in small.transform(df.where("words IS NOT NULL")).collect()}
    ours = {r.id: r.counts for r in index.transform(df).collect()}
    assert ours.pop(1001).numNonzeros() == 0
    assert ours == theirs and ours[1000].size == index.size


def test_term_index_of_no_rows(spark):
    df = spark.createDataFrame([], "id int, words array<string>")
    index = ft.fit_count_vectorizer(df, "id", "words", vocab_size=None)
    assert index.size == 0 and index.transform(df).count() == 0


def test_word2vec_averages_known_words(spark):
    df = spark.createDataFrame(
        [(["a", "b", "a"],), (["a", "zzz"],)], "text array<string>"
    )
    model = ft.word2vec(df.limit(1), "text", vector_size=3, partitions=1)
    known = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    got = model.transform(df).collect()[1].vector.toArray()
    assert abs(got - known["a"] / 2).max() < 1e-6
