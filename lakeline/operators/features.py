"""Text and vector features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    IDF,
    PCA,
    Binarizer,
    ChiSqSelector,
    CountVectorizerModel,
    HashingTF,
    IDFModel,
    IndexToString,
    NGram,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorIndexer,
    VectorIndexerModel,
    VectorSlicer,
    Word2Vec,
)
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.functions import vectors as vx
from lakeline.operators.joins import lookup_join
from lakeline.operators.skip_grams import fit_word_vectors
from lakeline.session import stored

MAX_VOCABULARY = 1 << 18


# text


def _cut(df: DataFrame, cutter, text: str, out: str) -> DataFrame:
    """Words by a tokenizer of ``__filled``; none for a NULL text, which stays NULL."""
    cut = cutter.transform(df.withColumn("__filled", F.coalesce(text, F.lit(""))))
    nothing = F.array().cast("array<string>")
    return cut.withColumn(out, F.when(F.col(text).isNull(), nothing).otherwise(F.col(out))).drop("__filled")


def tokenize(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """Lower-case words between single white-space characters; a NULL text has none."""
    return _cut(df, Tokenizer(inputCol="__filled", outputCol=out), text, out)


def regex_tokenize(
    df: DataFrame, text: str, out: str = "tokens", pattern: str = r"\W", gaps: bool = True
) -> DataFrame:
    """Lower-case words cut at ``pattern``, or found by it without ``gaps``."""
    cutter = RegexTokenizer(inputCol="__filled", outputCol=out, pattern=pattern, gaps=gaps)
    return _cut(df, cutter, text, out)


def default_stop_words(language: str = "english") -> list[str]:
    """Spark's own stop word list."""
    return StopWordsRemover.loadDefaultStopWords(language)


def remove_stop_words(
    df: DataFrame, tokens: str, out: str = "filtered", words: Sequence[str] | None = None
) -> DataFrame:
    """Drop stop words from a word array, ignoring case."""
    remover = StopWordsRemover(inputCol=tokens, outputCol=out)
    return (remover.setStopWords(list(words)) if words is not None else remover).transform(df)


def ngrams(df: DataFrame, tokens: str, out: str = "ngrams", n: int = 2) -> DataFrame:
    """Runs of ``n`` words joined by a space; none when there are fewer words."""
    return NGram(n=n, inputCol=tokens, outputCol=out).transform(df)


# term weights


def hashing_tf(
    df: DataFrame, tokens: str, out: str = "tf", num_features: int = 1 << 20
) -> DataFrame:
    """Term counts in a sparse vector of hashed slots; needs no vocabulary."""
    return HashingTF(numFeatures=num_features, inputCol=tokens, outputCol=out).transform(df)


def fit_idf(df: DataFrame, tf: str, out: str = "tf_idf", min_doc_freq: int = 0) -> IDFModel:
    """Inverse document frequency of vector slots; state is one number per slot."""
    return IDF(inputCol=tf, outputCol=out, minDocFreq=min_doc_freq).fit(df)


def term_rows(df: DataFrame, row_id: str, tokens: str | Column) -> DataFrame:
    """``(id, term, n)``, counted inside each row, so nothing is shuffled."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    counted = df.select(row_id, F.explode(tx.term_counts(tokens)).alias("e"))
    return counted.select(row_id, "e.term", F.col("e.n").cast("bigint").alias("n"))


def document_frequency(df: DataFrame, tokens: str | Column, min_df: int = 1) -> DataFrame:
    """``(term, df)``: rows that hold the term, combined before the shuffle."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    counts = (
        df.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    return counts.where(F.col("df") >= min_df) if min_df > 1 else counts


def idf_weights(
    df: DataFrame, tokens: str | Column, min_df: int = 1, rows: int | None = None
) -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((rows + 1) / (df + 1))``."""
    rows = df.count() if rows is None else rows
    return document_frequency(df, tokens, min_df).withColumn(
        "idf", F.log((F.lit(rows) + 1) / (F.col("df") + 1))
    )


def tf_idf(df: DataFrame, row_id: str, tokens: str | Column, min_df: int = 1) -> DataFrame:
    """``(id, term, weight)`` for every term that at least ``min_df`` rows hold.

    The term table is computed and stored once; the count rows of the documents
    are made in place and meet it by broadcast or, for a large vocabulary, by a
    shuffle that cuts up frequent terms.
    """
    weights = stored(idf_weights(df, tokens, min_df), "term-weights")
    counted = lookup_join(term_rows(df, row_id, tokens), weights, "term", "df", row_id)
    return counted.select(row_id, "term", (F.col("n") * F.col("idf")).alias("weight"))


def top_terms(
    df: DataFrame, row_id: str, tokens: str | Column, size: int | None, min_df: int = 1
) -> DataFrame:
    """``(term, corpus_n, df)``: the ``size`` most frequent terms (None: all), ties by term."""
    return _ranked(term_rows(df, row_id, tokens), size, min_df)


def _ranked(counted: DataFrame, size: int | None, min_df: int) -> DataFrame:
    """``top_terms`` of rows that are counted already."""
    counts = (
        counted
        .groupBy("term")
        .agg(F.sum("n").alias("corpus_n"), F.count(F.lit(1)).alias("df"))
    )
    ordered = counts.where(F.col("df") >= min_df).orderBy(F.desc("corpus_n"), "term")
    return ordered if size is None else ordered.limit(size)


@dataclass(frozen=True)
class TermIndex:
    """A vocabulary that stays a table: ``terms`` holds ``(pos, term, corpus_n, df)``."""

    terms: DataFrame
    size: int
    row_id: str
    tokens: str
    out: str
    #: The rows it was fitted on, and their ``(id, term, n)``.
    fitted: DataFrame
    counted: DataFrame

    def transform(self, df: DataFrame, *keep: str) -> DataFrame:
        """Add the count vector of each row; row ids are unique. A row without known terms has an empty vector.

        Counts are made inside the rows and meet the terms by ``lookup_join``; the
        entries of a row are put together by its id. Only the columns ``keep`` travel with it, all if none is named.
        """
        rows = self.counted if df is self.fitted else term_rows(df, self.row_id, self.tokens)
        counted = lookup_join(
            rows, self.terms.select("term", "pos", "df"), "term", "df", self.row_id)
        entries = counted.groupBy(self.row_id).agg(
            F.sort_array(F.collect_list(F.struct("pos", F.col("n").alias("value")))).alias("entries"))
        none = F.array().cast("array<struct<pos: bigint, value: bigint>>")
        parts = vx.sparse_parts(self.size, F.coalesce("entries", none))
        kept = df.select(*dict.fromkeys((self.row_id, *keep))) if keep else df
        rows = kept.join(entries, self.row_id, "left").withColumn(self.out, parts).drop("entries")
        return vx.stored_vectors(rows, self.out, "count-vectors")


def fit_term_index(
    df: DataFrame, row_id: str, tokens: str, out: str = "counts", min_df: int = 1
) -> TermIndex:
    """Number all terms that ``min_df`` rows hold, most frequent first, ties by term.

    Terms are ranked by a range sort. A term's number is its place in its partition and the
    rows of the partitions before; only one count for each partition reaches the driver. The rows are
    counted once, for the ranks and for the vectors of these rows.
    """
    counted = stored(term_rows(df, row_id, tokens), "term-rows")
    numbered, total = _numbered(_ranked(counted, None, min_df))
    return TermIndex(numbered, total, row_id, tokens, out, df, counted)


def _numbered(ordered: DataFrame) -> tuple[DataFrame, int]:
    """``(pos, ...)`` of sorted terms, and how many there are."""
    ranked = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ranked-terms")
    part = F.shiftright("at", 33).alias("part")
    sizes = ranked.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row.part, total))
        total += row.n
    start = ordered.sparkSession.createDataFrame(starts, "part bigint, start bigint")
    numbered = ranked.withColumn("part", part).join(F.broadcast(start), "part").select(
        (F.col("start") + F.col("at") - F.shiftleft("part", 33)).alias("pos"), *ordered.columns)
    return numbered, total


def fit_count_vectorizer(
    df: DataFrame,
    row_id: str,
    tokens: str,
    out: str = "counts",
    vocab_size: int | None = MAX_VOCABULARY,
    min_df: int = 1,
) -> CountVectorizerModel | TermIndex:
    """Count vectors over the most frequent terms.

    Terms of equal frequency are ordered by name, so the vocabulary is the
    same on every run. ``vocab_size`` terms reach the driver, as a fitted vocabulary lives
    there. With None the vocabulary is all terms that ``min_df`` leaves and stays a table.
    """
    if vocab_size is None:
        return fit_term_index(df, row_id, tokens, out, min_df)
    terms = [row.term for row in top_terms(df, row_id, tokens, vocab_size, min_df).collect()]
    return count_vectorizer_of(df.sparkSession, terms, tokens, out)


def count_vectorizer_of(
    spark: SparkSession, vocabulary: Sequence[str], tokens: str, out: str = "counts"
) -> CountVectorizerModel:
    """Count vectors over a given dictionary."""
    return CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=tokens, outputCol=out)


def count_rows(df: DataFrame, row_id: str, counts: str, vocabulary: Sequence[str]) -> DataFrame:
    """Count vectors as ``(id, term, n)``; Spark broadcasts the vocabulary only if it is small."""
    spark = df.sparkSession
    terms = spark.createDataFrame(list(enumerate(vocabulary)), "pos int, term string")
    entries = df.select(row_id, F.explode(vx.sparse_entries(F.col(counts))).alias("e"))
    return entries.select(
        row_id, F.col("e.pos").alias("pos"), F.col("e.value").cast("bigint").alias("n")
    ).join(terms, "pos").select(row_id, "term", "n")


def word2vec(
    df: DataFrame,
    tokens: str,
    out: str = "vector",
    vector_size: int = 10,
    min_count: int = 0,
    seed: int = 1,
    partitions: int = 4,
    max_iter: int = 1,
):
    """Word vectors; a row's vector is the sum of its known words' over all its words.

    Training runs in ``partitions`` tasks, whatever the cluster's size, and their vectors are averaged ``max_iter``
    times; one task repeats exactly. The library's class keeps the vocabulary on the driver, ``vector_size`` floats a word
    and more for its codes; of more than ``MAX_VOCABULARY`` words it stays a table, and tasks hold the words they train.
    """
    words = df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("corpus_n"))
    words = stored(words.where(F.col("corpus_n") >= min_count), "words")
    if words.count() > MAX_VOCABULARY:
        vocabulary, size = _numbered(words.orderBy(F.desc("corpus_n"), "term"))
        return fit_word_vectors(df, tokens, vocabulary, size, out, vector_size, seed, partitions, max_iter)
    return Word2Vec(
        vectorSize=vector_size, minCount=min_count, seed=seed,
        numPartitions=partitions, maxIter=max_iter, inputCol=tokens, outputCol=out,
    ).fit(df)


# numbers and vectors


def binarize(df: DataFrame, column: str, threshold: float = 0.5, out: str = "flag") -> DataFrame:
    """1.0 above the threshold, 0.0 at or below it."""
    return Binarizer(threshold=threshold, inputCol=column, outputCol=out).transform(df)


def normalize(
    df: DataFrame, vector: str, p: float = 2.0, out: str = "normalized",
    overrides: dict | None = None,
) -> DataFrame:
    """Divide by the p-norm; ``overrides`` are parameter values by name for this run only."""
    stage = Normalizer(p=p, inputCol=vector, outputCol=out)
    named = {stage.getParam(name): value for name, value in (overrides or {}).items()}
    return stage.transform(df, named)


def vector_slice(
    df: DataFrame,
    vector: str,
    out: str = "sliced",
    indices: Sequence[int] = (),
    names: Sequence[str] = (),
) -> DataFrame:
    """Slots by index, then by attribute name, in the order asked for."""
    return VectorSlicer(
        inputCol=vector, outputCol=out, indices=list(indices), names=list(names)
    ).transform(df)


def name_slots(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Attach slot names to a vector column."""
    slots = [{"idx": at, "name": name} for at, name in enumerate(names)]
    meta = {"ml_attr": {"attrs": {"numeric": slots}, "num_attrs": len(slots)}}
    return df.withColumn(vector, F.col(vector).alias(vector, metadata=meta))


def fit_chi2_selector(
    df: DataFrame, vector: str, label: str, top: int = 2, out: str = "selected"
):
    """Keep the ``top`` slots that depend most on the label."""
    return ChiSqSelector(
        numTopFeatures=top, featuresCol=vector, labelCol=label, outputCol=out
    ).fit(df)


def chi2_statistic(df: DataFrame, vector: str, label: str) -> DataFrame:
    """``(slot, p_value, dof, statistic)`` of the independence test for each slot."""
    result = ChiSquareTest.test(df, vector, label, flatten=True)
    return result.select(
        F.col("featureIndex").alias("slot"),
        F.col("pValue").alias("p_value"),
        F.col("degreesOfFreedom").alias("dof"),
        "statistic",
    )


def fit_pca(df: DataFrame, vector: str, k: int = 3, out: str = "projected"):
    """Principal components; the projection does not centre its input."""
    return PCA(k=k, inputCol=vector, outputCol=out).fit(df)


def fit_string_index(
    df: DataFrame, column: str, out: str = "index", invalid: str = "error"
) -> StringIndexerModel:
    """Index by falling frequency, ties by name. For labels: the driver keeps them all."""
    return StringIndexer(inputCol=column, outputCol=out, handleInvalid=invalid).fit(df)


def index_to_string(
    df: DataFrame, column: str, labels: Sequence[str], out: str = "label"
) -> DataFrame:
    """The label of an index."""
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def fit_vector_index(
    df: DataFrame, vector: str, out: str = "indexed", max_categories: int = 4
) -> VectorIndexerModel:
    """Treat slots of few distinct values as categories."""
    return VectorIndexer(maxCategories=max_categories, inputCol=vector, outputCol=out).fit(df)
