"""Text and vector features."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators import features as ops
from lakeline.plans.registry import (
    SQL_TOKENIZED,
    SQL_VECTORS,
    documents,
    embeddings,
    query,
    rounded,
    tokenized,
)
from lakeline.session import dealt
from lakeline.sources.files import table

DICTIONARY = ["the", "de", "la", "der", "and", "que", "und", "les"]
# Spark's default English stop words, for the SQL twin.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()
CODES = {"A": 5.0, "N": 0.0, "R": 2.0}
STATUS_CODES = {"O": 1.0, "F": 3.0}


def _term_counts(df, column, out):
    return df.select(F.explode(column).alias(out)).groupBy(out).agg(
        F.count(F.lit(1)).alias("n")
    )


def _code(column, codes):
    value = F.lit(None).cast("double")
    for name, code in codes.items():
        value = F.when(F.col(column) == name, F.lit(code)).otherwise(value)
    return value


def _sql_code(column, codes):
    cases = " ".join(f"WHEN '{name}' THEN {code}" for name, code in codes.items())
    return f"CAST(CASE {column} {cases} END AS DOUBLE)"


# text


@query(
    "tokenize",
    f"WITH {SQL_TOKENIZED} SELECT token, count(*) AS n FROM "
    "(SELECT unnest(tokens) AS token FROM tokenized) GROUP BY token",
)
def tokenize(spark, folder):
    return _term_counts(tokenized(spark, folder), "tokens", "token")


@query(
    "regex_tokenize",
    "SELECT token, count(*) AS n FROM "
    "(SELECT unnest(regexp_split_to_array(lower(text), '\\W')) AS token FROM documents) "
    "WHERE token <> '' GROUP BY token",
)
def regex_tokenize(spark, folder):
    df = ops.regex_tokenize(documents(spark, folder), "text")
    return _term_counts(df, "tokens", "token")


@query(
    "remove_stop_words",
    f"WITH {SQL_TOKENIZED} SELECT token, count(*) AS n FROM "
    "(SELECT unnest(tokens) AS token FROM tokenized) WHERE token NOT IN ("
    + ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
    + ") GROUP BY token",
)
def remove_stop_words(spark, folder):
    df = ops.remove_stop_words(tokenized(spark, folder), "tokens")
    return _term_counts(df, "filtered", "token")


@query(
    "ngrams",
    f"WITH {SQL_TOKENIZED}, placed AS (SELECT doc_id, unnest(tokens) AS token, "
    "generate_subscripts(tokens, 1) AS pos FROM tokenized), "
    "pairs AS (SELECT token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS follow "
    "FROM placed) "
    "SELECT token || ' ' || follow AS ngram, count(*) AS n FROM pairs "
    "WHERE follow IS NOT NULL GROUP BY 1",
)
def ngrams(spark, folder):
    df = ops.ngrams(tokenized(spark, folder), "tokens", n=2)
    return _term_counts(df, "ngrams", "ngram")


# term weights


@query(
    "hashing_tf",
    f"WITH {SQL_TOKENIZED} SELECT doc_id, CAST(len(tokens) AS DOUBLE) AS tf_total FROM tokenized",
)
def hashing_tf(spark, folder):
    df = ops.hashing_tf(tokenized(spark, folder), "tokens", num_features=1 << 20)
    return df.select("doc_id", vx.sparse_sum(F.col("tf")).alias("tf_total"))


@query("hashed_tf_idf")
def hashed_tf_idf(spark, folder):
    df = ops.hashing_tf(tokenized(spark, folder), "tokens", num_features=1 << 20)
    weighted = ops.fit_idf(df, "tf").transform(df)
    return weighted.select("doc_id", F.explode(vx.sparse_entries(F.col("tf_idf"))).alias("e")).select(
        "doc_id", F.col("e.pos").alias("slot"), F.col("e.value").alias("weight")
    )


SQL_TERMS = (
    f"{SQL_TOKENIZED}, tf AS (SELECT doc_id, term, count(*) AS n FROM "
    "(SELECT doc_id, unnest(tokens) AS term FROM tokenized) GROUP BY doc_id, term), "
    "df AS (SELECT term, count(*) AS df, "
    "ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1)) AS idf FROM tf GROUP BY term)"
)


@query(
    "idf_weights",
    f"WITH {SQL_TERMS} SELECT term, df, round(idf, 6) + 0.0 AS idf FROM df",
)
def idf_weights(spark, folder):
    weights = ops.idf_weights(tokenized(spark, folder), "tokens")
    return weights.select("term", "df", rounded(F.col("idf")).alias("idf"))


@query(
    "tf_idf",
    f"WITH {SQL_TERMS} SELECT doc_id, term, round(n * idf, 6) + 0.0 AS weight "
    "FROM tf JOIN df USING (term) WHERE df >= 2",
)
def tf_idf(spark, folder):
    weights = ops.tf_idf(tokenized(spark, folder), "doc_id", "tokens", min_df=2)
    return weights.select("doc_id", "term", rounded(F.col("weight")).alias("weight"))


@query(
    "count_vectorize",
    f"WITH {SQL_TERMS}, vocabulary AS (SELECT term FROM tf GROUP BY term HAVING count(*) >= 2 "
    "ORDER BY sum(n) DESC, term LIMIT 1000) "
    "SELECT doc_id, term, n FROM tf JOIN vocabulary USING (term)",
)
def count_vectorize(spark, folder):
    df = tokenized(spark, folder)
    model = ops.fit_count_vectorizer(df, "doc_id", "tokens", vocab_size=1000, min_df=2)
    return ops.count_rows(model.transform(df), "doc_id", "counts", model.vocabulary)


@query(
    "count_vectorize_vocab",
    f"WITH {SQL_TERMS} SELECT doc_id, term, n FROM tf WHERE term IN "
    "(" + ", ".join(f"'{word}'" for word in DICTIONARY) + ")",
)
def count_vectorize_vocab(spark, folder):
    df = tokenized(spark, folder)
    model = ops.count_vectorizer_of(spark, DICTIONARY, "tokens")
    return ops.count_rows(model.transform(df), "doc_id", "counts", model.vocabulary)


@query("word2vec")
def word2vec(spark, folder):
    df = tokenized(spark, folder)
    model = ops.word2vec(df, "tokens", vector_size=10, min_count=0, partitions=4, max_iter=1)
    return vx.vector_rows(model.transform(df), ["doc_id"], "vector")


# numbers and vectors


@query(
    "binarize",
    "SELECT CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS flag, count(*) AS n, "
    "sum(l_quantity) AS total FROM lineitem GROUP BY 1",
)
def binarize(spark, folder):
    items = table(spark, folder, "lineitem", "l_quantity")
    return ops.binarize(items, "l_quantity", 25.0).groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total")
    )


SQL_NORMALIZED = (
    f"WITH {SQL_VECTORS}, norms AS (SELECT vec_id, {{norm}} AS norm FROM vectors GROUP BY vec_id) "
    "SELECT vec_id, CAST(pos AS INTEGER) AS pos, "
    "CASE WHEN norm = 0 THEN 0.0 ELSE round(value / norm, 6) + 0.0 END AS value "
    "FROM vectors JOIN norms USING (vec_id)"
)


def _normalized(df):
    rows = vx.vector_rows(df, ["vec_id"], "normalized")
    return rows.select("vec_id", "pos", rounded(F.col("value")).alias("value"))


@query("normalize_l1", SQL_NORMALIZED.format(norm="sum(abs(value))"))
def normalize_l1(spark, folder):
    return _normalized(ops.normalize(embeddings(spark, folder), "features", p=1.0))


@query("normalize_linf", SQL_NORMALIZED.format(norm="max(abs(value))"))
def normalize_linf(spark, folder):
    return _normalized(ops.normalize(embeddings(spark, folder), "features", p=float("inf")))


@query(
    "score_with_overrides",
    f"WITH {SQL_VECTORS} SELECT vec_id, round(sum(abs(value)) / max(abs(value)), 6) AS size "
    "FROM vectors GROUP BY vec_id",
)
def score_with_overrides(spark, folder):
    first, later = {"p": 1.0}, {"p": float("inf")}
    df = ops.normalize(embeddings(spark, folder), "features", overrides={**first, **later})
    size = F.aggregate(
        vx.vector_to_array("normalized"), F.lit(0.0), lambda total, v: total + F.abs(v)
    )
    return df.select("vec_id", rounded(size).alias("size"))


@query(
    "vector_slice",
    "SELECT l_returnflag, round(sum(l_tax), 4) AS tax, sum(l_quantity) AS quantity "
    "FROM lineitem GROUP BY l_returnflag",
)
def vector_slice(spark, folder):
    columns = ["l_quantity", "l_discount", "l_tax"]
    items = table(spark, folder, "lineitem", "l_returnflag", *columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(items)
    sliced = ops.vector_slice(vectors, "features", indices=[2], names=["l_quantity"])
    values = vx.vector_to_array("sliced")
    return sliced.groupBy("l_returnflag").agg(
        rounded(F.sum(values[0]), 4).alias("tax"), F.sum(values[1]).alias("quantity")
    )


def _sql_chi2(slots: str) -> str:
    """Independence statistics of three item features against the return flag."""
    return (
        "WITH cells AS (SELECT slot, label, value, count(*) AS seen FROM ("
        f"SELECT unnest([0, 1, 2]) AS slot, l_returnflag AS label, unnest([{slots}]) AS value "
        "FROM lineitem) GROUP BY 1, 2, 3), "
        "by_label AS (SELECT slot, label, sum(seen) AS n FROM cells GROUP BY 1, 2), "
        "by_value AS (SELECT slot, value, sum(seen) AS n FROM cells GROUP BY 1, 2), "
        "expected AS (SELECT l.slot, l.label, v.value, "
        "l.n * v.n / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS e "
        "FROM by_label l JOIN by_value v ON l.slot = v.slot), "
        "tests AS (SELECT e.slot, "
        "CAST((count(DISTINCT e.label) - 1) * (count(DISTINCT e.value) - 1) AS INTEGER) AS dof, "
        "sum((coalesce(c.seen, 0) - e) ** 2 / e) AS statistic "
        "FROM expected e LEFT JOIN cells c ON e.slot = c.slot AND e.label = c.label "
        "AND e.value = c.value GROUP BY e.slot) "
    )


def _item_vectors(spark, folder, columns, *slots, keep=()):
    items = table(spark, folder, "lineitem", "l_returnflag", *dict.fromkeys(columns))
    values = F.array(*[slot.cast("double") for slot in slots])
    return dealt(items).select(
        *keep, _code("l_returnflag", CODES).alias("label"), vx.as_vector(values).alias("features")
    )


SEVENS = "l_linenumber, dayofweek(l_shipdate) + 1, CAST(l_quantity AS INTEGER) % 7"


def _sevens(spark, folder, *keep):
    return _item_vectors(
        spark, folder, ["l_linenumber", "l_shipdate", "l_quantity", *keep],
        F.col("l_linenumber"), F.dayofweek("l_shipdate"), F.col("l_quantity").cast("int") % 7, keep=keep,
    )


# three features of seven values each: with equal degrees of freedom the order
# by p-value is the order by statistic
@query(
    "chi2_select",
    _sql_chi2(SEVENS)
    + "SELECT CAST(row_number() OVER (ORDER BY slot) - 1 AS INTEGER) AS place, slot "
    "FROM (SELECT slot FROM tests ORDER BY statistic DESC LIMIT 2)",
)
def chi2_select(spark, folder):
    model = ops.fit_chi2_selector(_sevens(spark, folder), "features", "label", top=2)
    return spark.createDataFrame(
        [(at, int(slot)) for at, slot in enumerate(model.selectedFeatures)], "place int, slot int"
    )


@query(
    "chi2_selected_vectors",
    _sql_chi2(SEVENS)
    + ", kept AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS place "
    "FROM (SELECT slot FROM tests ORDER BY statistic DESC LIMIT 2)), "
    f"items AS (SELECT l_orderkey, l_linenumber AS line, [{SEVENS}] AS slots FROM lineitem) "
    "SELECT l_orderkey, line, CAST(place AS INTEGER) AS pos, CAST(slots[slot + 1] AS DOUBLE) AS value FROM items, kept",
)
def chi2_selected_vectors(spark, folder):
    rows = _sevens(spark, folder, "l_orderkey", "l_linenumber")
    model = ops.fit_chi2_selector(rows, "features", "label", top=2)
    kept = model.transform(rows).withColumnRenamed("l_linenumber", "line")
    return vx.vector_rows(kept, ["l_orderkey", "line"], "selected")


@query(
    "chi2_statistic",
    _sql_chi2("CAST(l_linenumber AS DOUBLE), round(l_discount * 100), round(l_tax * 100)")
    + "SELECT slot, dof, round(statistic, 6) AS statistic FROM tests",
)
def chi2_statistic(spark, folder):
    vectors = _item_vectors(
        spark, folder, ["l_linenumber", "l_discount", "l_tax"],
        F.col("l_linenumber"), F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100),
    )
    result = ops.chi2_statistic(vectors, "features", "label")
    return result.select("slot", "dof", rounded(F.col("statistic")).alias("statistic"))


@query("pca_project")
def pca_project(spark, folder):
    df = embeddings(spark, folder)
    return vx.vector_rows(ops.fit_pca(df, "features", 3).transform(df), ["vec_id"], "projected")


@query(
    "pca_norms",
    f"WITH {SQL_VECTORS} SELECT vec_id, round(sum(value * value), 6) AS square FROM vectors GROUP BY vec_id",
)
def pca_norms(spark, folder):
    """With as many components as dimensions the projection is a rotation and keeps lengths."""
    df = embeddings(spark, folder)
    width = len(df.select("features").first()[0])
    projected = ops.fit_pca(df, "features", width).transform(df)
    square = F.aggregate(vx.vector_to_array("projected"), F.lit(0.0), lambda total, x: total + x * x)
    return projected.select("vec_id", rounded(square).alias("square"))


@query(
    "string_index",
    "SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) "
    "AS index, count(*) AS n FROM part GROUP BY p_brand",
)
def string_index(spark, folder):
    parts = table(spark, folder, "part", "p_brand")
    indexed = ops.fit_string_index(parts, "p_brand").transform(parts)
    return indexed.groupBy("p_brand", "index").agg(F.count(F.lit(1)).alias("n"))


@query("index_to_string", "SELECT p_partkey, p_brand AS label FROM part")
def index_to_string(spark, folder):
    parts = table(spark, folder, "part", "p_partkey", "p_brand")
    model = ops.fit_string_index(parts, "p_brand")
    back = ops.index_to_string(model.transform(parts), "index", model.labels)
    return back.select("p_partkey", "label")


@query(
    "vector_index",
    "WITH slots AS (SELECT 0 AS slot, "
    f"{_sql_code('l_returnflag', CODES)} AS value FROM lineitem "
    f"UNION ALL SELECT 1, {_sql_code('l_linestatus', STATUS_CODES)} FROM lineitem), "
    "counted AS (SELECT slot, value, count(*) AS n FROM slots GROUP BY slot, value) "
    "SELECT slot, value, CAST(row_number() OVER (PARTITION BY slot ORDER BY value <> 0, value) - 1 "
    "AS DOUBLE) AS index, n FROM counted "
    "UNION ALL SELECT 2, l_quantity, l_quantity, count(*) FROM lineitem GROUP BY l_quantity",
)
def vector_index(spark, folder):
    items = table(spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
    slots = F.array(
        _code("l_returnflag", CODES), _code("l_linestatus", STATUS_CODES), F.col("l_quantity")
    )
    vectors = dealt(items).select(vx.as_vector(slots).alias("features"))
    indexed = ops.fit_vector_index(vectors, "features", max_categories=4).transform(vectors)
    both = F.arrays_zip(
        vx.vector_to_array("features").alias("value"), vx.vector_to_array("indexed").alias("index")
    )
    return (
        indexed.select(F.posexplode(both).alias("slot", "e"))
        .groupBy("slot", F.col("e.value").alias("value"), F.col("e.index").alias("index"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
