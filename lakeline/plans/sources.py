"""Sources and sinks."""

from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.functions import vectors as vx
from lakeline.plans.registry import (
    SQL_VECTORS,
    documents,
    embeddings,
    query,
    rounded,
    sql_lines,
)
from lakeline.session import work_folder
from lakeline.sources import files, rows
from lakeline.sources.files import table


@query(
    "read_text_lines",
    "SELECT value, count(*) AS n FROM "
    "(SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM conversations) "
    "GROUP BY value",
)
def read_text_lines(spark, folder):
    path = work_folder(spark, "lines")
    table(spark, folder, "conversations", "text").write.text(path)
    return files.read_text_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "lines_of_column",
    f"SELECT doc_id, len({sql_lines('text')}) AS lines, "
    f"CAST(coalesce(list_sum(list_transform({sql_lines('text')}, lambda x: length(x))), 0) "
    "AS BIGINT) AS chars FROM documents",
)
def lines_of_column(spark, folder):

    lines = tx.lines(F.col("text"))
    sizes = F.aggregate(
        lines, F.lit(0).cast("bigint"), lambda total, line: total + F.length(line)
    )
    return documents(spark, folder).select(
        "doc_id", F.size(lines).cast("bigint").alias("lines"), sizes.alias("chars")
    )


@query(
    "read_json_inferred",
    "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n "
    "FROM events GROUP BY 1",
)
def read_json_inferred(spark, folder):
    path = work_folder(spark, "json")
    table(spark, folder, "events", "props").write.text(path)
    return files.read_json_inferred(spark, path).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "read_libsvm",
    f"WITH {SQL_VECTORS} SELECT CAST(label AS DOUBLE) AS label, CAST(pos AS INTEGER) AS pos, "
    "count(*) AS n, round(sum(value), 6) + 0.0 AS total FROM vectors GROUP BY label, pos",
)
def read_libsvm(spark, folder):
    path = work_folder(spark, "libsvm")
    files.write_libsvm(embeddings(spark, folder).select("label", "features"), path)
    loaded = files.read_libsvm(spark, path, num_features=64)
    return (
        vx.vector_rows(loaded, ["label"], "features")
        .groupBy("label", "pos")
        .agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value")).alias("total"))
    )


@query(
    "rows_to_table",
    "SELECT f.meaning, count(*) AS n FROM lineitem JOIN (VALUES ('A', 'accepted'), "
    "('N', 'none'), ('R', 'returned')) AS f(flag, meaning) ON l_returnflag = f.flag "
    "GROUP BY f.meaning",
)
def rows_to_table(spark, folder):
    flags = rows.rows_to_table(
        spark, [("A", "accepted"), ("N", "none"), ("R", "returned")], "flag string, meaning string"
    )
    counts = (
        table(spark, folder, "lineitem", "l_returnflag")
        .groupBy(F.col("l_returnflag").alias("flag"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.join(F.broadcast(flags), "flag").select("meaning", "n")
