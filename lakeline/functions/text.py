"""Line and word splitting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

LINE_BREAK = "\r\n|\r|\n"


def lines(text: Column) -> Column:
    """Lines of a text as a text file reader cuts them: a final break ends the last line."""
    parts = F.split(text, LINE_BREAK)
    ends_open = F.element_at(parts, -1) == ""
    return F.slice(parts, F.lit(1), F.size(parts) - ends_open.cast("int"))


def words(line: Column) -> Column:
    """Words between single spaces.

    Trailing empty words go, leading and inner ones stay; an empty line is one
    empty word and a line of spaces only has no word.
    """
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def words_of_lines(text: Column) -> Column:
    """All words of all lines of a text, in order."""
    return F.flatten(F.transform(lines(text), words))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` by name.

    An expression used inside a lambda is otherwise evaluated for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, n>>`` of one token array, without a shuffle.

    Equal tokens are adjacent after sorting, so a term's count is the distance
    between the starts of two runs.
    """
    def run_starts(ordered: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, at: F.struct(
                F.get(ordered, start - 1).alias("term"),
                (F.coalesce(F.get(starts, at + 1), F.size(ordered) + 1) - start).alias("n"),
            ),
        )

    counted = let(
        F.sort_array(tokens),
        lambda ordered: let(run_starts(ordered), lambda starts: runs(ordered, starts)),
    )
    return F.when(F.size(tokens) > 0, counted)


def register_token_count(spark: SparkSession, name: str = "countTokens") -> str:
    """A named SQL function for the length of a word array; inlined by the optimizer."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(words ARRAY<STRING>) "
        "RETURNS INT RETURN size(words)"
    )
    return name
