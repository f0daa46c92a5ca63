"""Vectors as columns: to and from arrays, to rows, and distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakeline.session import work_folder


def as_vector(values: Column) -> Column:
    """Dense vector from a numeric array."""
    return array_to_vector(values.cast("array<double>"))


def vector_rows(df: DataFrame, keep: Sequence[str], vector: str) -> DataFrame:
    """One row ``(keep..., pos, value)`` per slot, zeros included."""
    return df.select(*keep, F.posexplode(vector_to_array(vector)).alias("pos", "value"))


def sparse_entries(vector: Column) -> Column:
    """Stored entries of a sparse vector as ``array<struct<pos, value>>``.

    Reads the vector's own index and value arrays, so a vector of a million
    slots with ten entries costs ten.
    """
    inner = F.unwrap_udt(vector)
    return F.arrays_zip(
        inner.getField("indices").alias("pos"), inner.getField("values").alias("value")
    )


def sparse_sum(vector: Column) -> Column:
    """Sum over the stored entries of a vector."""
    return F.aggregate(
        F.unwrap_udt(vector).getField("values"), F.lit(0.0), lambda total, value: total + value
    )


def sparse_parts(size: int, entries: Column) -> Column:
    """The stored form of a sparse vector of ``size`` slots, from its ``(pos, value)`` entries in order of pos."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.transform(entries, lambda e: e["pos"].cast("int")).alias("indices"),
        F.transform(entries, lambda e: e["value"].cast("double")).alias("values"))


def stored_vectors(df: DataFrame, column: str, purpose: str) -> DataFrame:
    """Write ``df`` and read it back with ``column``, made by ``sparse_parts``, as vectors.

    A file holds a vector as just these parts, so reading is the conversion: no Python, no
    dense form of a million slots.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    schema = StructType([
        StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two double arrays of equal length."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x - y),
        F.lit(0.0),
        lambda total, gap: total + gap * gap,
    )


def literal_vector(values: Sequence[float]) -> Column:
    """A constant double array."""
    return F.lit([float(value) for value in values])
