"""Aggregates with Python state that combine before the shuffle."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EMIT_ROWS = 10_000
NAN = math.nan


def _key(value: Any) -> Any:
    """One object for all NaN, so that they are one key; NULL stays None."""
    return NAN if isinstance(value, float) and value != value else value


def mergeable_aggregate(
    df: DataFrame,
    key: str,
    value: str,
    *,
    zero: Callable[[], tuple],
    reduce: Callable[[tuple, np.ndarray], tuple],
    merge: Callable[[tuple, tuple], tuple],
    finish: Callable[[tuple], tuple],
    state: str,
    result: str,
    max_keys: int = 100_000,
    salts: int = 32,
) -> DataFrame:
    """A user's aggregate per key: zero, reduce, merge, finish.

    ``reduce`` takes the values of a key in one Arrow batch as an array, without
    NULLs. States are combined inside each input partition (a full table of ``max_keys``
    states is sent on and started anew), then per key and salt, then per key.
    States arrive sorted by key and are merged as they stream by, so neither a
    key's rows nor its states are ever held together.

    Keys and states stay in the Arrow types of their columns all the way, so large integers keep their last
    digit next to NULL, and NULL and NaN are two keys. ``state`` and ``result`` are DDL
    field lists for the two tuples.
    """
    fields = [field.name for field in StructType.fromDDL(state)]
    outputs = [field.name for field in StructType.fromDDL(result)]
    key_type = df.schema[key].dataType.simpleString()
    key_state, key_result = (f"`{key}` {key_type}, {ddl}" for ddl in (state, result))
    state_schema, result_schema = (
        df.sparkSession.createDataFrame([], ddl).toArrow().schema for ddl in (key_state, key_result))

    def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[Any, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            keys, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            values = batch.column(1).take(pa.array(order))
            ends = np.cumsum(np.bincount(codes, minlength=len(keys)))
            for k, begin, end in zip(map(_key, keys), np.r_[0, ends], ends):
                if end > begin:
                    seen = values.slice(begin, end - begin).drop_null().to_numpy(zero_copy_only=False)
                    states[k] = reduce(states[k] if k in states else zero(), seen)
            if len(states) >= max_keys:
                yield packed([(k, *s) for k, s in states.items()], state_schema)
                states.clear()
        if states:
            yield packed([(k, *s) for k, s in states.items()], state_schema)

    def merged(last: Callable[[tuple], tuple], schema: pa.Schema) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_key, open_state, done = None, None, []
            for batch in batches:
                for k, *new in zip(*(column.to_pylist() for column in batch.columns)):
                    k, new = _key(k), tuple(new)
                    if open_state is not None and (k is open_key or k == open_key):
                        open_state = merge(open_state, new)
                        continue
                    if open_state is not None:
                        done.append((open_key, *last(open_state)))
                    open_key, open_state = k, new
                    if len(done) >= EMIT_ROWS:
                        yield packed(done, schema)
                        done = []
            if open_state is not None:
                done.append((open_key, *last(open_state)))
            if done:
                yield packed(done, schema)

        return run

    states = df.select(key, value).mapInArrow(partial, key_state)
    if salts > 1:
        salted = states.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        states = (
            salted.repartition(key, "__salt")
            .sortWithinPartitions(key)
            .select(key, *fields)
            .mapInArrow(merged(lambda s: s, state_schema), key_state)
        )
    return (
        states.repartition(key)
        .sortWithinPartitions(key)
        .mapInArrow(merged(finish, result_schema), key_result)
    )
