"""Functions for SQL: a table function over partitions of a table argument, and an aggregate over Arrow arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult


class TakeWithin:
    """``take_within(TABLE(t) PARTITION BY (k) ORDER BY (o), 'size', budget)``: rows until more than a budget has gone before one.

    The result has the table's columns and ``before``, the sizes that went
    before a row in its partition. A null size is 0. Rows stream through: a
    partition is not held. The column and the budget must be constants.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, size: AnalyzeArgument, budget: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument is a table")
        if not (size.isConstantExpression and budget.isConstantExpression) or size.value not in rows.dataType.names:
            raise ValueError("the second argument names a column of the table, the third is a constant budget")
        if not isinstance(rows.dataType[size.value].dataType, T.IntegralType):
            raise ValueError(f"{size.value} has no whole numbers")
        fields = [f for f in rows.dataType.fields if f.name != "before"]
        return AnalyzeResult(T.StructType([*fields, T.StructField("before", T.LongType())]))

    def __init__(self) -> None:
        self.before = 0

    def eval(self, rows: T.Row, size: str, budget: int) -> Iterator[tuple]:
        if self.before <= budget:
            yield (*[v for n, v in zip(rows.__fields__, rows, strict=True) if n != "before"], self.before)
        self.before += rows[size] or 0

    def terminate(self) -> Iterator[tuple]:
        return iter(())


def _same_as_before(column: pa.Array) -> np.ndarray:
    """For all values but the first whether the one before is equal; nulls are equal."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def take_within_runs(schema: T.StructType, keys: list[str], size: str, budget: int) -> type:
    """A table function like ``take_within`` for tables of this schema, over Arrow batches, with many keys in a partition.

    ``f(TABLE(t) PARTITION BY (b) ORDER BY (k, o))``: rows of equal ``keys`` are
    a run, in which the sizes are counted anew. ``b`` must follow from the keys,
    say as a hash of them; so a partition is not one key, and Python does not
    see each row. What a run has so far is all that goes from batch to batch.
    Keys are whole numbers or texts.
    """
    if not all(isinstance(schema[k].dataType, T.IntegralType | T.StringType) for k in keys) or not isinstance(schema[size].dataType, T.IntegralType):
        raise ValueError(f"{keys} must be whole numbers or texts, {size} whole numbers")
    names = [f.name for f in schema.fields if f.name != "before"]

    class TakeWithinRuns:
        def __init__(self) -> None:
            self.run, self.before = None, 0

        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if not rows.num_rows:
                return
            ends = [tuple(rows.column(k)[i].as_py() for k in keys) for i in (0, -1)]
            starts = np.ones(rows.num_rows, bool)
            starts[1:] = ~np.logical_and.reduce([_same_as_before(rows.column(k)) for k in keys])
            sizes = pc.fill_null(rows.column(size).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            if abs(self.before) + float(np.abs(sizes.astype(float)).sum()) >= 2.0**62:
                sizes = sizes.astype(object)  # whole numbers of any length
            gone = np.cumsum(sizes) - sizes
            run = np.cumsum(starts) - 1
            before = gone - gone[starts][run] + np.where((run == 0) & (self.run == ends[0]), self.before, 0)
            taken = np.asarray(before <= budget, bool)
            self.run, self.before = ends[1], int(before[-1]) + int(sizes[-1])
            kept = rows.filter(pa.array(taken))
            yield pa.RecordBatch.from_arrays([*[kept.column(n) for n in names], pa.array(before[taken].tolist() if before.dtype == object else before[taken], pa.int64())], names=[*names, "before"])

    return F.arrow_udtf(TakeWithinRuns, returnType=T.StructType([*[schema[n] for n in names], T.StructField("before", T.LongType())]))


def set_hash(values: pa.Array) -> str:
    """SHA-256, in hex, of the distinct texts of a group in order of their bytes, each after its length; nulls don't count."""
    digest = hashlib.sha256()
    for text in sorted({v.encode() for v in values.to_pylist() if v is not None}):
        digest.update(b"%d\0" % len(text) + text)
    return digest.hexdigest()


def register(spark: SparkSession) -> None:
    """Makes ``take_within`` and ``set_hash`` known to SQL."""
    spark.udtf.register("take_within", F.udtf(TakeWithin))
    spark.udf.register("set_hash", F.arrow_udf(set_hash, returnType=T.StringType(), functionType=F.ArrowUDFType.GROUPED_AGG))
