"""The two sketches as SQL table functions: a group is folded row by row into constant state.

Both take a TABLE argument whose last column is the value; the other columns are the
group's keys and come back in front of the result::

    SELECT * FROM MINHASH_SIGNATURES(TABLE(
      SELECT rid, window_end, FEATURE_HASH(sch_tpl, ts_tpl, event_type) FROM joined))

Spark partitions and sorts the rows by the keys, so a group streams through one task and
is never collected. Results can be folded again, with the result column as the value: a
hot group is spread by one more key in an inner call, left out in an outer one::

    SELECT * FROM MINHASH_SIGNATURES(TABLE(
      SELECT rid, window_end, minhash_signature FROM MINHASH_SIGNATURES(TABLE(
        SELECT rid, window_end, pmod(event_id, 64) AS part, FEATURE_HASH(sch_tpl, ts_tpl, event_type) FROM joined))))

NULL values add nothing; a group of nothing but NULLs has an empty signature or filter. A
table without rows gives no rows, also without keys.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from feedlake.functions.hashing import MERSENNE_31, coefficients
from feedlake.operators.sketches import FILTER_BITS, FILTER_HASHES, FILTER_SEED, SIGNATURE_LENGTH, SIGNATURE_SEED

#: Hashes, or results, that wait for one vectorised step.
CHUNK, MERGED = 1024, 64
_WHOLE = (ByteType, ShortType, IntegerType, LongType, NullType)


def _analyzed(table: AnalyzeArgument, name: str, result: DataType) -> AnalyzeResult:
    """Groups by all columns but the last, which must hold hashes or earlier results."""
    if not table.isTable or not table.dataType.fields:
        raise ValueError("the argument must be a TABLE with a value in its last column")
    *keys, value = table.dataType.fields
    if not isinstance(value.dataType, _WHOLE) and value.dataType.simpleString() != result.simpleString():
        raise ValueError(f"the last column must be BIGINT or {result.simpleString().upper()}, not {value.dataType.simpleString()}")
    schema = StructType([*keys, StructField(name, result)])
    names = [PartitioningColumn(f"`{k.name.replace('`', '``')}`") for k in keys]
    return AnalyzeResult(schema, partitionBy=names, withSinglePartition=not names)


@lru_cache(maxsize=8)
def _family(count: int, seed: int) -> np.ndarray:
    """The factors and the summands of a hash family; made once per Python worker, as every group has its own fold."""
    return np.array(coefficients(count, seed), np.int64).T.copy()


class _Fold:
    """One group: its keys, up to :data:`CHUNK` waiting hashes, and the state."""

    def __init__(self):
        self.keys, self.waiting = None, []

    def eval(self, row):
        *keys, value = row
        if self.keys is None:
            self.keys = keys
        if value is None:
            return
        if isinstance(value, int):
            self.waiting.append(value)
            if len(self.waiting) == CHUNK:
                self._settle()
        else:
            self.merge(value)

    def _settle(self) -> None:
        if self.waiting:
            self.fold(np.array(self.waiting, np.int64)[:, None])
            self.waiting.clear()

    def terminate(self):
        if self.keys is not None:
            self._settle()
            yield (*self.keys, self.result())


class MinhashSignatures(_Fold):
    """The least universal hash per position."""

    def __init__(self):
        super().__init__()
        self.a, self.b = _family(SIGNATURE_LENGTH, SIGNATURE_SEED)
        self.least, self.signatures = None, []

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        return _analyzed(table, "minhash_signature", ArrayType(LongType()))

    def fold(self, hashes: np.ndarray) -> None:
        self._take(((self.a * hashes + self.b) % MERSENNE_31).min(axis=0))

    def merge(self, signature) -> None:
        if len(signature):
            self.signatures.append(signature)
            if len(self.signatures) == MERGED:
                self._merge()

    def _merge(self) -> None:
        if self.signatures:
            self._take(np.array(self.signatures, np.int64).min(axis=0))
            self.signatures.clear()

    def _take(self, least: np.ndarray) -> None:
        self.least = least if self.least is None else np.minimum(self.least, least)

    def result(self):
        if self.least is None and len(self.signatures) == 1:
            return list(self.signatures[0])
        self._merge()
        return [] if self.least is None else self.least.tolist()


class BloomFilters(_Fold):
    """The union of the elements' bits, as Base64 text."""

    def __init__(self):
        super().__init__()
        self.a, self.b = _family(FILTER_HASHES, FILTER_SEED)
        self.bits = np.zeros(FILTER_BITS, np.uint8)

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        return _analyzed(table, "bloom_filter_base64", StringType())

    def fold(self, hashes: np.ndarray) -> None:
        self.bits[(self.a * hashes + self.b) % FILTER_BITS] = 1

    def merge(self, text: str) -> None:
        bits = np.unpackbits(np.frombuffer(base64.b64decode(text), np.uint8), bitorder="little")
        self.bits[: len(bits)] |= bits

    def result(self):
        return base64.b64encode(np.packbits(self.bits, bitorder="little").tobytes().rstrip(b"\0")).decode()


def register_sql_tables(spark: SparkSession) -> list[str]:
    """Create the table functions in a session; returns their names.

    Without Arrow: with it, Spark builds a record batch of results for every single row.
    """
    made = {"MINHASH_SIGNATURES": MinhashSignatures, "BLOOM_FILTERS": BloomFilters}
    for name, fold in made.items():
        spark.udtf.register(name, udtf(fold, useArrow=False))
    return list(made)
