"""Broadcasting only what has been measured."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 << 20

_WIDTHS = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4, T.BooleanType: 1,
}
_ROW_OVERHEAD = 32


def _size(df: DataFrame) -> DataFrame:
    """One row with the bytes of the frame's rows."""
    flexible = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = _ROW_OVERHEAD + sum(
        _WIDTHS.get(type(f.dataType), 16 if isinstance(f.dataType, T.DecimalType) else 8) for f in df.schema.fields
    )
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    texts = [F.col(f"`{c}`") for c in flexible] + [F.to_json(F.struct(F.col(f"`{c}`"))) for c in nested]
    text = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0))
    return df.agg(F.coalesce(F.sum(text.cast("bigint") + fixed), F.lit(0)).alias("bytes"))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the frame's rows, counted in one aggregate over it."""
    return _size(df).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The frame with a broadcast hint when its measured size is within ``limit``.

    Beyond the limit the frame is returned as it is: the join is then a
    sort-merge join whose hot partitions adaptive execution splits.
    """
    return broadcast_small([df], limit)[0]


def broadcast_small(frames: Sequence[DataFrame], limit: int = BROADCAST_LIMIT) -> list[DataFrame]:
    """The same for several frames, all measured in one job."""
    return [F.broadcast(df) if small else df for df, small in zip(frames, are_small(frames, limit), strict=True)]


def are_small(frames: Sequence[DataFrame], limit: int = BROADCAST_LIMIT) -> list[bool]:
    """Which of the frames are within ``limit`` bytes, all measured in one job."""
    sizes = [_size(df).select(F.lit(i).alias("i"), "bytes") for i, df in enumerate(frames)]
    measured = dict(tuple(r) for r in reduce(DataFrame.unionByName, sizes).collect())
    return [measured[i] <= limit for i in range(len(frames))]
