"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.session import checkpoint_dir

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: A word of the contracts.
WORD = r"[^\x20\x09-\x0D]+"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(df: DataFrame, col: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def fold(col: Column, modulus: int) -> Column:
    """``crc32`` of an id written as decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(col.cast("string")) % F.lit(modulus)


def hash_order(col: Column, seed: int) -> Column:
    """A seeded pseudo-random order key of an id."""
    return F.xxhash64(F.lit(seed), col)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function that yields ``{column: values}``; columns
    it passes on as Arrow arrays are not converted."""

    fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            arrays = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in fields]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return df.mapInArrow(wrapped, schema)


def map_texts(df: DataFrame, keep: tuple[str, ...], text: Column, make: Callable[[], Callable], schema: str) -> DataFrame:
    """The columns ``keep`` and what a function makes of each text (None
    included): one tuple a row, in the order of ``schema``. ``make`` returns
    that function and runs once a task."""
    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        of = make()
        for batch in batches:
            made = list(zip(*[of(t.as_py()) for t in batch.column(len(keep))])) or [()] * len(names)
            yield dict(zip(keep, batch.columns)) | dict(zip(names, made))

    last = "__text" + "_" * max((len(k) for k in keep), default=0)  # longer than any kept name
    return map_batches(df.select(*quoted(keep), text.cast("string").alias(last)), run, ddl(df, keep) + schema)


def quoted(names) -> list[Column]:
    """Columns by their plain names, dots and spaces included."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def ddl(df: DataFrame, names) -> str:
    """Schema text of the named columns, each followed by a comma."""
    types = dict(df.dtypes)
    return "".join(f"`{n.replace('`', '``')}` {types[n]}, " for n in names)
