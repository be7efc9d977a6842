"""File scans and sinks.

All readers are lazy and splittable except gzip inputs, which Spark reads one
file per task; call ``.repartition(n)`` after such a read only when the next
step is CPU-heavy (the reference repartitions every read, which costs a full
shuffle for splittable inputs).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

# Attribute-catalog type tokens and the Spark type each maps to.
# The lookup is exact-case; any other token is rejected.
TYPE_TOKENS: dict[str, DataType] = {
    "NUMERIC": DoubleType(),
    "real": DoubleType(),
    "string": StringType(),
    "STRING": StringType(),
}


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows anew over ``partitions`` tasks where a number is given."""
    return df.repartition(partitions) if partitions else df


def read_lines(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """One string column ``value`` per text line."""
    return dealt(spark.read.text(path), partitions)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                   sep: str = "\t", header: bool = False, partitions: int | None = None) -> DataFrame:
    """Delimited file with an explicit schema.

    Permissive mode, as in the reference: an unparsable field or a missing
    trailing field becomes null instead of failing the job.
    """
    frame = (spark.read.schema(schema)
             .option("sep", sep)
             .option("header", str(header).lower())
             .option("mode", "PERMISSIVE")
             .csv(path))
    return dealt(frame, partitions)


REASONS = ("missing field", "extra field")
#: Text that no field holds.
END = "\u0001end"


def read_quarantined(spark: SparkSession, path: str | Sequence[str], schema: StructType, sep: str = "\t",
                     header: bool = False) -> tuple[DataFrame, DataFrame]:
    """S2 with an account of bad rows: ``(good, bad)``.

    ``good`` has the rows that fit the schema; ``bad`` has ``(line, reason)`` of
    all others: ``missing field`` and ``extra field`` by their number, else
    ``unparsable <column>`` of the first column whose text is no value of its
    type. Empty text is null, not a fault. With ``header``, lines equal to the
    names are left out. A line is a record; quoted line breaks are not read.

    Each line is parsed once as typed columns and once as text, in one
    expression over the text scan, so both frames agree row by row whichever
    columns are asked for later (a CSV scan parses only those it needs, and
    then misses faults).
    """
    names = schema.names
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    texts = ", ".join(f"_c{k} string" for k in range(len(names) + 1))
    options = {"sep": sep, "mode": "PERMISSIVE"}
    lines = read_lines(spark, path)
    if header:
        lines = lines.where(F.col("value") != F.lit(sep.join(names)))
    # An empty field reads as null, like one that is not there; a last field added to the line tells where it ends.
    ended = F.concat("value", F.lit(sep + END))
    parsed = lines.select("value", F.from_csv("value", F.lit(columns), options).alias("typed"), F.from_csv(ended, F.lit(texts), options).alias("text"))
    text, typed = F.col("text"), F.col("typed")
    fields = [F.coalesce(text.getField(f"_c{k}"), F.lit("")) for k in range(len(names) + 1)]
    reason = F.when(F.array_contains(F.array(*fields[:-1]), END), REASONS[0]).when(fields[-1] != END, REASONS[1])
    for field, name in zip(fields, names):
        reason = reason.when(typed.getField(name).isNull() & (field != ""), f"unparsable {name}")
    marked = parsed.select("value", "typed", reason.alias("reason"))
    good = marked.where(F.col("reason").isNull()).select(*[typed.getField(n).alias(n) for n in names])
    return good, marked.where(F.col("reason").isNotNull()).select(F.col("value").alias("line"), "reason")


def quarantine_counts(good: DataFrame, bad: DataFrame) -> DataFrame:
    """``(reason, rows)``: bad rows by reason, and the good ones as ``ok``."""
    counts = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return counts.unionByName(good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("ok").alias("reason"), "rows"))


def read_untyped(spark: SparkSession, path: str | Sequence[str], header: bool = False,
                 sep: str = ",") -> DataFrame:
    """S3: all-string columns ``_c0, _c1, ...`` (no inference pass)."""
    return (spark.read.option("header", str(header).lower())
            .option("inferSchema", "false")
            .option("sep", sep)
            .csv(path))


def schema_from_catalog(spark: SparkSession, catalog_path: str,
                        type_map: Mapping[str, DataType] = TYPE_TOKENS) -> StructType:
    """Build a ``StructType`` from a ``(name, type token)`` catalog file.

    The catalog describes columns, so it has one row per column; collecting it
    is bounded by the schema width, not by the data. Lines count in the order
    of file names and, within a file, of their position.
    """
    rows = (read_untyped(spark, catalog_path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"),
                    F.col("_c0").alias("name"), F.col("_c1").alias("token"))
            .collect())
    rows.sort(key=lambda r: (r["file"], r["block"], r["pos"]))
    unknown = sorted({r["token"] for r in rows if r["token"] not in type_map}, key=str)
    if unknown:
        raise KeyError(f"unknown type token(s) in {catalog_path}: {unknown}")
    return StructType([StructField(r["name"], type_map[r["token"]], True) for r in rows])


def read_with_catalog(spark: SparkSession, catalog_path: str, data_path: str | Sequence[str],
                      type_map: Mapping[str, DataType] = TYPE_TOKENS, sep: str = ",",
                      header: bool = True) -> DataFrame:
    """Headered delimited data typed by its attribute catalog. A header
    that disagrees with the catalog fails, as columns are read by position."""
    schema = schema_from_catalog(spark, catalog_path, type_map)
    if header:
        found = read_untyped(spark, data_path, header=True, sep=sep).columns
        if found != schema.names:
            raise ValueError(f"header {found} is not the catalog's {schema.names}")
    return read_delimited(spark, data_path, schema, sep=sep, header=header)


def write_csv(df: DataFrame, path: str, single: bool = False, header: bool = False,
              sort_by: Sequence[str] | None = None, mode: str = "overwrite", sep: str = ",") -> None:
    """CSV sink.

    ``single=False`` (default) writes one part per task; with ``sort_by`` the
    frame is range-partitioned and sorted, so the parts read in name order
    are globally sorted. ``single=True`` writes one file and is meant for small
    results only: it moves every row to one task (``repartition(1)`` keeps the
    upstream stage parallel, unlike ``coalesce(1)``).
    """
    out = df
    if single:
        out = out.repartition(1)
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
    elif sort_by:
        out = out.orderBy(*sort_by)
    (out.write.mode(mode)
        .option("header", str(header).lower())
        .option("sep", sep)
        .csv(path))


def _normalise_path(c):
    return F.regexp_replace(c, r"^file:/+", "/")


def dataset_sizes(spark: SparkSession, datasets: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """``(dataset, bytes, rows)`` per named dataset, a file or a folder of files."""
    parts = []
    for name, path in datasets.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .agg(F.sum("length").alias("bytes")))
        rows = spark.read.format(fmt).load(path).select(F.count(F.lit(1))).scalar()
        parts.append(files.select(F.lit(name).alias("dataset"), F.coalesce("bytes", F.lit(0)).alias("bytes"), rows.alias("rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def inventory(spark: SparkSession, paths: str | Sequence[str], fmt: str = "text") -> DataFrame:
    """``(path, bytes, rows)`` per file.

    Sizes come from file metadata (the ``binaryFile`` source prunes the
    content column); rows are counted per input file by a distributed scan.
    ``fmt`` is ``text`` (line count) or any format ``spark.read.format`` knows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    sizes = (spark.read.format("binaryFile").load(paths)
             .select(_normalise_path(F.col("path")).alias("path"),
                     F.col("length").alias("bytes")))
    reader = spark.read.text(paths) if fmt == "text" else spark.read.format(fmt).load(paths)
    rows = (reader.select(_normalise_path(F.input_file_name()).alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("rows")))
    return (sizes.join(rows, "path", "left")
            .select("path", "bytes", F.coalesce("rows", F.lit(0)).alias("rows")))
