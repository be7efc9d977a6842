"""Analogues of the reference's inputs, derived by Spark from the shared tables.

Each builder reads the parquet tables under ``sf_dir`` and returns a lazy
DataFrame, so its work grows with the data. Next to each builder is its DuckDB
twin (``*_SQL``), which the query catalog composes into oracle queries.

| reference input      | analogue                                                     |
|----------------------|--------------------------------------------------------------|
| play-count triplets  | orders ⋈ lineitem summed per (customer, part)                |
| mismatch text lines  | fixed-position lines of all parts, small ones marked as errors |
| accepted text lines  | same, prefixed ``< ``, plus noise lines the prefix filter drops |
| track features       | part attributes plus lineitem aggregates per part            |
| genre labels         | part brand per track                                         |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FEATURES = ("f_lines", "f_quantity", "f_revenue", "f_discount", "f_tax", "f_price", "f_size", "f_key")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _user_id(c):
    return F.concat(F.lit("U"), F.lpad(c.cast("string"), 9, "0"))


def _song_id(c):
    return F.concat(F.lit("SO"), F.lpad(c.cast("string"), 16, "0"))


def _track_id(c):
    return F.concat(F.lit("TR"), F.lpad(c.cast("string"), 16, "0"))


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, song_id, play_count)``, unique on (user_id, song_id).

    Aggregates on the numeric keys and formats the string ids afterwards, so
    the shuffle hashes longs rather than strings.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy("o_custkey", "l_partkey")
            .agg(F.sum("l_quantity").cast("int").alias("play_count"))
            .select(_user_id(F.col("o_custkey")).alias("user_id"),
                    _song_id(F.col("l_partkey")).alias("song_id"),
                    "play_count"))


TRIPLETS_SQL = """
SELECT 'U' || lpad(CAST(o.o_custkey AS VARCHAR), 9, '0') AS user_id,
       'SO' || lpad(CAST(l.l_partkey AS VARCHAR), 16, '0') AS song_id,
       CAST(sum(l.l_quantity) AS INTEGER) AS play_count
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, l.l_partkey
"""


def mismatch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``ERROR: <SONG TRACK> name`` of small parts and ``CHECK: <...``
    of all others: song id at 9 (18), track at 27 (19)."""
    part = table(spark, sf_dir, "part")
    head = F.when(F.col("p_size") <= 3, "ERROR: <").otherwise("CHECK: <")
    return part.select(F.concat(head, _song_id(F.col("p_partkey")), F.lit(" "),
                                _track_id(F.col("p_partkey")), F.lit("> "),
                                F.col("p_name")).alias("value"))


MISMATCH_LINES_SQL = """
SELECT CASE WHEN p_size <= 3 THEN 'ERROR: <' ELSE 'CHECK: <' END
       || 'SO' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') || ' '
       || 'TR' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') || '> ' || p_name AS value
FROM part
"""


def accepted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ``< ERROR: <SONG TRACK>`` (ids at 11 and 29) for small parts of
    size 3 or 4, and ``# name`` noise lines for all other parts."""
    part = table(spark, sf_dir, "part")
    accepted = F.concat(F.lit("< ERROR: <"), _song_id(F.col("p_partkey")), F.lit(" "),
                        _track_id(F.col("p_partkey")), F.lit(">"))
    noise = F.concat(F.lit("# "), F.col("p_name"))
    return part.select(F.when((F.col("p_type") == "SMALL") & F.col("p_size").between(3, 4), accepted).otherwise(noise).alias("value"))


ACCEPTED_LINES_SQL = """
SELECT CASE WHEN p_type = 'SMALL' AND p_size BETWEEN 3 AND 4
            THEN '< ERROR: <' || 'SO' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') || ' '
                 || 'TR' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') || '>'
            ELSE '# ' || p_name END AS value
FROM part
"""


def track_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: a quoted ``track_id`` and eight double features.

    Lineitem is aggregated per part before the join (partial aggregation, so a
    hot part does not skew the shuffle); parts without lines get zeros. Sums
    of two-decimal prices are rounded to two decimals so every engine agrees.
    """
    lines = (table(spark, sf_dir, "lineitem")
             .select("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
             .groupBy("l_partkey")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum("l_quantity").alias("q"),
                  F.round(F.sum("l_extendedprice"), 2).alias("rev"),
                  F.round(F.sum("l_discount"), 2).alias("disc"),
                  F.round(F.sum("l_tax"), 2).alias("tax")))
    part = table(spark, sf_dir, "part")
    j = part.join(lines, part.p_partkey == lines.l_partkey, "left")
    zero = F.lit(0.0)
    return j.select(
        F.concat(F.lit('"'), _track_id(F.col("p_partkey")), F.lit('"')).alias("track_id"),
        F.coalesce(F.col("n").cast("double"), zero).alias("f_lines"),
        F.coalesce(F.col("q"), zero).alias("f_quantity"),
        F.coalesce(F.col("rev"), zero).alias("f_revenue"),
        F.coalesce(F.col("disc"), zero).alias("f_discount"),
        F.coalesce(F.col("tax"), zero).alias("f_tax"),
        F.col("p_retailprice").alias("f_price"),
        F.col("p_size").cast("double").alias("f_size"),
        F.col("p_partkey").cast("double").alias("f_key"),
    )


TRACK_FEATURES_SQL = """
SELECT '"' || 'TR' || lpad(CAST(p.p_partkey AS VARCHAR), 16, '0') || '"' AS track_id,
       coalesce(CAST(a.n AS DOUBLE), 0.0) AS f_lines,
       coalesce(a.q, 0.0) AS f_quantity,
       coalesce(a.rev, 0.0) AS f_revenue,
       coalesce(a.disc, 0.0) AS f_discount,
       coalesce(a.tax, 0.0) AS f_tax,
       p.p_retailprice AS f_price,
       CAST(p.p_size AS DOUBLE) AS f_size,
       CAST(p.p_partkey AS DOUBLE) AS f_key
FROM part p LEFT JOIN (
    SELECT l_partkey, count(*) AS n, sum(l_quantity) AS q,
           round(sum(l_extendedprice), 2) AS rev, round(sum(l_discount), 2) AS disc,
           round(sum(l_tax), 2) AS tax
    FROM lineitem GROUP BY l_partkey) a ON p.p_partkey = a.l_partkey
"""


def genre_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(track_id, genre)``: the brand of each part (25 classes)."""
    part = table(spark, sf_dir, "part")
    return part.select(_track_id(F.col("p_partkey")).alias("track_id"), F.col("p_brand").alias("genre"))


GENRE_LABELS_SQL = """
SELECT 'TR' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS track_id, p_brand AS genre FROM part
"""


def feature_catalog_rows() -> list[tuple[str, str]]:
    """Attribute catalog of ``track_features``: (column name, type token)."""
    tokens = ["NUMERIC", "real"]
    rows = [("track_id", "string")]
    rows += [(name, tokens[i % 2]) for i, name in enumerate(FEATURES)]
    return rows
