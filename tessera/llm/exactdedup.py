"""Exact dedup in DataFrame operations only.

Texts are equal when they are identical after white space is deleted. Rows are
grouped by the 128-bit hash of that text together with the text itself, so the
aggregation compares the bytes of every row with its group and a collision of
hashes cannot merge two texts. Copies collapse in each task before the shuffle,
which leaves one text per group and task; every text is moved once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, pin, text_of


def normalised(text: Column) -> Column:
    """The text without any white space character."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _rows(docs: DataFrame, id_col: str, text_col: str, content_hash: Callable[[Column], Column]) -> DataFrame:
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), F.char_length(text).alias("points"),
                       normalised(text).alias("norm"))
    return rows.withColumn("hash", content_hash(F.col("norm")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256``.

    The row with the most code points in its original text stays, then the
    smallest id; a null id comes after all others. Null texts count as empty,
    and all texts without a visible character are equal. Rows that repeat both
    the id and the length of the row that stays cannot be told from it and are
    all marked ``kept``; ``exact_dedup`` returns one of them. Columns beside
    the two named ones are not read. No rows give no rows.
    """
    rows = _rows(docs, id_col, text_col, content_hash)
    order = F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    classes = rows.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("first"))
    # The text goes no further. A hash names a class unless several texts share it.
    named = pin(classes.select("hash", F.struct("size", "first", F.sha2("norm", 256).alias("sha")).alias("c"))
                .groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.min("c").alias("c")))
    found = rows.select("id", "points", "hash").join(named.where("texts = 1"), "hash").select("id", "points", "c")
    clash = named.where("texts > 1").select("hash")
    if not clash.isEmpty():  # such texts find their class by their bytes
        hit = rows.join(clash, "hash", "left_semi")
        exact = (hit.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("first"))
                 .select("hash", "norm", F.struct("size", "first", F.sha2("norm", 256).alias("sha")).alias("c")))
        found = found.unionByName(hit.join(exact, ["hash", "norm"]).select("id", "points", "c"))
    c = F.col("c")
    return found.select(
        "id", c["first"]["id"].alias("keep_id"), c["size"].alias("group_size"),
        (F.col("id").eqNullSafe(c["first"]["id"]) & (F.col("points") == -c["first"]["points"])).alias("kept"),
        c["sha"].alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """The row of each group that stays, with all its columns and their names;
    of identical rows, one. Nulls and ties as in ``exact_groups``; rows tied on
    length and id are ordered by their other columns."""
    names = docs.columns
    text = text_of(docs, text_col)
    order = F.struct((-F.char_length(text)).alias("points"), docs[id_col].isNull().alias("none"),
                     docs[id_col].alias("id"),
                     F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("row"))
    rows = docs.select(normalised(text).alias("norm"), order.alias("o"))
    best = (rows.groupBy(content_hash(F.col("norm")).alias("hash"), "norm").agg(F.min("o").alias("o")))
    return best.select(*[F.col(f"o.row.c{i}").alias(c) for i, c in enumerate(names)])
