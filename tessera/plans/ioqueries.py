"""File-format queries: write a derived frame, read it back with the
matching reader. Files go under the shared checkpoint folder, never to a
machine-local path on a cluster."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.functions.columns import hash_key
from tessera.operators import shape, summary
from tessera.plans import frames as fr
from tessera.plans import params as P
from tessera.plans.catalog import query
from tessera.plans.sqlparts import h_sql, with_ctes
from tessera.session import scratch_path
from tessera.sources import files
from tessera.sources import fixtures as fx

TRIPLET_SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("song_id", StringType()),
    StructField("play_count", IntegerType()),
])


@query("read_delimited", with_ctes("SELECT user_id, song_id, play_count FROM clean", "clean"))
def q_read_delimited(spark, d):
    path = scratch_path(spark, "triplets-tsv")
    files.write_csv(fr.clean_triplets(spark, d), path, sep="\t")
    return files.read_delimited(spark, path, TRIPLET_SCHEMA, sep="\t")


@query("csv_roundtrip", with_ctes("SELECT * FROM ua", "ua"))
def q_csv_roundtrip(spark, d):
    """S6 with header: globally sorted parallel parts (the reference's single
    file would move every profile row through one task)."""
    path = scratch_path(spark, "user-activity")
    files.write_csv(fr.user_activity(spark, d), path, header=True, sort_by=["user_id"])
    schema = "user_id string, n_songs bigint, total_plays bigint"
    return files.read_delimited(spark, path, StructType.fromDDL(schema), sep=",", header=True)


@query("catalog_read", with_ctes("SELECT * FROM feat_raw", "feat_raw"))
def q_catalog_read(spark, d):
    base = scratch_path(spark, "features")
    catalog = f"{base}/catalog"
    data = f"{base}/data"
    rows = fx.feature_catalog_rows()
    spark.createDataFrame(rows, "name string, token string").coalesce(1).write.csv(catalog)
    files.write_csv(fx.track_features(spark, d), data, header=True)
    return files.read_with_catalog(spark, catalog, data)


@query("read_lines", with_ctes("SELECT song_id, track_id FROM line_ids", "line_ids"))
def q_read_lines(spark, d):
    path = scratch_path(spark, "mismatch-lines")
    fx.mismatch_lines(spark, d).write.text(path)
    return shape.extract_fixed(files.read_lines(spark, path), "value", fr.MISMATCH_FIELDS)


@query("read_gzip_glob", with_ctes("SELECT user_id, song_id, play_count FROM clean", "clean"))
def q_read_gzip_glob(spark, d):
    """Gzip parts named by a glob, dealt anew after the read."""
    path = scratch_path(spark, "triplets-gz")
    fr.clean_triplets(spark, d).write.option("sep", "\t").option("compression", "gzip").csv(path)
    return files.read_delimited(spark, f"{path}/part-*.csv.gz", TRIPLET_SCHEMA, sep="\t",
                                partitions=spark.sparkContext.defaultParallelism)


_TOKEN_SQL = "CASE WHEN p_size % 3 = 0 THEN 'NUMERIC' WHEN p_size % 3 = 1 THEN 'real' ELSE 'string' END"


@query("catalog_tokens", f"SELECT DISTINCT {_TOKEN_SQL} AS token FROM part")
def q_catalog_tokens(spark, d):
    """S3 + S5 + A15: the distinct type tokens over many catalog files, one line
    per part, written by Spark in one folder per brand."""
    path = scratch_path(spark, "catalogs")
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, "NUMERIC").when(size % 3 == 1, "real").otherwise("string")
    lines = fx.table(spark, d, "part").select("p_brand", F.col("p_name"), kind.alias("token"))
    lines.write.partitionBy("p_brand").csv(path)
    tokens = files.read_untyped(spark, f"{path}/p_brand=*").select(F.col("_c1").alias("token"))
    return summary.distinct_values(tokens, "token")


_LEVEL_SQL = f"('0x' || substr({h_sql(['user_id', 'song_id'], P.SCORE_SEED)}, 1, 2))::BIGINT"
_FAULT_SQL = ("SELECT *, CASE WHEN lv < 8 THEN 'missing field' WHEN lv < 16 THEN 'extra field' WHEN lv < 24 THEN 'unparsable play_count' "
              f"ELSE 'ok' END AS reason FROM (SELECT *, {_LEVEL_SQL} AS lv FROM clean)")


def _faulty(spark, d):
    """Triplet files in which some lines lack a field, have one too many or no number, or an empty one."""
    level = F.conv(F.substring(hash_key(["user_id", "song_id"], P.SCORE_SEED), 1, 2), 16, 10).cast("bigint")
    sep, count = F.lit("\t"), F.col("play_count").cast("string")
    pair = F.concat("user_id", sep, "song_id")
    line = (F.when(level < 8, pair).when(level < 16, F.concat(pair, sep, count, sep, F.lit("1")))
            .when(level < 24, F.concat(pair, sep, F.lit("x"), count)).when(level < 32, F.concat(pair, sep))
            .otherwise(F.concat(pair, sep, count)))
    path = scratch_path(spark, "faulty-triplets")
    fr.clean_triplets(spark, d).select(line.alias("value")).write.text(path)
    return files.read_quarantined(spark, path, TRIPLET_SCHEMA)


@query("quarantine_counts", with_ctes(f"SELECT reason, count(*) AS rows FROM ({_FAULT_SQL}) GROUP BY reason", "clean"))
def q_quarantine_counts(spark, d):
    return files.quarantine_counts(*_faulty(spark, d))


@query("quarantine_good", with_ctes(
    "SELECT user_id, song_id, CASE WHEN lv >= 32 THEN play_count END AS play_count "
    f"FROM ({_FAULT_SQL}) WHERE reason = 'ok'", "clean"))
def q_quarantine_good(spark, d):
    return _faulty(spark, d)[0]


@query("inventory")
def q_inventory(spark, d):
    return files.dataset_sizes(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in fx.TABLES})


@query("inventory_rows", " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}" for t in fx.TABLES))
def q_inventory_rows(spark, d):
    return q_inventory(spark, d).select("dataset", "rows")
