"""Sources and sinks on temporary files."""

import gzip
import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.sources import files

SCHEMA = StructType([StructField("user", StringType()), StructField("item", StringType()),
                     StructField("plays", IntegerType())])


def test_read_delimited_is_permissive(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.tsv")
    with open(path, "w") as f:
        f.write("u1\ts1\t3\nu2\ts2\tnotanint\nu3\ts3\n")
    rows = sorted(files.read_delimited(spark, path, SCHEMA).collect())
    assert rows[0]["plays"] == 3
    assert rows[1]["plays"] is None and rows[2]["plays"] is None


def test_gzip_and_glob(spark, tmp_dir):
    for i in range(2):
        with gzip.open(os.path.join(tmp_dir, f"part-{i}.tsv.gz"), "wt") as f:
            f.write(f"u{i}\ts{i}\t{i}\n")
    df = files.read_delimited(spark, os.path.join(tmp_dir, "part-*.tsv.gz"), SCHEMA)
    assert df.count() == 2


def test_read_lines_and_untyped(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.txt")
    with open(path, "w") as f:
        f.write("a,NUMERIC\nb,string\n")
    assert files.read_lines(spark, path).columns == ["value"]
    assert files.read_untyped(spark, path).columns == ["_c0", "_c1"]


def test_catalog_read_and_unknown_token(spark, tmp_dir):
    cat = os.path.join(tmp_dir, "cat.csv")
    data = os.path.join(tmp_dir, "data.csv")
    with open(cat, "w") as f:
        f.write("x,NUMERIC\ny,real\nid,STRING\n")
    with open(data, "w") as f:
        f.write("x,y,id\n1.5,2,'a'\n3,4.25,'b'\n")
    df = files.read_with_catalog(spark, cat, data)
    assert [t.simpleString() for t in [f.dataType for f in df.schema]] == ["double", "double", "string"]
    assert sorted(r["y"] for r in df.collect()) == [2.0, 4.25]
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(bad, "w") as f:
        f.write("x,INTEGER\n")
    with pytest.raises(KeyError, match="INTEGER"):
        files.schema_from_catalog(spark, bad)


def test_write_csv_single_sorted_with_header(spark, tmp_dir):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, v int")
    out = os.path.join(tmp_dir, "out")
    files.write_csv(df, out, single=True, header=True, sort_by=["k"])
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0])) as f:
        assert f.read().splitlines() == ["k,v", "a,1", "b,2", "c,3"]


def test_inventory_counts_lines_and_bytes(spark, tmp_dir):
    p1 = os.path.join(tmp_dir, "a.txt")
    with open(p1, "w") as f:
        f.write("1\n2\n3")            # no final newline: still 3 lines for Spark
    inv = files.inventory(spark, [p1]).collect()
    assert inv[0]["rows"] == 3 and inv[0]["bytes"] == os.path.getsize(p1)


def test_rows_are_dealt_anew_only_on_request(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines")
    spark.range(100).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.text(path)
    assert files.read_lines(spark, path).rdd.getNumPartitions() == 1
    wide = files.read_lines(spark, path, partitions=7)
    assert wide.rdd.getNumPartitions() == 7 and wide.count() == 100


def test_catalog_order_follows_file_names_and_header_must_agree(spark, tmp_dir):
    cat, data = os.path.join(tmp_dir, "cat"), os.path.join(tmp_dir, "data.csv")
    os.mkdir(cat)
    for name, lines in (("b.csv", "y,real\nz,string\n" * 1), ("a.csv", "x,STRING\n")):
        with open(os.path.join(cat, name), "w") as f:
            f.write(lines)
    with open(data, "w") as f:
        f.write("x,y,z\nq,1.5,w\n")
    row = files.read_with_catalog(spark, cat, data).first()
    assert (row["x"], row["y"], row["z"]) == ("q", 1.5, "w")
    with open(data, "w") as f:
        f.write("x,z,y\nq,w,1.5\n")
    with pytest.raises(ValueError):
        files.read_with_catalog(spark, cat, data)


def test_dataset_sizes_of_folders(spark, tmp_dir):
    one, two = os.path.join(tmp_dir, "one.parquet"), os.path.join(tmp_dir, "two.parquet")
    spark.range(10).repartition(3).write.parquet(one)
    spark.range(0).write.parquet(two)
    got = {r["dataset"]: (r["bytes"] > 0, r["rows"]) for r in files.dataset_sizes(spark, {"one": one, "two": two}).collect()}
    assert got["one"] == (True, 10) and got["two"][1] == 0
