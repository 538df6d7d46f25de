"""CSV reading edge cases, round trips, the text scrub job."""

import os

from pyspark.sql import functions as F

from lendscope.sources import loans_csv


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_quoting_and_corrupt_records(spark, tmp_dir):
    text = ('id,title,amount\n'
            '1,"a, b",10\n'
            '2,"line one\nline two",20\n'
            '3,"say ""hi""",30\n'
            '4,plain "inner" quotes,40\n'
            '5,"unescaped "quote", and comma",50\n'
            '6,too,many,fields\n'
            '7,few\n')
    path = os.path.join(tmp_dir, "loans", "part.csv")
    _write(path, text)
    schema = loans_csv.typed_schema([("id", "int"), ("title", "string"), ("amount", "int")],
                                    corrupt_col=loans_csv.CORRUPT_COL)
    df = loans_csv.read_loans(spark, os.path.dirname(path), schema=schema, multiline=True).cache()
    rows = {r.id: r for r in df.collect()}
    assert rows[1].title == "a, b" and rows[1].amount == 10
    assert rows[2].title == "line one\nline two"
    assert rows[3].title == 'say "hi"'
    assert rows[4].title == 'plain "inner" quotes' and rows[4].amount == 40
    for bad in (5, 6, 7):
        assert rows[bad][loans_csv.CORRUPT_COL] is not None, bad
    for good in (1, 2, 3, 4):
        assert rows[good][loans_csv.CORRUPT_COL] is None, good


def test_csv_round_trip_keeps_blanks_nulls_and_empties(spark, tmp_dir):
    df = spark.createDataFrame([(1, " 36 months", "", None, float("nan")), (2, "x", None, "y", 1.5)],
                               "id int, term string, e string, n string, d double")
    path = os.path.join(tmp_dir, "rt")
    loans_csv.write_layer(df, path, fmt="csv")
    back = loans_csv.read_loans(spark, path, schema=df.schema, corrupt_col="none").orderBy("id").collect()
    assert back[0].term == " 36 months" and back[0].e == "" and back[0].n is None
    assert back[0].d != back[0].d  # NaN survives
    assert back[1].e is None and back[1].n == "y" and back[1].d == 1.5


def test_single_file_export(spark, tmp_dir):
    df = spark.range(100).withColumn("v", F.col("id") * 2).repartition(4)
    path = os.path.join(tmp_dir, "single")
    loans_csv.export_single_csv(df, path)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    assert spark.read.option("header", True).csv(path).count() == 100


def test_scrub_text_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw", "f.txt")
    _write(src, "héllo   wörld\n\tx y  \n\U0001F600\n")
    dst = os.path.join(tmp_dir, "clean")
    loans_csv.scrub_text_files(spark, os.path.dirname(src), dst)
    got = [r.value for r in spark.read.text(dst).collect()]
    expected = [" ".join(line.split()).encode("ascii", "ignore").decode()
                for line in open(src, encoding="utf-8").read().splitlines()]
    assert sorted(got) == sorted(expected)
    assert "hllo wrld" in got and "x y" in got


def test_partitioned_layer_prunes(spark, tmp_dir):
    df = spark.range(1000).withColumn("year", (F.col("id") % 5 + 2010).cast("int"))
    path = os.path.join(tmp_dir, "layer")
    loans_csv.write_layer(df, path, partition_by=["year"])
    sub = spark.read.parquet(path).where(F.col("year") == 2012)
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2012" in plan
    assert sub.count() == 200


def test_partitioned_write_is_rebalanced(spark, tmp_dir):
    """Many input partitions, one hot year: few files per year folder, every row written."""
    import glob

    n = 20000
    df = spark.range(0, n, numPartitions=40).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(2016)).otherwise(2010 + F.col("id") % 5).alias("year"))
    path = os.path.join(tmp_dir, "rebalanced")
    loans_csv.write_layer(df, path, partition_by=["year"])
    back = spark.read.parquet(path)
    assert back.count() == n
    for folder in glob.glob(os.path.join(path, "year=*")):
        assert len(glob.glob(os.path.join(folder, "*.parquet"))) <= 2, folder


def test_splittable_read_sends_broken_records_to_corrupt_column(spark, tmp_dir):
    text = ('id,title,amount\n'
            '1,"a, b",10\n'
            '2,"line one\nline two",20\n'
            '3,plain,30\n')
    path = os.path.join(tmp_dir, "split", "part.csv")
    _write(path, text)
    schema = loans_csv.typed_schema([("id", "int"), ("title", "string"), ("amount", "int")],
                                    corrupt_col=loans_csv.CORRUPT_COL)
    rows = loans_csv.read_loans(spark, os.path.dirname(path), schema=schema, multiline=False).cache().collect()
    good = {r.id: r.title for r in rows if r[loans_csv.CORRUPT_COL] is None}
    broken = [r[loans_csv.CORRUPT_COL] for r in rows if r[loans_csv.CORRUPT_COL] is not None]
    assert good == {1: "a, b", 3: "plain"}
    assert len(broken) == 2 and any("line one" in b for b in broken)


def test_inferred_types(spark, tmp_dir):
    """Types by inference: a column of numbers with one odd value is text, as with the notebook's read."""
    rows = [(1, 2.5, "7", "Dec-2015"), (2, None, "n/a", "Jan-2016")]
    loans_csv.write_layer(spark.createDataFrame(rows, "id int, rate double, dti string, issue_d string"), tmp_dir + "/inferred", fmt="csv")
    back = loans_csv.read_loans(spark, tmp_dir + "/inferred", infer=True)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["int", "double", "string", "string"]
    assert sorted(map(tuple, back.collect())) == rows
