"""The row rules on a file stream; valid + quarantined = input, batches idempotent."""

import os

from lendscope.sources.loans_csv import text_schema
from lendscope.streaming.clean_stream import loan_stream, tag_rows, write_valid_and_rejects


def test_file_stream_split(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    header = "id,dti,delinq_2yrs,addr_state,issue_d,emp_length,term,loan_status,tot_coll_amt,tot_cur_bal\n"
    lines = [
        "1,12.5,0,CA,Dec-2015,10+ years, 36 months,Charged Off,,",
        "2,x,0,CA,Jan-2016,1 year, 60 months,Current,5,6",
        "3,7,OWN,NY,Feb-2016,n/a, 36 months,Fully Paid,,",
        "4,3,1,,Mar-2016,< 1 year, 36 months,Default,1,2",
    ]
    for i, chunk in enumerate([lines[:2], lines[2:]]):
        with open(os.path.join(src, f"part{i}.csv"), "w") as fh:
            fh.write(header + "\n".join(chunk) + "\n")
    schema = text_schema(header.strip().split(","), corrupt_col=None)
    tagged = tag_rows(loan_stream(spark, src, schema, max_files_per_trigger=1))
    out = os.path.join(tmp_dir, "out")
    q = write_valid_and_rejects(tagged, f"{out}/valid", f"{out}/rejects", f"{out}/_ckpt")
    q.awaitTermination()
    valid = spark.read.parquet(f"{out}/valid")
    rejects = spark.read.parquet(f"{out}/rejects")
    # an empty unquoted CSV field is NULL, so loan 4 fails the state rule as NULL
    assert sorted(r.id for r in valid.collect()) == ["1"]
    assert {r.id: r.reject_reason for r in rejects.collect()} == {
        "2": "dti:pattern", "3": "delinq_2yrs:pattern", "4": "addr_state:null"}
    row1 = [r for r in valid.collect() if r.id == "1"][0]
    assert (row1.target, row1.emplength_clean, row1.tot_coll_amt_clean) == (1, 10, 0.0)


def test_defaults_by_event_time_window(spark, tmp_dir):
    """Loans and defaults per 30-day issue window on a file stream (memory sink, complete mode)."""
    from pyspark.sql import functions as F

    from lendscope.functions.parse import issue_date
    from lendscope.streaming.clean_stream import defaults_by_window

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    header = "id,dti,delinq_2yrs,addr_state,issue_d,emp_length,term,loan_status,tot_coll_amt,tot_cur_bal\n"
    rows = ["1,1,0,CA,Jan-2016,1 year, 36 months,Charged Off,1,1",
            "2,1,0,CA,Jan-2016,1 year, 36 months,Current,1,1",
            "3,1,0,CA,Jun-2016,1 year, 36 months,Default,1,1"]
    with open(os.path.join(src, "part0.csv"), "w") as fh:
        fh.write(header + "\n".join(rows) + "\n")
    schema = text_schema(header.strip().split(","), corrupt_col=None)
    tagged = tag_rows(loan_stream(spark, src, schema)).withColumn(
        "issued", issue_date("issue_d").cast("timestamp"))
    q = (defaults_by_window(tagged, "issued").writeStream.outputMode("complete").format("memory")
         .queryName("defaults_by_window_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.window_start.month, r.n_loans, r.n_defaults)
           for r in spark.table("defaults_by_window_test").where(F.col("n_loans") > 0).collect()}
    assert sum(n for _, n, _ in got) == 3
    assert sum(d for _, _, d in got) == 2


def test_retried_batch_replaces_its_output(spark, tmp_dir):
    from lendscope.streaming.clean_stream import write_split_batch
    batch = spark.createDataFrame([("1", None), ("2", "dti:pattern"), ("3", None)], "id string, reject_reason string")
    valid, rejects = os.path.join(tmp_dir, "v"), os.path.join(tmp_dir, "r")
    for _ in range(2):                      # the same batch id written twice, as after a retry
        write_split_batch(batch, 7, valid, rejects)
    write_split_batch(batch.where("id = '3'"), 8, valid, rejects)
    got = sorted((r.id, r.batch_id) for r in spark.read.parquet(valid).collect())
    assert got == [("1", 7), ("3", 7), ("3", 8)]
    assert [r.id for r in spark.read.parquet(rejects).collect()] == ["2"]


def test_stream_reads_a_table_that_is_a_folder(spark, tmp_dir):
    from __spark_entry__ import queries
    from tests.conftest import SF001
    for table in ("orders", "customer"):
        spark.read.parquet(f"{SF001}/{table}.parquet").repartition(3).write.parquet(f"{tmp_dir}/sf/{table}.parquet")
    query = queries()["stream_valid_rows"]
    assert sorted(query(spark, f"{tmp_dir}/sf").collect()) == sorted(query(spark, SF001).collect())
