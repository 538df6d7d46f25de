"""I/O queries: text scrub, CSV round trip, development subset, curated layer."""

from __future__ import annotations

from lendscope.constants import DEFAULT_STATUSES, ZERO_BAL_STATUSES, ZERO_COLL_STATUSES
from lendscope.functions.text import scrub_ascii
from lendscope.operators.columns import rename_positional
from lendscope.operators.rows import dev_subset, preview
from lendscope.plans import curate
from lendscope.plans.catalog import register
from lendscope.session import scratch_path
from lendscope.sources import loans_csv
from lendscope.sources.fixtures import LOANS_SCHEMA, loans_view, with_loans
from lendscope.sources.tables import is_folder, read_table, table_path

_BLANKS = ("[\\x{09}\\x{0B}\\x{0C}\\x{1C}-\\x{1F}\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
           "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+")


@register("scrub_ascii", f"""
SELECT doc_id, array_to_string(list_transform(string_split_regex(text, '\\r\\n|\\r|\\n'),
         lambda l: regexp_replace(trim(regexp_replace(l, '{_BLANKS}', ' ', 'g')), '[^\\x{{00}}-\\x{{7F}}]', '', 'g')),
         chr(10)) AS clean_text
FROM documents
""")
def scrub_ascii_q(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", scrub_ascii("text").alias("clean_text"))


@register("csv_round_trip", with_loans("SELECT * FROM loans"))
def csv_round_trip(spark, sf_dir):
    """Write the loan view as CSV (parallel, header) and read it back with a declared schema."""
    path = scratch_path(spark, "csv_round_trip")
    loans_csv.write_layer(loans_view(spark, sf_dir), path, fmt="csv")
    schema = loans_csv.typed_schema(LOANS_SCHEMA)
    return loans_csv.read_loans(spark, path, schema=schema)


@register("dev_subset", with_loans("""
SELECT * FROM loans
WHERE CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':0'), 1, 8)) AS BIGINT) % 100 < 10
"""))
def dev_subset_q(spark, sf_dir):
    return dev_subset(loans_view(spark, sf_dir), "id", percent=10, seed=0)


@register("top_loans", with_loans("""
SELECT id, loan_amnt, grade, addr_state FROM loans ORDER BY loan_amnt DESC, id LIMIT 20
"""))
def top_loans(spark, sf_dir):
    """The largest loans: a top-n, where the limit is the feature."""
    loans = loans_view(spark, sf_dir).select("id", "loan_amnt", "grade", "addr_state")
    return preview(loans, 20, [loans["loan_amnt"].desc(), loans["id"]])


def _listed(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_CURATED_SQL = f"""
SELECT id, coalesce(CASE WHEN isnan(loan_amnt) THEN NULL ELSE loan_amnt END, 0.0) AS loan_amnt,
       coalesce(CASE WHEN isnan(int_rate) THEN NULL ELSE int_rate END, 0.0) AS int_rate,
       grade, sub_grade, addr_state, dti, delinq_2yrs,
       coalesce(CASE WHEN isnan(annual_inc) THEN NULL ELSE annual_inc END, 0.0) AS annual_inc,
       desc_text, purpose,
       coalesce(TRY_CAST(string_split(issue_d, '-')[2] AS INTEGER), 0) AS issue_d_year,
       coalesce(TRY_CAST(trim(regexp_replace(emp_length, 'years|year|\\+|\\<', '', 'g')) AS INTEGER), 0)
         AS emplength_clean,
       coalesce(TRY_CAST(regexp_extract(term, '\\d+', 0) AS INTEGER), 0) AS term_clean,
       coalesce(CASE WHEN tot_coll_amt IS NULL AND loan_status IN ({_listed(ZERO_COLL_STATUSES)}) THEN 0.0
            ELSE TRY_CAST(tot_coll_amt AS DOUBLE) END, 0.0) AS tot_coll_amt_clean,
       coalesce(CASE WHEN tot_cur_bal IS NULL AND loan_status IN ({_listed(ZERO_BAL_STATUSES)}) THEN 0.0
            ELSE TRY_CAST(tot_cur_bal AS DOUBLE) END, 0.0) AS tot_cur_bal_clean,
       CASE WHEN loan_status IN ({_listed(DEFAULT_STATUSES)}) THEN 1 ELSE 0 END AS target
FROM loans
WHERE regexp_matches(dti, '[0-9]+') AND regexp_matches(delinq_2yrs, '[0-9]+')
  AND regexp_matches(addr_state, '^[A-Z]{{0,3}}$')
"""


@register("curated_loans", with_loans(_CURATED_SQL))
def curated_loans(spark, sf_dir):
    return curate.curate(loans_view(spark, sf_dir))


@register("curated_layer_round_trip", with_loans(_CURATED_SQL))
def curated_layer_round_trip(spark, sf_dir):
    """Write the curated layer as Parquet partitioned by issue year and read it back.

    A later filter on ``issue_d_year`` reads only that year's folder (partition pruning).
    """
    path = scratch_path(spark, "curated")
    loans_csv.write_layer(curate.curate(loans_view(spark, sf_dir)), path, partition_by=["issue_d_year"])
    return spark.read.parquet(path)


@register("single_file_export", with_loans("SELECT grade, count(*) AS n FROM loans GROUP BY 1"))
def single_file_export(spark, sf_dir):
    """Loans per grade exported as one CSV file and read back."""
    path = scratch_path(spark, "single_file")
    counts = loans_view(spark, sf_dir).groupBy("grade").count().withColumnRenamed("count", "n")
    loans_csv.export_single_csv(counts, path)
    return loans_csv.read_loans(spark, path, schema=counts.schema, corrupt_col="none")


@register("sql_over_view", with_loans("""
SELECT addr_state AS state, count(*) AS n, round(avg(loan_amnt), 6) AS mean_amnt
FROM loans WHERE int_rate > 15 GROUP BY addr_state
"""))
def sql_over_view(spark, sf_dir):
    """SQL text over the loans registered as a view, then columns renamed by position."""
    loans_csv.register_view(loans_view(spark, sf_dir), "loans_sql")
    out = spark.sql("SELECT addr_state, count(*), round(avg(loan_amnt), 6) FROM loans_sql WHERE int_rate > 15 GROUP BY addr_state")
    return rename_positional(out, ["state", "n", "mean_amnt"])


@register("stream_valid_rows", with_loans("""
SELECT id, dti, delinq_2yrs, addr_state FROM loans
WHERE regexp_matches(dti, '[0-9]+') AND regexp_matches(delinq_2yrs, '[0-9]+')
  AND regexp_matches(addr_state, '^[A-Z]{0,3}$')
"""))
def stream_valid_rows(spark, sf_dir):
    """The orders table read as a file stream, joined to customer (stream-static),
    tagged by the row rules and split into valid / quarantined sinks; returns the
    valid sink read back."""
    from lendscope.sources.fixtures import loans_from
    from lendscope.streaming.clean_stream import tag_rows, write_valid_and_rejects

    orders_schema = read_table(spark, sf_dir, "orders").schema
    # A file stream source watches a folder: the table's own, or the one its single file lies in.
    stream = spark.readStream.schema(orders_schema)
    path = table_path(sf_dir, "orders")
    if is_folder(spark, path):
        orders = stream.parquet(path)
    else:
        orders = stream.option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    tagged = tag_rows(loans_from(orders, read_table(spark, sf_dir, "customer")))
    base = scratch_path(spark, "stream")
    q = write_valid_and_rejects(tagged, f"{base}/valid", f"{base}/rejects", f"{base}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/valid").select("id", "dti", "delinq_2yrs", "addr_state")
