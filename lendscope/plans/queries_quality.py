"""Row-rule, quarantine and column-quality queries over the loan view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope.constants import REDUNDANT_DROP_STEP1, SPARSE_DROP_STEP1
from lendscope.operators import columns, quality, replicas
from lendscope.plans.catalog import register
from lendscope.sources.fixtures import LOANS_SCHEMA, loans_view, sql_is_missing, with_loans

_NUMERIC = ("bigint", "double", "int")
_CATEGORY_COLS = ("loan_status", "grade", "sub_grade", "emp_length", "term", "purpose", "addr_state")


@register("keep_valid_rows", with_loans("""
SELECT id, dti, delinq_2yrs, addr_state FROM loans
WHERE regexp_matches(dti, '[0-9]+') AND regexp_matches(delinq_2yrs, '[0-9]+')
  AND regexp_matches(addr_state, '^[A-Z]{0,3}$')
"""))
def keep_valid_rows(spark, sf_dir):
    return quality.keep_matching(loans_view(spark, sf_dir)).select("id", "dti", "delinq_2yrs", "addr_state")


@register("reject_view_dti", with_loans("""
SELECT * FROM loans WHERE NOT regexp_matches(dti, '[0-9]+')
"""))
def reject_view_dti(spark, sf_dir):
    return quality.keep_matching(loans_view(spark, sf_dir), [("dti", "[0-9]+")], negate=True)


@register("quarantine_rows", with_loans("""
SELECT id, CASE
  WHEN dti IS NULL THEN 'dti:null' WHEN NOT regexp_matches(dti, '[0-9]+') THEN 'dti:pattern'
  WHEN delinq_2yrs IS NULL THEN 'delinq_2yrs:null'
  WHEN NOT regexp_matches(delinq_2yrs, '[0-9]+') THEN 'delinq_2yrs:pattern'
  WHEN addr_state IS NULL THEN 'addr_state:null'
  WHEN NOT regexp_matches(addr_state, '^[A-Z]{0,3}$') THEN 'addr_state:pattern' END AS reject_reason
FROM loans
WHERE NOT (coalesce(regexp_matches(dti, '[0-9]+'), false) AND coalesce(regexp_matches(delinq_2yrs, '[0-9]+'), false)
           AND coalesce(regexp_matches(addr_state, '^[A-Z]{0,3}$'), false))
"""))
def quarantine_rows(spark, sf_dir):
    return quality.quarantine(loans_view(spark, sf_dir)).select("id", "reject_reason")


@register("charged_off_rows", with_loans("""
SELECT * FROM loans WHERE loan_status = 'Charged Off'
"""))
def charged_off_rows(spark, sf_dir):
    return loans_view(spark, sf_dir).where(F.col("loan_status") == "Charged Off")


@register("sparsity_within", with_loans("""
SELECT count(loan_status) AS n_rows,
       count(*) FILTER (WHERE settlement_status IS NULL AND loan_status IS NOT NULL) AS n_missing,
       round(1.0 - count(*) FILTER (WHERE settlement_status IS NULL AND loan_status IS NOT NULL)
             / count(loan_status), 6) AS filled_share
FROM loans WHERE loan_status = 'Charged Off'
"""))
def sparsity_within(spark, sf_dir):
    return quality.sparsity_within(loans_view(spark, sf_dir), F.col("loan_status") == "Charged Off",
                                   "settlement_status", "loan_status")


def _census_sql():
    parts = [f"SELECT {i} AS position, '{n}' AS column_name, "
             f"count(*) FILTER (WHERE {sql_is_missing(n, t)}) AS n_missing FROM loans"
             for i, (n, t) in enumerate(LOANS_SCHEMA)]
    return with_loans("\nUNION ALL\n".join(parts))


@register("missing_census", _census_sql())
def missing_census(spark, sf_dir):
    return quality.missing_census(loans_view(spark, sf_dir))


def _profile_parts():
    parts = []
    for i, (n, t) in enumerate(LOANS_SCHEMA):
        miss = f"count(*) FILTER (WHERE {sql_is_missing(n, t)})"
        if t in _NUMERIC:
            x = f"(CASE WHEN isnan(CAST({n} AS DOUBLE)) THEN NULL ELSE CAST({n} AS DOUBLE) END)"
            num = (f"count(*) FILTER (WHERE {x} = 0) AS n_zeros, min({x}) AS min_value, "
                   f"max({x}) AS max_value, round(avg({x}), 6) AS mean, "
                   f"round(stddev_samp({x}), 6) AS stddev")
        else:
            num = ("CAST(NULL AS BIGINT) AS n_zeros, CAST(NULL AS DOUBLE) AS min_value, "
                   "CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean, "
                   "CAST(NULL AS DOUBLE) AS stddev")
        parts.append(f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, "
                     f"count(*) AS n, {miss} AS n_missing, round({miss} / count(*), 6) AS p_missing, "
                     f"{num} FROM loans")
    return "\nUNION ALL\n".join(parts)


@register("profile_columns", with_loans(_profile_parts()))
def profile_columns(spark, sf_dir):
    return quality.profile(loans_view(spark, sf_dir))


def _schema_sql():
    parts = [f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, count({n}) AS n_known FROM loans"
             for i, (n, t) in enumerate(LOANS_SCHEMA)]
    return with_loans("\nUNION ALL\n".join(parts))


@register("schema_table", _schema_sql())
def schema_table(spark, sf_dir):
    """The schema as rows, with the number of values that are not NULL."""
    loans = loans_view(spark, sf_dir)
    known = quality.per_column_rows(
        loans, list(enumerate(loans.schema.fields)), inputs=lambda i, f: [f"{quality.sql_name(f.name)} AS v{i}"],
        aggs=lambda i, f: [f"count(v{i}) AS n{i}"], rows=lambda i, f: [f"named_struct('position', {i}, 'n_known', n{i})"],
        width=lambda f: 1, schema="position int, n_known bigint")
    return columns.schema_table(spark, loans).drop("nullable").join(known, "position")


def _sparse_sql():
    parts = [f"SELECT {i} AS position, '{n}' AS column_name, "
             f"round(count(*) FILTER (WHERE {sql_is_missing(n, t)}) / count(*), 6) AS p_missing FROM loans"
             for i, (n, t) in enumerate(LOANS_SCHEMA)]
    return with_loans("SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE p_missing > 0.1")


@register("sparse_columns", _sparse_sql())
def sparse_columns(spark, sf_dir):
    return quality.sparse_columns(loans_view(spark, sf_dir))


def _describe_sql():
    parts = []
    for n, t in LOANS_SCHEMA:
        if t == "string":
            x = f"TRY_CAST({n} AS DOUBLE)"
            lo = f"CAST(NULL AS DOUBLE), min({n})"
            hi = f"CAST(NULL AS DOUBLE), max({n})"
        else:
            x = f"CAST({n} AS DOUBLE)"
            lo = f"min({x}), CAST(NULL AS VARCHAR)"
            hi = f"max({x}), CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{n}' AS column_name, unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary, "
            f"unnest([CAST(count({n}) AS DOUBLE), round(avg({x}), 6), round(stddev_samp({x}), 6), "
            f"{lo.split(', ')[0]}, {hi.split(', ')[0]}]) AS value, "
            f"unnest([CAST(NULL AS VARCHAR), NULL, NULL, {lo.split(', ')[1]}, {hi.split(', ')[1]}]) AS text_value "
            f"FROM loans")
    return with_loans("\nUNION ALL\n".join(parts))


@register("describe_long", _describe_sql())
def describe_long(spark, sf_dir):
    return quality.describe_long(loans_view(spark, sf_dir))


@register("category_values", with_loans("SELECT column_name, value, count(*) AS n FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM loans" for c in _CATEGORY_COLS)
    + "\n) GROUP BY 1, 2 ORDER BY 1, 2"))
def category_values(spark, sf_dir):
    return quality.category_values(loans_view(spark, sf_dir), _CATEGORY_COLS)


_DROPPED = set(SPARSE_DROP_STEP1) | set(REDUNDANT_DROP_STEP1)


@register("drop_columns", with_loans(
    "SELECT " + ", ".join(n for n, _ in LOANS_SCHEMA if n not in _DROPPED) + " FROM loans"))
def drop_columns(spark, sf_dir):
    df = loans_view(spark, sf_dir)
    df = columns.drop_columns(df, SPARSE_DROP_STEP1)
    return columns.drop_columns(df, REDUNDANT_DROP_STEP1)


def _redundant_sql():
    parts = [f"SELECT {i} AS position, '{n}' AS column_name, CASE WHEN count({n}) = 0 THEN 'empty' "
             f"WHEN min({n}) = max({n}) THEN 'constant' END AS reason FROM loans"
             for i, (n, _) in enumerate(LOANS_SCHEMA)]
    return with_loans("SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE reason IS NOT NULL")


@register("redundant_columns", _redundant_sql())
def redundant_columns(spark, sf_dir):
    return columns.redundant_columns(loans_view(spark, sf_dir))


@register("high_cardinality_columns", with_loans("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{n}' AS column_name FROM loans HAVING count(DISTINCT {n}) > 0.5 * count(*)"
    for i, (n, t) in enumerate(LOANS_SCHEMA) if t == "string") + ")"))
def high_cardinality_columns(spark, sf_dir):
    return columns.high_cardinality_columns(loans_view(spark, sf_dir))


@register("distinct_estimates")
def distinct_estimates(spark, sf_dir):
    return quality.distinct_estimates(loans_view(spark, sf_dir))


def _distinct_parts():
    return "\nUNION ALL\n".join(f"SELECT {i} AS position, '{n}' AS column_name, count(DISTINCT {n}) AS n_distinct FROM loans"
                                for i, (n, _) in enumerate(LOANS_SCHEMA))


def _quartiles_parts():
    parts = []
    for i, (n, t) in enumerate(LOANS_SCHEMA):
        if t not in _NUMERIC:
            continue
        x = f"CAST({n} AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS position, '{n}' AS column_name, count(x) AS n, round(quantile_cont(x, 0.25), 6) AS q1, "
            f"round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q3 "
            f"FROM (SELECT CASE WHEN isnan({x}) THEN NULL ELSE {x} END AS x FROM loans)")
    return "\nUNION ALL\n".join(parts)


@register("column_quartiles", with_loans(_quartiles_parts()))
def column_quartiles(spark, sf_dir):
    q = quality.column_quartiles(loans_view(spark, sf_dir))
    return q.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@register("profile_report", with_loans(
    f"SELECT p.*, q.q1, q.median, q.q3, d.n_distinct FROM ({_profile_parts()}) p LEFT JOIN ({_quartiles_parts()}) q USING (position) "
    f"LEFT JOIN ({_distinct_parts()}) d USING (position)"))
def profile_report(spark, sf_dir):
    return quality.profile_report(loans_view(spark, sf_dir))


@register("distinct_counts", with_loans(_distinct_parts()))
def distinct_counts(spark, sf_dir):
    return replicas.distinct_counts(loans_view(spark, sf_dir))


#: Columns planted beside the loan's own: copies, values under other names, a near copy.
_PLANTED = {
    "funded_amnt": ("loan_amnt", "double"),
    "grade_name": ("CASE grade WHEN 'A' THEN 'best' WHEN 'B' THEN 'good' WHEN 'C' THEN 'fair' WHEN 'D' THEN 'poor' WHEN 'E' THEN 'worst' "
                   "WHEN 'H' THEN 'other' END", "string"),
    "grade_name_2": ("CASE grade WHEN 'A' THEN 'best' WHEN 'B' THEN 'good' WHEN 'C' THEN 'fair' WHEN 'D' THEN 'poor' WHEN 'E' THEN 'worst' "
                     "WHEN 'H' THEN 'other' END", "string"),
    "n_payments": ("CASE WHEN term = ' 60 months' THEN 60 ELSE 36 END", "int"),
    "term_but_one": ("CASE WHEN id = 1 THEN NULL ELSE term END", "string"),
    "status_text": ("coalesce(loan_status, 'unknown')", "string"),
    "grade_group": ("CASE WHEN grade IN ('A', 'B') THEN 'AB' ELSE grade END", "string"),
}


def _replicated_sql():
    cols = [*LOANS_SCHEMA, *[(c, t) for c, (_, t) in _PLANTED.items()]]
    ranked = ", ".join(f"min(id) OVER (PARTITION BY {c}) AS s{i}" for i, (c, _) in enumerate(cols))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    checks = ", ".join(f"bool_and(s{i} = s{j}) AS r{i}_{j}" + (
        f", bool_and({cols[i][0]} IS NOT DISTINCT FROM {cols[j][0]}) AS c{i}_{j}" if cols[i][1] == cols[j][1] else "") for i, j in pairs)
    sizes = ", ".join(f"count(DISTINCT s{i}) AS n{i}" for i in range(len(cols)))
    found = []
    for i, (c, t) in enumerate(cols):
        copy = " ".join(f"WHEN c{i}_{j} THEN {j}" for j in range(i) if cols[j][1] == t)
        recoding = " ".join(f"WHEN r{i}_{j} THEN {j}" for j in range(i))
        found.append(f"SELECT {i} AS position, '{c}' AS column_name, n{i} AS n_distinct, "
                     f"{f'CASE {copy} END' if copy else 'NULL'} AS copy_of, {f'CASE {recoding} END' if recoding else 'NULL'} AS recoding_of FROM checks")
    names = "[" + ", ".join(f"'{c}'" for c, _ in cols) + "]"
    union = " UNION ALL ".join(found)
    return with_loans(f"""
SELECT position, column_name, CAST(coalesce(copy_of, recoding_of) AS INTEGER) AS of_position, {names}[coalesce(copy_of, recoding_of) + 1] AS of_column,
       CASE WHEN copy_of IS NOT NULL THEN 'copy' ELSE 'recoding' END AS kind, n_distinct
FROM ({union}) WHERE n_distinct > 1 AND coalesce(copy_of, recoding_of) IS NOT NULL
""", "planted AS MATERIALIZED (SELECT *, " + ", ".join(f"{e} AS {c}" for c, (e, _) in _PLANTED.items()) + " FROM loans)",
        f"splits AS MATERIALIZED (SELECT *, {ranked} FROM planted)", f"checks AS MATERIALIZED (SELECT {checks}, {sizes} FROM splits)")


@register("replicated_columns", _replicated_sql())
def replicated_columns(spark, sf_dir):
    """Which columns repeat an earlier one, among the loan's own and some planted ones."""
    loans = loans_view(spark, sf_dir).selectExpr("*", *[f"{e} AS {c}" for c, (e, _) in _PLANTED.items()])
    return replicas.replicated_columns(loans)
