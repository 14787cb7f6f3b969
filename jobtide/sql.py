"""SQL names of public functions, as temporary SQL functions that Catalyst inlines; nothing runs in Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name, parameters, type, body
FUNCTIONS: tuple[tuple[str, str, str, str], ...] = (
    ("jt_strip", "x STRING", "STRING", r"regexp_replace(x, '(?U)^\\s+|\\s+$', '')"),
    ("jt_row_id", "url STRING", "STRING", "substr(sha2(coalesce(url, ''), 256), 1, 12)"),
    ("jt_salary_mid", "low DOUBLE, high DOUBLE", "DOUBLE", "(low + high) / 2"),
    ("jt_estimate_tokens", "x STRING, chars_per_token DOUBLE", "BIGINT", "CAST(floor(length(x) / chars_per_token) AS BIGINT)"),
    ("jt_list_contains", "items ARRAY<STRING>, wanted STRING", "BOOLEAN", "coalesce(exists(items, i -> lower(i) = lower(wanted)), false)"),
    ("jt_jaccard", "a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "CASE WHEN size(array_union(a, b)) = 0 THEN 1.0D ELSE size(array_intersect(a, b)) / size(array_union(a, b)) END"),
    ("jt_squeeze", "x STRING", "STRING", r"regexp_replace(regexp_replace(x, '(?U)\\s+', ' '), '^ | $', '')"),
    ("jt_blank", "x STRING", "BOOLEAN", r"x IS NOT NULL AND regexp_replace(x, '(?U)^\\s+|\\s+$', '') = ''"),
    ("jt_null_if_sentinel", "x STRING", "STRING", "CASE WHEN x NOT IN ('', 'nan', 'NaN', 'None', 'none', 'NA', 'na', 'N/A', 'n/a', 'null') THEN x END"),
    ("jt_description_hash", "x STRING", "STRING", r"sha2(regexp_replace(regexp_replace(coalesce(x, ''), '(?U)\\s+', ' '), '^ | $', ''), 256)"),
    ("jt_clean_whitespace", "x STRING", "STRING", r"regexp_replace(regexp_replace(regexp_replace(x, '[ \\t]{2,}', ' '), '\\n{3,}', '\n\n'), '(?U)^\\s+|\\s+$', '')"),
    ("jt_german_int", "x STRING", "INT", r"try_cast(CASE WHEN trim(x) RLIKE '^\\d+(?:\\.\\d{3})*(?:,\\d+)?$' THEN replace(regexp_replace(trim(x), ',\\d+$', ''), '.', '') END AS INT)"),
    ("jt_salary", "x INT", "INT", "CASE WHEN x BETWEEN 10000 AND 300000 THEN x END"),
    ("jt_round_half_up", "x DOUBLE", "BIGINT", "CAST(floor(x + 0.5) AS BIGINT)"),
    ("jt_percent", "x DOUBLE", "DOUBLE", "CASE WHEN x > 1 THEN x ELSE x * 100 END"),
    ("jt_list_except", "items ARRAY<STRING>, others ARRAY<STRING>", "ARRAY<STRING>", "filter(items, i -> NOT array_contains(transform(others, o -> lower(o)), lower(i)))"),
    ("jt_tokens", "x STRING", "ARRAY<STRING>", "array_distinct(filter(split(lower(x), '[^a-zà-ÿ]+'), w -> w <> ''))"),
    ("jt_week", "d DATE", "STRING", "date_format(date_trunc('WEEK', d), 'yyyy-MM-dd')"),
    ("jt_persona_junior", "seniority STRING, years INT", "BOOLEAN", "coalesce(seniority = 'Junior', false) OR (seniority IS NULL AND coalesce(years < 3, false))"),
    ("jt_description_quality", "x STRING", "STRING", "CASE WHEN size(regexp_extract_all(x, '[a-z][A-Z]', 0)) > 10 THEN 'concatenated' ELSE 'clean' END"),
)


def register(spark: SparkSession) -> list[str]:
    """Make the names known to the session's SQL; returns them."""
    for name, parameters, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
