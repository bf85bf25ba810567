"""The scalar expressions as temporary SQL functions, which Catalyst inlines: SELECT gm_normalised_domain(host) ..."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gristmill.functions import text


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


FUNCTIONS = {
    "gm_is_domain(x STRING) RETURNS BOOLEAN": f"rlike(x, {_quoted(text.DOMAIN)})",
    "gm_is_hosts(x STRING) RETURNS BOOLEAN": f"rlike(trim(x), {_quoted(text.HOSTS)})",
    "gm_is_element_hiding(x STRING) RETURNS BOOLEAN": f"rlike(x, {_quoted(text.ELEMENT_HIDING)})",
    "gm_is_bare(x STRING) RETURNS BOOLEAN": f"rlike(x, {_quoted(text.BARE)})",
    "gm_normalised_domain(x STRING) RETURNS STRING": "regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(x)), '^\\\\*\\\\.', ''), '\\\\.+$', ''), '\\\\.{2,}', '.'), '^\\\\.+', '')",
    "gm_suffixes(x STRING) RETURNS ARRAY<STRING>": "if(x = '', array(), transform(sequence(1, size(split(x, '[.]'))), i -> array_join(slice(split(x, '[.]'), i, size(split(x, '[.]'))), '.')))",
    "gm_safe_file_name(x STRING) RETURNS STRING": "concat(left(regexp_replace(regexp_replace(x, '(?i)^https?://', ''), '[^A-Za-z0-9._-]', '_'), 163), '_', left(sha2(x, 256), 16), '.txt')",
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions of this session; returns their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in FUNCTIONS]
