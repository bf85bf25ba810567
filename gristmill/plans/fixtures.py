"""Views over the driver's tables that stand for rule lists; the same SQL runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One ordered list: pos, base, rule.
RULES = """
select page_id as pos, b as base, case page_id % 16
  when 0 then '0.0.0.0 ' || b               when 1 then '0.0.0.0 ' || b
  when 2 then '127.0.0.1 ' || b || ' # c'   when 3 then b
  when 4 then b                             when 5 then 'x.' || b
  when 6 then upper(b)                      when 7 then '||' || b || '^'
  when 8 then '||x.' || b || '^'            when 9 then '||' || b || '^$important'
  when 10 then '||*.' || b || '^'           when 11 then '@@||' || b || '^'
  when 12 then '0.0.0.0 x.' || b            when 13 then '/^ads' || cast(page_id % 7 as string) || '[.]/'
  when 14 then '0.0.0.0 ' || b || ' y.' || b
  else '||' || b || '^$dnstype=A' end as rule
from (select page_id, 'd' || cast((page_id * 7) % 11 as string) || '.' ||
             regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '^(www|blog|m)[.]', '') as b
      from pages) a"""

#: Raw lines of seven files: line_no, file_id, raw.
RAW = """
select page_id as line_no, page_id % 7 as file_id, case page_id % 20
  when 0 then '! comment ' || host            when 1 then '  '
  when 2 then '||' || host || '^'             when 3 then '0.0.0.0 ' || host || ' # tail'
  when 4 then '||' || host || '^$script'      when 5 then host || '##.banner'
  when 6 then '||' || host || '^$important'   when 7 then '  ' || upper(host) || '  '
  when 8 then '/^ads[0-9]+[.]/'               when 9 then '||*.' || dom || '^'
  when 10 then '||a*' || dom || '^'           when 11 then '-----'
  when 12 then '127.0.0.1 ' || host || ' ' || dom
  when 13 then '||bad_' || host || '^'        when 14 then '@@||' || host || '^'
  when 15 then '||' || host || '^|'           when 16 then '||' || host || '^x'
  when 17 then '# ' || host                   when 18 then host || '.'
  else '||' || dom || '^$dnstype=A,client=c1' end as raw
from (select page_id, host, regexp_replace(host, '^(www|blog|m)[.]', '') as dom
      from (select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as host from pages) a) b"""


def of(spark: SparkSession, sf_dir: str, sql: str, table: str = "pages") -> DataFrame:
    """A view's rows. The table is an argument of the statement, so no name is left in the session."""
    return spark.sql(sql.replace("{", "{{").replace("}", "}}").replace(f"from {table}", "from {table}"), table=spark.read.parquet(f"{sf_dir}/{table}.parquet"))
