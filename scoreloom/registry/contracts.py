"""Registered queries: checks of a result file made of all line items.

Line number = system and supplier = query, so that keys repeat and leave the
allowed values; some lines miss a field and some scores are no numbers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import contracts as ops
from scoreloom.plans.spreading import spread_scan
from scoreloom.registry.base import register, table, with_ctes
from scoreloom.sources.schemas import METRICS

CONTRACT = ops.EVALUATION_CONTRACT

LINES_SQL = """
file AS (
  SELECT concat_ws(',', l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount,
                   CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE l_tax::VARCHAR END, l_tax,
                   CASE WHEN l_linestatus = 'F' OR l_quantity > 10 THEN '0.5' END) AS line
  FROM lineitem),
headers AS (
  SELECT DISTINCT 'system_number,query_number,P@10,R@50,r-precision,AP,nDCG@10,nDCG@'
                  || (10 * l_linenumber) AS line FROM lineitem),
parsed AS (SELECT line, string_split(line, ',') AS f FROM file),
good AS (SELECT f[1] AS s, f[2] AS q, f FROM parsed WHERE len(f) = 8)
"""

_QUERIES = ", ".join(f"'{q}'" for q in CONTRACT.domains["query_number"])
_SYSTEMS = ", ".join(f"'{s}'" for s in CONTRACT.domains["system_number"])

CHECKS_SQL = {
    "check_header": f"""
        SELECT 'header' AS rule, line AS key, '{CONTRACT.header}' AS detail
        FROM headers WHERE line <> '{CONTRACT.header}'
        UNION ALL
        SELECT 'header', '', '{CONTRACT.header}' FROM headers HAVING count(*) = 0""",
    "check_column_count": """
        SELECT 'column_count' AS rule, line AS key, len(f)::VARCHAR AS detail
        FROM parsed WHERE len(f) <> 8""",
    "check_unique_key": """
        SELECT 'unique_key' AS rule, s || ',' || q AS key, count(*)::VARCHAR AS detail
        FROM good GROUP BY s, q HAVING count(*) > 1""",
    "check_domain": f"""
        SELECT 'domain' AS rule, s || ',' || q AS key, 'system_number=' || s AS detail
        FROM good WHERE s NOT IN ({_SYSTEMS})
        UNION ALL
        SELECT 'domain', s || ',' || q, 'query_number=' || q
        FROM good WHERE q NOT IN ({_QUERIES})""",
    "check_numeric": " UNION ALL ".join(
        f"""SELECT 'numeric' AS rule, s || ',' || q AS key, '{m}=' || f[{i}] AS detail
            FROM good WHERE try_cast(f[{i}] AS DOUBLE) IS NULL"""
        for i, m in enumerate(METRICS, start=3)
    ),
    "check_complete": f"""
        SELECT 'complete' AS rule, ws || ',' || wq AS key, 'missing' AS detail
        FROM unnest([{_SYSTEMS}]) a(ws), unnest([{_QUERIES}]) b(wq)
        WHERE NOT EXISTS (SELECT 1 FROM good WHERE s = ws AND q = wq)""",
}


def _lines(spark, sf_dir):
    fields = F.expr(
        """concat_ws(',', l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount,
                     CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE string(l_tax) END, l_tax,
                     CASE WHEN l_linestatus = 'F' OR l_quantity > 10 THEN '0.5' END)"""
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    )
    return spread_scan(items, "l_orderkey").select(fields.alias("value"))


def _headers(spark, sf_dir):
    first = "system_number,query_number,P@10,R@50,r-precision,AP,nDCG@10,nDCG@"
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat(F.lit(first), (10 * F.col("l_linenumber")).cast("string")).alias("value")
    ).distinct()


@register("check_header", with_ctes(LINES_SQL, select=CHECKS_SQL["check_header"]))
def check_header(spark, sf_dir):
    return ops.check_header(_headers(spark, sf_dir), CONTRACT)


def _check(name, check):
    @register(name, with_ctes(LINES_SQL, select=CHECKS_SQL[name]))
    def run(spark, sf_dir):
        return check(ops.parse_lines(_lines(spark, sf_dir)), CONTRACT)

    return run


_check("check_column_count", ops.check_column_count)
_check("check_unique_key", ops.check_unique_key)
_check("check_domain", ops.check_domain)
_check("check_numeric", ops.check_numeric)
_check("check_complete", ops.check_complete)


@register(
    "contract_verdict",
    with_ctes(
        LINES_SQL,
        "violations AS (" + " UNION ALL ".join(f"({sql})" for sql in CHECKS_SQL.values()) + ")",
        select="SELECT count(*) AS violations, count(*) = 0 AS valid FROM violations",
    ),
)
def contract_verdict(spark, sf_dir):
    found = ops.check_all(_headers(spark, sf_dir), _lines(spark, sf_dir), CONTRACT)
    return ops.contract_verdict(found)
