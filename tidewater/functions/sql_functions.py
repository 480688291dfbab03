"""SQL function surface: the scalar, table and aggregate functions callable
from SQL text.

Scalar and table functions are Spark SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN``): their bodies are inlined into the query plan, so
they run inside whole-stage codegen like built-ins.  Spark has no SQL-bodied
aggregate functions; ``avg_temp`` is therefore a pandas grouped-aggregate
UDF for the SQL surface, while DataFrame code uses the algebraic
:func:`tidewater.operators.aggregates.avg_temp` (partial/final aggregate).
"""

from pyspark.sql import SparkSession


def _int32(x: str) -> str:
    """SQL: wrap a BIGINT expression into the signed 32-bit range."""
    m = f"pmod({x}, 4294967296)"
    return f"CAST(CASE WHEN {m} >= 2147483648 THEN {m} - 4294967296 ELSE {m} END AS INT)"


# String.hashCode: 31-polynomial over UTF-16 code units (two for a character
# above U+FFFF), int32 wrap-around
_HASH = _int32("aggregate(transform(split(s, ''), c -> CAST(ascii(c) AS BIGINT)), 0L, (a, c) -> "
               "(CASE WHEN c > 65535 THEN a * 961 + (55296 + shiftright(c - 65536, 10)) * 31 + 56320 + ((c - 65536) & 1023) "
               "ELSE a * 31 + c END) % 4294967296)")

STATEMENTS = [
    f"""
CREATE OR REPLACE TEMPORARY FUNCTION java_string_hash(s STRING) RETURNS INT
RETURN {_HASH}""",
    # parameterised scalar function: hash * factor - 1000, int32 wrap-around
    f"""
CREATE OR REPLACE TEMPORARY FUNCTION hash_code(s STRING, factor INT) RETURNS INT
RETURN {_int32(f"CAST({_HASH} AS BIGINT) * factor - 1000")}""",
    r"""
CREATE OR REPLACE TEMPORARY FUNCTION normalize_part(s STRING) RETURNS STRING
RETURN trim(regexp_replace(regexp_replace(upper(s), '\\W', ' '), '\\s+', ' '))""",
    """
CREATE OR REPLACE TEMPORARY FUNCTION normalize_address(street STRING, zip STRING, city STRING) RETURNS STRING
RETURN concat(normalize_part(street), ', ', normalize_part(zip), ', ', normalize_part(city))""",
    # table function: split by a separator into (word, length); as with the
    # JVM split, trailing empty words are dropped
    r"""
CREATE OR REPLACE TEMPORARY FUNCTION split_words(s STRING, sep STRING)
RETURNS TABLE (word STRING, length INT)
RETURN SELECT w, length(w) FROM (SELECT explode(
  CASE WHEN regexp_replace(s, concat('(?:', sep, ')+\\z'), '') = ''
       THEN (CASE WHEN s = '' THEN array('') ELSE CAST(array() AS ARRAY<STRING>) END)
       ELSE split(regexp_replace(s, concat('(?:', sep, ')+\\z'), ''), sep) END) AS w)""",
]


def register_sql_functions(spark: SparkSession) -> None:
    for stmt in STATEMENTS:
        spark.sql(stmt)
    register_avg_temp(spark)


def register_avg_temp(spark: SparkSession, name: str = "avg_temp") -> None:
    """Aggregate function for SQL text (sum/count accumulator).  It receives
    a whole group in one call: use it on bounded groups; the DataFrame form
    is the scalable one."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def avg_temp(v: pd.Series) -> float:
        n = v.count()
        return float(v.sum() / n) if n else None

    spark.udf.register(name, avg_temp)
