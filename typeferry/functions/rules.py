"""The rule table: one PostgreSQL type name, one Spark type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# They decide what every column becomes. "decimal" alone stands for
# decimal(p,s) with the precision and scale of the column.
TYPE_RULES: tuple[tuple[str, str], ...] = (
    # integers
    ("smallint", "smallint"),
    ("int2", "smallint"),
    ("integer", "int"),
    ("int", "int"),
    ("int4", "int"),
    ("bigint", "bigint"),
    ("int8", "bigint"),
    ("serial", "int"),
    ("bigserial", "bigint"),
    ("smallserial", "smallint"),
    # exact numbers and money
    ("numeric", "decimal"),
    ("decimal", "decimal"),
    ("money", "double"),
    # floating point
    ("real", "float"),
    ("float4", "float"),
    ("double precision", "double"),
    ("float8", "double"),
    ("float", "double"),
    # text
    ("character varying", "string"),
    ("varchar", "string"),
    ("character", "string"),
    ("char", "string"),
    ("bpchar", "string"),
    ("text", "string"),
    ("name", "string"),
    ("citext", "string"),
    # bytes and truth values
    ("bytea", "binary"),
    ("boolean", "boolean"),
    ("bool", "boolean"),
    # dates and times; a time of day or an interval keeps its text
    ("date", "date"),
    ("timestamp", "timestamp"),
    ("timestamp without time zone", "timestamp"),
    ("timestamp with time zone", "timestamp"),
    ("timestamptz", "timestamp"),
    ("time", "string"),
    ("time without time zone", "string"),
    ("time with time zone", "string"),
    ("timetz", "string"),
    ("interval", "string"),
    # network addresses
    ("inet", "string"),
    ("cidr", "string"),
    ("macaddr", "string"),
    ("macaddr8", "string"),
    # documents and identifiers
    ("json", "string"),
    ("jsonb", "string"),
    ("uuid", "string"),
    ("xml", "string"),
    # bit strings
    ("bit", "string"),
    ("bit varying", "string"),
    ("varbit", "string"),
    # geometry
    ("point", "string"),
    ("line", "string"),
    ("lseg", "string"),
    ("box", "string"),
    ("path", "string"),
    ("polygon", "string"),
    ("circle", "string"),
    # ranges
    ("int4range", "string"),
    ("int8range", "string"),
    ("numrange", "string"),
    ("tsrange", "string"),
    ("tstzrange", "string"),
    ("daterange", "string"),
    # text search and system types
    ("tsvector", "string"),
    ("tsquery", "string"),
    ("pg_lsn", "string"),
    ("txid_snapshot", "string"),
    ("oid", "bigint"),
)

# A numeric column that does not state its precision or scale.
DEFAULT_PRECISION = 38
DEFAULT_SCALE = 18

# Spark's own bound on decimal precision.
MAX_PRECISION = 38

FALLBACK_TYPE = "string"


def rules_frame(spark: SparkSession) -> DataFrame:
    """The rules as an inline table of fixed size, safe to broadcast."""
    rows = ", ".join(f"('{name}', '{spark_type}')" for name, spark_type in TYPE_RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(_name_ruled, _rule)")
