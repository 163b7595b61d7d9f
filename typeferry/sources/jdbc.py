"""A PostgreSQL database, read through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from typeferry.functions.casts import quoted
from typeferry.operators.splits import conditions, equi_depth

if TYPE_CHECKING:
    from typeferry.operators.mapping import MappedColumn


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def qualified(schema: str, table: str) -> str:
    return f"{identifier(schema)}.{identifier(table)}"


@dataclass(frozen=True)
class ByRange:
    """Equal strides of one numeric, date or timestamp column.

    Bounds left out are looked up in the table. Values are assumed to be spread
    evenly, and nulls all go to the first stride: for a column with heavy values or
    many nulls use ``ByDepth`` or ``ByBlocks``.
    """

    column: str
    partitions: int
    lower: str | int | None = None
    upper: str | int | None = None


@dataclass(frozen=True)
class ByDepth:
    """About as many rows in each task, by the values of one column.

    The column alone is read first, by blocks, and its quantiles are sketched; heavy
    values and nulls are read apart, by blocks again where they are more than one task's
    share. For readers that want ranges of a column, on a table whose values are uneven.
    """

    column: str
    partitions: int


@dataclass(frozen=True)
class ByPredicates:
    """One partition per SQL condition; together they must cover each row once."""

    predicates: Sequence[str]


@dataclass(frozen=True)
class ByBlocks:
    """Runs of the table's disk blocks, whatever the values in it.

    Of a table, a materialised view, or all leaves of a partitioned table. ``partitions``
    is about how many; left out, there is one for each ``bytes_each`` of the table's size.
    Views and foreign tables have no blocks.
    """

    partitions: int | None = None
    bytes_each: int = 256 << 20


@dataclass(frozen=True)
class SingleTask:
    """The whole table in one task and one connection."""


Partitioning = ByRange | ByDepth | ByPredicates | ByBlocks | SingleTask


def block_predicates(blocks: int, partitions: int) -> list[str]:
    """Conditions on the row address that split ``blocks`` evenly.

    The last one has no upper bound, so rows appended meanwhile are read too.
    """
    partitions = max(1, min(partitions, blocks))
    starts = [blocks * i // partitions for i in range(partitions)]
    conditions = []
    for start, end in zip(starts, [*starts[1:], None]):
        condition = f"ctid >= '({start},0)'::tid"
        if end is not None:
            condition += f" AND ctid < '({end},0)'::tid"
        conditions.append(condition)
    return conditions


def leaf_predicates(leaves: Sequence[tuple[int, int]], blocks_each: int) -> list[str]:
    """Conditions that split the leaves of a partitioned table, each by its own blocks.

    ``leaves`` are their object ids and blocks. A leaf attached meanwhile is not read.
    """
    return [
        f"tableoid = {oid} AND {condition}"
        for oid, blocks in leaves
        for condition in block_predicates(blocks, -(-blocks // blocks_each))
    ]


@dataclass(frozen=True)
class JdbcSource:
    """Connection settings; the driver's jar must be on Spark's class path."""

    host: str = "localhost"
    port: int = 5432
    database: str = "source_db"
    user: str = "postgres"
    password: str = field(default="", repr=False)
    sslmode: str = "require"
    driver: str = "org.postgresql.Driver"
    fetchsize: int = 10_000
    max_connections: int | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.database}?sslmode={self.sslmode}"

    def reader_options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetchsize),
            **self.options,
        }

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The result of one statement, run by the database."""
        return spark.read.format("jdbc").options(**self.reader_options()).option("query", sql).load()

    # -- discovery ---------------------------------------------------------------

    @staticmethod
    def columns_sql(schema: str | None = None, table: str | None = None) -> str:
        """The catalog query. The array depth is not in the standard catalog views."""
        conditions = ["c.table_schema NOT IN ('pg_catalog', 'information_schema')"]
        if schema is not None:
            conditions = [f"c.table_schema = {literal(schema)}"]
        if table is not None:
            conditions.append(f"c.table_name = {literal(table)}")
        return f"""
            SELECT c.table_schema, c.table_name, c.column_name, c.data_type, c.udt_name,
                   c.numeric_precision, c.numeric_scale, c.is_nullable,
                   a.attndims AS array_dimensions, c.ordinal_position
            FROM information_schema.columns c
            LEFT JOIN pg_catalog.pg_namespace n ON n.nspname = c.table_schema
            LEFT JOIN pg_catalog.pg_class r
                   ON r.relnamespace = n.oid AND r.relname = c.table_name
            LEFT JOIN pg_catalog.pg_attribute a
                   ON a.attrelid = r.oid AND a.attname = c.column_name
            WHERE {" AND ".join(conditions)}"""

    def columns(
        self, spark: SparkSession, schema: str | None = None, table: str | None = None
    ) -> DataFrame:
        return self.query(spark, self.columns_sql(schema, table))

    # -- tables ------------------------------------------------------------------

    @staticmethod
    def text_schema(columns: Sequence[MappedColumn]) -> str:
        """The columns to fetch as text: all that are mapped to string.

        Spark would read a time of day as a timestamp, a bit string as bytes and a
        numeric of 50 digits as decimal(38,0). The database's own text keeps the value.
        """
        return ", ".join(
            f"{quoted(c.column_name)} STRING" for c in columns if c.spark_type == "string"
        )

    @staticmethod
    def count_sql(schema: str, table: str) -> str:
        return f"SELECT count(*) AS n_rows FROM {qualified(schema, table)}"

    def count(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        """Counted by the database; no row is transferred."""
        return self.query(spark, self.count_sql(schema, table))

    @staticmethod
    def bounds_sql(schema: str, table: str, column: str) -> str:
        name = identifier(column)
        return f"SELECT min({name}) AS lo, max({name}) AS hi FROM {qualified(schema, table)}"

    @staticmethod
    def blocks_sql(schema: str, table: str) -> str:
        """The kind of a relation, and its storage: itself, or the leaves below it."""
        name = literal(qualified(schema, table))
        return f"""
            SELECT r.relkind::text AS kind, l.oid::bigint AS oid,
                   pg_relation_size(l.oid) / s.size AS blocks, s.size AS block_size
            FROM pg_catalog.pg_class r
            CROSS JOIN (SELECT current_setting('block_size')::bigint AS size) s
            LEFT JOIN pg_partition_tree({name}::regclass) t ON r.relkind = 'p' AND t.isleaf
            LEFT JOIN pg_catalog.pg_class l
                   ON l.oid = CASE WHEN r.relkind = 'p' THEN t.relid ELSE r.oid END
            WHERE r.oid = {name}::regclass"""

    def _block_predicates(
        self, spark: SparkSession, schema: str, table: str, by: ByBlocks
    ) -> list[str]:
        """Conditions over the blocks of a table or of a partitioned table's leaves."""
        found = self.query(spark, self.blocks_sql(schema, table)).collect()
        kind = found[0]["kind"] if found else None
        if kind not in ("r", "m", "p", "t"):
            raise ValueError(
                f"{schema}.{table} has no blocks to read by (a view or a foreign table); "
                "choose ByRange, ByPredicates or SingleTask()"
            )
        leaves = [(int(r["oid"]), int(r["blocks"])) for r in found if r["oid"] is not None]
        total = sum(blocks for _, blocks in leaves)
        if not leaves:
            return ["false"]  # a partitioned table without partitions
        if by.partitions is None:
            each = max(1, by.bytes_each // int(found[0]["block_size"]))
        else:
            each = max(1, -(-total // max(1, by.partitions)))
        if kind == "p":
            return leaf_predicates(leaves, each)
        return block_predicates(total, by.partitions or -(-total // each))

    def read(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        columns: Sequence[MappedColumn] = (),
        partitioning: Partitioning | None = None,
    ) -> DataFrame:
        """All rows of one table, read with the types Spark infers.

        Without ``partitioning`` the table is read by its blocks, a task for so many
        bytes. ``columns`` names those to fetch as text; ``conform`` casts the rest. The
        partitions of a parallel read are separate transactions: rows changed while
        it runs may be seen twice or not at all.

        Each running task has a connection. Spark has no option that bounds them apart
        from the number of partitions, so ``max_connections`` groups the partitions: a
        task then reads several, one after the other.
        """
        options = self.reader_options()
        text_schema = self.text_schema(columns)
        if text_schema:
            options["customSchema"] = text_schema
        name = qualified(schema, table)

        by = ByBlocks() if partitioning is None else partitioning
        predicates: Sequence[str] | None = None
        if isinstance(by, ByPredicates):
            predicates = by.predicates
        elif isinstance(by, ByBlocks):
            predicates = self._block_predicates(spark, schema, table, by)
        elif isinstance(by, ByDepth):
            predicates = self._depth_predicates(spark, schema, table, by)
        if predicates is not None:
            url = options.pop("url")
            frame = spark.read.jdbc(url, name, predicates=list(predicates), properties=options)
            if self.max_connections and len(predicates) > self.max_connections:
                frame = frame.coalesce(self.max_connections)
            return frame

        if isinstance(by, ByRange):
            options.update(self._range_options(spark, schema, table, by))
        return spark.read.format("jdbc").options(**options).option("dbtable", name).load()

    def _depth_predicates(
        self, spark: SparkSession, schema: str, table: str, by: ByDepth
    ) -> list[str]:
        """Conditions on a column that share its rows out evenly."""
        values = self.read(spark, schema, table).select(quoted(by.column))
        splits = equi_depth(values, by.column, by.partitions)

        def blocks(parts: int) -> list[str]:
            return self._block_predicates(spark, schema, table, ByBlocks(parts))

        return conditions(identifier(by.column), splits, blocks)

    def _range_options(
        self, spark: SparkSession, schema: str, table: str, by: ByRange
    ) -> dict[str, str]:
        lower, upper = by.lower, by.upper
        if lower is None or upper is None:
            found = self.query(spark, self.bounds_sql(schema, table, by.column)).first()
            lower = found[0] if lower is None else lower
            upper = found[1] if upper is None else upper
        return range_options(by.column, by.partitions, lower, upper)


def range_options(column: str, partitions: int, lower: object, upper: object) -> dict[str, str]:
    """Spark's options for a range scan; none where the column has no value."""
    if lower is None or upper is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
