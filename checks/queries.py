"""The registered queries. Each reads whole tables of the folder it is given."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typeferry import (
    TYPE_RULES,
    Buckets,
    FrameSource,
    IngestConfig,
    MappedColumn,
    append_once,
    apply_changes,
    build_schema,
    column_checks,
    conform,
    current_rows,
    diff_rows,
    differences,
    discover_columns,
    equi_depth,
    in_zones,
    infer_types,
    ingest,
    ingest_many,
    keys_of_tables,
    map_types,
    mapped_columns,
    mapped_tables,
    mapping_audit,
    preview,
    read_table,
    reconcile,
    row_count,
    split_of,
    write_clustered,
    write_table,
)
from typeferry.operators.mapping import map_one
from typeferry.operators.scratch import scratch_table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Names without a rule, and the bare word for arrays, to go with the rule names.
OTHER_NAMES = ("hstore", "serial4", "xid", "varchar(20)", "USER-DEFINED", "array")

UDT_NAMES = (
    "_int2", "_int4", "_int8", "_float4", "_float8", "_text", "_bool", "_numeric",
    "_timestamptz", "_mood",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, *names: str) -> FrameSource:
    return FrameSource({name: read(spark, sf_dir, name) for name in names or TABLES})


def as_text(df: DataFrame) -> DataFrame:
    """Decimals, dates and truth values as text: the same form from any engine."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DecimalType, T.DateType, T.BooleanType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def declared(*columns: tuple) -> list[MappedColumn]:
    """Columns as a database would declare them: name, type and, for numerics, p and s."""
    found = []
    for name, data_type, *rest in columns:
        base, spark_type, status = map_one(data_type, None, *(rest or (None, None)))
        found.append(MappedColumn(name, data_type, base, spark_type, True, status))
    return found


# -- discovery and mapping of the tables' own columns ----------------------------------


def checked_catalog(spark: SparkSession, tables: FrameSource, *measures: str) -> DataFrame:
    """Mapped descriptors of all tables, with the row count and the measures of every column."""
    mapped = map_types(discover_columns(spark, tables))
    columns = mapped_tables(mapped, list(tables.tables))
    checks = [
        column_checks(frame, columns[name], measures).withColumn("table_name", F.lit(name))
        for name, frame in tables.tables.items()
    ]
    return mapped.join(
        reduce(DataFrame.unionByName, checks), ["table_name", "column_name"], "left"
    )


def discover_all(spark, sf_dir):
    return checked_catalog(spark, source(spark, sf_dir), "nulls").select(
        "table_name", "column_name", "data_type", "ordinal_position", "is_nullable",
        "n_rows", "n_nulls",
    )


def discover_one(spark, sf_dir):
    tables = source(spark, sf_dir)
    found = discover_columns(spark, tables, "public", "orders")
    checks = column_checks(tables.tables["orders"], mapped_columns(map_types(found)), ())
    return (
        found.join(checks, "column_name")
        .select("column_name", "data_type", "ordinal_position", "n_rows")
        .orderBy("ordinal_position")
    )


def discover_count(spark, sf_dir):
    return (
        checked_catalog(spark, source(spark, sf_dir))
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("n_columns"), F.max("n_rows").alias("n_rows"))
    )


def map_catalog(spark, sf_dir):
    return checked_catalog(spark, source(spark, sf_dir), "lost").select(
        "table_name", "column_name", "spark_type", "nullable", "n_rows", "n_lost"
    )


def audit(spark, sf_dir):
    """The types of every column, and whether all values in it keep to them."""
    checked = checked_catalog(spark, source(spark, sf_dir), "nulls", "lost")
    return mapping_audit(checked, "n_nulls", "n_lost")


# -- mapping of a catalog as long as lineitem: one descriptor per row ------------------


def pick(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def stated(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("not stated")).alias(name)


def any_name() -> Column:
    names = tuple(name for name, _ in TYPE_RULES) + OTHER_NAMES
    return pick(names, F.col("l_partkey") + F.col("l_linenumber"))


def long_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", any_name().alias("data_type")
    )


def map_rules(spark, sf_dir):
    return map_types(long_catalog(spark, sf_dir)).select(
        "l_orderkey", "l_partkey", "l_linenumber", "data_type", "spark_type", "status"
    )


def map_summary(spark, sf_dir):
    return (
        map_types(long_catalog(spark, sf_dir))
        .groupBy("spark_type", "status")
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )


def map_normalise(spark, sf_dir):
    name = F.col("name")
    flag = F.col("l_returnflag")
    spelled = (
        F.when(flag == "A", F.upper(name))
        .when(flag == "R", F.concat(F.upper(F.substr(name, F.lit(1), F.lit(1))),
                                    F.substr(name, F.lit(2))))
        .otherwise(name)
    )
    outer = F.when(F.col("l_linestatus") == "O", "  ").otherwise("")
    suffix = F.when(F.col("l_linestatus") == "O", "[]").otherwise(" []")
    descriptors = read(spark, sf_dir, "lineitem").withColumn("name", any_name()).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.concat(outer, spelled, F.repeat(suffix, F.col("l_linenumber") % 4), outer).alias(
            "data_type"
        ),
        (F.col("l_quantity") % 3).cast("int").alias("array_dimensions"),
    )
    return map_types(descriptors).select(
        "l_orderkey", "l_partkey", "l_linenumber", "data_type", "array_dimensions", "spark_type"
    )


def map_decimal(spark, sf_dir):
    descriptors = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") > 3, "numeric").otherwise("decimal").alias("data_type"),
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity").cast("int")).alias(
            "numeric_precision"
        ),
        F.when(F.col("l_linestatus") != "O", (F.round(F.col("l_discount") * 100) * 3 - 2).cast("int"))
        .alias("numeric_scale"),
    )
    return map_types(descriptors).select(
        "l_orderkey", "l_partkey", "l_linenumber", "data_type",
        stated("numeric_precision"), stated("numeric_scale"), "spark_type", "status",
    )


def map_arrays(spark, sf_dir):
    descriptors = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.lit("ARRAY").alias("data_type"),
        F.when(F.col("l_returnflag") != "N", pick(UDT_NAMES, F.col("l_partkey"))).alias("udt_name"),
        (F.col("l_linenumber") % 3).alias("array_dimensions"),
    )
    return map_types(descriptors).select(
        "l_orderkey", "l_partkey", "l_linenumber", stated("udt_name"), "array_dimensions",
        "spark_type", "status",
    )


def map_nullability(spark, sf_dir):
    flag = F.col("l_returnflag")
    answer = F.when(flag == "A", "YES").when(flag == "N", "no").otherwise("NO ")
    descriptors = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.lit("integer").alias("data_type"),
        F.when(F.col("l_linenumber") < 6, answer).alias("is_nullable"),
    )
    return map_types(descriptors).select(
        "l_orderkey", "l_partkey", "l_linenumber", stated("is_nullable"), "nullable"
    )


def map_unknown(spark, sf_dir):
    """Words that stand in the tables, taken for type names."""
    words = [
        read(spark, sf_dir, table).select(F.lit(table).alias("table_name"),
                                          F.col(column).alias("data_type"))
        for table, column in (("part", "p_type"), ("customer", "c_mktsegment"),
                              ("orders", "o_orderpriority"), ("events", "event_type"),
                              ("documents", "lang"))
    ]
    return (
        map_types(reduce(DataFrame.unionByName, words))
        .groupBy("table_name", "data_type", "spark_type", "status")
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )


# -- casts -----------------------------------------------------------------------------


def lineitem_columns(spark: SparkSession) -> list[MappedColumn]:
    return declared(
        ("l_shipdate", "date"),
        ("l_orderkey", "int8"),
        ("l_linenumber", "smallint"),
        ("l_partkey", "integer"),
        ("l_suppkey", "character varying"),
        ("l_quantity", "int2"),
        ("l_extendedprice", "numeric", 10, 2),
        ("l_discount", "decimal", 3, 2),
        ("l_tax", "double precision"),
        ("l_returnflag", "char"),
    )


def conform_lineitem(spark, sf_dir):
    return as_text(conform(read(spark, sf_dir, "lineitem"), lineitem_columns(spark)))


def orders_columns(spark: SparkSession) -> list[MappedColumn]:
    return declared(
        ("o_orderkey", "text"),
        ("o_custkey", "integer"),
        ("o_totalprice", "numeric", 12, 2),
        ("o_orderdate", "date"),
        ("o_orderstatus", "bpchar"),
    )


def conform_orders(spark, sf_dir):
    return as_text(conform(read(spark, sf_dir, "orders"), orders_columns(spark)))


def events_columns(spark: SparkSession) -> list[MappedColumn]:
    return declared(
        ("event_id", "bigint"),
        ("ts", "timestamp with time zone"),
        ("value", "integer"),
        ("props", "jsonb"),
    )


def conform_events(spark, sf_dir):
    """Values with a fraction become integers, as ``rounding`` allows."""
    return conform(read(spark, sf_dir, "events"), events_columns(spark), rounding=True)


def conform_documents(spark, sf_dir):
    columns = declared(
        ("doc_id", "integer"), ("text", "text"), ("lang", "name"), ("n_chars", "numeric", 9, 0)
    )
    return as_text(conform(read(spark, sf_dir, "documents"), columns))


def embeddings_columns(spark: SparkSession) -> list[MappedColumn]:
    return declared(("vec_id", "bigint"), ("embedding", "double precision[]"))


def conform_embeddings(spark, sf_dir):
    vectors = conform(read(spark, sf_dir, "embeddings"), embeddings_columns(spark))
    return vectors.select("vec_id", F.posexplode("embedding").alias("at", "v")).select(
        "vec_id", (F.col("at") + 1).cast("bigint").alias("pos"), "v"
    )


def conform_money(spark, sf_dir):
    balance = F.col("c_acctbal")
    text = F.concat(
        F.when(balance < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(balance), 2)
    )
    accounts = read(spark, sf_dir, "customer").select("c_custkey", text.alias("c_acctbal"))
    return conform(accounts, declared(("c_custkey", "int8"), ("c_acctbal", "money")))


def conform_time(spark, sf_dir):
    columns = declared(("event_id", "int8"), ("ts", "time without time zone"))
    return conform(read(spark, sf_dir, "events"), columns)


def narrow_columns(spark: SparkSession) -> list[MappedColumn]:
    return declared(
        ("l_orderkey", "bigint"),
        ("l_linenumber", "integer"),
        ("l_extendedprice", "numeric", 6, 2),
        ("l_quantity", "numeric", 3, 2),
        ("l_returnflag", "boolean"),
        ("l_linestatus", "boolean"),
    )


def conform_lenient(spark, sf_dir):
    lineitem = read(spark, sf_dir, "lineitem")
    return as_text(conform(lineitem, narrow_columns(spark), strict=False))


def lost_lineitem(spark, sf_dir):
    lineitem = read(spark, sf_dir, "lineitem")
    return column_checks(lineitem, narrow_columns(spark), ("nulls", "lost"))


def altered_lineitem(spark, sf_dir):
    columns = declared(
        ("l_orderkey", "bigint"),
        ("l_quantity", "smallint"),
        ("l_extendedprice", "numeric", 10, 1),
        ("l_discount", "numeric", 3, 1),
        ("l_tax", "real"),
        ("l_shipdate", "date"),
    )
    return column_checks(read(spark, sf_dir, "lineitem"), columns)


def altered_events(spark, sf_dir):
    columns = declared(
        ("event_id", "double precision"), ("ts", "date"), ("value", "integer")
    )
    return column_checks(read(spark, sf_dir, "events"), columns)


def types_of(frame: DataFrame, table: str, columns: list[MappedColumn]) -> DataFrame:
    """Per column its type, asked of the rows, with the declared nullability beside it."""
    declared_null = {f.name: f.nullable for f in build_schema(columns)}
    found = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.max(F.typeof(F.col(c))).alias("type"),
            F.lit(declared_null[c]).alias("nullable"),
        )
        for c in frame.columns
    ]
    counted = frame.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*found).alias("found"))
    return counted.select(
        F.lit(table).alias("table_name"), "n_rows", F.inline("found")
    )


def conformed_tables(spark: SparkSession, sf_dir: str) -> dict[str, tuple]:
    """Four tables under their declared types, their keys NOT NULL."""
    out = {}
    for table, columns in (
        ("lineitem", lineitem_columns(spark)),
        ("orders", orders_columns(spark)),
        ("events", events_columns(spark)),
        ("embeddings", embeddings_columns(spark)),
    ):
        keyed = [c._replace(nullable=not c.column_name.endswith(("key", "_id"))) for c in columns]
        out[table] = conform(read(spark, sf_dir, table), keyed, rounding=True), keyed
    return out


def schema_conformed(spark, sf_dir):
    return reduce(
        DataFrame.unionByName,
        [types_of(f, table, c) for table, (f, c) in conformed_tables(spark, sf_dir).items()],
    )


def schema_written(spark, sf_dir):
    """The same of the tables written and read back."""
    found = []
    for table, (frame, columns) in conformed_tables(spark, sf_dir).items():
        target = scratch_table(spark, f"schema_{table}")
        write_table(frame, target)
        found.append(types_of(spark.table(target), table, columns))
    return reduce(DataFrame.unionByName, found)


# -- writers ---------------------------------------------------------------------------


def write_overwrite(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    target = scratch_table(spark, "overwrite")
    write_table(orders.withColumn("o_totalprice", F.lit(0.0)), target)
    write_table(orders, target)
    return spark.table(target)


def write_overwrite_keeps_layout(spark, sf_dir):
    """Overwritten without a word on partitions: they are those of the table before."""
    target = scratch_table(spark, "keeps_layout")
    orders = read(spark, sf_dir, "orders")
    write_table(orders.withColumn("o_totalprice", F.lit(0.0)), target, partition_by=["o_orderstatus"])
    write_table(orders, target)
    by_status = spark.table(target).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("o_totalprice").alias("max_price")
    )
    name = F.concat(F.lit("o_orderstatus="), F.col("o_orderstatus"))
    return spark.sql(f"SHOW PARTITIONS {target}").join(
        by_status, F.col("partition") == name
    ).select("partition", "n_rows", "max_price")


def accounts(spark: SparkSession, sf_dir: str, table: str, prefix: str) -> DataFrame:
    return read(spark, sf_dir, table).select(
        F.col(f"{prefix}_{'custkey' if prefix == 'c' else 'suppkey'}").alias("account"),
        F.col(f"{prefix}_name").alias("name"),
        F.col(f"{prefix}_nationkey").alias("nation"),
        F.col(f"{prefix}_acctbal").alias("balance"),
    )


def write_append(spark, sf_dir):
    target = scratch_table(spark, "append")
    write_table(accounts(spark, sf_dir, "customer", "c"), target, "append")
    write_table(accounts(spark, sf_dir, "supplier", "s"), target, "append")
    return spark.table(target)


def write_partitioned(spark, sf_dir):
    target = scratch_table(spark, "partitioned")
    write_table(read(spark, sf_dir, "orders"), target, partition_by=["o_orderstatus"])
    return spark.table(target)


def write_partitioned_append(spark, sf_dir):
    """The second write takes the partitioning the table has."""
    target = scratch_table(spark, "partitioned_append")
    customers = accounts(spark, sf_dir, "customer", "c")
    write_table(customers, target, partition_by=["nation"])
    write_table(accounts(spark, sf_dir, "supplier", "s"), target, "append")
    return spark.table(target)


def write_lineitem(spark, sf_dir):
    target = scratch_table(spark, "lineitem")
    lineitem = read(spark, sf_dir, "lineitem")
    write_table(lineitem, target, partition_by=["l_returnflag", "l_linestatus"])
    return spark.table(target)


def revenue(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(price).cast("double").alias("o_totalprice"), *extra)
    )


def merge_orders(spark, sf_dir):
    """Orders take the price summed from their lines; those without lines keep theirs."""
    target = scratch_table(spark, "merge_orders")
    write_table(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), target)
    write_table(revenue(spark, sf_dir), target, "merge", keys=["o_orderkey"])
    return spark.table(target)


def merge_accounts(spark, sf_dir):
    """Few rows are replaced, most are new."""
    target = scratch_table(spark, "merge_accounts")
    write_table(accounts(spark, sf_dir, "supplier", "s"), target)
    write_table(
        accounts(spark, sf_dir, "customer", "c"), target, "merge", keys=["account"]
    )
    return spark.table(target)


def merge_partitioned(spark, sf_dir):
    """The partition column is one of the keys; no source row has status P."""
    target = scratch_table(spark, "merge_partitioned")
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    write_table(
        read(spark, sf_dir, "orders").select(*columns), target, partition_by=["o_orderstatus"]
    )
    incoming = revenue(spark, sf_dir, F.min("l_linestatus").alias("o_orderstatus"))
    write_table(incoming, target, "merge", keys=["o_orderkey", "o_orderstatus"])
    return spark.table(target)


def merge_moving(spark, sf_dir):
    """As before, by the order alone: its row moves from one status to another."""
    target = scratch_table(spark, "merge_moving")
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    write_table(
        read(spark, sf_dir, "orders").select(*columns), target, partition_by=["o_orderstatus"]
    )
    incoming = revenue(spark, sf_dir, F.min("l_linestatus").alias("o_orderstatus"))
    write_table(incoming, target, "merge", keys=["o_orderkey"])
    return spark.table(target)


def merge_many_partitions(spark, sf_dir):
    """Over a thousand partitions, all of them touched; the partition is not a key."""
    target = scratch_table(spark, "merge_many")
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_orderkey") % 1201).alias("bin")
    )
    write_table(lines, target, partition_by=["bin"])
    firsts = lines.filter("l_linenumber = 1").groupBy("l_orderkey", "l_linenumber", "bin")
    incoming = firsts.agg((F.max("l_quantity") + 100).alias("l_quantity"))
    write_table(incoming, target, "merge", keys=["l_orderkey", "l_linenumber"])
    return spark.table(target)


def last_orders(spark, sf_dir):
    """The last order of each customer that has lines, with their quantity and last month."""
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    return (
        last.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey")
        .agg(
            F.sum("l_quantity").alias("o_totalprice"),
            F.date_format(F.max("l_shipdate"), "yyyy-MM").alias("month"),
        )
    )


def merge_exchange(spark, sf_dir):
    """Orders move between months; the partitions they leave and enter are exchanged, twice."""
    target = scratch_table(spark, "merge_exchange")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", month)
    write_table(orders, target, partition_by=["month"])
    for _ in range(2):
        write_table(last_orders(spark, sf_dir), target, "merge", keys=["o_orderkey"])
    return spark.table(target)


def merge_buckets(spark, sf_dir):
    """The last order of each nation's customers hits few of the buckets of a flat table."""
    target = scratch_table(spark, "merge_buckets")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_table(orders, target, buckets=Buckets(["o_orderkey"], 64))
    customers = read(spark, sf_dir, "customer")
    incoming = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.max("o_orderkey").alias("o_orderkey"))
        .select("o_orderkey", F.col("c_nationkey").cast("long").alias("o_custkey"),
                F.lit(0.0).alias("o_totalprice"))
    )
    write_table(incoming, target, "merge", keys=["o_orderkey"])
    return read_table(spark, target)


def apply_events(spark, sf_dir):
    """The later half of the events comes first, the earlier one late; errors delete."""
    events = read(spark, sf_dir, "events")
    middle = events.agg(F.percentile_approx("ts", 0.5).alias("middle"))
    halves = events.join(F.broadcast(middle))  # one row
    target = scratch_table(spark, "apply_changes")
    for half in ("ts >= middle", "ts < middle"):
        apply_changes(
            halves.filter(half),
            target,
            ["user_id"],
            "event_id",
            F.col("event_type") == "error",
            ["user_id", "event_id", "event_type", "value"],
        )
    return current_rows(spark, target)


def evolve_orders(spark, sf_dir):
    """Orders in narrow types are merged with wider ones that have one more column."""
    target = scratch_table(spark, "evolve_orders")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        F.col("o_totalprice").cast("decimal(10,1)").alias("o_totalprice"),
    )
    write_table(orders, target, buckets=Buckets(["o_orderkey"], 8))
    incoming = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").cast("decimal(14,3)").alias("o_totalprice"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    write_table(incoming, target, "merge", keys=["o_orderkey"], evolve=True)
    return as_text(read_table(spark, target))


def append_batches(spark, sf_dir):
    """A batch for each status, each tried twice."""
    target = scratch_table(spark, "append_once")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status in ("F", "O", "P", "O", "F", "P"):
        rows = orders.filter(F.col("o_orderstatus") == status)
        append_once(rows, target, f"status {status}", partition_by=["o_orderstatus"])
    return spark.table(target)


def write_clustered_lines(spark, sf_dir):
    """Lines along a curve through date and part; each year is read by the zone map."""
    target = scratch_table(spark, "write_clustered")
    lines = read(spark, sf_dir, "lineitem")
    write_clustered(lines, target, ["l_shipdate", "l_partkey"], 32)
    ends = lines.agg(F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate"))).first()
    years = []
    for year in range(ends[0], ends[1] + 1):
        first, last = (F.make_date(F.lit(year), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
        low, high = spark.range(1).select(
            first.cast("timestamp_ntz"), last.cast("timestamp_ntz") + F.expr("interval 86399.999999 seconds")
        ).first()
        here = in_zones(spark, target, {"l_shipdate": (low, high)})
        years.append(
            spark.table(target)
            .filter(here & F.col("l_shipdate").between(F.lit(low), F.lit(high)))
            .groupBy(F.lit(year).alias("year"))
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.sum("l_quantity").alias("quantity"),
                F.countDistinct("l_partkey").alias("n_parts"),
            )
        )
    return reduce(DataFrame.unionByName, years)


# -- splits, differences, keys, types --------------------------------------------------


def splits_orders(spark, sf_dir):
    """For several columns: is every row in one split, and is none over twice the mean."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.col("o_custkey")).alias("heavy"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("sparse"),
    )
    results = []
    for column in orders.columns:
        splits = equi_depth(orders, column, 16)
        sizes = (
            orders.select(column, split_of(orders, column, splits).alias("split"))
            .groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("n_set"))
        )
        results.append(
            sizes.agg(
                F.lit(column).alias("column_name"),
                F.sum("n").alias("n_rows"),
                F.sum("n_set").alias("n_set"),
                F.sum(F.when(F.col("split").between(0, len(splits) - 1), F.col("n"))).alias("n_in_one"),
                (F.max("n") <= 2 * F.avg("n")).alias("even"),
            )
        )
    return reduce(DataFrame.unionByName, results)


def diff_orders(spark, sf_dir):
    """Orders against a written copy in which some are missing, extra, changed and doubled."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = read(spark, sf_dir, "orders").select(*columns)
    ends = orders.groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )
    known = orders.join(ends, "o_custkey")
    price = F.when(F.col("o_orderstatus") == "P", F.floor("o_totalprice").cast("double"))
    altered = known.filter("o_orderkey <> first").withColumn(
        "o_totalprice", F.coalesce(price, "o_totalprice")
    )
    again = known.filter("o_orderkey = last")
    extra = again.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    target = scratch_table(spark, "diff_orders")
    copy = [df.select(*columns) for df in (altered, again, extra)]
    write_table(reduce(DataFrame.unionAll, copy), target)
    return diff_rows(orders, spark.table(target), ["o_orderkey"], rows_at_once=1000)


def keys_tables(spark, sf_dir):
    """The keys of up to two columns that each table could be merged by."""
    tables = {name: read(spark, sf_dir, name) for name in TABLES}
    return keys_of_tables(tables, width=2).select(
        "table_name", F.array_join("columns", ",").alias("key")
    )


def infer_events(spark, sf_dir):
    """Events with every column as text: which types they had."""
    events = read(spark, sf_dir, "events")
    return infer_types(events.select(*[F.col(c).cast("string") for c in events.columns]))


# -- looking and checking --------------------------------------------------------------


def count_tables(spark, sf_dir):
    counts = [
        row_count(read(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def preview_orders(spark, sf_dir):
    target = scratch_table(spark, "preview")
    write_table(read(spark, sf_dir, "orders"), target)
    return preview(spark, target, ["o_orderkey"])


def reconcile_orders(spark, sf_dir):
    target = scratch_table(spark, "reconcile")
    orders = read(spark, sf_dir, "orders")
    write_table(orders, target)
    columns = [
        c._replace(nullable=False)
        for c in declared(("o_orderkey", "bigint"), ("o_custkey", "bigint"))
    ]
    return reconcile(row_count(orders), spark.table(target), columns)


def reconcile_append(spark, sf_dir):
    """A lenient cast leaves nulls in a column declared NOT NULL."""
    target = scratch_table(spark, "reconcile_append")
    lineitem = read(spark, sf_dir, "lineitem")
    columns = [c._replace(nullable=c.column_name != "l_extendedprice") for c in narrow_columns(spark)]
    rows = conform(lineitem, columns, strict=False)
    write_table(rows, target)
    before = row_count(spark.table(target)).first()["n_rows"]
    write_table(rows, target, "append")
    return reconcile(row_count(lineitem), spark.table(target), columns, before)


# -- whole runs ------------------------------------------------------------------------


def ingested(spark: SparkSession, sf_dir: str, table: str, **settings) -> DataFrame:
    target = scratch_table(spark, f"ingest_{table}")
    tables = source(spark, sf_dir, table)
    ingest(spark, IngestConfig(tables, table, target_table=target, **settings))
    return spark.table(target)


def ingest_orders(spark, sf_dir):
    return ingested(spark, sf_dir, "orders", partition_cols=["o_orderstatus"])


def ingest_lineitem(spark, sf_dir):
    return ingested(spark, sf_dir, "lineitem")


def ingest_documents(spark, sf_dir):
    return ingested(spark, sf_dir, "documents", strict=False, partition_cols=["lang"])


def ingest_merge(spark, sf_dir):
    """The same events twice, merged by their key."""
    target = scratch_table(spark, "ingest_merge")
    config = IngestConfig(
        source(spark, sf_dir, "events"),
        "events",
        target_table=target,
        write_mode="merge",
        merge_keys=["event_id"],
    )
    ingest(spark, config)
    ingest(spark, config)
    return spark.table(target)


def ingest_inferred(spark, sf_dir):
    """Events as text under types that no rule knows: ingested with the types they show, twice
    as one batch, and compared with their source row by row."""
    events = read(spark, sf_dir, "events")
    texts = events.select(*[F.col(c).cast("string") for c in events.columns])
    columns = [MappedColumn(c, "mood", "mood", "string", True, "unknown") for c in events.columns]
    config = IngestConfig(
        FrameSource({"events": texts}),
        "events",
        target_table=scratch_table(spark, "ingest_inferred"),
        write_mode="append",
        merge_keys=["event_id"],
        infer_unknown=True,
        batch="all events",
    )
    reports = [ingest(spark, config, columns) for _ in range(2)]
    missing = differences(spark, config, reports[0].columns)
    target = spark.table(config.target)
    shown = target.select(*[F.col(c).cast("string") for c in target.columns])
    return shown.join(missing.select(F.col("event_id").cast("string")), "event_id", "left_anti")


def ingest_all(spark, sf_dir):
    """The report of one run per table, some of them at a time."""
    tables = source(spark, sf_dir)
    columns = mapped_tables(map_types(discover_columns(spark, tables)), TABLES)
    configs = [
        IngestConfig(tables, name, target_table=scratch_table(spark, f"all_{name}"))
        for name in TABLES
    ]
    reports = ingest_many(spark, configs, columns)
    rows = [(c.table, len(r.columns), *r.counts) for c, r in zip(configs, reports)]
    for config in configs:
        spark.sql(f"DROP TABLE {config.target}")
    return spark.createDataFrame(
        rows,
        "table_name string, n_columns int, source_rows bigint, target_rows bigint, "
        "rows_match boolean, null_violations bigint",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        discover_all, discover_one, discover_count, map_catalog, audit,
        map_rules, map_summary, map_normalise, map_decimal, map_arrays, map_nullability,
        map_unknown,
        conform_lineitem, conform_orders, conform_events, conform_documents,
        conform_embeddings, conform_money, conform_time, conform_lenient, lost_lineitem,
        altered_lineitem, altered_events, schema_conformed, schema_written,
        write_overwrite, write_overwrite_keeps_layout, write_append, write_partitioned, write_partitioned_append,
        write_lineitem, merge_orders, merge_accounts, merge_partitioned,
        merge_moving, merge_many_partitions, merge_exchange, merge_buckets, evolve_orders,
        splits_orders, diff_orders, keys_tables, infer_events,
        count_tables, preview_orders, reconcile_orders, reconcile_append,
        ingest_orders, ingest_lineitem, ingest_documents, ingest_merge, ingest_all,
        ingest_inferred,
    )
}
QUERIES |= {
    "apply_changes": apply_events,
    "append_once": append_batches,
    "write_clustered": write_clustered_lines,
}
