"""The registered queries in DuckDB's SQL, written without the library."""

from __future__ import annotations

# The types the given tables have, by column.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}

# Type names and the Spark type of each, numbered from 1.
RULES = """
smallint: smallint
int2: smallint
integer: int
int: int
int4: int
bigint: bigint
int8: bigint
serial: int
bigserial: bigint
smallserial: smallint
numeric: decimal(38,18)
decimal: decimal(38,18)
money: double
real: float
float4: float
double precision: double
float8: double
float: double
character varying: string
varchar: string
character: string
char: string
bpchar: string
text: string
name: string
citext: string
bytea: binary
boolean: boolean
bool: boolean
date: date
timestamp: timestamp
timestamp without time zone: timestamp
timestamp with time zone: timestamp
timestamptz: timestamp
time: string
time without time zone: string
time with time zone: string
timetz: string
interval: string
inet: string
cidr: string
macaddr: string
macaddr8: string
json: string
jsonb: string
uuid: string
xml: string
bit: string
bit varying: string
varbit: string
point: string
line: string
lseg: string
box: string
path: string
polygon: string
circle: string
int4range: string
int8range: string
numrange: string
tsrange: string
tstzrange: string
daterange: string
tsvector: string
tsquery: string
pg_lsn: string
txid_snapshot: string
oid: bigint
hstore: ?
serial4: ?
xid: ?
varchar(20): ?
USER-DEFINED: ?
array: array<string>
"""


def _rules_values() -> str:
    rows = []
    for number, line in enumerate(RULES.strip().splitlines(), start=1):
        name, spark_type = line.split(": ")
        status = "unknown" if spark_type == "?" else "ok"
        rows.append(f"({number}, '{name}', '{spark_type.replace('?', 'string')}', '{status}')")
    return ", ".join(rows)


_RULES = f"rules(number, name, spark_type, status) as (values {_rules_values()})"
_N_RULES = len(RULES.strip().splitlines())

_TABLE_LIST = ", ".join(f"'{t}'" for t in COLUMNS)

_COUNTS = " union all ".join(
    f"select '{table}' as table_name, '{column}' as column_name, count(*) as n_rows, "
    f"count(*) - count({column}) as n_nulls from {table}"
    for table, columns in COLUMNS.items()
    for column in columns.split()
)

_CATALOG = f"""
counts as ({_COUNTS}),
catalog as (
  select c.table_name, c.column_name, cast(c.ordinal_position as int) as ordinal_position,
    case c.data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'integer'
      when 'DOUBLE' then 'double precision' when 'VARCHAR' then 'text'
      when 'TIMESTAMP' then 'timestamp without time zone'
      when 'FLOAT[]' then 'real[]' else lower(c.data_type) end as data_type,
    case c.data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
      when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp'
      when 'FLOAT[]' then 'array<float>' else 'string' end as spark_type,
    n.n_rows, n.n_nulls
  from information_schema.columns c
  join counts n on n.table_name = c.table_name and n.column_name = c.column_name
  where c.table_name in ({_TABLE_LIST}))"""

_KEYS = "l_orderkey, l_partkey, l_linenumber"
_ANY_NAME = f"join rules on rules.number = (l_partkey + l_linenumber) % {_N_RULES} + 1"

_REVENUE = """
select l_orderkey as o_orderkey,
  cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as o_totalprice,
  min(l_linestatus) as o_orderstatus
from lineitem group by l_orderkey"""

_CUSTOMERS = """select c_custkey as account, c_name as name, c_nationkey as nation,
  c_acctbal as balance from customer"""
_SUPPLIERS = """select s_suppkey as account, s_name as name, s_nationkey as nation,
  s_acctbal as balance from supplier"""

# The declared types of four tables, as Spark spells them.
_DECLARED = {
    "lineitem": "l_shipdate date, l_orderkey bigint, l_linenumber smallint, l_partkey int, "
    "l_suppkey string, l_quantity smallint, l_extendedprice decimal(10;2), "
    "l_discount decimal(3;2), l_tax double, l_returnflag string",
    "orders": "o_orderkey string, o_custkey int, o_totalprice decimal(12;2), o_orderdate date, "
    "o_orderstatus string",
    "events": "event_id bigint, ts timestamp, value int, props string",
    "embeddings": "vec_id bigint, embedding array<double>",
}

_SCHEMAS = " union all ".join(
    f"select '{table}' as table_name, count(*) as n_rows, '{column}' as column_name, "
    f"'{kind}' as type, {str(not column.endswith(('key', '_id'))).lower()} as nullable "
    f"from {table}"
    for table, columns in _DECLARED.items()
    for column, kind in (c.replace(";", ",").split(" ") for c in columns.split(", "))
)


def _minimal_keys() -> str:
    """Every column and pair of columns of every table, counted; the unique ones without a
    smaller one in them."""
    parts = []
    for table, columns in COLUMNS.items():
        names = columns.split()
        sets = [(c,) for c in names]
        sets += [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        full = [" and ".join(f"{c} is not null" for c in s) for s in sets]
        counts = ", ".join(
            f"count(distinct case when {f} then ({', '.join(s)}) end)" for f, s in zip(full, sets)
        )
        parts.append(
            f"""select '{table}' as table_name, unnest({[list(s) for s in sets]}) as k,
              unnest(counts) as found, n from (select [{counts}] as counts, count(*) as n from {table})"""
        )
    return f"""
        with u as (select * from ({" union all ".join(parts)}) where found = n and n > 0)
        select table_name, array_to_string(k, ',') as key from u
        where not exists (select 1 from u v where v.table_name = u.table_name
          and len(v.k) < len(u.k) and list_contains(u.k, v.k[1]))"""


ORACLES: dict[str, str] = {
    # discovery and mapping of the tables' own columns
    "discover_all": f"""
        with {_CATALOG}
        select table_name, column_name, data_type, ordinal_position, 'YES' as is_nullable,
          n_rows, n_nulls from catalog""",
    "discover_one": f"""
        with {_CATALOG}
        select column_name, data_type, ordinal_position, n_rows from catalog
        where table_name = 'orders' order by ordinal_position""",
    "discover_count": f"""
        with {_CATALOG}
        select table_name, count(*) as n_columns, max(n_rows) as n_rows from catalog
        group by table_name""",
    "map_catalog": f"""
        with {_CATALOG}
        select table_name, column_name, spark_type, true as nullable, n_rows,
          cast(0 as bigint) as n_lost from catalog""",
    "audit": f"""
        with {_CATALOG}
        select table_name, column_name, data_type, spark_type, 'ok' as status, n_nulls,
          cast(0 as bigint) as n_lost from catalog""",
    # mapping of a catalog as long as lineitem
    "map_rules": f"""
        with {_RULES}
        select {_KEYS}, name as data_type, spark_type, status from lineitem {_ANY_NAME}""",
    "map_summary": f"""
        with {_RULES}
        select spark_type, status, count(*) as n_columns from lineitem {_ANY_NAME}
        group by spark_type, status""",
    "map_normalise": f"""
        with {_RULES},
        spelled as (
          select {_KEYS}, cast(l_quantity % 3 as int) as array_dimensions,
            case when l_linestatus = 'O' then '  ' else '' end
            || case l_returnflag when 'A' then upper(name)
                 when 'R' then upper(substr(name, 1, 1)) || substr(name, 2) else name end
            || repeat(case when l_linestatus = 'O' then '[]' else ' []' end, l_linenumber % 4)
            || case when l_linestatus = 'O' then '  ' else '' end as data_type
          from lineitem {_ANY_NAME}),
        parsed as (
          select *, regexp_replace(lower(trim(data_type)), '(\\s*\\[\\])+$', '') as bare,
            length(data_type) - length(replace(data_type, '[', '')) + array_dimensions as depth
          from spelled),
        typed as (
          select parsed.*, case when bare = 'array' then 'string'
              else coalesce(rules.spark_type, 'string') end as element,
            case when bare = 'array' then greatest(depth, 1) else depth end as n
          from parsed left join rules on rules.name = bare)
        select {_KEYS}, data_type, array_dimensions,
          repeat('array<', n) || element || repeat('>', n) as spark_type from typed""",
    "map_decimal": f"""
        with stated as (
          select {_KEYS}, case when l_linenumber > 3 then 'numeric' else 'decimal' end as data_type,
            case when l_returnflag <> 'A' then cast(l_quantity as int) end as p,
            case when l_linestatus <> 'O' then cast(round(l_discount * 100) * 3 - 2 as int) end as s
          from lineitem),
        filled as (select *, coalesce(p, 38) as fp, coalesce(s, 18) as fs from stated),
        judged as (select *, fp between 1 and 38 and fs between 0 and fp as fits from filled)
        select {_KEYS}, data_type, coalesce(cast(p as varchar), 'not stated') as numeric_precision,
          coalesce(cast(s as varchar), 'not stated') as numeric_scale,
          case when fits then 'decimal(' || fp || ',' || fs || ')' else 'string' end as spark_type,
          case when fits then 'ok' else 'invalid_decimal' end as status
        from judged""",
    "map_arrays": f"""
        with udts(number, udt_name, element, status) as (values
          (1, '_int2', 'smallint', 'ok'), (2, '_int4', 'int', 'ok'), (3, '_int8', 'bigint', 'ok'),
          (4, '_float4', 'float', 'ok'), (5, '_float8', 'double', 'ok'),
          (6, '_text', 'string', 'ok'), (7, '_bool', 'boolean', 'ok'),
          (8, '_numeric', 'decimal(38,18)', 'ok'), (9, '_timestamptz', 'timestamp', 'ok'),
          (10, '_mood', 'string', 'unknown')),
        typed as (
          select {_KEYS}, l_linenumber % 3 as array_dimensions,
            greatest(l_linenumber % 3, 1) as n,
            case when l_returnflag = 'N' then 'not stated' else udt_name end as udt_name,
            case when l_returnflag = 'N' then 'string' else element end as element,
            case when l_returnflag = 'N' then 'ok' else status end as status
          from lineitem join udts on udts.number = l_partkey % 10 + 1)
        select {_KEYS}, udt_name, array_dimensions, status,
          repeat('array<', n) || element || repeat('>', n) as spark_type from typed""",
    "map_nullability": f"""
        select {_KEYS},
          case when l_linenumber >= 6 then 'not stated' when l_returnflag = 'A' then 'YES'
            when l_returnflag = 'N' then 'no' else 'NO ' end as is_nullable,
          not (l_linenumber < 6 and l_returnflag = 'N') as nullable
        from lineitem""",
    "map_unknown": """
        with words as (
          select 'part' as table_name, p_type as data_type from part
          union all select 'customer', c_mktsegment from customer
          union all select 'orders', o_orderpriority from orders
          union all select 'events', event_type from events
          union all select 'documents', lang from documents)
        select table_name, data_type, 'string' as spark_type, 'unknown' as status,
          count(*) as n_columns
        from words group by table_name, data_type""",
    # casts
    "conform_lineitem": """
        select cast(cast(l_shipdate as date) as varchar) as l_shipdate, l_orderkey,
          cast(l_linenumber as smallint) as l_linenumber, cast(l_partkey as int) as l_partkey,
          cast(l_suppkey as varchar) as l_suppkey, cast(l_quantity as smallint) as l_quantity,
          cast(cast(l_extendedprice as decimal(10,2)) as varchar) as l_extendedprice,
          cast(cast(l_discount as decimal(3,2)) as varchar) as l_discount, l_tax, l_returnflag
        from lineitem""",
    "conform_orders": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as int) as o_custkey,
          cast(cast(o_totalprice as decimal(12,2)) as varchar) as o_totalprice,
          cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderstatus
        from orders""",
    "conform_events": """
        select event_id, ts, cast(trunc(value) as int) as value, props from events""",
    "conform_documents": """
        select cast(doc_id as int) as doc_id, text, lang,
          cast(cast(n_chars as decimal(9,0)) as varchar) as n_chars from documents""",
    "conform_embeddings": """
        select vec_id, pos, cast(embedding[pos] as double) as v
        from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as pos
              from embeddings)""",
    "conform_money": "select c_custkey, c_acctbal from customer",
    "conform_time": "select event_id, strftime(ts, '%H:%M:%S.%f') as ts from events",
    "conform_lenient": """
        select l_orderkey, l_linenumber,
          cast(try_cast(l_extendedprice as decimal(6,2)) as varchar) as l_extendedprice,
          cast(try_cast(l_quantity as decimal(3,2)) as varchar) as l_quantity,
          case l_returnflag when 'N' then 'false' end as l_returnflag,
          case l_linestatus when 'F' then 'false' end as l_linestatus
        from lineitem""",
    "lost_lineitem": """
        select 'l_orderkey' as column_name, count(*) as n_rows, cast(0 as bigint) as n_nulls,
          cast(0 as bigint) as n_lost from lineitem
        union all select 'l_linenumber', count(*), 0, 0 from lineitem
        union all select 'l_extendedprice', count(*), 0,
          count(*) filter (where l_extendedprice >= 9999.995) from lineitem
        union all select 'l_quantity', count(*), 0, count(*) filter (where l_quantity >= 9.995)
          from lineitem
        union all select 'l_returnflag', count(*), 0, count(*) filter (where l_returnflag <> 'N')
          from lineitem
        union all select 'l_linestatus', count(*), 0, count(*) filter (where l_linestatus <> 'F')
          from lineitem""",
    "altered_lineitem": """
        select 'l_orderkey' as column_name, count(*) as n_rows, cast(0 as bigint) as n_nulls,
          cast(0 as bigint) as n_lost, cast(0 as bigint) as n_altered from lineitem
        union all select 'l_quantity', count(*), 0, 0,
          count(*) filter (where trunc(l_quantity) <> l_quantity) from lineitem
        union all select 'l_extendedprice', count(*), 0, 0, count(*) filter (
          where cast(cast(l_extendedprice as decimal(10,1)) as double) <> l_extendedprice)
          from lineitem
        union all select 'l_discount', count(*), 0, 0, count(*) filter (
          where cast(cast(l_discount as decimal(3,1)) as double) <> l_discount) from lineitem
        union all select 'l_tax', count(*), 0, 0, count(*) filter (
          where cast(cast(l_tax as float) as double) <> l_tax) from lineitem
        union all select 'l_shipdate', count(*), 0, 0, count(*) filter (
          where date_trunc('day', l_shipdate) <> l_shipdate) from lineitem""",
    "altered_events": """
        select 'event_id' as column_name, count(*) as n_rows, count(*) - count(event_id) as n_nulls,
          cast(0 as bigint) as n_lost, count(*) filter (
            where cast(cast(event_id as double) as bigint) <> event_id) as n_altered from events
        union all select 'ts', count(*), count(*) - count(ts), 0,
          count(*) filter (where date_trunc('day', ts) <> ts) from events
        union all select 'value', count(*), count(*) - count(value), 0,
          count(*) filter (where trunc(value) <> value) from events""",
    "schema_conformed": _SCHEMAS,
    "schema_written": _SCHEMAS,
    # writers
    "write_overwrite": "select * from orders",
    "write_overwrite_keeps_layout": """
        select 'o_orderstatus=' || o_orderstatus as partition, count(*) as n_rows,
          max(o_totalprice) as max_price from orders group by o_orderstatus""",
    "write_append": f"{_CUSTOMERS} union all {_SUPPLIERS}",
    "write_partitioned": "select * from orders",
    "write_partitioned_append": f"{_CUSTOMERS} union all {_SUPPLIERS}",
    "write_lineitem": "select * from lineitem",
    "merge_orders": f"""
        with s as ({_REVENUE})
        select o_orderkey, o_totalprice from orders t
        where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)
        union all select o_orderkey, o_totalprice from s""",
    "merge_accounts": f"""
        with s as ({_CUSTOMERS}), t as ({_SUPPLIERS})
        select * from t where not exists (select 1 from s where s.account = t.account)
        union all select * from s""",
    "merge_partitioned": f"""
        with s as ({_REVENUE})
        select o_orderkey, o_totalprice, o_orderstatus from orders t
        where not exists (select 1 from s where s.o_orderkey = t.o_orderkey
                            and s.o_orderstatus = t.o_orderstatus)
        union all select o_orderkey, o_totalprice, o_orderstatus from s""",
    "merge_moving": f"""
        with s as ({_REVENUE})
        select o_orderkey, o_totalprice, o_orderstatus from orders t
        where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)
        union all select o_orderkey, o_totalprice, o_orderstatus from s""",
    "merge_many_partitions": """
        with s as (
          select l_orderkey, l_linenumber, max(l_quantity) + 100 as l_quantity,
            l_orderkey % 1201 as bin
          from lineitem where l_linenumber = 1 group by l_orderkey, l_linenumber)
        select l_orderkey, l_linenumber, l_quantity, l_orderkey % 1201 as bin from lineitem
        where l_linenumber <> 1
        union all select l_orderkey, l_linenumber, l_quantity, bin from s""",
    "merge_exchange": """
        with s as (
          select l_orderkey as o_orderkey, sum(l_quantity) as o_totalprice,
            strftime(max(l_shipdate), '%Y-%m') as month
          from lineitem
          where l_orderkey in (select max(o_orderkey) from orders group by o_custkey)
          group by l_orderkey)
        select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from orders t
        where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)
        union all select * from s""",
    "merge_buckets": """
        with s as (
          select max(o_orderkey) as o_orderkey, cast(c_nationkey as bigint) as o_custkey,
            cast(0 as double) as o_totalprice
          from orders join customer on o_custkey = c_custkey group by c_nationkey)
        select o_orderkey, o_custkey, o_totalprice from orders t
        where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)
        union all select * from s""",
    "apply_changes": """
        select user_id, event_id, event_type, value from events
        qualify row_number() over (partition by user_id order by event_id desc) = 1
          and event_type <> 'error'""",
    "evolve_orders": """
        with s as (
          select cast(l_orderkey as bigint) as o_orderkey,
            cast(sum(l_quantity) as decimal(14,3)) as o_totalprice, count(*) as n_lines
          from lineitem group by l_orderkey)
        select o_orderkey, cast(o_totalprice as varchar) as o_totalprice, n_lines from s
        union all
        select o_orderkey,
          cast(cast(cast(o_totalprice as decimal(10,1)) as decimal(14,3)) as varchar), null
        from orders t where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)""",
    "append_once": "select o_orderkey, o_orderstatus, o_totalprice from orders",
    "write_clustered": """
        select cast(year(l_shipdate) as int) as year, count(*) as n_rows,
          sum(l_quantity) as quantity, count(distinct l_partkey) as n_parts
        from lineitem group by all""",
    # splits, differences, keys, types
    "splits_orders": " union all ".join(
        f"""select '{name}' as column_name, count(*) as n_rows, count({value}) as n_set,
          count(*) as n_in_one, true as even from orders"""
        for name, value in {
            "o_orderkey": "o_orderkey", "o_custkey": "o_custkey",
            "o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate", "heavy": "o_custkey",
            "sparse": "case when o_orderstatus <> 'F' then o_custkey end",
        }.items()
    ),
    "diff_orders": """
        with k as (select o_custkey, min(o_orderkey) as lo, max(o_orderkey) as hi
                   from orders group by o_custkey),
        a as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders),
        b as (
          select o_orderkey, o_custkey, o_orderstatus,
            case when o_orderstatus = 'P' then floor(o_totalprice) else o_totalprice end
              as o_totalprice
          from a join k using (o_custkey) where o_orderkey <> lo
          union all select a.* from a join k using (o_custkey) where o_orderkey = hi
          union all select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice
          from a join k using (o_custkey) where o_orderkey = hi),
        m as (select *, 'source' as side from (select * from a except all select * from b)
              union all
              select *, 'target' as side from (select * from b except all select * from a)),
        c as (select o_orderkey from m group by o_orderkey having count(distinct side) = 2)
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, side, count(*) as copies,
          case when o_orderkey in (select * from c) then 'changed'
               when side = 'source' then 'missing' else 'extra' end as kind
        from m group by all""",
    "keys_tables": _minimal_keys(),
    "infer_events": """
        with t as (select max(event_id) as e, max(user_id) as u,
            count(distinct length(split_part(cast(value as varchar), '.', 2))) as scales,
            max(length(cast(value as varchar))) - 1 as digits,
            max(length(split_part(cast(value as varchar), '.', 2))) as scale,
            count(*) as n from events),
        i as (select unnest(['event_id', 'user_id']) as column_name, unnest([e, u]) as most, n from t)
        select column_name, case when most <= 32767 then 'smallint'
          when most <= 2147483647 then 'int' else 'bigint' end as spark_type, n as n_set from i
        union all select 'ts', 'timestamp', n from t
        union all select 'event_type', 'string', n from t
        union all select 'value', case when scales = 1
          then 'decimal(' || digits || ',' || scale || ')' else 'double' end, n from t
        union all select 'props', 'string', n from t""",
    # looking and checking
    "count_tables": " union all ".join(
        f"select '{table}' as table_name, count(*) as n_rows from {table}" for table in COLUMNS
    ),
    "preview_orders": "select * from orders order by o_orderkey limit 10",
    "reconcile_orders": """
        select count(*) as source_rows, count(*) as target_rows, true as rows_match,
          2 * count(*) - count(o_orderkey) - count(o_custkey) as null_violations from orders""",
    "reconcile_append": """
        select count(*) as source_rows, 2 * count(*) as target_rows, true as rows_match,
          2 * (count(*) - count(try_cast(l_extendedprice as decimal(6,2)))) as null_violations
        from lineitem""",
    # whole runs
    "ingest_orders": "select * from orders",
    "ingest_lineitem": "select * from lineitem",
    "ingest_documents": "select * from documents",
    "ingest_merge": "select * from events",
    "ingest_inferred": """
        select cast(event_id as varchar) as event_id, cast(ts as varchar) as ts,
          cast(user_id as varchar) as user_id, event_type, cast(value as varchar) as value, props
        from events""",
    "ingest_all": " union all ".join(
        f"select '{table}' as table_name, {len(columns.split())} as n_columns, "
        "count(*) as source_rows, count(*) as target_rows, true as rows_match, "
        f"cast(0 as bigint) as null_violations from {table}"
        for table, columns in COLUMNS.items()
    ),
}
