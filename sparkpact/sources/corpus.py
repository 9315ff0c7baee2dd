"""Inputs derived from the supplied tables: contract documents and dirtied rows.

All views are row-wise expressions, so they work on batch tables and streams.
"""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpact.model import Column, Contract, Metadata


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly before costly per-row work: the few bytes of an order become a whole document."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


DEFECT = """
    CASE WHEN o_orderkey % 23 = 0 THEN 'cut_short'
         WHEN o_orderkey % 17 = 0 THEN 'no_columns_key'
         WHEN o_orderkey % 19 = 0 THEN 'amount_is_int'
         WHEN o_orderkey % 29 = 0 THEN 'id_twice'
         WHEN o_orderkey % 31 = 0 THEN 'blank_name'
         WHEN o_orderkey % 37 = 0 THEN 'numeric_version'
         WHEN o_orderkey % 41 = 0 THEN 'null_description'
         ELSE 'clean' END
"""

_COLUMNS = """
    filter(array(
        named_struct('name', 'id', 'data_type', 'string', 'nullable', false),
        named_struct('name', 'amount', 'data_type', if(defect = 'amount_is_int', 'int', 'number'),
                     'nullable', o_orderstatus <> 'F'),
        if(o_orderstatus <> 'P', named_struct('name', 'placed_on', 'data_type', 'timestamp', 'nullable', true), NULL),
        named_struct('name', 'priority', 'data_type', if(o_orderpriority < '3', 'string', 'integer'), 'nullable', true),
        if(o_orderkey % 5 = 0, named_struct('name', 'flag', 'data_type', 'boolean', 'nullable', false), NULL),
        if(defect = 'id_twice', named_struct('name', 'id', 'data_type', 'string', 'nullable', false), NULL)
    ), c -> c IS NOT NULL)
"""

_DOCUMENT = f"""
    to_json(named_struct(
        'contract_id', concat('cust-', o_custkey),
        'name', if(defect = 'blank_name', '   ', concat('Customer ', o_custkey)),
        'description', if(defect = 'null_description', parse_json('null'),
                          CAST(concat('Orders of customer ', o_custkey) AS VARIANT)),
        'version', if(defect = 'numeric_version', CAST(2 AS VARIANT),
                      CAST(concat(1 + o_orderkey % 3, '.0.0') AS VARIANT)),
        'columns', if(defect = 'no_columns_key', NULL, {_COLUMNS}),
        'metadata', if(o_orderkey % 7 = 0, NULL, named_struct(
            'data_owner', concat('Team ', o_orderpriority),
            'sla_max_latency_ms', 1000 * (1 + o_orderkey % 5)))
    ))
"""


def contract_corpus(orders: DataFrame) -> DataFrame:
    """One contract document per order: ``file_path, seq, raw``.

    The orders of a customer are the version history of one contract. Two orders
    in three share their ``seq`` with others of the customer; the path decides then.
    """
    return (
        orders.withColumn("defect", F.expr(DEFECT))
        .withColumn("document", F.expr(_DOCUMENT))
        .select(
            F.concat(F.lit("all/customer/"), F.col("o_custkey"), F.lit("/"), F.col("o_orderkey"), F.lit(".json")).alias("file_path"),
            F.expr("if(o_orderkey % 3 = 0, o_orderkey, o_orderkey - o_orderkey % 5000)").alias("seq"),
            F.when(F.col("defect") == "cut_short", F.expr("left(document, length(document) - 10)"))
            .otherwise(F.col("document"))
            .alias("raw"),
        )
    )


ORDERS_CONTRACT = Contract(
    contract_id="orders-v1",
    name="Orders",
    description="Orders as they arrive",
    columns=(
        Column("o_orderkey", "integer", nullable=False),
        Column("o_custkey", "integer", nullable=False),
        Column("o_totalprice", "number", nullable=False),
        Column("o_orderdate", "date", nullable=False),
        Column("o_orderstatus", "string", nullable=False),
        Column("o_orderpriority", "string"),
    ),
)


# Documents that break the rules which those of orders never break.
ODD = """
    CASE p_partkey % 20
         WHEN 0 THEN '[1, 2]'
         WHEN 1 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": "id"}'
         WHEN 2 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [7, {"name": "id", "data_type": "string"}]}'
         WHEN 3 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"data_type": "string"}]}'
         WHEN 4 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": "id"}]}'
         WHEN 5 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": " ", "data_type": "string"}]}'
         WHEN 6 THEN '{"contract_id": " ", "name": "N", "description": "", "columns": [{"name": "id", "data_type": "string"}]}'
         WHEN 7 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": []}'
         WHEN 8 THEN '{"columns": [{"name": "id", "data_type": "string"}]}'
         WHEN 9 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": "id", "data_type": "string", "nullable": "yes"}],
                       "metadata": {"sla_uptime_percentage": "99.5", "sla_max_latency_ms": "250", "data_owner": "O", "other": 1}}'
         WHEN 10 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": "id", "data_type": "string", "nullable": 1}],
                        "metadata": {"sla_max_latency_ms": null}}'
         WHEN 11 THEN '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": "id", "data_type": "string"}], "metadata": [1]}'
         ELSE '{"contract_id": "P", "name": "N", "description": "D", "columns": [{"name": "id", "data_type": "string"}]}' END
"""


def odd_corpus(part: DataFrame) -> DataFrame:
    """One document per part: ``file_path, seq, raw``. Ids of parts come in two spellings that name one table."""
    spelled = F.expr("concat(if(p_partkey % 2 = 0, 'Part-', 'part_'), p_partkey div 2)")
    return part.select(
        F.concat(F.lit("current/part/"), F.col("p_partkey"), F.when(F.col("p_partkey") % 25 == 0, ".txt").otherwise(".json")).alias("file_path"),
        F.col("p_partkey").alias("seq"),
        F.replace(F.expr(ODD), F.lit('"contract_id": "P"'), F.concat(F.lit('"contract_id": "'), spelled, F.lit('"'))).alias("raw"),
    )


def supplier_corpus(supplier: DataFrame, version: int) -> DataFrame:
    """One document per supplier: ``file_path, seq, raw``. The second version adds a column, and retypes one for every fourth."""
    second = version > 1
    column = "named_struct('name', '{}', 'data_type', {}, 'nullable', true)".format
    kind = "if(s_suppkey % 4 = 0, 'string', 'number')" if second else "'number'"
    columns = [column("id", "'integer'"), column("balance", kind), *([column("nation", "'string'")] if second else [])]
    document = f"""
        to_json(named_struct('contract_id', concat('Supp-', s_suppkey), 'name', s_name, 'description', 'A supplier',
                             'version', '{version}.0.0', 'columns', array({', '.join(columns)})))
    """
    path = F.concat(F.lit("current/supplier/"), F.col("s_suppkey"), F.lit(".json"))
    return supplier.select(path.alias("file_path"), F.lit(version).cast("bigint").alias("seq"), F.expr(document).alias("raw"))


def orders_dirty(orders: DataFrame, *more: SparkColumn) -> DataFrame:
    """Orders with nulls, unreadable numbers and impossible dates put in, and ``more`` columns."""
    key = F.col("o_orderkey")
    return orders.select(
        key,
        F.when(key % 11 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 13 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 7 == 0, F.lit("1998-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        "o_orderstatus",
        "o_orderpriority",
        *more,
    )


LINEITEM_CONTRACT = Contract(
    contract_id="lineitem-v1",
    name="Line items",
    description="Order lines as they arrive",
    columns=(
        Column("l_orderkey", "integer", nullable=False),
        Column("l_partkey", "integer", nullable=False),
        Column("l_quantity", "number", nullable=False),
        Column("l_discount", "number", nullable=False),
        Column("l_returnflag", "string", nullable=False),
        Column("l_shipdate", "date", nullable=False),
        Column("l_comment", "string"),
        Column("l_receiptdate", "date", nullable=False),
    ),
)


def lineitem_dirty(lineitem: DataFrame) -> DataFrame:
    """Line items with defects spread over keys, one column missing and extra ones."""
    key = F.col("l_orderkey")
    return lineitem.select(
        key,
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey")).alias("l_partkey"),
        F.when(key % 13 == 0, F.lit("many")).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        "l_discount",
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
        "l_shipdate",
        "l_linestatus",
        "l_tax",
    )


EVENTS_CONTRACT = Contract(
    contract_id="events-v1",
    name="Events",
    description="User events",
    columns=(
        Column("event_id", "integer", nullable=False),
        Column("ts", "timestamp", nullable=False),
        Column("user_id", "integer", nullable=False),
        Column("event_type", "string", nullable=False),
        Column("value", "number"),
        Column("props", "object"),
    ),
    metadata=Metadata(data_owner="Product", sla_uptime_percentage=99.0),
)


def events_arrived(events: DataFrame) -> DataFrame:
    """Events with the time they arrived, up to 12 seconds late."""
    delay = F.expr("make_dt_interval(0, 0, 0, (event_id % 12000) / 1000.0)")
    return events.withColumn("arrival_ts", F.col("ts") + delay)


def events_dirty(events: DataFrame) -> DataFrame:
    """Events with missing users and values that are no numbers."""
    key = F.col("event_id")
    return events.select(
        "event_id",
        "ts",
        F.when(key % 13 != 0, F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(key % 17 == 0, F.lit("broken")).otherwise(F.col("value").cast("string")).alias("value"),
        "props",
    )


PROPS_CONTRACT = Contract(
    contract_id="event-props-v1",
    name="Event properties",
    description="What an event carries",
    columns=(Column("k", "integer", nullable=False), Column("note", "string")),
)


def event_props(events: DataFrame) -> DataFrame:
    """``event_id, props``: JSON texts, some cut short, some with a value of the wrong type."""
    key = F.col("event_id")
    return events.select(
        "event_id",
        F.when(key % 9 == 0, F.expr("left(props, length(props) - 1)"))
        .when(key % 10 == 1, F.lit('{"k": "many"}'))
        .otherwise(F.col("props"))
        .alias("props"),
    )
