"""An incident event log derived from the order tables.

One order is one incident and each of its lines is one lifecycle event. It
gives every registered query real input whose size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.operators.cleaning import ROW_ORDER, clean_incidents
from breachscope.session import settle


def _text(column) -> F.Column:
    return column.cast("string")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed lifecycle events."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    a = (part * 31 + supp * 17) % 1000
    b = (part * 53 + supp * 29) % 1000
    group_no = F.floor((a * a) / F.lit(5000.0)).cast("int")
    category_no = F.floor((b * b) / F.lit(12000.0)).cast("int")
    moves = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") - 1).otherwise(0)
    weight = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 80)
        .when(F.col("o_orderpriority") == "2-HIGH", 60)
        .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), 5)
        .otherwise(0)
    )
    minutes = (
        F.col("l_linenumber") * F.col("l_quantity") * 60
        + F.floor("l_extendedprice").cast("bigint") % 60
    ).cast("int")
    updated = F.col("o_orderdate") + F.make_dt_interval(mins=minutes)
    closing = (F.col("l_quantity") * 37 + F.col("l_linenumber")).cast("int")
    is_resolved = ~((F.col("l_linestatus") == "O") & (F.col("l_discount") < 0.015))
    is_closed = is_resolved & (F.col("l_tax") < 0.075)
    burden = F.col("l_quantity") + weight + moves * 8 + (group_no * 37) % 120 + (category_no * 23) % 120
    # Both tables grow with the data: neither side is broadcast.
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat(F.lit("INC"), F.lpad(_text(F.col("o_orderkey")), 10, "0")).alias("number"),
        F.col("o_orderdate").alias("opened_at"),
        updated.alias("sys_updated_at"),
        F.when(is_resolved, updated).alias("resolved_at"),
        F.when(is_closed, updated + F.make_dt_interval(mins=closing)).alias("closed_at"),
        (~(burden > 160)).alias("made_sla"),
        (F.col("l_linestatus") == "O").alias("active"),
        moves.alias("reassignment_count"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") >= 0.09), 1)
        .otherwise(0)
        .alias("reopen_count"),
        F.col("l_linenumber").alias("sys_mod_count"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Closed").alias("incident_state"),
        F.when(
            ~((F.col("l_discount") < 0.005) & (F.col("l_linestatus") == "F")),
            F.concat(F.lit("Category "), _text(category_no)),
        ).alias("category"),
        F.when(
            ~(F.col("l_tax") >= 0.08), F.concat(F.lit("Group "), _text(group_no))
        ).alias("assignment_group"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "1 - Critical")
        .when(F.col("o_orderpriority") == "2-HIGH", "2 - High")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "3 - Moderate")
        .when(F.col("o_orderpriority") == "5-LOW", "4 - Low")
        .alias("priority"),
        F.concat(F.lit("Caller "), _text(F.col("o_custkey"))).alias("caller_id"),
        F.concat(F.lit("Resolver "), _text(supp)).alias("resolved_by"),
        # The tables have no line order; these columns settle equal times.
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias(ROW_ORDER),
    )


def raw_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as the all-text log a help desk exports."""
    return as_texts(event_log(spark, sf_dir))


def as_texts(typed: DataFrame) -> DataFrame:
    """Events in the columns of the export; what they lack is unknown."""
    present = {f.name: f.dataType.typeName() for f in typed.schema}
    shown = []
    for name in S.RAW_COLUMNS:
        kind = present.get(name)
        if kind is None:
            text = F.lit("?")
        elif kind == "timestamp_ntz":
            text = F.date_format(name, "d/M/yyyy HH:mm")
        elif kind == "boolean":
            text = F.when(F.col(name), "true").otherwise("FALSE ")
        else:
            text = _text(F.col(name))
        shown.append(F.coalesce(text, F.lit("?")).alias(name))
    return typed.select(*shown, ROW_ORDER)


def incidents(
    spark: SparkSession, sf_dir: str, columns: list[str] | None = None, settled: bool = False
) -> DataFrame:
    """Incidents of the log; ``settled`` writes them once for several readers."""
    frame = clean_incidents(event_log(spark, sf_dir), columns)
    return settle(frame) if settled else frame
