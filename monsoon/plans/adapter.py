"""Demand tables made from a TPC-H-like star: parts are item codes, nations are branches, line items are monthly sales."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILES = {"STANDARD": "3060", "ECONOMY": "4040", "MEDIUM": "6060", "SMALL": "3030", "LARGE": "8080", "PROMO": "1020"}


@dataclass(frozen=True)
class Sources:
    master_sku: DataFrame
    master_channel: DataFrame
    sales: DataFrame


def master_sku(part: DataFrame) -> DataFrame:
    nn = F.lpad(F.regexp_extract("p_brand", r"(\d+)", 1), 2, "0")
    number = nn.cast("int")
    kind = F.split("p_type", " ")[0]
    tile = F.create_map(*[F.lit(x) for pair in TILES.items() for x in pair])[kind]
    level = F.when(kind == "PROMO", "L2").otherwise("L1")
    base = F.when(F.col("p_size") == 49, None).when(F.col("p_size") == 50, F.concat(nn, F.lit(".L1"))).otherwise(F.concat_ws(".", nn, level, tile, F.concat(F.lit("B"), nn)))
    key = F.col("p_partkey")
    status = F.when((key % 7 == 0) | (number % 10 == 3), "inactive").when(key % 11 == 0, "Vô hiệu hóa").when(key % 2 == 0, " Hoạt động ").otherwise("active")
    channel = F.when(key % 5 == 1, "BAN CHUNG").when(key % 5 == 2, "CH1+CH2").when(key % 5 == 3, "HANG CT").when(key % 5 == 4, "CH1")
    return part.select(
        F.concat(F.lit("P"), key).alias("bravo_sku"), base.alias("base_sku"), status.alias("master_status"), F.lit("GACH").alias("product_group"), F.col("p_brand").alias("brand"),
        tile.alias("price_group"), F.concat(F.lit("F"), nn).alias("factory_code"), F.lit(None).cast("string").alias("pull_source"), channel.alias("branch_channel"),
    )


def master_channel(nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.where(key != 24).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lpad(key.cast("string"), 3, "0").alias("branch_code"), F.col("n_name").alias("branch_name"), F.col("r_name").alias("region"), F.concat(F.lit("CH"), key % 4).alias("brand"),
        F.when(key % 6 == 5, "inactive").otherwise("Hoạt động").alias("master_status"),
    )


def sales_monthly(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity"))
    rows = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("P"), F.col("l_partkey")).alias("bravo_sku"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("branch_code"),
        F.when(F.col("l_linenumber") == 7, "KG").otherwise("M2").alias("unit"), F.trunc("l_shipdate", "MM").alias("month"), quantity.alias("quantity"), F.col("l_extendedprice").alias("amount"),
    )
    return rows.groupBy("bravo_sku", "branch_code", "unit", "month").agg(F.sum("quantity").alias("total_quantity"), F.sum("amount").alias("total_amount"), F.count("*").alias("line_count"))


#: The tables that sources are made of.
TABLES = ("part", "nation", "region", "lineitem", "supplier")


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return Sources(master_sku(read("part")), master_channel(read("nation"), read("region")), sales_monthly(read("lineitem"), read("supplier")))
