"""Filing records derived from the supplied tables, with the defects the jobs must handle.

Every row of the tables becomes a record. The conditions on remainders below plant defects: missing
keys, negative values, unlisted customers, unmarked messages.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.functions.columns import quarter_end
from filingmill.operators.quarantine import clean_branches, clean_financials
from filingmill.operators.projection import BAD_CAST, BAD_VALUES, project_snapshots
from filingmill.operators.scd2 import build_history
from filingmill.plans import models
from filingmill.schemas import BRANCHES, DT_MARKER, FINANCIALS, HISTORY
from filingmill.session import new_folder, prepare
from filingmill.sources.warehouse import typed


def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 12, "0")


def _day_text(day: Column) -> Column:
    return day.cast("string")


@dataclass(frozen=True)
class Inputs:
    """The supplied tables read as raw filings, and the layers above them, all lazy."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        prepare(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self, label: str) -> str:
        return new_folder(self.spark, label)

    @cached_property
    def _customers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        customer = self.table("customer")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey)

    @cached_property
    def _orders(self) -> DataFrame:
        orders = self.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
        return orders.join(self._customers, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def raw_financials(self) -> DataFrame:
        """One filing per order; several orders of a customer in a quarter are restatements."""
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        return self._orders.select(
            F.when(key % 97 != 0, F.col("o_custkey")).alias("CERT"),
            F.date_format(quarter_end(F.col("day")), "yyyyMMdd").alias("REPDTE"),
            F.col("c_name").alias("NAME"),
            F.col("n_name").alias("STALP"),
            F.col("n_name").alias("STNAME"),
            F.col("c_mktsegment").alias("BKCLASS"),
            (price - 20000).alias("ASSET"),
            (price / 2).alias("DEP"),
            (price / 10).alias("EQ"),
            (price / 100).alias("NETINC"),
            ((key % 500) / 100 - 1).alias("ROA"),
            ((key % 700) / 50).alias("ROE"),
            _day_text(F.col("day")).alias("_ingested_at"),
            _padded(key).alias("_batch_id"),
        )

    @cached_property
    def raw_institutions(self) -> DataFrame:
        """A snapshot per order, on its quarter end. Some customers are never listed, so that their
        filings must fall to the unknown member."""
        none = F.lit(None).cast("string")
        return self._orders.filter(F.col("o_custkey") % 13 != 0).select(
            F.col("o_custkey").alias("CERT"),
            quarter_end(F.col("day")).alias("SNAPSHOT_DATE"),
            F.col("o_orderpriority").alias("NAME"),
            F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("CITY"),
            F.col("n_name").alias("STALP"),
            F.col("c_mktsegment").alias("BKCLASS"),
            none.alias("REGAGNT"),
            none.alias("NAMEHCR"),
            _day_text(F.col("day")).alias("_ingested_at"),
            _padded(F.col("o_orderkey")).alias("_batch_id"),
        )

    @cached_property
    def raw_branches(self) -> DataFrame:
        """A branch survey row per line item; suppliers are banks and parts are branches."""
        lines = self.table("lineitem").withColumn("shipped", F.col("l_shipdate").cast("date"))
        rows = lines.join(self._orders, F.col("l_orderkey") == F.col("o_orderkey"))
        price = F.col("l_extendedprice")
        line = F.col("l_linenumber").cast("string")
        return rows.select(
            F.col("l_suppkey").alias("CERT"),
            F.when(F.col("l_orderkey") % 89 != 0, F.col("l_partkey")).alias("UNINUMBR"),
            F.col("c_name").alias("NAMEFULL"),
            F.col("o_orderpriority").alias("CITYBR"),
            F.when(F.col("o_custkey") % 101 != 0, F.col("n_name")).alias("STALPBR"),
            F.col("n_name").alias("STNAMEBR"),
            F.when(F.col("l_linenumber") == 7, -price).otherwise(price).alias("DEPSUMBR"),
            F.col("o_totalprice").alias("ASSET"),
            F.year("shipped").cast("bigint").alias("YEAR"),
            _day_text(F.col("shipped")).alias("_ingested_at"),
            F.concat_ws("-", _padded(F.col("l_orderkey")), line).alias("_batch_id"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        """One message per event, with Kafka's columns; some lack the partition marker."""
        event = F.col("event_id")
        day = F.date_format("ts", "yyyyMMdd")
        payload = F.struct(
            F.col("user_id").alias("CERT"),
            day.alias("REPDTE"),
            F.col("value").alias("ASSET"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_ingested_at"),
            _padded(event).alias("_batch_id"),
            F.when(event % 53 != 0, day).alias(DT_MARKER),
        )
        return self.table("events").select(
            F.col("user_id").cast("string").alias("key"),
            F.to_json(payload).alias("value"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            event.alias("offset"),
        )

    # ---- layers above the raw records ----

    @cached_property
    def financials(self) -> DataFrame:
        return typed(clean_financials(self.raw_financials)[0], FINANCIALS)

    @cached_property
    def branches(self) -> DataFrame:
        return typed(clean_branches(self.raw_branches)[0], BRANCHES)

    @cached_property
    def snapshots(self) -> DataFrame:
        projected = project_snapshots(self.raw_institutions, F.col("SNAPSHOT_DATE"))
        return projected.drop(BAD_CAST, BAD_VALUES)

    @cached_property
    def history_text(self) -> DataFrame:
        return build_history(self.snapshots)

    @cached_property
    def history(self) -> DataFrame:
        return typed(self.history_text, HISTORY, "yyyy-MM-dd")

    @cached_property
    def dim(self) -> DataFrame:
        return models.dim_institution(models.stage_history(self.history))

    @cached_property
    def fact(self) -> DataFrame:
        return models.fct_financials(models.stage_financials(self.financials), self.dim)
