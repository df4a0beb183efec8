"""The two job chains: source to Bronze, and Silver to Gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tierlake.contract import Contract
from tierlake.functions.privacy import Keys
from tierlake.names import Layers
from tierlake.plans.bronze import bronze_delta, bronze_full
from tierlake.plans.gold import plan_publish, publish_gold
from tierlake.plans.lake import ingest
from tierlake.plans.silver import run_silver


def ingest_and_promote(spark: SparkSession, layers: Layers, app: str, df: DataFrame, contract: Contract,
                       run_date: str, mode: str = "overwrite", keys: Keys = Keys()) -> tuple[int, int]:
    """Lake, then Bronze: full after a ``replace``, else delta. Returns both row counts."""
    lake = ingest(spark, layers, app, df, contract, run_date, mode, keys)
    promote = bronze_full if mode == "replace" else bronze_delta
    return lake, promote(spark, layers, app, run_date, contract)


def transform_and_publish(spark: SparkSession, layers: Layers, spec: Mapping, gold: str,
                          strategy: str = "replace", date_column: str | None = None,
                          run_date: str | None = None, silver: str | None = None,
                          tests: Sequence[Mapping] = (), partition_by: str | None = None) -> tuple[int, int]:
    """Silver, then Gold. The Gold arguments are checked before Silver is built, and Gold
    is published only when Silver and its tests succeeded."""
    target = layers.resolve((spec.get("target_table") or "").strip(), "silver")
    source, _, _ = plan_publish(layers, silver or target.table, gold, strategy, date_column, run_date)
    if source != target:
        raise ValueError("The Gold source must be the table that the specification writes")
    built = run_silver(spark, layers, spec, run_date, tests)
    return built, publish_gold(
        spark, layers, target.table, gold, strategy, date_column, run_date, partition_by)
