"""Web traffic from JSON lines to two sharded outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.contracts import traffic_contract
from strata.operators.quality import conservation
from strata.operators.traffic import minute_traffic, user_traffic
from strata.session import cut_lineage
from strata.sources.files import read_json_lines, read_jsonl_shards
from strata.sources.sinks import overwrite_json_lines

USER_SCHEMA = "user_id string, page_views bigint, bytes_sent bigint, unique_paths bigint"
MINUTE_SCHEMA = "traffic_minute string, page_views bigint, bytes_sent bigint, active_users bigint"


@dataclass(frozen=True)
class TrafficOutputs:
    users: DataFrame
    minutes: DataFrame
    conserved: DataFrame


def run(spark: SparkSession, pattern: str, folder: str) -> TrafficOutputs:
    """Parse once, aggregate twice, write both, and check that nothing was lost."""
    views = cut_lineage(read_json_lines(spark, pattern, traffic_contract()), "views")
    overwrite_json_lines(user_traffic(views), f"{folder}/by-user")
    overwrite_json_lines(minute_traffic(views), f"{folder}/by-minute")
    users = read_jsonl_shards(spark, f"{folder}/by-user", USER_SCHEMA)
    minutes = read_jsonl_shards(spark, f"{folder}/by-minute", MINUTE_SCHEMA)
    return TrafficOutputs(users, minutes, check(views, users, minutes))


def check(views: DataFrame, users: DataFrame, minutes: DataFrame) -> DataFrame:
    """Both outputs must add up to the source's views and bytes."""
    totals = {"page_views": F.count(F.lit(1)), "bytes_sent": F.sum("bytes_sent")}
    return conservation(views, {"by_user": users, "by_minute": minutes}, totals)
