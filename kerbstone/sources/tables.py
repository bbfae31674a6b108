"""Collision-shaped views of the star-schema tables.

The same text serves Spark and, as common table expressions, the SQL checks:
it uses only syntax that both engines read alike, and no random or hash
function.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstone.plans.cut import scratch_root

RAW_COLLISIONS_SQL = """
SELECT
  CAST(l.l_orderkey * 8 + l.l_linenumber AS STRING) AS collision_index,
  lpad(CAST(day(l.l_shipdate) AS STRING), 2, '0') || '/' ||
    lpad(CAST(month(l.l_shipdate) AS STRING), 2, '0') || '/' ||
    CAST(year(l.l_shipdate) AS STRING) AS date,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL
       WHEN l.l_partkey % 89 = 0 THEN '99:99'
       ELSE lpad(CAST((l.l_orderkey * 7 + l.l_partkey * 3 + l.l_linenumber) % 24 AS STRING), 2, '0')
            || ':' || lpad(CAST(l.l_orderkey % 60 AS STRING), 2, '0') END AS time,
  CASE WHEN l.l_partkey % 101 = 0 THEN NULL
       WHEN l.l_quantity >= 50 - (CASE WHEN l.l_orderkey % 6 >= 4 THEN 1 ELSE 0 END) THEN '1'
       WHEN l.l_quantity >= 38 THEN '2' ELSE '3' END AS collision_severity,
  CASE (l.l_orderkey + l.l_suppkey) % 9 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '7'
       WHEN 4 THEN '9' WHEN 5 THEN '12' WHEN 6 THEN 'x' ELSE '6' END AS road_type,
  CASE l.l_partkey % 9 WHEN 0 THEN '13' WHEN 1 THEN '16' WHEN 2 THEN '17' WHEN 3 THEN '18' WHEN 4 THEN '19'
       WHEN 5 THEN '99' WHEN 6 THEN '42' ELSE '0' END AS junction_detail,
  CAST((l.l_orderkey + l.l_partkey) % 10 AS STRING) AS weather_conditions,
  CASE WHEN l.l_suppkey % 5 = 0 THEN '5' WHEN l.l_orderkey % 7 = 0 THEN '4'
       WHEN l.l_orderkey % 11 = 0 THEN '6' WHEN l.l_orderkey % 13 = 0 THEN '-1' ELSE '1' END AS light_conditions,
  CAST((l.l_partkey + l.l_linenumber) % 10 AS STRING) AS road_surface_conditions,
  ' E' || lpad(CAST(s.s_nationkey AS STRING), 8, '0') AS local_authority_ons_district,
  CASE WHEN l.l_partkey % 103 = 0 THEN NULL
       WHEN l.l_partkey % 107 = 0 THEN 999.0E0
       WHEN l.l_orderkey % 10 = 0
         THEN 50.0E0 + ((l.l_orderkey * 7919 + l.l_linenumber * 104729) % 100003) * 8.0E0 / 100003
       ELSE 50.0E0 + (l.l_suppkey % 40) * 0.2E0 + ((l.l_partkey * 37 + l.l_orderkey * 11) % 1000) * 0.00002E0
  END AS latitude,
  CASE WHEN l.l_orderkey % 10 = 0
         THEN -5.0E0 + ((l.l_orderkey * 15485863 + l.l_linenumber * 32452843) % 100003) * 6.0E0 / 100003
       ELSE -5.0E0 + ((l.l_suppkey * 7) % 40) * 0.15E0 + ((l.l_partkey * 53 + l.l_orderkey * 17) % 1000) * 0.00002E0
  END AS longitude,
  CASE WHEN l.l_partkey % 83 = 0 THEN '-1' WHEN l.l_partkey % 79 = 0 THEN '99'
       WHEN l.l_partkey % 73 = 0 THEN NULL
       ELSE CAST(20 + 10 * (l.l_orderkey % 6) AS STRING) END AS speed_limit,
  CAST(1 + l.l_linenumber % 4 AS STRING) AS number_of_vehicles
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

DISTRICT_CODES_SQL = """
SELECT 'local_authority_ons_district' AS field_name,
       'E' || lpad(CAST(n_nationkey AS STRING), 8, '0') AS code,
       n_name AS label
FROM nation WHERE n_nationkey <> 24
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive_raw_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw coded collision records derived from every line item."""
    text = RAW_COLLISIONS_SQL.replace(
        "FROM lineitem l JOIN supplier s", "FROM {lineitem} l JOIN {supplier} s"
    )
    lineitem = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    parallelism = spark.sparkContext.defaultParallelism
    if lineitem.rdd.getNumPartitions() < parallelism:
        # a few large files, or one: spread the rows before deriving the columns
        lineitem = lineitem.repartition(parallelism)
    return spark.sql(
        text, lineitem=lineitem, supplier=table(spark, folder, "supplier")
    )


_stored: dict[tuple, str] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """What tells whether the tables that raw records derive from have changed."""
    return tuple(
        table(spark, folder, name)
        .select("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
        .agg(F.count("*"), F.bit_xor(F.xxhash64("file_path", "file_modification_time", "file_size")),
             F.max("file_modification_time"))
        .first()
        for name in ("lineitem", "supplier")
    )


def raw_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records as a stored table, derived once per application.

    Raw records are files in practice. Storing the derived ones gives the
    queries the same starting point: a columnar scan they can prune.
    """
    key = (spark.sparkContext.applicationId, folder, *_state(spark, folder))
    if key in _stored:
        try:
            return spark.read.parquet(_stored[key])
        except AnalysisException:
            pass  # the scratch folder was cleared since
    path = f"{scratch_root(spark)}/raw-{uuid.uuid4().hex}"
    derive_raw_collisions(spark, folder).write.parquet(path)
    _stored[key] = path
    return spark.read.parquet(path)


def district_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The code-list lines for districts: ``(field_name, code, label)``."""
    return spark.sql(
        DISTRICT_CODES_SQL.replace("FROM nation", "FROM {nation}"),
        nation=table(spark, folder, "nation"),
    )
