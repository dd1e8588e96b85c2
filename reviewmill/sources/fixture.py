"""A review table made from the order tables, used by the checks and the bench.

The same text runs on Spark and on the independent SQL engine of the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEWS_SQL = """
SELECT CAST(o_custkey AS INT)                                        AS customer_id,
       concat('P', l_partkey)                                        AS product_id,
       CAST(least(5, ceil(l_quantity / 7)) AS FLOAT)                 AS star_rating,
       lower(p_type)                                                 AS category,
       CAST(o_orderdate AS DATE)                                     AS review_date,
       CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END            AS verified_purchase,
       concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 CAST(l_quantity AS INT),
                 CAST(round(l_extendedprice * 100) AS BIGINT))       AS review_id,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE p_name END        AS product_title,
       p_brand                                                       AS product_category
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review view over the tables of ``sf_dir``."""
    frames = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "part")}
    return spark.sql(REVIEWS_SQL, **frames)
