"""Joins of one period's rows with a table of all time, in shares by a hash of the key.

Spark filters the large table's scan by a Bloom filter of the period's keys, before anything of
it is aggregated or shuffled. A filter has a bounded size, and with more keys than it is made for
it lets more and more rows by. So the keys are dealt into shares that a filter can hold, and each
share of the period joins the same share of the large table: its tasks hold the filter of that
share alone. The results are those of the one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FILTER = "spark.sql.optimizer.runtime.bloomFilter."
_MOST_FILTERS = "spark.sql.optimizer.runtimeFilter.number.threshold"


def keys_per_filter(spark: SparkSession) -> int:
    """How many keys a filter holds, as the session is set."""
    return int(spark.conf.get(f"{_FILTER}maxNumItems"))


def estimated_bytes(rows: DataFrame) -> int:
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shares_for(rows: DataFrame, most: int | None = None) -> int:
    """How many filters of `most` keys the rows need, by default of as many as the session's
    hold. The rows are counted unless they surely fit one."""
    most = most or keys_per_filter(rows.sparkSession)
    if estimated_bytes(rows) <= most:  # a key takes a byte or more
        return 1
    return max(1, -(-rows.count() // most))


def joined_by_share(rows: DataFrame, whole: DataFrame, key: str, shares: int) -> DataFrame:
    """`rows.join(whole, key)` in so many shares.

    `whole` is read once a share, so that its surviving rows alone are moved; tables landed by
    the key (`sources.landing`) need neither filters nor shares.
    """
    if shares <= 1:
        return rows.join(whole, key)
    spark = rows.sparkSession
    # The optimizer knows nothing of the shares' sizes and has a limit of filters a query.
    for name, least in ((f"{_FILTER}creationSideThreshold", estimated_bytes(rows)),
                        (_MOST_FILTERS, 2 * shares)):
        if _bytes(spark, spark.conf.get(name)) < least:
            spark.conf.set(name, str(least))

    def share(df: DataFrame, i: int) -> DataFrame:
        return df.filter(F.pmod(F.xxhash64(key), F.lit(shares)) == i)

    joins = [share(rows, i).join(share(whole, i), key) for i in range(shares)]
    return reduce(DataFrame.unionByName, joins)


def _bytes(spark: SparkSession, text: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))
