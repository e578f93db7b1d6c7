"""What several operators of this package need: stored intermediate tables and a join that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.session import new_location

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# A table of at most this many rows and bytes of text is broadcast whole; of larger ones, hot rows whose
# text is no longer than that.
BROADCAST_ROWS, BROADCAST_BYTES, HOT_BYTES = 10_000, 4_000_000, 4_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later passes see the same rows even
    after an executor is lost. The folder belongs to its owner, as every ``quitanda-<id>``."""
    path = new_location(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_BYTES, ARROW_DEFAULT, ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands rows to Python in batches of 8 MB instead of Spark's 64 MB,
    unless it has a setting of its own: texts are long, and every running task holds a batch twice
    on either side. The setting stays, as plans read it when they run."""
    spark = df.sparkSession
    if spark.conf.get(ARROW_BYTES, ARROW_DEFAULT) == ARROW_DEFAULT:
        spark.conf.set(ARROW_BYTES, ARROW_LIMIT)
    return df


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_key_values(
    facts: DataFrame,
    per_key: DataFrame,
    key: str,
    rows: str,
    values: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` left join ``per_key`` on ``key``, a string or bigint column, whatever the skew.

    ``per_key`` has one row per key, NULL excluded, and says in ``rows`` how many facts have it;
    its values are numbers or texts. It is read several times and should be stored. If it is
    counted to be small, it is broadcast. Else a key with more than 0.7 of an average task's share
    of the facts is hot. Fewer than 1.5 keys per shuffle partition can be, so they are broadcast on
    every cluster, but for those with long texts, and their facts are dealt out evenly under made-up
    keys; all other facts meet ``per_key`` in a plain shuffled join, in which Spark may split what is
    large. Facts without a key get NULL values.
    """
    spark = facts.sparkSession
    texts = [c for c in (key, *values) if per_key.schema[c].dataType.typeName() == "string"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    count, size, total = per_key.agg(F.count("*"), F.sum(width), F.sum(rows)).first()
    if count <= broadcast_rows and (size or 0) <= BROADCAST_BYTES:
        all_keys = per_key.select(F.col(key).alias("_k"), *[F.col(v).alias(f"_v_{v}") for v in values])
        joined = facts.join(F.broadcast(all_keys), F.col(key) == F.col("_k"), "left")
        return joined.select(*facts.columns, *[F.col(f"_v_{v}").alias(v) for v in values])
    hot_from = max(2, 0.7 * total / tasks(spark))
    is_hot = (F.col(rows) >= hot_from) & (width <= HOT_BYTES)
    hot = per_key.where(is_hot).select(F.col(key).alias("_hot"), *[F.col(v).alias(f"_h_{v}") for v in values])
    rest = per_key.where(~is_hot).select(F.col(key).alias("_k"), *[F.col(v).alias(f"_v_{v}") for v in values])
    # A made-up key may equal a real one; what it finds there is not used.
    anywhere = F.xxhash64(F.monotonically_increasing_id()).cast(facts.schema[key].dataType)
    routed = facts.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_route", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), anywhere).otherwise(F.col(key))
    )
    joined = routed.join(rest.hint("merge"), F.col("_route") == F.col("_k"), "left")
    is_hot, has_key = F.col("_hot").isNotNull(), F.col(key).isNotNull()
    found = [F.when(is_hot, F.col(f"_h_{v}")).when(has_key, F.col(f"_v_{v}")).alias(v) for v in values]
    return joined.select(*facts.columns, *found)

