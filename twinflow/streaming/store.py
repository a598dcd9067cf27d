"""The observation store of the streams: recent steps, and a folded table that prunes.

Folding lays all rows down in buckets of the hash of twin and id, sorted by it, with
Parquet's Bloom filter on it. A batch with few keys names their hashes in the
query, so that buckets, row groups and pages without them are not read. A larger one
is joined by the hash: the batch goes to the buckets, the store is not shuffled.
Both find a superset of the rows wanted, as two keys can share a hash; the submission
compares twin and id.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.streaming import commits

KEY = ("digital_twin", "observation_id")
HASH = "key_hash"
A_BUCKET = 1_000_000  # rows of a bucket, on average
FEW = 1000  # hashes that a query names


def key_hash() -> Column:
    return F.xxhash64(*KEY)


def write_folded(rows: DataFrame, path: str, version: int) -> str:
    """Write the rows as a folded table below ``path``; the folder, which tells the number of buckets."""
    spark = rows.sparkSession
    # with fewer buckets than shuffle partitions Spark would shuffle the store after all
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-rows.count() // A_BUCKET))
    folder = f"{path}/run=fold/batch_id={version}/try={uuid.uuid4().hex}-{buckets}"
    rows = rows.withColumn(HASH, key_hash()).repartition(buckets, HASH)
    table = f"folded_{uuid.uuid4().hex}"
    (
        rows.write.bucketBy(buckets, HASH)
        .sortBy(HASH)
        .option("path", folder)
        .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")  # the files stay; readers name the folder
    return folder


def folded(spark: SparkSession, folder: str) -> DataFrame:
    """A folded table with its buckets known to the planner."""
    name, _, buckets = folder.rpartition("/try=")[2].rpartition("-")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.OBSERVATION)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS folded_{name} ({fields}, {HASH} bigint) USING parquet "
        f"CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(f"folded_{name}")


def stored(spark: SparkSession, now: commits.State) -> DataFrame:
    """All rows."""
    rows = commits.read(spark, now, "rows", S.OBSERVATION)
    for folder in now.folders.get("folded", []):
        rows = rows.unionByName(folded(spark, folder).drop(HASH))
    return rows


def matching(spark: SparkSession, now: commits.State, keys: DataFrame) -> DataFrame:
    """The rows with one of the keys (``digital_twin, observation_id``), and maybe a few more."""
    recent = commits.read(spark, now, "rows", S.OBSERVATION)
    found = recent.join(keys, list(KEY), "left_semi")
    tables = now.folders.get("folded", [])
    if not tables:
        return found
    hashes = keys.select(key_hash().alias(HASH)).distinct()
    few = [r[0] for r in hashes.limit(FEW + 1).collect()]
    for folder in tables:
        table = folded(spark, folder)
        if len(few) <= FEW:
            part = table.where(F.col(HASH).isin(few))
        else:
            part = table.join(hashes, HASH, "left_semi")
        found = found.unionByName(part.drop(HASH))
    return found
