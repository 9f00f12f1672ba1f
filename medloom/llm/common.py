"""What several operators share: stored intermediate tables, connected components, input reading."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch, whichever is reached first: a batch of long texts has fewer rows.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounded Arrow batches, so that a batch of long texts fits in a worker, and workers that find this package.

    On a cluster the package is installed or shipped with the job; for workers on the driver's machine its
    folder goes on their path.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def whole_row(df: DataFrame, without: str | None = None) -> Column:
    """All columns in one, whatever their names hold."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != without])


#: The highest hash that `chosen` compares.
HASHES = (1 << 63) - 1


def bound_for(about: int, total: int) -> int:
    """The hash up to which about `about` of `total` rows lie; never 0, however many rows there are."""
    return min(HASHES, max(1, HASHES * about // max(1, total)))


def chosen(bound: int, *by: str, salt: str) -> Column:
    """Whether a row's hash lies within the bound."""
    return F.shiftrightunsigned(F.xxhash64(*by, F.lit(salt)), 1) <= F.lit(bound)


def shared_root(spark: SparkSession) -> str:
    """The folder that all machines share: the one the cluster names, else one beside its tables."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/llm-stored"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later steps read files instead of computing it again, and a lost executor costs one step. The files
    stay until the shared folder is cleaned.
    """
    path = f"{shared_root(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links: (node, root), root the smallest node reachable.

    Alternating star contraction: every round hangs the larger neighbours of each node, then its smaller
    ones, on the smallest; the rounds grow with the logarithm of the number of nodes. A node with a third
    of all links is an aggregate combined before the shuffle and one row on the other side of a join.
    Nodes without a link to another node are not in the result.
    """
    pair = lambda x, y: links.select(F.col(x).alias("u"), F.col(y).alias("v"))
    edges = stored(pair(a, b).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        edges = stored(small, "links")
        # Converged when nothing moved: the count and an order-free digest of all links stay the same.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
