"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: what follows reads files that every executor can reach, so
    a lost executor costs a re-read and not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """An object of this package, broadcast for tasks on executors that do not have the package.

    Spark's broadcast stores an object's class by name; here the object goes as bytes that
    hold its class too.  A worker unpacks them once a task."""

    def __init__(self, spark: SparkSession, thing: Any) -> None:
        self._data, self._thing = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), None

    def __getstate__(self) -> dict:
        return {"_data": self._data, "_thing": None}

    @property
    def value(self) -> Any:
        if self._thing is None:
            self._thing = pickle.loads(self._data.value)
        return self._thing


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def remainder_of_crc(column: str, modulus: int) -> Column:
    """crc32 of the identifier's decimal text, modulo ``modulus`` (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column,
                    rows: int, max_chars: int) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts of at most ``max_chars`` characters, chosen by
    a hash of doc_id among the rows that ``allowed`` admits: (text, label) pairs in
    that order.  This is the only place where labels are read; a doc_id with several
    labels is left out when they differ."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed)
             .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
             .where("low = high").select("doc_id", F.col("low").cast("int").alias("target")))
    chosen = (known.withColumn("turn", F.xxhash64("doc_id"))
              .orderBy("turn", "doc_id").limit(rows))
    picked = (docs.where(F.length("text") <= max_chars).select("doc_id", "text")
              .join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id", "turn", "target").agg(F.min("text").alias("text"))
              .orderBy("turn", "doc_id").limit(rows))
    return [(r["text"], r["target"]) for r in picked.select("text", "target").collect()]
