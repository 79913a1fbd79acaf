"""File sources and sinks (S1-S9): explicit schemas, partitioned layouts,
append-only logs, idempotent writes.

No file is rewritten in place: logs and action tables are append-only
(partitioned by a run / batch key so a retried write replaces only its own
partition), and state is derived by reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P

N_V = 28


def card_schema(n_v: int = N_V, with_target: bool = True) -> T.StructType:
    """The transaction table: Time, V1..V28, Amount (doubles), Class (int)."""
    fields = [T.StructField("Time", T.DoubleType())]
    fields += [T.StructField(f"V{k}", T.DoubleType()) for k in range(1, n_v + 1)]
    fields += [T.StructField("Amount", T.DoubleType())]
    if with_target:
        fields += [T.StructField(P.TARGET, T.IntegerType())]
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """CSV scan with a declared schema (never inferred); FAILFAST turns
    malformed rows into an error at the first action."""
    return spark.read.schema(schema).option("header", True).option("mode", mode).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """S3: one table partitioned by split (each split a directory)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split of a partitioned table; the filter prunes partitions."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def append_log(df: DataFrame, path: str, run_key: str, fmt: str = "json") -> None:
    """Append-only log; each write lands in its own ``run=`` partition
    and overwrites only it (dynamic partition overwrite), so a retried write
    does not duplicate rows."""
    (df.withColumn("run", F.lit(run_key)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").format(fmt).save(path))


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "json") -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """JSON lines with a declared schema; blank lines are skipped and
    malformed lines are kept aside (PERMISSIVE) instead of failing the read.
    Returns (good rows, malformed raw lines)."""
    sch = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})
    df = lines.select(parsed.alias("r")).select("r.*")
    good = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return good, bad


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib persistence (metadata + stage data as files)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


MODEL_RECORD = ("model_name string, threshold double, composite_score double, fit_seconds double, features array<string>, "
                "saved_at timestamp")


def save_model_record(spark: SparkSession, root: str, name: str, model: PipelineModel, threshold: float, composite: float,
                      fit_seconds: float, features: Sequence[str]) -> None:
    """The fitted pipeline, then its record (what it was tuned to and how long it took); the
    record is written last, so a model that has one is whole."""
    from datetime import datetime, timezone

    save_model(model, f"{root}/{name}/model")
    row = (name, float(threshold), float(composite), float(fit_seconds), list(features), datetime.now(timezone.utc))
    spark.createDataFrame([row], MODEL_RECORD).coalesce(1).write.mode("overwrite").json(f"{root}/{name}/record")


def load_model_record(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, DataFrame]:
    return load_model(f"{root}/{name}/model"), spark.read.schema(MODEL_RECORD).json(f"{root}/{name}/record")


def write_scores(df: DataFrame, path: str) -> None:
    """The scored table written once; later stages join on the key."""
    df.write.mode("overwrite").parquet(path)
