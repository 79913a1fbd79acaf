"""Tables written by micro-batches, visible only when their batch is committed.

A batch writes its part of any number of tables (``<table>/batch_id=N``) and then one small
manifest, put in place by a rename. Readers take the parts of committed batches only, so
all tables change together; a batch that is replayed after its commit changes nothing, and
one that failed before it overwrites its own parts.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "batch_id long, n_in long, n_out long, n_side long, max_us long, closed_us long"


class Ledger:
    """The tables and manifests below ``root``, a folder that the cluster shares."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/manifest/{batch_id:012d}.json"

    def is_committed(self, batch_id: int) -> bool:
        fs, at = self._fs(self._manifest(batch_id))
        return fs.exists(at)

    def part(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def write(self, table: str, batch_id: int, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.part(table, batch_id))

    def commit(self, batch_id: int, **info: int | None) -> None:
        """Makes the batch's parts visible. ``info`` are fields of MANIFEST."""
        fs, at = self._fs(self._manifest(batch_id))
        draft = self._fs(f"{self.root}/manifest/_{batch_id:012d}.draft")[1]
        out = fs.create(draft, True)
        out.write(bytearray((json.dumps({"batch_id": batch_id, **info}) + "\n").encode()))
        out.close()
        if not fs.rename(draft, at):
            raise RuntimeError(f"batch {batch_id} could not be committed")

    def manifests(self) -> DataFrame:
        """One row per committed batch."""
        fs, at = self._fs(f"{self.root}/manifest")
        if not fs.exists(at):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).option("pathGlobFilter", "*.json").json(f"{self.root}/manifest")

    def before(self, batch_id: int) -> dict:
        """The manifest of the last batch before this one, or nothing."""
        for k in range(batch_id - 1, -1, -1):
            fs, at = self._fs(self._manifest(k))
            if fs.exists(at):
                stream = fs.open(at)
                try:
                    text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                return json.loads(text)
        return {}

    def read(self, table: str, also: int | None = None) -> DataFrame:
        """The committed rows of a table with their ``batch_id``; ``also`` adds the part of
        a batch that is about to be committed."""
        rows = self.spark.read.parquet(f"{self.root}/{table}")
        done = self.manifests().select(F.col("batch_id").alias("_b"))
        if also is not None:
            done = done.unionByName(self.spark.createDataFrame([(also,)], "_b long")).distinct()
        return rows.join(done, rows["batch_id"] == done["_b"], "left_semi")


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs what is available through ``write``, from where ``checkpoint`` left off."""
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
