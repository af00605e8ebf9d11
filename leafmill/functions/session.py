"""Session-level helpers: shared scratch tables and Arrow batch size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, the warehouse, or an own local folder in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="leafmill-")
        spark.conf.set("spark.checkpoint.dir", _OWN[app])
    return _OWN[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/leafmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back. Survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the folders behind materialized tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if "/leafmill/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def arrow_rows(spark: SparkSession, rows: int = 256) -> None:
    """Rows per Arrow batch sent to Python: texts can be long, so the default of 10,000 is too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
