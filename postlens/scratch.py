"""Intermediate tables in the shared checkpoint folder.

A table written there survives lost executors, is computed once however many results read it, and has
a size Spark knows from its files: Catalyst then broadcasts it in a join only when it is really small.
"""
import uuid

SETTING = "spark.checkpoint.dir"


def scratch_root(spark):
    """The shared folder named by the cluster; where it names none, a folder in the (shared) warehouse."""
    root = spark.conf.get(SETTING, None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return root.rstrip("/")


def new_folder(spark, purpose):
    """A path not used before."""
    return f"{scratch_root(spark)}/postlens/{purpose}-{uuid.uuid4().hex}"


def settle(df, purpose, partition_by=()):
    """Write ``df`` as a Parquet table in the shared folder and return the table."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path).select(df.columns)
    table.settled_in = path
    return table


def forget(table):
    """Delete a settled table that nothing will read again, through the file system that holds it."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.settled_in)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
