"""Row ids and tables written to storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans.sizing import broadcast_if_small

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only where it is unset and the master is local is a temporary folder used; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if "folder" not in _FALLBACK:
        _FALLBACK["folder"] = "file://" + tempfile.mkdtemp(prefix="weftgraph-llm-")
    return _FALLBACK["folder"]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/weftgraph-llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    This cuts the lineage: what follows reads files, so a lost executor costs the rerun of a scan
    and never of the work before it. Nothing removes these tables while a result may still read
    them; they lie together under ``weftgraph-llm`` of the shared folder.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


#: Numbers of the rows of one file lie below this; the file's place in the sorted list of files lies above.
FILE_ROWS = 2**40
#: Plan nodes that keep the rows of a scan apart, one output row for each that stays.
_KEEPS_ROWS = {"Project", "Filter", "SubqueryAlias"}


def is_scan(df: DataFrame) -> bool:
    """``df`` is the scan of Parquet files, with columns chosen or rows filtered at most."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in _KEEPS_ROWS:
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    return plan.relation().fileFormat().toString() == "Parquet"


def with_row(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a number in ``column`` that stays a row's own however often and on whatever cores it is evaluated.

    The rows of Parquet files are told apart by file and by place in the file, so nothing is copied; the numbers
    follow the order of the file names. What is no plain scan is written once with its numbers.
    """
    spark = df.sparkSession
    if not is_scan(df):
        return store(df.withColumn(column, F.monotonically_increasing_id()), "numbered")
    path, place = free_name(df, "file_path_"), free_name(df, "file_place_")
    # One path per file of the table, as many as the driver lists to plan the scan.
    paths = sorted(r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect())
    files = spark.createDataFrame([(p, i * FILE_ROWS) for i, p in enumerate(paths)], f"{path} string, {place} long")
    found = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(column))
    found = found.join(broadcast_if_small(files), path)
    return found.select(*df.columns, (F.col(place) + F.col(column)).alias(column))


def numbered(df: DataFrame, row_col: str | None = None) -> tuple[DataFrame, str]:
    """``df`` with row numbers and the name of their column; ``row_col`` names one that is there already."""
    if row_col:
        return df, row_col
    column = free_name(df, "row_number_")
    return with_row(df, column), column
