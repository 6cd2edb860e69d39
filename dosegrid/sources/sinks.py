"""Writers: global prediction file, reports by cell line, numbered chunks, reject log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosegrid.sources.shared import kept


def safe_name(c: Column) -> Column:
    """Everything but letters and digits as an underscore. Two names can end alike, so the raw name stays a column."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "_")


def four_digits(c: Column) -> Column:
    """%.4f of a number; null stays null, so that its cell is empty."""
    return F.when(c.isNotNull(), F.format_string("%.4f", c.cast("double")))


#: Folders of reports that a task writes at most if there are many, and the setting by which tasks put what they wrote in place.
TASK_FOLDERS, COMMIT = 256, "mapreduce.fileoutputcommitter.algorithm.version"
#: Rows that are written as one file on request.
SINGLE_ROWS = 1_000_000


def write_global(df: DataFrame, path: str, score: str, single: bool = False) -> None:
    """A folder of CSV parts. single: one part, with one header, for a result whose number of rows has been checked."""
    found = df.withColumn(score, four_digits(F.col(score)))
    if single:
        found = kept(found, "global")
        if (n := found.count()) > SINGLE_ROWS:
            raise ValueError(f"{n} rows are too many for one file; the most is {SINGLE_ROWS}")
        found = found.coalesce(1)
    found.write.option("header", True).csv(path)


def top_reports(scores: DataFrame, k: int, cell: str = "cell_line", drug: str = "drug_name", score: str = "ensemble_score") -> DataFrame:
    """(cell, Rank, drug, score): the k lowest scores of each cell line, ties by drug."""
    w = Window.partitionBy(cell).orderBy(F.col(score).asc_nulls_last(), drug)
    return scores.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= k).select(cell, "Rank", drug, score)


def write_reports(scores: DataFrame, path: str, k: int, cell: str = "cell_line", drug: str = "drug_name", score: str = "ensemble_score") -> None:
    """A folder of CSV for each cell line with its k lowest scores, by rank and with four digits. Cell lines whose safe names are alike share a folder.

    Folders are dealt to tasks whose number grows with them, and each task moves its own to
    their place when it ends, so the driver moves none; a stopped job leaves some of them
    and no _SUCCESS.
    """
    found = kept(top_reports(scores, k, cell, drug, score).withColumn("cell_key", safe_name(F.col(cell))).withColumn(score, four_digits(F.col(score))), "reports")
    tasks = max(-(-found.select("cell_key").distinct().count() // TASK_FOLDERS), int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = found.repartition(tasks, "cell_key").sortWithinPartitions("cell_key", cell, "Rank")
    dealt.write.partitionBy("cell_key").option("header", True).option(COMMIT, "2").csv(path)


def write_chunks(df: DataFrame, path: str, *chunk_ids: str) -> None:
    """A folder for each chunk, or pair of chunks, written by one task each."""
    df.repartition(*chunk_ids).write.partitionBy(*chunk_ids).option("header", True).csv(path)


def last_chunk(spark: SparkSession, path: str, chunk: str = "chunk_id") -> int:
    """The highest number of a chunk that has been written and has rows, by the files' names; 0 if there is none."""
    try:
        files = spark.read.text(f"{path.rstrip('/')}/{chunk}=*").select("_metadata.file_path")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0
    return files.agg(F.max(F.regexp_extract("file_path", f"/{chunk}=([0-9]+)/", 1).try_cast("int"))).first()[0] or 0


def resume_chunks(df: DataFrame, path: str, start: int = 0, chunk: str = "chunk_id") -> int:
    """Chunks that are not there yet: those after the highest that is, or from start if that is given. The first number that was written.

    Rows have their chunk's number, from 1. A forced start replaces the chunks from there on;
    those that df no longer has go. Chunks are written in one job, which makes them visible
    when all are done, so a stopped job is done again.
    """
    spark = df.sparkSession
    begin = start if start > 0 else last_chunk(spark, path, chunk) + 1
    if start > 0:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{chunk}=*")) or []:
            if int(found.getPath().getName().split("=")[1]) >= begin:
                fs.delete(found.getPath(), True)
    df.where(F.col(chunk) >= begin).repartition(chunk).write.mode("append").partitionBy(chunk).option("header", True).csv(path)
    return begin


def write_batch(df: DataFrame, path: str, number: int) -> None:
    """Rows of a numbered batch, in a folder of its own: a batch that is written again replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")


def write_once(df: DataFrame, path: str) -> None:
    """Nothing happens if the output is already there."""
    df.write.mode("ignore").parquet(path)
