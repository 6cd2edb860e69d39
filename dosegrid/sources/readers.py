"""Readers of drug lists, omics matrices, feature lists, vectors, parameters and prediction files.

Fixed tables get explicit schemas. Matrices with thousands of columns are read as text
and unfolded to (sample_id, feature, value) rows; only their header is read first.
"""

from __future__ import annotations

import csv

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosegrid.functions.columns import number, strip
from dosegrid.operators.pairs import numbered

DRUGS = "drug_name string, smiles string"


def drug_list(spark: SparkSession, path: str, header: bool | None = None) -> DataFrame:
    """(drug_name, smiles), comma or, if over 90 % of smiles are missing then, tab separated. header None: a first line that names a smiles column is one."""
    if header is None:
        first = spark.read.text(path).limit(1).collect()
        header = bool(first) and "smiles" in first[0][0].lower()
    read = lambda sep: spark.read.schema(DRUGS).option("header", header).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path, sep=sep)
    drugs = read(",")
    missing = drugs.agg(F.avg(F.col("smiles").isNull().cast("int"))).first()[0]
    return read("\t") if missing is not None and missing > 0.9 else drugs


def well_formed(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Rows of a CSV without the malformed ones."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").csv(path, sep=sep)


def _lines(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """The header, and the other lines of each file as a column `value`."""
    lines = spark.read.option("header", True).option("sep", "\x01").option("quote", "").csv(path)  # no line holds that separator
    return lines.columns[0] if lines.columns else "", lines.toDF("value") if lines.columns else spark.createDataFrame([], "value string")


def cells_of(line: Column, sep: str) -> Column:
    """A line's cells; where it has quotes, separators inside them do not count, and doubled quotes are one."""
    literal = "\\Q" + sep + "\\E"
    every = F.regexp_extract_all(line, F.lit(f'("(?:[^"]|"")*"|(?:(?!{literal}).)*)(?:{literal}|$)'), F.lit(1))
    every = F.when(line.endswith(sep), every).otherwise(F.slice(every, F.lit(1), F.size(every) - 1))  # after the last cell there is an empty match
    quoted = F.transform(every, lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, literal))


def matrix(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(sample_id, feature, pos, value) of a matrix with a header and an index column, however wide. Cells may be quoted; each file's first line is its header."""
    header, lines = _lines(spark, path)
    names = next(csv.reader([header], delimiter=sep), [])[1:]
    name = F.array(*(F.lit(n.strip()) for n in names)) if names else F.array().cast("array<string>")
    cells = lines.select(cells_of(F.col("value"), sep).alias("c"))
    return cells.select(F.get("c", F.lit(0)).alias("sample_id"), F.posexplode(F.slice("c", 2, max(1, len(names)))).alias("pos", "raw")).select("sample_id", F.get(name, F.col("pos")).alias("feature"), "pos", number(strip(F.col("raw"))).alias("value"))


def transposed_matrix(spark: SparkSession, path: str, prefix: str = "DATA.", sep: str = "\t") -> DataFrame:
    """(sample_id, feature, pos, value) of a matrix whose rows are features and whose columns are samples."""
    found = matrix(spark, path, sep)
    return found.select(F.regexp_replace("feature", f"^{prefix.replace('.', chr(92) + '.')}", "").alias("sample_id"), F.col("sample_id").alias("feature"), "pos", "value")


def decoded(value: Column, fallback: str = "gbk") -> Column:
    """Text of a line's bytes: as UTF-8 if they are that, else in the other encoding, without what that cannot say."""

    @F.pandas_udf("string")
    def other(lines: pd.Series) -> pd.Series:
        return lines.map(lambda b: None if b is None else bytes(b).decode(fallback, errors="ignore"))

    return F.when(F.is_valid_utf8(value), value).otherwise(other(value.cast("binary")))


def feature_list(spark: SparkSession, path: str, sep: str = ",", fallback: str = "gbk") -> DataFrame:
    """(pos, feature) of a matrix's header, which alone is decoded. Names may be quoted."""
    header = spark.read.text(path).limit(1).select(decoded(F.col("value"), fallback).alias("value"))
    return header.select(F.posexplode(cells_of(F.col("value"), sep)).alias("pos", "feature")).where("pos > 0").select((F.col("pos") - 1).alias("pos"), strip(F.col("feature")).alias("feature"))


#: Most features that a list can have; numbered by one task.
MOST_FEATURES = 100_000


def feature_column(spark: SparkSession, path: str, most: int = MOST_FEATURES, sep: str = "\t", fallback: str = "gbk") -> DataFrame:
    """(pos, feature): the first column's first `most` values below the header, in the order of the file; most is MOST_FEATURES or less."""
    if most > MOST_FEATURES:
        raise ValueError(f"a list has {MOST_FEATURES} features at most")
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).orderBy("at").limit(most + 1)
    first = lines.where("at > 0 and trim(value) <> ''").select("at", F.get(cells_of(decoded(F.col("value"), fallback), sep), F.lit(0)).alias("feature"))
    return first.select((F.row_number().over(Window.orderBy("at")) - 1).alias("pos"), "feature")  # `most` rows


def word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(key, vec) of lines `word v1 .. vn`; lines of another length, as a first `count dim` line, are dropped."""
    parts = F.split(strip(F.col("value")), r"\s+")
    return spark.read.text(path).select(parts.alias("p")).where(F.size("p") == dim + 1).select(F.get("p", F.lit(0)).alias("key"), F.slice("p", 2, dim).cast("array<float>").alias("vec"))


def parameters(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """JSON documents of parameters, one for each file or, without multi_line, each line; broken ones end up in _corrupt_record."""
    return spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)


def chunk_files(spark: SparkSession, pattern: str, schema: str, least_bytes: int = 10) -> DataFrame:
    """All rows of the files of a pattern that are larger than least_bytes."""
    return spark.read.schema(schema).option("header", True).csv(pattern).select("*", "_metadata.file_size").where(F.col("file_size") > least_bytes).drop("file_size")


def feature_index(rows: DataFrame, feature: str, order: str) -> DataFrame:
    """(feature, idx): distinct features numbered by where they first appear."""
    first = rows.where(F.col(feature).isNotNull()).groupBy(F.col(feature).alias("feature")).agg(F.min(order).alias("first"))
    return numbered(first, ["first", "feature"], "idx").select("feature", "idx")
