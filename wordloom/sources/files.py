"""Article snapshots, text, word counts and CSV files."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.schemas import ARTICLE, LABELLED_SENTENCE, require_columns


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """JSON-array snapshot of articles."""
    return spark.read.schema(ARTICLE).option("multiLine", True).json(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored Parquet table, or an empty one of that schema before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: A session setting: partitions to deal the rows of text tables to. Unset, nothing is dealt out.
TEXT_PARTITIONS = "wordloom.texts.partitions"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table of texts, as its files are split.

    Text work is heavy per byte, and a file of one row group is one task. Who has few such files
    and many cores can set TEXT_PARTITIONS, which shuffles the texts once.
    """
    df = spark.read.parquet(path)
    partitions = spark.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def write_batch(df: DataFrame, table: str, batch_id: int | str) -> None:
    """Replace one batch of a table; writing the same batch again changes nothing."""
    df.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")


def read_batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All batches of a table with their ``batch_id``."""
    return read_or_empty(spark, table, f"{schema}, batch_id STRING")


def read_text_parts(spark: SparkSession, folder: str, pattern: str = "part*") -> DataFrame:
    """Lines of the part files of a folder."""
    return spark.read.option("pathGlobFilter", pattern).text(folder)


def part_files(spark: SparkSession, folder: str, pattern: str = "part*") -> DataFrame:
    """Paths of the part files of a folder; the listing reads no file contents."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select("path")
    )


def write_text(df: DataFrame, column: str, path: str, mode: str = "append") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def read_word_counts(spark: SparkSession, path: str) -> DataFrame:
    """``word<TAB>count`` lines."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("word"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("count"),
    )


def write_word_counts(counts: DataFrame, path: str) -> None:
    counts.orderBy("word").select(F.concat_ws("\t", "word", F.col("count").cast("string"))).write.mode(
        "overwrite"
    ).text(path)


def _plain(field: str) -> Column:
    """A path or name of a row's file without the escapes of a URI, in which a plus sign is itself."""
    return F.url_decode(F.replace(f"_metadata.{field}", F.lit("+"), F.lit("%2B")))


def csv_headers(spark: SparkSession, path: str, pattern: str = "*", skip_unreadable: bool = False) -> DataFrame:
    """``path``, ``header`` (the first line that is not blank) and ``wrapped`` of every CSV file.

    ``wrapped`` files have quoted line breaks: a value that goes on in the next line leaves an odd
    number of quotes in its first. Files are read as lines, in parts; a file without a line has no row.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", skip_unreadable).text(path)
    numbered = lines.where(F.rlike("value", F.lit(r"\S"))).select(
        _plain("file_path").alias("path"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"),
        "value",
        (F.length(F.regexp_replace("value", '[^"]+', "")) % 2 == 1).alias("odd"),
    )
    return numbered.groupBy("path").agg(F.min_by("value", "at").alias("header"), F.max("odd").alias("wrapped"))


def _csv_tables(spark: SparkSession, path: str, pattern: str = "*", skip_unreadable: bool = False) -> list[DataFrame]:
    """One scan for each different header; only files with quoted line breaks are read whole by a task.

    The driver holds the list of files, as it does for every scan.
    """
    headers = csv_headers(spark, path, pattern, skip_unreadable)
    # A header that goes on in the next line is not known from its first one.
    own = F.when(F.length(F.regexp_replace("header", '[^"]+', "")) % 2 == 1, F.col("path"))
    groups = headers.groupBy("header", "wrapped", own.alias("own")).agg(F.sort_array(F.collect_list("path")).alias("paths"))
    reader = spark.read.option("header", True).option("escape", '"')
    return [
        reader.option("multiLine", group.wrapped).csv([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in group.paths])
        for group in groups.orderBy("paths").collect()
    ]


def _by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def read_csv(spark: SparkSession, path: str, schema: str, required: tuple[str, ...]) -> DataFrame:
    """CSV with a header; columns are found by name and every file must have the required ones."""
    none = spark.createDataFrame([], schema)
    tables = _csv_tables(spark, path)
    if not tables:
        raise ValueError(f"no header in {path}")
    for table in tables:
        require_columns(table, *required)
    return reduce(_by_name, [
        table.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in none.schema if f.name in table.columns])
        for table in tables
    ])


def _listed(spark: SparkSession, folder: str, pattern: str) -> set[str]:
    """Paths of the files of a folder as rows name them, empty files included."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).inputFiles()
    return {re.sub("^file:/+", "file:/", unquote(path)) for path in files}


def skipped_csvs(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files that ``read_labelled_csvs`` skips: unreadable ones and ones without a header."""
    read = csv_headers(spark, folder, "*.csv", skip_unreadable=True).select("path").collect()
    return sorted(_listed(spark, folder, "*.csv") - {row.path for row in read})


def read_labelled_csvs(spark: SparkSession, folder: str, label: str | None = None) -> DataFrame:
    """Every CSV of a folder as labelled rows; the label is given or the file's stem.

    Files may differ in their columns: each file's columns are kept and missing ones are
    null. Duplicate rows stay. A folder without CSV files is an error. A file that cannot be
    opened or has no header is skipped (``skipped_csvs`` names them); one that breaks off later
    is an error, so that no rows are lost silently.
    """
    if not _listed(spark, folder, "*.csv"):
        raise ValueError(f"no CSV files in {folder}")
    stem = F.lit(label) if label else F.regexp_extract(_plain("file_name"), r"(.*)\.csv$", 1)
    tables = [
        table.select("*", stem.alias("node_label"))
        for table in _csv_tables(spark, folder, "*.csv", skip_unreadable=True)
    ]
    return reduce(_by_name, tables) if tables else spark.createDataFrame([], "node_label STRING")


def write_labelled_sentences(df: DataFrame, path: str) -> None:
    df.select("cleaned_text", "label").write.mode("errorifexists").option("header", True).option(
        "escape", '"'
    ).csv(path)


def read_labelled_sentences(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LABELLED_SENTENCE, ("cleaned_text", "label"))
