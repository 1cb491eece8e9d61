"""Election inputs: results files (TSV), civic listings (JSON) and typed seed tables (CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sinks import latest_csv
from ..schemas import CIVIC_FILE, RESULTS_FILE, Contract


def scan_results_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Candidate results; quotes are plain characters and are stripped from both ends of text cells.

    Lines with too many cells are dropped. ``seq`` orders the rows as the files do.
    """
    names = RESULTS_FILE.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_malformed"]])
    lines = (
        spark.read.schema(text)
        .option("header", "true")
        .option("sep", "\t")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("columnPruning", "false")
        .csv(path)
    )
    # A reader may not look at the malformed line alone, so a cell stands in where it is null.
    line = F.coalesce("_malformed", names[0])
    tabs = F.length(line) - F.length(F.replace(line, F.lit("\t"), F.lit("")))
    typed = [
        F.btrim(F.col(f.name), F.lit('"')).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.btrim(F.col(f.name), F.lit('"')).try_cast(f.dataType).alias(f.name)
        for f in RESULTS_FILE
    ]
    return lines.where(F.col("_malformed").isNull() | (tabs < len(names))).select(
        *typed,
        F.struct(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("seq"),
    )


def scan_civic_json(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Listed elections (id, name, electionDay), one row each, with ``seq`` as their order.

    A file is one document, indented or not, or with ``one_per_line`` a document on every line.
    What is not JSON fails the job.
    """
    return (
        spark.read.schema(CIVIC_FILE)
        .option("multiLine", str(not one_per_line).lower())
        .option("mode", "FAILFAST")
        .json(path)
        .withColumn("seq", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("line")))
        .select("seq", F.posexplode("elections").alias("position", "election"))
        .select("election.*", F.struct("seq", "position").alias("seq"))
    )


def read_seed(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """A seed CSV with the column types its contract names."""
    return (
        spark.read.schema(contract.schema)
        .option("header", "true")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(latest_csv(spark, path))
    )


def load_seed(spark: SparkSession, path: str, contract: Contract, database: str) -> DataFrame:
    """Replace the seed table ``database.<name>`` by the file's rows and return the table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    table = f"{database}.{contract.name}"
    read_seed(spark, path, contract).write.mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)


def list_tables(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """Every (schema, table) of the catalog, sorted; table names only, no data."""
    found = databases or [d.name for d in spark.catalog.listDatabases()]
    shown = [
        spark.sql(f"SHOW TABLES IN {name}").where("NOT isTemporary").select(
            F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name")
        )
        for name in sorted(found)
    ]
    result = shown[0]
    for tables in shown[1:]:
        result = result.unionByName(tables)
    return result.orderBy("table_schema", "table_name")
