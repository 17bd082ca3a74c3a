"""Reading inputs with declared schemas and writing results."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from namesieve.plans.storage import shared_folder, written

__all__ = ["csv_roundtrip", "read_csv", "read_input", "read_model", "read_parquet", "require_columns", "write_csv", "write_manifest", "write_model", "written"]

# Schemas of the inputs; declared, so that reading needs no inference pass.
SOURCE_RESULTS = "entity_id STRING, evidence_count DOUBLE, query_used STRING"
EVIDENCE_ITEMS = "entity_id STRING, identity_score DOUBLE, review_required STRING"
ENTITY_LIST = "entity_id STRING, entity_name STRING, entity_type STRING, country_code STRING"


# Place of a row: file, block of the file, row in the block. Blocks of one file can be in several partitions.
PLACE = "struct(_metadata.file_path AS file, _metadata.file_block_start AS block, monotonically_increasing_id() AS row)"


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False, position: str | None = None) -> DataFrame:
    """CSV with a header row, quoted text and empty fields as null.

    Columns are taken by their header names, so files may hold more columns or another order. ``multi_line`` allows
    line breaks inside quoted texts; a file is many tasks then as well, see ``quoted_records``.
    ``position`` names a column with the place of each row, by which rows follow the order of file names and lines.
    """
    options = {"header": True, "quote": '"', "escape": '"'}
    if not multi_line:
        return _typed(spark.read.options(**options).option("inferSchema", False).csv(path), schema, position)
    # Only the header is read with whole files as tasks, and of it the first record.
    names = spark.read.options(**options, multiLine=True).csv(path).columns
    parsing = {"quote": '"', "escape": '"', "multiLine": "true"}
    records = quoted_records(spark, path).where("record > 1 AND text <> ''")
    parsed = records.select(F.from_csv("text", ", ".join(f"`{c}` STRING" for c in names), parsing).alias("_r"), "place")
    return _typed(parsed.select("_r.*", "place"), schema, position, "place")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of text files whose quoted texts may hold line breaks: ``file, record`` (from 1), ``text``, ``place``.

    Files are read in blocks of lines. The quotes of each block are counted first; an odd number before a line says that it
    starts inside a quoted text, so it belongs to the record of the line before it, in whatever block that is. Quotes inside
    a text are doubled, which keeps the count. A record's lines meet in one task, so a block's records are found in many.
    """
    lines = spark.read.option("lineSep", "\n").text(path).selectExpr("value AS line", f"{PLACE} AS place", "length(value) - length(replace(value, '\"', '')) AS quotes")
    lines = lines.selectExpr("line", "place", "quotes", "place.file AS file", "place.block AS block")
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

    def before(rows: DataFrame, value: str, name: str) -> DataFrame:
        """Running total of ``value`` before each line of its file: that of the blocks before, a row each, and inside the block."""
        sums = rows.groupBy("file", "block").agg(F.expr(f"sum({value}) AS _n"))
        sums = sums.selectExpr("file", "block", f"coalesce(sum(_n) OVER (PARTITION BY file ORDER BY block {earlier}), 0) AS _before")
        inside = rows.selectExpr("*", f"coalesce(sum({value}) OVER (PARTITION BY file, block ORDER BY place {earlier}), 0) AS _inside")
        return inside.join(sums, ["file", "block"]).selectExpr(*[c for c in rows.columns], f"_before + _inside AS {name}")

    counted = before(lines, "quotes", "quotes_before").withColumn("starts", F.expr("CAST(quotes_before % 2 = 0 AS INT)"))
    numbered = before(counted.drop("quotes", "quotes_before"), "starts", "starts_before").selectExpr("file", "place", "line", "starts_before + starts AS record")
    joined = numbered.groupBy("file", "record").agg(F.expr("array_sort(collect_list(struct(place, line))) AS l"))
    text = F.expr("rtrim('\r', array_join(transform(l, x -> x.line), '\n'))")
    return joined.select("file", "record", text.alias("text"), F.expr("l[0].place").alias("place"))


def read_parquet(spark: SparkSession, path: str, schema: str, position: str | None = None) -> DataFrame:
    """The same columns from Parquet files."""
    return _typed(spark.read.parquet(path), schema, position)


def read_input(spark: SparkSession, path: str, schema: str, position: str | None = None) -> DataFrame:
    """An input of the phases: Parquet if the name ends so, else CSV."""
    read = read_parquet if path.rstrip("/").endswith(".parquet") else read_csv
    return read(spark, path, schema, position=position)


def _typed(table: DataFrame, schema: str, position: str | None, place: str = PLACE) -> DataFrame:
    wanted = StructType.fromDDL(schema)
    require_columns(table, wanted.fieldNames())
    columns = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wanted.fields]
    return table.selectExpr(*columns, *([f"{place} AS `{position}`"] if position else []))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The table itself, or an error that names the missing columns."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV parts with a header; quotes inside a text are doubled."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def csv_roundtrip(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as CSV in the shared folder and read it back with its own schema."""
    path = f"{shared_folder(df.sparkSession)}/namesieve/{name}-{uuid.uuid4().hex}.csv"
    write_csv(df, path)
    return read_csv(df.sparkSession, path, ", ".join(f"`{c}` {t}" for c, t in df.dtypes), multi_line=True)


def write_manifest(spark: SparkSession, path: str, manifest: dict, mode: str = "errorifexists") -> DataFrame:
    """One JSON object with the facts of a run; returns what was written."""
    row = spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False, sort_keys=True),)], "value string")
    row.coalesce(1).write.mode(mode).text(path)
    return spark.read.json(path)


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
