"""Raw inputs and the shapes derived from them."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebind import settings as S
from casebind.operators.skew import outer_join_many
from casebind.sources.staging import staged

RECEIPT = "raw_inbound_submission"
# the review sheet as people send it back
REVIEW_CSV_SCHEMA = S.LEDGER_SCHEMAS["manual_review_resp"]


def src_query(spark: SparkSession, query: str, jdbc: dict | None = None) -> DataFrame:
    """Rows of a SQL query, from the catalog or, with JDBC options, from a database.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` among the
    options to read a database in parallel. The query is then wrapped as a subquery.
    """
    if jdbc is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(**jdbc).option("dbtable", f"({query}) t").load()


def submissions_since(df: DataFrame, cutoff: str = "2024-01-01",
                      column: str = "SpecimenDateCollected") -> DataFrame:
    return df.filter(F.col(column) > F.lit(cutoff).cast("date"))


def cases_by_code(df: DataFrame, code: str = S.DEFAULT_CASE_CODE) -> DataFrame:
    return df.filter(F.col("CODE") == code)


def ref_assemble(wizard: DataFrame, investigation: DataFrame) -> DataFrame:
    """Every case with each of its labs; cases without a lab stay. One shuffle of either side."""
    clash = [c for c in investigation.columns if c in wizard.columns and c != "CASE_ID"]
    labs = investigation.withColumnsRenamed({c: f"{c}_right" for c in clash})
    columns = [*wizard.columns, *(c for c in labs.columns if c != "CASE_ID")]
    return (outer_join_many(wizard, labs, "CASE_ID").select(*[f"`{c}`" for c in columns])
            .withColumnRenamed("SPECIMEN__COLLECTION__DTTM", "SPECIMEN_COLLECTION_DTTM"))


def raw_receipt(df: DataFrame, primary_key: str, run_date: dt.date) -> DataFrame:
    """Each raw row kept whole in one nested column, with its key and the run date."""
    return df.select(
        F.col(primary_key).cast("string").alias("submission_number"),
        F.lit(run_date).alias("internal_create_date"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(RECEIPT),
    )


def receipt_unnest(receipt: DataFrame, json_schema: StructType | str | None = None) -> DataFrame:
    """Nested rows back to columns, in name order; JSON receipts need their schema."""
    if json_schema is not None:
        receipt = receipt.withColumn(RECEIPT, F.from_json(F.col(RECEIPT), json_schema))
    flat = receipt.select("submission_number", "internal_create_date", f"{RECEIPT}.*")
    return flat.select(*[F.col(f"`{c}`") for c in sorted(flat.columns)])


def receipt_as_json(receipt: DataFrame) -> DataFrame:
    """The form a receipt is stored in: nulls stay visible, the schema may change over time."""
    return receipt.withColumn(
        RECEIPT, F.to_json(F.col(RECEIPT), {"ignoreNullFields": "false"}))


def receipt_as_variant(receipt: DataFrame) -> DataFrame:
    """The form a receipt is stored in where its columns change: each row with its own, typed."""
    return receipt.withColumn(RECEIPT, F.to_variant_object(RECEIPT))


def variant_columns(receipt: DataFrame) -> dict[str, str]:
    """Name and type of every column that any stored receipt has, from one aggregate.

    A column that has several types, or none, is read as text.
    """
    told = receipt.agg(F.schema_of_variant_agg(RECEIPT)).first()[0]
    if told is None or not told.startswith("OBJECT<"):
        return {}
    found = StructType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", told)[len("STRUCT<"):-1])
    odd = ("void", "variant")
    return {f.name: "string" if f.dataType.simpleString() in odd else f.dataType.simpleString() for f in found}


def variant_unnest(receipt: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Receipts stored as variants back to columns, in name order; ``columns`` (name and type), or
    all that occur. A row without a column has null there. No schema is asked of the caller."""
    columns = variant_columns(receipt) if columns is None else columns

    def path(name: str) -> str:
        mark = "'" if '"' in name else '"'  # a path has no escapes: a name with both marks is not readable
        return f"$[{mark}{name}{mark}]"

    read = {name: F.variant_get(RECEIPT, path(name), kind) for name, kind in columns.items()}
    read |= {c: F.col(c) for c in ("submission_number", "internal_create_date")}
    return receipt.select(*[read[c].alias(c) for c in sorted(read)])


REJECT = "_rejected_line"


def _matches(spark: SparkSession, path: str) -> bool:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def review_csv(spark: SparkSession, path: str) -> DataFrame:
    """Completed review sheets under a glob; none gives an empty frame of the same schema."""
    return review_sheets(spark, path)[0]


def review_sheets(spark: SparkSession, path: str, stage: Callable[..., DataFrame] = staged,
                  ) -> tuple[DataFrame, DataFrame]:
    """Completed review sheets under a glob, and the lines that are none: (rows, rejects).

    A line with a cell that is not of its column's type (a date that a spreadsheet rewrote, say)
    or with too few or many cells is no row with a null in it but a reject: the line as it
    stands, and its file. The lines are written once before they are told apart, as what counts
    as malformed depends on the columns that are read.
    """
    rejects = f"file string, {REJECT} string"
    if not _matches(spark, path):
        return spark.createDataFrame([], REVIEW_CSV_SCHEMA), spark.createDataFrame([], rejects)
    read = spark.read.csv(
        path, header=True, schema=f"{REVIEW_CSV_SCHEMA}, {REJECT} string", enforceSchema=False,
        mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT)
    lines = stage(read.withColumn("file", F.col("_metadata.file_path")), "review_lines")
    return (lines.filter(F.col(REJECT).isNull()).drop(REJECT, "file"),
            lines.filter(F.col(REJECT).isNotNull()).select("file", REJECT))


def form_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Exported form records, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def open_non_matches(ledger: DataFrame) -> DataFrame:
    return ledger.filter(~F.col("match_found"))
