"""Raw values that typing turned into NULL: typed rows and their rejects from one scan (S2-S5).

The readers of :mod:`.jsonl` never fail on a bad value, they give NULL. Here
every such value is kept: what the field is, the text, why it is no value of
the field's type, and the file. A line that is no JSON object is a reject of
the whole line (and, as in the plain readers, a row of NULLs).

:func:`split_dataset` writes rows and rejects in one job over the raw files,
with the counts observed on the way; nothing is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import jsonl

REASONS = {
    T.DateType: "not a date",
    T.TimestampNTZType: "not a timestamp",
    T.IntegerType: "not an integer",
    T.DoubleType: "not a number",
    T.DecimalType: "not a number of the field's precision",
    T.BooleanType: "not a boolean",
}
CORRUPT = "_corrupt_record"
NOT_JSON = "not a JSON object"
REJECT = T.StructType([T.StructField(n, T.StringType()) for n in ("dataset", "file", "field", "value", "reason")])


def _typed_fields(name: str, raw: DataFrame) -> list[T.StructField]:
    """The typed fields that are not plain text."""
    return [f for f in jsonl.typed(name, raw).schema.fields if not isinstance(f.dataType, T.StringType)]


def read_checked(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row for each raw line: ``row`` (typed, as the plain reader gives it) and ``rejects`` (array, mostly empty)."""
    schema = T.StructType([*jsonl.raw_schema(name).fields, T.StructField(CORRUPT, T.StringType())])
    raw = jsonl.read_json_tree(spark, jsonl.dataset_path(root, name), schema).withColumn("_file", F.col("_metadata.file_path"))
    return checked(raw, name)


def checked(raw: DataFrame, name: str) -> DataFrame:
    """The same from raw text columns, with optional ``_corrupt_record`` and ``_file``."""
    fields = _typed_fields(name, raw)
    file = F.col("_file") if "_file" in raw.columns else F.lit(None).cast("string")

    def reject(field: str, value: Column, reason: str) -> Column:
        return F.struct(F.lit(name).alias("dataset"), file.alias("file"), F.lit(field).alias("field"), value.alias("value"), F.lit(reason).alias("reason"))

    typed = jsonl.typed_columns(name, raw)
    found = [
        F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), reject(f.name, F.col(f.name), REASONS[type(f.dataType)]))
        for f in fields
    ]
    if CORRUPT in raw.columns:
        found.append(F.when(F.col(CORRUPT).isNotNull(), reject(CORRUPT, F.col(CORRUPT), NOT_JSON)))
    row = F.struct(*[c.alias(n) for n, c in typed.items()])
    return raw.select(row.alias("row"), F.array_compact(F.array(*found)).alias("rejects"))


@dataclass(frozen=True)
class Split:
    """Where rows and rejects are, and how many there are."""

    rows_path: str
    rejects_path: str
    rows: int
    rejects: int


def split_dataset(spark: SparkSession, root: str, name: str, out_root: str) -> Split:
    """Write ``<out>/<name>/kind=row`` and ``.../kind=reject`` from one scan of the raw files."""
    path = f"{out_root.rstrip('/')}/{name}"
    both = read_checked(spark, root, name).select(
        F.explode(
            F.concat(
                F.array(F.struct("row", F.lit(None).cast(REJECT).alias("reject"))),
                F.transform("rejects", lambda r: F.struct(F.lit(None).cast(_row_type(spark, name)).alias("row"), r.alias("reject"))),
            )
        ).alias("x")
    ).select("x.row", "x.reject", F.when(F.col("x.reject").isNull(), "row").otherwise("reject").alias("kind"))
    seen = Observation(f"rejects of {name}")
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("row", "reject")]
    both.observe(seen, *counts).write.mode("overwrite").partitionBy("kind").parquet(path)
    return Split(f"{path}/kind=row", f"{path}/kind=reject", seen.get["row"], seen.get["reject"])


def _row_type(spark: SparkSession, name: str) -> T.StructType:
    return jsonl.typed(name, spark.createDataFrame([], jsonl.raw_schema(name))).schema


def read_rows(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """The typed rows of a split dataset."""
    return _read(spark, out_root, name).where("kind = 'row'").select("row.*")


def read_rejects(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """The quarantined values of a split dataset: dataset, file, field, value, reason."""
    return _read(spark, out_root, name).where("kind = 'reject'").select("reject.*")


def _read(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField("row", _row_type(spark, name)), T.StructField("reject", REJECT), T.StructField("kind", T.StringType())]
    )
    return spark.read.schema(schema).parquet(f"{out_root.rstrip('/')}/{name}")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """How often each value was rejected, and why."""
    return rejects.groupBy("dataset", "field", "value", "reason").agg(F.count(F.lit(1)).alias("n"))
