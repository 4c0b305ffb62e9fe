"""Closed vocabularies and group maps as small tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def category_vocabulary(truth: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Sorted distinct non-empty values per categorical field."""
    values = truth.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
        ).alias("v")
    ).select("v.*")
    return values.filter(F.col("value") != "").distinct()


def name_tokens(truth: DataFrame, column: str = "applicant_name") -> DataFrame:
    """Distinct alphabetic tokens of the names."""
    tokens = truth.select(F.explode(F.split(column, " ")).alias("token"))
    return tokens.filter(F.col("token").rlike(r"\A\p{L}+\z")).distinct()


def parse_map(text: Column) -> Column:
    """A JSON object of strings as a map; NULL when it is not one."""
    return F.from_json(text, "map<string,string>")


CATEGORY_SCHEMA = "category-vocabulary/v1"


def write_vocabulary(values: DataFrame, path: str) -> None:
    """One JSON document of (field, value): closed vocabularies, each sorted."""
    fields = values.groupBy("field").agg(F.sort_array(F.collect_set("value")).alias("v"))
    document = fields.agg(F.map_from_entries(F.collect_list(F.struct("field", "v"))).alias("fields"))
    text = F.to_json(F.struct(F.lit(CATEGORY_SCHEMA).alias("schema"), "fields"))
    document.select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(field, value) of such a document; empty if it is missing, no JSON, or of another schema."""
    try:
        documents = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "field string, value string")
    parsed = documents.select(F.from_json("value", "schema string, fields map<string,array<string>>").alias("d"))
    known = parsed.filter(F.col("d.schema") == CATEGORY_SCHEMA)
    return known.select(F.explode("d.fields").alias("field", "values")).select("field", F.explode("values").alias("value"))
