"""Corpus summary and field statistics, as partial + final aggregates.

Summary counters and per-subreddit counts are one-pass aggregates; field
statistics read schema-less JSON records through VARIANT so that records with
different keys and mixed value types (``edited`` is false, true or a float)
are counted as the Python dict walk counts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import DELETED
from skein.operators.pairs import parent_key
from skein.operators.skew import join_facts
from skein.session import staged


def summary_totals(df: DataFrame) -> DataFrame:
    """comments, deleted, on posts, reply pairs, subreddits.

    A reply is decided as the summary does it: the text after the first '_'
    of parent_id starts with 'c' (differs from the '_c' anywhere test).
    """
    is_pair = F.coalesce(parent_key("parent_id").startswith("c"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("comments"),
        F.count_if(F.coalesce(F.col("body") == F.lit(DELETED), F.lit(False))).alias("deleted"),
        F.count_if(~is_pair).alias("posts"),
        F.count_if(is_pair).alias("pairs"),
        # a missing subreddit_id is a key of its own, as None is in a dict
        (F.count_distinct("subreddit_id")
         + F.max(F.col("subreddit_id").isNull().cast("int"))).alias("subreddits"),
    )


def summary_groups(df: DataFrame) -> DataFrame:
    """Comments per subreddit id, named by the first name seen, in report order:
    ascending count, ties by first appearance (E2)."""
    return (df.groupBy("subreddit_id")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min_by("subreddit", "pos").alias("subreddit"),
                 F.min("pos").alias("first_pos"))
            .orderBy("n", "first_pos"))


def inconsistent_names(df: DataFrame) -> DataFrame:
    """Rows whose subreddit name differs from the first name of their id (E3);
    rows without an id are one group."""
    rows = staged(df.select("pos", "subreddit_id", "subreddit"), "names")
    first = rows.groupBy(F.col("subreddit_id").alias("_g")).agg(F.min_by("subreddit", "pos").alias("first_name"))
    return (join_facts(rows, first, "subreddit_id", "_g").drop("_g")
            .where(~F.col("subreddit").eqNullSafe(F.col("first_name"))))


def group_counts(df: DataFrame, col: str = "subreddit") -> DataFrame:
    """Comments per subreddit name."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def record_fields(records: DataFrame, json_col: str = "value", order: str = "pos") -> DataFrame:
    """One row per (record, field) of JSON-text records: pos, field, value (VARIANT).

    A JSON null value is present (the key exists); a missing key is absent.
    """
    v = records.select(F.col(order).alias("pos"), F.parse_json(F.col(json_col)).alias("_v"))
    spark = records.sparkSession
    return v.lateralJoin(
        spark.tvf.variant_explode(F.col("_v").outer())
        .select(F.col("key").alias("field"), F.col("value").alias("_val"))
    ).select("pos", "field", F.col("_val").alias("value"))


def value_text(v) -> F.Column:
    """Display text of a field value: strings as themselves, others as JSON."""
    return F.when(F.schema_of_variant(v) == "STRING", v.cast("string")).otherwise(F.to_json(v))


def list_fields(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Distinct field names over all records (E5)."""
    return record_fields(records, json_col).select("field").distinct()


def count_fields(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Records per field, ascending by count, ties by first appearance."""
    return field_counts(record_fields(records, json_col))


def field_counts(fields: DataFrame) -> DataFrame:
    return (fields.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
            .orderBy("n", "first_pos"))


def count_field_values(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Occurrences of each value of each field (E7). Values of different JSON
    types stay apart (the type is part of the key); arrays and objects count
    by their JSON text."""
    return field_value_counts(record_fields(records, json_col))


def field_value_counts(fields: DataFrame) -> DataFrame:
    return (fields.groupBy("field", F.schema_of_variant("value").alias("value_type"),
                           value_text(F.col("value")).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def records_as_json(df: DataFrame, order: str = "pos") -> DataFrame:
    """Typed rows rendered as JSON-text records (pos, value); null fields are
    left out, as a dump omits absent keys."""
    cols = [c for c in df.columns if c != order]
    return df.select(F.col(order).alias("pos"), F.to_json(F.struct(*cols)).alias("value"))
