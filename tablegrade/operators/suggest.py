"""Drafting column descriptions and checks from what the data shows, and prompts for a model.

A hosted model is outside a Spark job, so the drafts are made from the profile by fixed rules; the
prompt frames hold what a model would be asked, one row per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrade.functions.expressions import stripped
from tablegrade.schemas import COLUMN_KEYS, GENERATED, TAG_LOW_CARDINALITY

DESCRIPTION_PROMPT = (
    "Write a description of the table column given below, two sentences at most. Keep what its "
    "comment already says if it is still true. If the column takes few distinct values, list them "
    'after the words "valid values". Answer with the description alone, ending in a full stop.'
    "\n\nContext: {context}"
)

CHECK_PROMPT = (
    "Write one or two data quality checks for the table column given below, in the check language "
    "of these examples:\n"
    "  - missing_count(order_id) = 0\n"
    "  - invalid_count(state) = 0:\n"
    "      valid values: [NEW, PAID]\n"
    "  - invalid_count(phone) = 0:\n"
    "      invalid regex: [a-z]\n"
    'Use the reference checks in the context where they fit. Start each check with "  -" and answer '
    "with the checks alone.\n\nContext: {context}"
)


def _quoted(value: Column) -> Column:
    """A value as a double-quoted list item, with backslash escapes."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit('"'))


def suggest_checks(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """Checks that hold on the data today, at most two per column, as one generated text each.

    A column without nulls must stay so; a column of low cardinality must keep to the values seen.
    Columns that give neither, among them those without any value, get no row.
    """
    # Names that the check language could misread stand in backticks.
    name = F.when(
        F.col("column_name").rlike(r"^[^()`\s]+( [^()`\s]+)*$"), F.col("column_name")
    ).otherwise(F.concat(F.lit("`"), F.replace("column_name", F.lit("`"), F.lit("``")), F.lit("`")))
    complete = F.when(
        (F.col("null_count") == 0) & (F.col("row_count") > 0),
        F.concat(F.lit("  - missing_count("), name, F.lit(") = 0")),
    )
    listed = F.array_join(F.transform("values", _quoted), ", ")
    closed = F.when(
        F.col("is_low_cardinality") & (F.size("values") > 0),
        F.concat(
            F.lit("  - invalid_count("),
            name,
            F.lit(") = 0:\n      valid values: ["),
            listed,
            F.lit("]"),
        ),
    )
    return (
        profile.join(counts, COLUMN_KEYS)
        .select(
            *COLUMN_KEYS,
            F.concat_ws("\n", complete, closed).alias("check"),
            F.lit(GENERATED).alias("tag"),
        )
        .where(F.col("check") != "")
    )


def _listing(values: Column) -> Column:
    """The end of a drafted comment: the values of a column, joined."""
    return F.concat(F.lit(". Valid values: "), values)


def draft_descriptions(
    columns: DataFrame, profile: DataFrame, tags: DataFrame | None = None
) -> DataFrame:
    """A comment for every column: its present one if filled, else its name and type in words.

    Values of low-cardinality columns are added as "valid values", once: a present comment loses its end
    if that lists the values of now or those of the low-cardinality tag in ``tags``, the tags from
    before the profile. Any other text stays as it is.
    """
    found = profile.select(*COLUMN_KEYS, "is_low_cardinality", "values")
    columns = columns.join(found, COLUMN_KEYS, "left")
    lists = [F.array_join("values", ", ")]
    if tags is not None:
        listed = tags.where((F.col("tag_name") == TAG_LOW_CARDINALITY) & F.col("tag_value").isNotNull())
        columns = columns.join(
            listed.groupBy(*COLUMN_KEYS).agg(F.max("tag_value").alias("listed_before")), COLUMN_KEYS, "left"
        )
        lists.append(F.col("listed_before"))
    comment = stripped(F.coalesce("comment", F.lit("")))
    present = comment
    for values in lists:
        end = F.concat(_listing(values), F.lit("."))
        shorter = comment.substr(F.lit(1), F.length(comment) - F.length(end))
        present = F.when(comment.endswith(end), shorter).otherwise(present)
    words = F.regexp_replace(F.regexp_replace("column_name", "_", " "), r"\s+", " ")
    start = F.concat(F.upper(F.substring(words, 1, 1)), words.substr(F.lit(2), F.length(words)))
    optional = F.when(F.col("is_nullable") == "YES", ", may be empty").otherwise("")
    fallback = F.concat(start, F.lit(" ("), F.col("data_type"), optional, F.lit(")"))
    text = F.regexp_replace(F.when(present != "", present).otherwise(fallback), r"\.$", "")
    values = F.when(
        F.col("is_low_cardinality") & (F.size("values") > 0),
        _listing(F.array_join("values", ", ")),
    ).otherwise("")
    return columns.select(
        *COLUMN_KEYS,
        F.concat(text, F.coalesce(values, F.lit("")), F.lit(".")).alias("comment"),
    )


def column_record(tags: Column) -> Column:
    """A column's metadata as JSON text, with its tags as two parallel lists."""
    fields = ("column_name", "is_nullable", "data_type", "comment")
    return F.to_json(
        F.struct(
            *fields,
            F.transform(tags, lambda t: t["tag_name"]).alias("tag_names"),
            F.transform(tags, lambda t: F.coalesce(t["tag_value"], F.lit(""))).alias("tag_values"),
        ),
        {"ignoreNullFields": "false"},
    )


def build_prompts(columns: DataFrame, contexts: DataFrame | None, template: str) -> DataFrame:
    """System and user text for every column.

    ``columns`` carries ``tags`` (see ``sources.inventory.column_metadata``). ``contexts`` gives a
    ``context`` per column; columns without one get an empty context.
    """
    if contexts is None:
        columns = columns.withColumn("context", F.lit(""))
    else:
        columns = columns.join(contexts.select(*COLUMN_KEYS, "context"), COLUMN_KEYS, "left")
    context = F.coalesce("context", F.lit(""))
    return columns.select(
        *COLUMN_KEYS,
        F.replace(F.lit(template), F.lit("{context}"), context).alias("system"),
        column_record(F.col("tags")).alias("user"),
    )
