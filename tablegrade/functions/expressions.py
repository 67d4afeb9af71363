"""Scalar building blocks, all of them plain column expressions that run in the JVM."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablegrade.schemas import RETENTION_PROPERTIES, TABLE_KEYS, TAG_LOW_CARDINALITY

#: Seconds in each unit a window text may use (``m`` means minutes).
_UNIT_SECONDS = {"d": 86_400, "h": 3_600, "m": 60}


def full_name(*parts: str | Column) -> Column:
    """Dotted ``catalog.schema.table`` name; without arguments, of the three key columns."""
    return F.concat_ws(".", *(parts or TABLE_KEYS))


def base_name(name: str | Column) -> Column:
    """Last part of a dotted name."""
    return F.substring_index(name, ".", -1)


def instant(moment: datetime | str | Column) -> Column:
    """A zone-free timestamp column from a datetime, a text or a column; a moment with a zone becomes UTC."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    try:
        given = datetime.fromisoformat(str(moment))
    except ValueError:
        given = None
    if given is not None and given.tzinfo is not None:
        moment = given.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(moment)).cast("timestamp_ntz")


def is_filled(text: str | Column) -> Column:
    """True when a text is neither null nor blank; never null itself."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.rlike(r"\S"), F.lit(False))


def stripped(text: Column) -> Column:
    """A text without white space of any kind around it."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _unit_total(window: Column, unit: str) -> Column:
    numbers = F.regexp_extract_all(window, F.lit(rf"(\d+){unit}"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))


def window_seconds(window: str | Column) -> Column:
    """Seconds of a window text such as ``1d6h``; null when it has no recognisable part.

    Every ``<n>d``, ``<n>h`` and ``<n>m`` found anywhere in the text is added up.
    """
    window = F.col(window) if isinstance(window, str) else window
    parts = (_unit_total(window, unit) * seconds for unit, seconds in _UNIT_SECONDS.items())
    days, hours, minutes = parts
    return F.when(window.rlike(r"\d[dhm]"), days + hours + minutes)


def checked_window_seconds(window: str | Column) -> Column:
    """Like :func:`window_seconds`, but a text without any part fails the job."""
    window = F.col(window) if isinstance(window, str) else window
    message = F.concat(F.lit("not a window: "), F.coalesce(window, F.lit("NULL")))
    return F.coalesce(window_seconds(window), F.raise_error(message).cast("bigint"))


def seconds_before(moment: Column, seconds: Column) -> Column:
    """The instant ``seconds`` before ``moment``."""
    zero = F.lit(0)
    return moment - F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, rounded down; zone-free."""
    exact = (end - start).cast("interval second").cast("decimal(20,6)")
    return F.floor(exact).cast("bigint")


def age_parts(seconds: Column) -> Column:
    """Days, hours and minutes of an age, with floored days for negative ages."""
    rest = F.pmod(seconds, F.lit(86_400))
    return F.struct(
        F.floor((seconds - rest) / 86_400).cast("bigint").alias("days"),
        F.floor(rest / 3_600).cast("bigint").alias("hours"),
        F.floor(F.pmod(rest, F.lit(3_600)) / 60).cast("bigint").alias("minutes"),
    )


def age_text(seconds: Column) -> Column:
    """An age as ``"Xd Yh Zm"``; null for a null age."""
    parts = age_parts(seconds)
    text = F.format_string("%dd %dh %dm", parts["days"], parts["hours"], parts["minutes"])
    return F.when(seconds.isNotNull(), text)


def enforces_retention(properties: Column) -> Column:
    """True when the table-properties text names one of the retention settings."""
    named = F.lit(False)
    for setting in RETENTION_PROPERTIES:
        named = named | properties.contains(setting)
    return F.coalesce(named, F.lit(False))


def joined_values(values: Column) -> Column:
    """Sorted values as one comma-separated text."""
    return F.array_join(F.array_sort(values), ", ")


def clean_check(check: Column) -> Column:
    """A stored check without surrounding white space and without its leading dash."""
    return F.regexp_replace(F.regexp_replace(check, r"^\s*(-\s*)?", ""), r"\s+$", "")


def primary_tag(tags: Column) -> Column:
    """The one tag that stands for a column: low cardinality if present, else the first, else null.

    ``tags`` is an array of ``struct<tag_name, tag_value>``.
    """
    preferred = F.filter(tags, lambda tag: tag["tag_name"] == TAG_LOW_CARDINALITY)
    return F.coalesce(F.try_element_at(preferred, F.lit(1)), F.try_element_at(tags, F.lit(1)))


_COLUMN_JSON = (
    "column_name string, is_nullable string, data_type string, comment string, "
    "tag_names array<string>, tag_values array<string>"
)


def summarise_column_json(record: Column) -> Column:
    """A column record given as JSON text, reduced to its primary tag; null if it is not JSON.

    Parallel ``tag_names`` / ``tag_values`` lists are zipped, so both must be filled for a tag
    to be reported.
    """
    def summary(parsed: Column) -> Column:
        pairs = F.when(
            (F.size(parsed["tag_names"]) > 0) & (F.size(parsed["tag_values"]) > 0),
            F.zip_with(
                parsed["tag_names"],
                parsed["tag_values"],
                lambda name, value: F.struct(name.alias("tag_name"), value.alias("tag_value")),
            ),
        )
        tag = primary_tag(pairs)
        fields = ("column_name", "is_nullable", "data_type", "comment")
        found = F.struct(
            *(parsed[f].alias(f) for f in fields),
            tag["tag_name"].alias("tag_name"),
            tag["tag_value"].alias("tag_value"),
        )
        return F.when(parsed["column_name"].isNotNull(), found)

    # The one-element array makes the parsed record a variable, so that it is parsed once.
    parsed = F.from_json(record, _COLUMN_JSON, {"mode": "PERMISSIVE"})
    return F.transform(F.array(parsed), summary)[0]
