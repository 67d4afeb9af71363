"""Column checks: reading the stored text, rendering documents, and evaluating on the data.

The check language is the part shown to check authors: ``missing_count(col)`` and
``invalid_count(col)`` with ``valid values`` or ``invalid regex``, compared with a number. Any other
text is kept and reported as ``not_evaluated``, which does not pass.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterable
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tablegrade.functions.expressions import clean_check, full_name, is_filled, stripped
from tablegrade.functions.text import sql_name, sql_struct, sql_text
from tablegrade.operators.profile import Tables, as_text, fold, name_parts, union_all
from tablegrade.schemas import TABLE_KEYS
from tablegrade.sources.local import local_frame
from tablegrade.sources.state_files import stored_once

log = logging.getLogger(__name__)

PASS, FAIL, NOT_EVALUATED = "pass", "fail", "not_evaluated"

# --- fixed values -------------------------------------------------------------------------------

MISSING, INVALID = "missing_count", "invalid_count"
_METRIC = (
    r"^(missing_count|invalid_count)\s*\(\s*(`(?:[^`]|``)+`|[^()`]+?)\s*\)"
    r"\s*(!=|<>|<=|>=|=|<|>)\s*(-?\d{1,18})\s*:?\s*$"
)
# Lines end at a newline alone; other line separators may stand in a value.
_VALID_VALUES = r"\n\s*valid values:[ \t]*\[([^\n]*)\][ \t]*(?:\n|\z)"
_INVALID_REGEX = r"\n\s*invalid regex:[ \t]*([^\n]*?)[ \t]*(?:\n|\z)"
_LIST_ITEM = r""""(?:[^"\\]|\\[^\n])*"|'(?:[^']|'')*'|[^,\s][^,]*"""

# ------------------------------------------------------------------------------------------------


def split_checks(checks: DataFrame) -> DataFrame:
    """One row per check: a stored text may hold several, each on a line that starts with a dash.

    Adds ``item`` (position in the text) and ``definition``; blank texts give no row.
    """
    items = F.split(clean_check(F.col("check")), r"\n\s*-\s+")
    return checks.where(is_filled("check")).select(
        "*", F.posexplode(items).alias("item", "definition")
    )


def _unquoted(item: Column) -> Column:
    """A list item without its quotes and escapes."""
    item = F.trim(item)
    inner = item.substr(F.lit(2), F.length(item) - 2)
    # A newline is written as backslash-n; a backslash before anything else only escapes it.
    broken = F.regexp_replace(inner, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    double = F.regexp_replace(broken, r"(?s)\\(.)", "$1")
    single = F.replace(inner, F.lit("''"), F.lit("'"))
    long_enough = F.length(item) > 1
    return (
        F.when(long_enough & item.startswith('"') & item.endswith('"'), double)
        .when(long_enough & item.startswith("'") & item.endswith("'"), single)
        .otherwise(item)
    )


def parse_checks(checks: DataFrame) -> DataFrame:
    """Split the stored texts and read each check into columns.

    Adds ``check_name`` (its first line), ``metric``, ``argument``, ``comparator``, ``threshold``,
    ``valid_values``, ``invalid_regex`` and ``readable``.
    """
    definition = F.col("definition")
    first = F.regexp_extract(definition, r"^\s*([^\n]*?)\s*:?\s*(?:\n|$)", 1)

    def setting(pattern: str) -> Column:
        return F.when(definition.rlike(pattern), F.regexp_extract(definition, pattern, 1))

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract("check_name", _METRIC, group), F.lit(""))

    quoted = F.regexp_extract(part(2), r"(?s)^`(.+)`$", 1)
    argument = F.when(part(2).startswith("`"), F.replace(quoted, F.lit("``"), F.lit("`"))).otherwise(part(2))
    listed = F.regexp_extract_all(F.col("_list"), F.lit(_LIST_ITEM), F.lit(0))
    # Lines below the first that are not blank.
    settings = F.regexp_count(definition, F.lit(r"\n\s*\S"))
    one_setting = (settings == 1) & (
        F.col("valid_values").isNotNull() != F.col("invalid_regex").isNotNull()
    )
    readable = F.when(F.col("metric") == MISSING, settings == 0).when(
        F.col("metric") == INVALID, one_setting
    )
    return (
        split_checks(checks)
        .withColumns(
            {
                "check_name": first,
                "_list": setting(_VALID_VALUES),
                "invalid_regex": setting(_INVALID_REGEX),
            }
        )
        .withColumns(
            {
                "metric": part(1),
                "argument": argument,
                "comparator": part(3),
                "threshold": part(4).cast("bigint"),
                "valid_values": F.when(F.col("_list").isNotNull(), F.transform(listed, _unquoted)),
            }
        )
        .withColumn("readable", F.coalesce(readable, F.lit(False)))
        .drop("_list")
    )


# --- rendering ----------------------------------------------------------------------------------


def check_lines(definition: Column) -> Column:
    """A check as lines of a document: dash before the first, the others indented below it."""
    lines = F.split(definition, r"\n")
    first = F.concat(F.lit("  - "), F.element_at(lines, 1))
    others = F.transform(
        F.slice(lines, 2, F.size(lines)), lambda line: F.concat(F.lit("      "), stripped(line))
    )
    return F.array_join(F.concat(F.array(first), others), "\n")


def render_checks(checks: DataFrame, per_document: int | None = None) -> DataFrame:
    """The checks of every table as one document, in order of ``check_id``; checks without an id come first.

    With ``per_document``, a table with more checks gets several documents, numbered by ``part``, each complete with its
    header and holding a run of ids. Runs are formed from counts per id range, which are folded before they are
    shuffled, so no group of different ids holds more than ``per_document`` stored texts. Tables without a filled check get no
    document. A document is one value here; :func:`write_documents` writes documents of any size.
    """
    items = split_checks(checks).select(*TABLE_KEYS, "check_id", "item", "definition", "column_name", "check")
    if per_document is None:
        parted = items.withColumn("part", F.lit(0).cast("bigint"))
    else:
        parted = _in_parts(items, per_document)
    entry = F.struct("check_id", "item", check_lines(F.col("definition")).alias("text"))
    texts = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])
    return (
        parted.groupBy(*TABLE_KEYS, "part")
        .agg(texts.alias("texts"))
        .select(
            *TABLE_KEYS,
            "part",
            F.array_join(F.concat(F.array(_header()), F.col("texts")), "\n").alias("yaml_content"),
        )
    )


def _header() -> Column:
    return F.concat(F.lit("checks for "), full_name(), F.lit(":"))


def _in_parts(items: DataFrame, per_document: int) -> DataFrame:
    """The checks with the number of the document that each belongs to."""
    by_text = -1 - F.pmod(F.xxhash64("column_name", "check"), F.lit(1_000))
    ranges = F.coalesce(F.floor(F.col("check_id") / F.lit(per_document)), by_text).cast("bigint")
    items = items.withColumn("range", ranges)
    before = W.partitionBy(*TABLE_KEYS).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        items.groupBy(*TABLE_KEYS, "range")
        .agg(F.count("*").alias("n"))
        .withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(*TABLE_KEYS, "range", F.floor(F.col("seen") / per_document).cast("bigint").alias("part"))
    )
    return items.join(parts, [*TABLE_KEYS, "range"])


def write_documents(checks: DataFrame, folder: str) -> None:
    """Write the checks of every table as text below ``folder``, one folder ``document=<table>`` per table.

    Lines are sorted over all partitions by table, id and place, and written as they come, so no document is ever held as
    a whole. One that spans partitions is several files, whose names are in its order.
    """
    items = split_checks(checks).select(full_name().alias("document"), F.lit(1).alias("body"), "check_id", "item", check_lines(F.col("definition")).alias("value"))
    headers = checks.where(is_filled("check")).select(full_name().alias("document"), _header().alias("value")).distinct()
    headers = headers.select("document", F.lit(0).alias("body"), F.lit(None).cast("bigint").alias("check_id"), F.lit(0).alias("item"), "value")
    order = ["document", "body", "check_id", "item", "value"]
    lines = headers.unionByName(items).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("document", "value").write.partitionBy("document").text(folder)


# --- evaluation ---------------------------------------------------------------------------------

#: The most counts of one aggregate, and the most values that a check in it lists. What exceeds them is joined.
COUNTS_AT_ONCE = 200
LISTED_AT_ONCE = 1_000
#: Checks that one task reads, rows that one task folds to different values, and the most patterns that are broadcast.
CHECKS_AT_ONCE, ROWS_AT_ONCE, PATTERNS_AT_ONCE = 100_000, 500_000, 10_000

_SIGNATURE = ["metric", "argument", "valid_values", "invalid_regex"]
_VALUES = T.StructType(
    [T.StructField(k, T.StringType()) for k in [*TABLE_KEYS, "signature"]]
    + [T.StructField("value", T.LongType())]
)


def _compiles(spark: SparkSession, patterns: list[str]) -> bool:
    """Whether Spark can compile all the patterns; a constant expression, so no job runs."""
    tries = ", ".join(f"text rlike {sql_text(p)}" for p in patterns)
    try:
        spark.sql(f"select {tries} from values ('') as t(text)").collect()
        return True
    except Exception as error:
        if len(patterns) == 1:
            log.warning("not a valid pattern: %r (%s)", patterns[0], type(error).__name__)
        return False


def _bad_patterns(spark: SparkSession, patterns: Iterable[str]) -> set[str]:
    """The patterns that Spark can't compile. They are tried in groups, and those of a bad group one by one."""
    bad: set[str] = set()
    patterns = iter(patterns)
    while group := list(islice(patterns, COUNTS_AT_ONCE)):
        if not _compiles(spark, group):
            bad |= {p for p in group if not _compiles(spark, [p])}
    return bad


def _count(field: T.StructField, metric: str, valid: list[str] | None, regex: str | None) -> str:
    """SQL for the number of rows a check objects to.

    Listed values are compared in the column's own type, nested ones as JSON; one that does not fit
    it matches nothing.
    """
    column = sql_name(field.name)
    if metric == MISSING:
        return f"count_if({column} is null)"
    if regex is not None:
        return f"count_if(cast({column} as string) rlike {sql_text(regex)})"
    if not valid:
        return f"count({column})"
    plain = _is_plain(field)
    kind = "string" if plain else field.dataType.simpleString()
    listed = ", ".join(f"try_cast({sql_text(v)} as {kind})" for v in valid)
    value = as_text(field) if plain else column
    return f"count_if({column} is not null and not coalesce({value} in ({listed}), false))"


def evaluate_checks(spark: SparkSession, checks: DataFrame, tables: Tables) -> DataFrame:
    """Run all checks on the monitored tables: one row per check with its value and outcome.

    Checks of tables that are not in ``tables`` are left out, as nothing was run for them. What is to be counted (metric,
    column, values or pattern) is counted once for however many checks use it, in one of two ways:

    * up to ``COUNTS_AT_ONCE`` things of a table come to the driver, as they are the text of one aggregate, which
      scans the checked columns once;
    * the others stay rows. One scan folds the columns concerned to their different values with counts, and things are joined to
      those: listed values by equality, and each pattern looks at each different value once.
    """
    shares = -(-checks.count() // CHECKS_AT_ONCE)
    if shares > 1:
        # By rows: files of checks are so small that Spark would deal out too many at a time.
        checks = checks.repartition(shares, *TABLE_KEYS, "column_name", "check_id", "check")
    parsed = parse_checks(checks).join(F.broadcast(_open_names(spark, tables)), TABLE_KEYS, "left_semi")
    parsed = parsed.withColumn(
        "signature", F.when(F.col("readable"), F.to_json(F.struct(*_SIGNATURE)))
    )
    if shares > 1:
        parsed = stored_once(parsed)
    things = parsed.where("readable").select(*TABLE_KEYS, "signature", *_SIGNATURE)
    things = (things.repartition(shares, "signature") if shares > 1 else things).distinct()
    small = F.coalesce(F.size("valid_values"), F.lit(0)) <= LISTED_AT_ONCE
    wanted = things.where(small).limit(COUNTS_AT_ONCE + 1).collect()
    many = None
    if len(wanted) > COUNTS_AT_ONCE:
        things = stored_once(things)
        counts = things.where(small).groupBy(*TABLE_KEYS).agg(F.count("*").alias("n"))
        few = F.broadcast(counts.where(F.col("n") <= COUNTS_AT_ONCE).select(*TABLE_KEYS))
        wanted = things.where(small).join(few, TABLE_KEYS, "left_semi").collect()
        many = things.where(small).join(few, TABLE_KEYS, "left_anti").unionByName(things.where(~small))
    elif not things.where(~small).isEmpty():
        many = things.where(~small)

    bad = _bad_patterns(spark, {w["invalid_regex"] for w in wanted if w["invalid_regex"] is not None})
    by_table = defaultdict(list)
    for w in wanted:
        by_table[".".join(w[k] for k in TABLE_KEYS)].append(w)
    counted = []
    for name, table in tables.items():
        fields = {f.name.lower(): f for f in table.schema}
        todo = [w for w in by_table[name] if w["argument"].lower() in fields and w["invalid_regex"] not in bad]
        if todo:
            counted.append(_counts(name, table, fields, todo))
    if many is not None:
        many = stored_once(many.withColumn("thing", F.monotonically_increasing_id()))
        counted.append(_joined_counts(spark, many, tables))
    values = union_all(counted)
    if values is None:
        values = local_frame(spark, [], _VALUES)
    return (
        parsed.join(values, [*TABLE_KEYS, "signature"], "left")
        .withColumn("outcome", _outcome())
        .select(
            "check_id",
            *TABLE_KEYS,
            "column_name",
            "item",
            "check_name",
            "definition",
            "metric",
            "value",
            "outcome",
        )
    )


def _open_names(spark: SparkSession, tables: Tables) -> DataFrame:
    """The names of the open tables."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in TABLE_KEYS])
    return local_frame(spark, [tuple(name_parts(name)) for name in tables], schema)


def _is_plain(field: T.StructField) -> bool:
    """Whether a column's values are compared as text."""
    return isinstance(field.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType))


def _in_kind(text: str, field: T.StructField) -> str:
    """SQL for a text as the column would show it; null if it doesn't fit the column's type."""
    if _is_plain(field):
        return text
    kind = field.dataType.simpleString()
    fraction = isinstance(field.dataType, (T.FloatType, T.DoubleType))
    # adding zero makes minus zero zero, which it equals
    value = f"try_cast({text} as {kind})" + f" + cast(0 as {kind})" * fraction
    return f"cast({value} as string)"


def counted_values(table: DataFrame, fields: dict[int, T.StructField]) -> DataFrame:
    """The different values of some numbered columns with their counts, from one scan that folds before it shuffles by them.

    ``value`` is the text that values are compared by; ``shown`` is the column cast to text where that differs.
    """
    shares = -(-table.count() // ROWS_AT_ONCE)
    if shares > 1:
        # A file may be one task's, with more different values than fit its memory.
        table = table.select(*(F.col(sql_name(f.name)) for f in fields.values())).repartition(shares)
    cells = []
    for number, field in fields.items():
        shown = f"cast({sql_name(field.name)} as string)"
        value = as_text(field) if _is_plain(field) else _in_kind(sql_name(field.name), field)
        cells.append(sql_struct(number=str(number), value=value, shown=f"nullif({shown}, {value})"))
    rows = table.selectExpr(f"inline(array({', '.join(cells)}))")
    return rows.groupBy("number", "value", "shown").agg(F.count("*").alias("n"))


def _joined_counts(spark: SparkSession, things: DataFrame, tables: Tables) -> DataFrame:
    """The value of each thing to count, by joins with the counted values of its column. ``things`` is stored.

    Rows that are shuffled name a thing and a column by number. Only the columns that are asked for, and patterns that can't
    be compiled, come to the driver.
    """
    things = things.withColumn("argument", F.lower("argument"))
    asked = defaultdict(set)
    known = F.broadcast(_open_columns(spark, tables))
    for row in things.select(*TABLE_KEYS, "argument").distinct().join(known, [*TABLE_KEYS, "argument"], "left_semi").collect():
        asked[".".join(row[k] for k in TABLE_KEYS)].add(row["argument"])
    frames, rows, ways = [], [], {}
    for name, columns in asked.items():
        fields = {len(rows) + i: f for i, f in enumerate(f for f in tables[name].schema if f.name.lower() in columns)}
        frames.append(counted_values(tables[name], fields))
        for number, f in fields.items():
            rows.append((*name_parts(name), f.name.lower(), number, ways.setdefault(_in_kind("listed", f), len(ways))))
    if not frames:
        return local_frame(spark, [], _VALUES)
    values = stored_once(union_all(frames))
    column = [*TABLE_KEYS, "argument"]
    schema = T.StructType([T.StructField(k, T.StringType()) for k in column]).add("number", T.IntegerType()).add("way", T.IntegerType())
    things = things.join(F.broadcast(local_frame(spark, rows, schema)), column)

    patterns = things.where("invalid_regex is not null").select("thing", "number", "invalid_regex")
    bad = _bad_patterns(spark, (row["invalid_regex"] for row in patterns.select("invalid_regex").distinct().toLocalIterator()))
    if bad:
        things = things.where(F.col("invalid_regex").isNull() | ~F.col("invalid_regex").isin(bad))
        patterns = patterns.where(~F.col("invalid_regex").isin(bad))
    matched = patterns.count()
    patterns = F.broadcast(patterns) if matched <= PATTERNS_AT_ONCE else patterns

    # What a check lists, each value once in the way that its column shows it.
    in_kind = "case way " + " ".join(f"when {i} then {way}" for way, i in ways.items()) + " end"
    listed = things.selectExpr("thing", "number", f"explode(array_distinct(transform(valid_values, listed -> {in_kind}))) as value")
    known = listed.where("value is not null").join(values, ["number", "value"]).groupBy("thing").agg(F.sum("n").alias("known"))

    filled = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    # One row for each column that is asked for.
    totals = F.broadcast(values.groupBy("number").agg(filled.alias("filled"), missing.alias("missing")))
    found = things.select(*TABLE_KEYS, "signature", "thing", "number", "metric", "invalid_regex")
    found = found.join(totals, "number", "left").join(known, "thing", "left")
    if matched:
        shown = F.coalesce("shown", "value")
        met = values.where("value is not null").join(patterns, "number").where(F.rlike(shown, F.col("invalid_regex")))
        found = found.join(met.groupBy("thing").agg(F.sum("n").alias("met")), "thing", "left")
    else:
        found = found.withColumn("met", F.lit(0))

    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    value = (
        F.when(F.col("metric") == MISSING, count("missing"))
        .when(F.col("invalid_regex").isNotNull(), count("met"))
        .otherwise(count("filled") - count("known"))
    )
    return found.select(*TABLE_KEYS, "signature", value.alias("value"))


def _open_columns(spark: SparkSession, tables: Tables) -> DataFrame:
    """The columns of the open tables, in lower case as ``argument``."""
    rows = [(*name_parts(name), field.name.lower()) for name, table in tables.items() for field in table.schema]
    return local_frame(spark, rows, T.StructType([T.StructField(k, T.StringType()) for k in [*TABLE_KEYS, "argument"]]))


def _counts(name: str, table: DataFrame, fields: dict, todo: list) -> DataFrame:
    """All counts of one table from one scan, labelled by signature."""
    cells = {
        w["signature"]: {
            "value": _count(
                fields[w["argument"].lower()], w["metric"], w["valid_values"], w["invalid_regex"]
            )
        }
        for w in todo
    }
    return fold(name, table, cells).withColumnRenamed("column_name", "signature")


def _outcome() -> Column:
    value, threshold = F.col("value"), F.col("threshold")
    holds = (
        F.when(F.col("comparator") == "=", value == threshold)
        .when(F.col("comparator").isin("!=", "<>"), value != threshold)
        .when(F.col("comparator") == "<", value < threshold)
        .when(F.col("comparator") == "<=", value <= threshold)
        .when(F.col("comparator") == ">", value > threshold)
        .when(F.col("comparator") == ">=", value >= threshold)
    )
    return F.when(holds, PASS).when(~holds, FAIL).otherwise(NOT_EVALUATED)


def check_rollup(results: DataFrame) -> DataFrame:
    """Per evaluated table: did all checks pass, and how many did what."""
    return results.groupBy(*TABLE_KEYS).agg(
        F.bool_and(F.col("outcome") == PASS).alias("all_checks_passed"),
        F.count("*").alias("n_checks"),
        F.count_if(F.col("outcome") == FAIL).alias("n_failed"),
        F.count_if(F.col("outcome") == NOT_EVALUATED).alias("n_not_evaluated"),
    )


def check_summaries(results: DataFrame) -> DataFrame:
    """Per evaluated check the fields of a scan summary, as rows rather than nested lists."""
    return results.select(
        full_name().alias("table_name"),
        "check_id",
        "check_name",
        (F.col("outcome") == PASS).alias("is_passed"),
        F.col("definition").alias("check_definition"),
        F.col("value").alias("failed_value_count"),
    )
