"""URL filters: a blocked Bloom filter of listed canonical URLs, and an exact join of what passes it.

The filter is a table of blocks of 512 bits, eight lanes of 64; a key sets one bit in every lane of one block. Pages look
up one block each. The block table goes to every executor while its counted size allows, and is joined by shuffling
beyond that. Pages that pass the filter, listed ones and about one in a thousand others, are joined exactly with the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, for_all, fresh, table

LANES = 8
BITS_PER_KEY = 16

#: (host, path, verdict) of the rules that the query is asked to apply.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Host labels whose pages the query lists.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What stands after the first ``://``; empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.``, default port, closing slashes, fragment or tracking parameters;
    other parameters sorted."""
    host = F.regexp_replace(host_of(url), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(_rest(url), "^[^?#]*[?]([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.startswith("utm_"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _fits(host: Column, path: Column, rule: Sequence[str]) -> Column:
    same = (host == rule[0]) | host.endswith("." + rule[0])
    return same & path.startswith(rule[1])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _bit(key: Column, lane: int) -> Column:
    spot = F.shiftright(F.xxhash64(key, F.lit("bits")), 6 * lane).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), spot)


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's blocks that are not empty: ``_block`` and its lanes."""
    lanes = [F.bit_or(_bit(col(key), i)).alias(f"_lane{i}") for i in range(LANES)]
    return keys.groupBy(_block(col(key), blocks).alias("_block")).agg(*lanes)


def passes(frame: DataFrame, key: str, keys: DataFrame, keys_key: str) -> DataFrame:
    """The frame with ``_possible``: false for rows whose key is certainly not among the (distinct) ``keys``."""
    rows = keys.count()
    blocks = max(1, -(-rows * BITS_PER_KEY // (64 * LANES)))
    bloom = for_all(bloom_blocks(keys, keys_key, blocks), 8 * (LANES + 1), min(rows, blocks))
    found = frame.withColumn("_block", _block(col(key), blocks)).join(bloom, "_block", "left")
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & (F.col(f"_lane{i}").bitwiseAND(_bit(col(key), i)) != 0)
    return found.withColumn("_possible", F.coalesce(hit, F.lit(False))).drop("_block", *[f"_lane{i}" for i in range(LANES)])


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Sequence[str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``listed``, ``verdict``.

    ``listed`` has one column of URLs to block; any spelling of them will do, nulls and repeats don't matter. The longest
    rule that fits a page decides; pages without one are blocked if listed, else allowed. A null URL, or one without
    ``://``, has an empty host and path, fits no rule and is never listed. Ids may be null or repeat; other columns
    are not read. Rules stand in the plan, so long lists belong in ``listed``.
    """
    url = col(url_column)
    rows = pages.select(
        col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("_key")
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = _fits(F.col("host"), F.col("path"), (host, path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_said"), "_key")
    keys = listed.select(canonical(col(listed.columns[0])).alias("_listed")).filter("_listed != ''").distinct()
    tested = passes(rows, "_key", keys, "_listed")
    sure = tested.filter("NOT _possible").withColumn("listed", F.lit(False))
    possible = tested.filter("_possible").join(keys, F.col("_key") == F.col("_listed"), "left")
    possible = possible.withColumn("listed", F.col("_listed").isNotNull()).drop("_listed")
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return sure.unionByName(possible).select(
        "page_id", "host", "path", "rule", "listed", F.coalesce("_said", method).alias("verdict")
    )


def listed_urls(pages: DataFrame, url_column: str = "url", labels: Sequence[str] = LISTED_LABELS) -> DataFrame:
    """The URLs of pages whose host has one of the labels: the list that the query blocks."""
    host = F.split(host_of(col(url_column)), "[.]")
    return pages.filter(F.arrays_overlap(host, F.array(*map(F.lit, labels)))).select(col(url_column).alias("url"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, and by the list of URLs on hosts of listed labels where no rule fits."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, listed_urls(pages))


_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"

OP1_SQL = f"""
WITH parts AS (
  SELECT page_id, {_REST} AS rest,
         translate(regexp_extract({_REST}, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
keyed AS (
  SELECT *, regexp_replace(host, '^www[.]|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '') AS stem,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
                         lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS query
  FROM parts),
full_key AS (SELECT *, stem || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS key FROM keyed),
listed AS (SELECT DISTINCT key FROM full_key
           WHERE list_has_any(string_split(host, '.'), [{", ".join(f"'{x}'" for x in LISTED_LABELS)}]) AND key <> ''),
ruled AS (
  SELECT f.*, CASE
    {" ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
              for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1])))} END AS rule
  FROM full_key f)
SELECT page_id, host, path, rule, l.key IS NOT NULL AS listed,
       CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in RULES)}
            WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN listed l ON r.key = l.key
"""
