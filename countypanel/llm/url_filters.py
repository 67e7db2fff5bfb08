"""URL filters (operator 2): dated list entries become validity intervals, joined as of each capture's fetch time.

An entry (list_name, verdict, pattern, action, dated) adds a pattern to a list or removes it. It holds from its date until the next
entry of the same list and pattern; of entries of one moment, a removal counts last. A capture (url, fetched_at) is
matched by the patterns that are its host, a domain above it, or its host with leading parts of its path, as
far as they were on a list when it was fetched. The longest such pattern decides; of equally long ones, `block`.

DataFrame operations only. Dates are cut into buckets, so that neither a pattern with very many entries nor a host with
very many captures meets in one task: intervals are closed inside a bucket and, from a table of one row per pattern and
bucket, across buckets; the as-of join is an equi-join on pattern and time slot with a check of the times. Slots have
levels, each twice as wide as the one below. An interval is listed in the slots of one level, at most 2 ** (SLOT_BITS + 1) + 1
however long it is, and a capture is looked up once per level, so neither grows with the time span by more than its logarithm.

Defined results: captures without url or time match nothing and get the verdict `none`, as do those that no list names.
Entries with a null in any column that matters take no part. Repeated entries count once; repeated captures come back
as often as they went in. Far-off times cost another level or two. Of a very long url or host only the parts that some
entry is long enough to name are looked up, which loses nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countypanel.llm.common import table

BUCKET_SECONDS = 6 * 3600
#: An interval of 2 ** SLOT_BITS buckets or more lies in at least that many slots, which spreads a hot pattern.
SLOT_BITS = 3

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), _HOST, 1)


def path_parts(url: Column) -> Column:
    return F.array_remove(F.split(F.regexp_extract(url, _PATH, 1), "/"), "")


def with_patterns(urls: DataFrame, max_labels: int, max_parts: int) -> DataFrame:
    """urls once for each pattern that could list its url: the host, the domains above it, the host with 1, 2, ... parts of the path.

    Patterns of more labels or parts than the bounds, which no entry has, are left out.
    """
    host, parts, labels = F.col("_host"), F.col("_parts"), F.col("_labels")
    count = F.size(labels)
    lower = F.greatest(count - max_labels + 1, F.lit(1))
    domains = F.when(F.lit(max_labels > 0), F.transform(
        F.sequence(lower, count), lambda i: F.array_join(F.slice(labels, i, count), "."))).otherwise(F.array().cast("array<string>"))
    depth = F.least(F.size(parts), F.lit(max_parts))
    deeper = F.transform(F.slice(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), F.lit(1), depth),
                         lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))
    cut = urls.withColumn("_host", host_of(F.col("url"))).withColumn("_parts", path_parts(F.col("url")))
    cut = cut.where("_host <> ''").withColumn("_labels", F.split("_host", r"\."))
    return cut.select(*urls.columns, F.explode(F.array_distinct(F.concat(domains, deeper))).alias("pattern"))


def _bucket(time: str, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / seconds).cast("bigint")


def _slot(bucket: str) -> Column:
    """The slot of a bucket on the row's level."""
    return F.call_function("shiftright", F.col(bucket), F.col("level"))


def intervals(entries: DataFrame, seconds: int = BUCKET_SECONDS) -> DataFrame:
    """list_name, verdict, pattern, valid_from, valid_to (null: still valid) of every stretch in which a list holds a pattern."""
    key = ["list_name", "verdict", "pattern"]
    known = entries.dropna(subset=[*key, "action", "dated"]).where(F.col("action").isin("add", "remove"))
    moments = known.groupBy(*key, "dated").agg(F.max(F.col("action") == "remove").alias("removed")).withColumn(
        "bucket", _bucket("dated", seconds)
    )
    later = moments.groupBy(*key, "bucket").agg(F.min("dated").alias("first")).withColumn(
        "after", F.lead("first").over(Window.partitionBy(*key).orderBy("bucket"))
    ).drop("first")
    inside = moments.withColumn("next", F.lead("dated").over(Window.partitionBy(*key, "bucket").orderBy("dated")))
    closed = inside.join(later, [*key, "bucket"]).where(~F.col("removed"))
    return closed.select(*key, F.col("dated").alias("valid_from"), F.coalesce("next", "after").alias("valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame, seconds: int = BUCKET_SECONDS) -> DataFrame:
    """captures (page_id, url, fetched_at) with verdict, pattern and list_name."""
    bucket = _bucket("fetched_at", seconds)
    begin, end = captures.agg(F.min(bucket), F.max(bucket)).first()  # two numbers
    if begin is None:
        begin, end = 0, -1
    host, path = F.substring_index("pattern", "/", 1), F.col("pattern")
    labels, parts = entries.agg(F.max(F.size(F.split(host, r"\."))), F.max(F.size(F.split(path, "/")) - 1)).first()  # two more
    top = max(0, (end - begin + 1).bit_length() - 1 - SLOT_BITS)
    first = F.greatest(_bucket("valid_from", seconds), F.lit(begin).cast("bigint")) - begin
    last = F.least(_bucket("valid_to", seconds), F.lit(end).cast("bigint")) - begin  # skips a null end of validity
    held = intervals(entries, seconds).withColumn("first", first).withColumn("last", last).where("first <= last")
    width = F.length(F.bin(F.col("last") - F.col("first") + 1)) - 1
    listed = held.withColumn("level", F.greatest(width - SLOT_BITS, F.lit(0))).withColumn(
        "slot", F.explode(F.sequence(_slot("first"), _slot("last")))).drop("first", "last")
    asked = captures.where("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct()
    keyed = with_patterns(asked, labels or 0, parts or 0).withColumn("at", bucket - begin).withColumn(
        "level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("slot", _slot("at")).drop("at")
    active = keyed.join(listed, ["pattern", "level", "slot"]).where(
        (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    )
    best = F.max(F.struct(F.length("pattern").alias("size"), (F.col("verdict") == "block").alias("blocks"), "verdict", "pattern", "list_name"))
    decided = active.groupBy("url", "fetched_at").agg(best.alias("best")).select("url", "fetched_at", "best.verdict", "best.pattern", "best.list_name")
    return captures.select("page_id", "url", "fetched_at").join(decided, ["url", "fetched_at"], "left").select(
        "page_id", "url", "fetched_at", F.coalesce("verdict", F.lit("none")).alias("verdict"), "pattern", "list_name"
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """pages with a fetch time within January 2024, spread by page_id."""
    seconds = F.pmod(F.col("page_id") * 7919, F.lit(30 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + seconds).cast("timestamp_ntz").alias("fetched_at"))


def entries_of(events: DataFrame, pages: DataFrame) -> DataFrame:
    """List entries from events: each names the page of its user, by domain, host or first part of the path."""
    url = F.col("url")
    labels = F.split(host_of(url), r"\.")
    pattern = (
        F.when(F.col("event_id") % 3 == 0, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), "."))
        .when(F.col("event_id") % 3 == 1, host_of(url))
        .otherwise(F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(path_parts(url), 1, 1), "/")))
    )
    return events.join(pages.select(F.col("page_id").alias("user_id"), "url"), "user_id").select(
        F.concat(F.lit("list"), (F.col("event_id") % 4).cast("string")).alias("list_name"),
        F.when(F.col("event_id") % 4 == 3, F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
        pattern.alias("pattern"), F.when(F.col("event_type") == "error", F.lit("add")).otherwise(
            F.when(F.col("event_id") % 2 == 0, F.lit("remove")).otherwise(F.lit("add"))).alias("action"),
        F.col("ts").cast("timestamp_ntz").alias("dated"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return evaluate(captures_of(pages), entries_of(table(spark, sf_dir, "events"), pages))


OP2_SQL = r"""
WITH p AS (
    SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 7919) % 2592000) AS fetched_at,
           regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
           list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts
    FROM pages
), e AS (
    SELECT 'list' || (event_id % 4) AS list_name, CASE WHEN event_id % 4 = 3 THEN 'allow' ELSE 'block' END AS verdict,
           CASE WHEN event_id % 3 = 0 THEN array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - 2, 1):], '.')
                WHEN event_id % 3 = 1 THEN host ELSE host || '/' || coalesce(parts[1], '') END AS pattern,
           event_type <> 'error' AND event_id % 2 = 0 AS removed, ts AS dated
    FROM events JOIN p ON p.page_id = events.user_id
), i AS (
    SELECT list_name, verdict, pattern, dated AS a, lead(dated) OVER (PARTITION BY list_name, verdict, pattern ORDER BY dated) AS b, removed
    FROM (SELECT list_name, verdict, pattern, dated, bool_or(removed) AS removed FROM e GROUP BY ALL)
), k AS (
    SELECT DISTINCT page_id, url, fetched_at, unnest(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1), lambda n: array_to_string(string_split(host, '.')[n:], '.')),
        list_transform(range(1, len(parts) + 1), lambda n: host || '/' || array_to_string(parts[1:n], '/')))) AS pattern
    FROM p WHERE host <> ''
), m AS (
    SELECT page_id, url, fetched_at, verdict, pattern, list_name,
           row_number() OVER (PARTITION BY page_id, url, fetched_at ORDER BY length(pattern) DESC, verdict = 'block' DESC, verdict DESC, pattern DESC, list_name DESC) AS n
    FROM k JOIN i USING (pattern) WHERE NOT removed AND a <= fetched_at AND (b IS NULL OR fetched_at < b)
)
SELECT p.page_id, p.url, p.fetched_at, coalesce(m.verdict, 'none') AS verdict, m.pattern, m.list_name
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.url = p.url AND m.fetched_at = p.fetched_at AND m.n = 1
"""
