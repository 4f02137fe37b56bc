"""URL filter: host-suffix and path-prefix expressions against a rule list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ROW, lower_ascii, numbered, small

PREFIX_DIGITS = 8  # hex digits of the short hash
SALTS = 16  # parts per expression when the rules are too many to broadcast
RULE_BYTES = 400  # of a rule as broadcast: hashes, text, action


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for NULL."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per expression: digest, short prefix, shape, text and action.

    Rules with a NULL, or whose path could begin no URL path, fit nothing and
    are left out.  Of the same expression given twice, ``block`` wins.
    """
    host, path = lower_ascii(F.col("host")), F.col("path")
    rules = (
        rules.select(host.alias("host"), path.alias("path"), F.lower("action").alias("action"))
        .filter(F.col("host").isNotNull() & F.col("action").isNotNull())
        .filter((F.col("path") == "") | F.col("path").startswith("/"))
        .filter(~F.col("host").rlike("[/?#]"))
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))  # 'block' sorts after 'allow'
    )
    rule = F.concat("host", "path")
    digest = F.sha2(rule, 256)
    return rules.select(
        rule.alias("rule"),
        "action",
        F.length("host").alias("host_length"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("path_length"),
        digest.alias("digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
    )


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Array of the host suffixes and path prefixes that a rule of these shapes could equal.

    Only label counts and path lengths found among the rules are expanded, so a
    host of very many labels or a very long path yields no more than the rules ask for.
    """
    labels, length = F.size(F.split(host, r"\.")), F.length(path)
    made = [
        F.when(
            (labels >= count) & (length >= size),
            F.concat(F.substring_index(host, ".", -count), F.substring(path, 1, size)),
        )
        for count, size in shapes
    ]
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<string>")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    broadcast: bool | None = None,
) -> DataFrame:
    """One row per page: id, host, path, the rule that decides (or NULL) and the verdict.

    ``rules`` has columns host, path and action (``allow`` or ``block``).  A rule
    fits its host and all subdomains when the URL's path starts with the rule's
    path.  The longest fitting rule wins; at equal length the longer host, then
    ``block``.  A URL that no rule fits gets ``default``.  A NULL or malformed
    URL has an empty host and path.  Repeated rows are judged one by one, an
    empty table gives an empty result, further columns are ignored.

    The rules are broadcast when their measured size allows; otherwise both
    sides are shuffled by short hash, with every rule repeated over some salts,
    so that an expression shared by a third of the URLs is spread.
    ``broadcast`` overrides the measurement (for tests).
    """
    rules = prepare_rules(rules)
    shapes = sorted((r.labels, r.path_length) for r in rules.select("labels", "path_length").distinct().collect())
    host, path = split_url(F.col("__url"))
    named = pages.select(F.col(page_id).alias("__id"), F.col(url).alias("__url"))
    parts = numbered(named, "__id", "__url").select(ROW, "__id", host.alias("__host"), path.alias("__path"))
    made = expressions(F.col("__host"), F.col("__path"), shapes)
    spread = parts.select(ROW, "__id", "__host", "__path", F.explode_outer(made).alias("expression"))
    digest = F.sha2("expression", 256)
    spread = spread.withColumn("own_digest", digest).withColumn(
        "own_prefix", F.substring(F.col("own_digest"), 1, PREFIX_DIGITS)
    )
    rules = rules.select("rule", "action", "host_length", "digest", "prefix")
    fits = (F.col("own_prefix") == F.col("prefix")) & (F.col("own_digest") == F.col("digest"))
    if small(rules, RULE_BYTES) if broadcast is None else broadcast:
        rules = F.broadcast(rules)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        rules = rules.withColumn("salt", salts)
        spread = spread.withColumn("own_salt", F.pmod(F.xxhash64(ROW), F.lit(SALTS)).cast("int"))
        fits = fits & (F.col("own_salt") == F.col("salt"))
    order = F.struct(
        F.length("rule").alias("size"), "host_length", F.col("action").alias("action"), F.col("rule").alias("rule")
    )
    best = (
        spread.join(rules, fits, "left")
        .groupBy(ROW, "__id", "__host", "__path")
        .agg(F.max(F.when(F.col("rule").isNotNull(), order)).alias("best"))
    )
    return best.select(
        F.col("__id").alias("page_id"),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
