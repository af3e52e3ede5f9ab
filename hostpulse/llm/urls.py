"""URL filters: host-suffix and path-prefix expressions, joined with the rules on short hash prefixes.

A URL is cut into host and path. Each distinct pair of them expands into every host suffix combined with every
prefix of the path whose length some rule has; these expressions meet the rules on the first 32 bits of their
digest, and only equal full digests count. Of the rules that fit, the longest wins; of two equally long ones,
which fit only if their text is the same, `allow` wins. Only Spark expressions are used.

Each pair of host and path is judged once, whatever the number of its pages, and equal expressions are joined once.
Rules are broadcast if there are at most `BROADCAST_RULES` of them; beyond that they are joined by a shuffle.

A null URL or one without `://` has an empty host and path, which no rule fits; its verdict is `allow`. Repeated
rows give repeated results; columns besides the id and the URL are ignored. Without rules all verdicts are `allow`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest rule set that is sent to every task: with texts of at most `RULE_CHARS`, some 20 MB.
BROADCAST_RULES = 50_000
RULE_CHARS = 400


def host(url: Column) -> Column:
    """What stands after the first `://`, up to `/`, `?`, `#` or the end, with A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What stands after the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every suffix of the host at a dot with every prefix of the path of one of these lengths."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """The id, host, path, winning rule and verdict of each page. `rules`: host, path, verdict."""
    texts = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.concat("host", "path").alias("rule"),
        F.length("path").alias("path_length"),
        F.col("verdict").alias("rule_verdict"),
    )
    listed = texts.groupBy("rule").agg(
        F.min("rule_verdict").alias("rule_verdict"), F.min("path_length").alias("path_length")
    )
    # One row for each length of a rule's path, and the size of the rule set.
    sizes = listed.groupBy("path_length").agg(F.count("*").alias("n"), F.max(F.length("rule")).alias("longest")).collect()
    lengths = sorted(row.path_length for row in texts.select("path_length").distinct().collect())
    small = sum(r.n for r in sizes) <= broadcast_rules and max((r.longest for r in sizes), default=0) <= RULE_CHARS
    hashed = listed.select(
        "rule", "rule_verdict", F.sha2("rule", 256).alias("digest"), F.substring(F.sha2("rule", 256), 1, 8).alias("short")
    )
    seen = pages.select(
        F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")
    )
    if not lengths:
        fits = seen.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("v")).limit(0)
    else:
        # Partial aggregation leaves one row for each task and host or expression, however many pages share it.
        places = seen.select("host", "path").distinct()
        expanded = places.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), lengths)).alias("text"))
        keyed = expanded.select(
            "host", "path", F.sha2("text", 256).alias("own"), F.substring(F.sha2("text", 256), 1, 8).alias("own_short")
        )
        if small:
            met = keyed.join(F.broadcast(hashed), F.col("own_short") == F.col("short"))
        else:
            # Equal expressions of many hosts meet a rule once; the rules found go back to their hosts.
            distinct = keyed.select("own", "own_short").distinct()
            hits = distinct.join(hashed, F.col("own_short") == F.col("short"))
            hits = hits.where(F.col("own") == F.col("digest")).select("own", "rule", "rule_verdict", "digest")
            met = keyed.drop("own_short").join(hits, "own")
        fits = (
            met.where(F.col("own") == F.col("digest"))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
            .select("host", "path", "best.rule", F.col("best.rule_verdict").alias("v"))
        )
    return seen.join(fits, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("v", F.lit("allow")).alias("verdict")
    )
