"""URL filters: host-suffix and path-prefix expressions, matched by short hash prefixes.

Every URL is expanded into the expressions a rule could be written as: each suffix of its
host at a label boundary, with each prefix of its path that ends at a slash. Expressions
and rules meet in an equi-join on the first 32 bits of their SHA-256 digests; the full
digest then confirms the match, and of the rules that fit the longest one wins.

The work is done once per distinct host and path. Expressions are made only as deep as the
deepest rule, so a URL of a thousand slashes makes no more than any other. A rule for a top
level domain may fit a third of all URLs; its join key is salted: URLs are dealt over
``SALT`` copies of the rules.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm.frames import lower_ascii, without

# Copies of each rule, among which the URLs of a popular host are dealt out.
SALT = 16

ADDED = ("host", "path", "rule", "verdict")


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules ``(action, "host/path/")`` as a frame of host, path and action."""
    rows = []
    for action, rule in rules:
        host, slash, rest = rule.partition("/")
        rows.append((host, slash + rest, action))
    return spark.createDataFrame(rows, "host string, path string, action string")


def host_of(url: Column) -> Column:
    """Lower-cased text between ``://`` and the next ``/``, ``?`` or ``#``; else empty."""
    return lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Text from the end of the host up to ``?`` or ``#``; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALT)).cast("int")


def _checked(rules: DataFrame) -> DataFrame:
    """Rules with a host and a path of whole segments; one action per rule, block first."""
    whole = (F.length("host") > 0) & F.col("path").rlike("^/(.*/)?$") & F.col("action").isin("allow", "block")
    fault = F.raise_error(F.concat_ws(" ", F.lit("not a rule of host, path of whole segments, action:"), "host", "path", "action"))
    checked = rules.select(
        lower_ascii(F.when(F.coalesce(whole, F.lit(False)), F.col("host")).otherwise(fault)).alias("host"),
        "path",
        "action",
    )
    return checked.groupBy("host", "path").agg(F.max("action").alias("action"))


def match(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each distinct ``host`` and ``path``; none, no row."""
    rules = _checked(rules)
    # How deep expressions must go: two numbers.
    deepest = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.max(F.size(F.split("path", "/")) - 1).alias("slashes"),
    ).first()
    labels, slashes = deepest.labels or 0, deepest.slashes or 0
    keyed = rules.select(
        "action",
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("__host_length"),
        _digest(F.col("host"), F.col("path")).alias("__rule_digest"),
        F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("__salt"),
    ).withColumn("__short", _short(F.col("__rule_digest")))

    parts, steps = F.split("host", r"\."), F.split("path", "/")
    n_hosts = F.least(F.size(parts), F.lit(labels))
    n_paths = F.least(F.size(steps) - 1, F.lit(slashes))
    suffixes = F.when(n_hosts > 0, F.transform(
        F.sequence(F.lit(1), n_hosts), lambda n: F.array_join(F.slice(parts, -n, n), ".")
    ))
    prefixes = F.when(n_paths > 0, F.transform(
        F.sequence(F.lit(1), n_paths), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))
    ))
    expressions = (
        places.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(suffixes).alias("__suffix"), prefixes.alias("__prefixes"))
        .select("host", "path", "__suffix", F.explode("__prefixes").alias("__prefix"))
        .select("host", "path", _digest(F.col("__suffix"), F.col("__prefix")).alias("__digest"))
        .withColumn("__short", _short(F.col("__digest")))
        .withColumn("__salt", _salt("host", "path"))
    )
    fits = expressions.join(keyed, ["__short", "__salt"]).filter(F.col("__digest") == F.col("__rule_digest"))
    rank = F.struct(F.length("rule").alias("length"), F.col("__host_length").alias("of_host"), "rule", "action")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("__best"))
    return best.select("host", "path", F.col("__best.rule").alias("rule"), F.col("__best.action").alias("action"))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (the winner's ``host/path``, null if none fits) and
    ``verdict`` (its action, else ``default``) to every row.

    A rule fits its host and all subdomains of it, if the path starts with the rule's,
    which must begin and end with a slash; another rule fails the query. A URL without
    ``://``, or a null one, has an empty host and path and fits no rule. Repeated rows stay
    as they are. Columns of the input named as one of the four are replaced.
    """
    placed = urls.select(*without(urls, ADDED), host_of(urls[url]).alias("host"), path_of(urls[url]).alias("path"))
    won = match(placed, rules).withColumnRenamed("action", "__action")
    judged = placed.join(won, ["host", "path"], "left")
    return judged.select(
        *without(placed, ("host", "path")),
        placed["host"],
        placed["path"],
        "rule",
        F.coalesce("__action", F.lit(default)).alias("verdict"),
    )
