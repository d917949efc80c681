"""Allow and block rules for URLs, matched by an equi-join on short hash prefixes."""

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace
from .names import shielded

ALLOW, BLOCK = "allow", "block"
PREFIX_HEX = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_HEX), 16, 10).cast("long")


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (``host``, ``path``, ``verdict``) with their digests; incomplete rules are left out.

    Of rules with the same host and path, block wins over allow.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"])
    digest = _digest(F.col("host"), F.col("path"))
    return rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("path_length"),
        digest.alias("digest"),
        _short(digest).alias("short"),
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = ALLOW,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each row's URL.

    A rule fits its host and all subdomains if the URL's path starts with the rule's
    path. The longest rule string wins, of equally long ones that with the longer
    host. Without a fitting rule ``rule`` is null and the verdict ``default``.

    Each distinct pair of host and path is expanded into host suffixes and path
    prefixes, in the shapes that the rules have: a stored table of the path lengths for each number
    of labels, joined with the host suffixes, so thousands of shapes make no larger plan.
    The expressions meet the rules by the first 32 bits of their SHA-256; equal
    full digests confirm the match.

    A null URL, or one without ``://``, has an empty host and path and fits no rule
    with a non-empty host. Columns of ``pages`` named like a result column are
    replaced, all others kept. Empty pages or rules are fine; repeated rows are judged
    one by one.
    """
    spark = pages.sparkSession
    workspace = workspace or Workspace(spark)
    ready = workspace.save(prepare_rules(rules), "rules")
    shapes = workspace.save(
        ready.groupBy("labels").agg(F.collect_set("path_length").alias("lengths")), "shapes"
    )

    rows, names = shielded(pages)
    kept = {new: c for c, new in names.items() if c not in ("host", "path", "rule", "verdict")}
    own = [F.col(new).alias(c) for new, c in kept.items()]
    url = rows[names[url_col]]
    parsed = rows.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))

    sites = parsed.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    counted = sites.select(
        "host", "path", parts.alias("parts"), F.explode(F.sequence(F.lit(1), F.size(parts))).alias("labels")
    )
    suffix = F.array_join(F.expr("slice(parts, -labels, labels)"), ".")
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    expanded = counted.join(shapes, "labels").select(
        "host", "path", suffix.alias("e_host"), F.explode(prefixes).alias("e_path")
    )
    digest = _digest(F.col("e_host"), F.col("e_path"))
    candidates = expanded.select(
        "host", "path", F.length("e_host").alias("host_length"), digest.alias("found")
    ).withColumn("short", _short(F.col("found")))
    confirmed = candidates.join(ready, "short").filter(F.col("found") == F.col("digest"))
    best = F.max(F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict"))
    decided = confirmed.groupBy("host", "path").agg(best.alias("best"))
    # A third of the pages may have one host and path: adaptive execution splits that join.
    return parsed.join(decided, ["host", "path"], "left").select(
        *own,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
