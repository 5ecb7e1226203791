"""URL filters as sort-merge range joins, in DataFrame functions alone.

A rule (host, path) covers its host, the subdomains and every path that starts with its
path.  With the labels of a host reversed, a rule's host is a prefix of the hosts it covers,
and its path prefix is an interval of the sorted paths below that host.  For each number of
labels that rules have, urls and rules meet at the canonical key (those labels, path): both
are sorted by it, and one sweep keeps a stack of the rules that are open, a slot per depth
of nesting.  The innermost open rule is the longest of that host; of the hosts' answers the
longest rule wins, and of equally long ones the one with the longer host.

Host, path and salts split the work: a rule is repeated for each of ``salts`` parts, so that
urls of one hot host are swept in that many groups, each streamed through a window.

Defined results: a null url or one without ``://`` has an empty host and path and no rule.
Rules that repeat count once; of rules with equal host and path, block wins.  A url table
without rows gives none, and without rules every url gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: after every string that starts with a prefix
LAST = "\U0010ffff"
SALTS = 64
#: (host, path, verdict) of the registered query
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rules_frame(spark, rules=RULES) -> DataFrame:
    """A table ``host, path, verdict`` of a few rules; a large list is read from a table instead."""
    if not rules:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    rows = ", ".join("(" + ", ".join(f":r{i}_{j}" for j in range(3)) + ")" for i in range(len(rules)))
    args = {f"r{i}_{j}": v for i, r in enumerate(rules) for j, v in enumerate(r)}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, verdict)", args=args)


def canonical(host: Column, labels: int) -> Column:
    """The last ``labels`` labels of the host in reverse, each closed by a dot; null if it has fewer."""
    parts = F.split(host, r"\.")
    own = F.reverse(F.slice(parts, -labels, labels))
    return F.when(F.size(parts) >= labels, F.concat(F.array_join(own, "."), F.lit(".")))


def nested(rules: DataFrame) -> DataFrame:
    """Distinct rules with the number of labels and their depth among the rules of the host."""
    once = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(
        F.when(F.max((F.col("verdict") == "block").cast("int")) == 1, F.lit("block")).otherwise(F.min("verdict")).alias("verdict"))
    event = F.explode(F.array(
        F.struct(F.col("path").alias("at"), F.lit(1).alias("open")),
        F.struct(F.concat("path", F.lit(LAST)).alias("at"), F.lit(-1).alias("open"))))
    events = once.withColumn("_e", event)
    sweep = Window.partitionBy("host").orderBy("_e.at", F.col("_e.open").desc())
    depth = F.sum("_e.open").over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    return (
        events.withColumn("depth", depth).where("_e.open = 1").drop("_e")
        .withColumn("labels", F.size(F.split("host", r"\."))).withColumn("rule", F.concat("host", "path"))
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int = SALTS) -> DataFrame:
    """Adds ``host, path, rule, verdict``; columns of these names are replaced.

    The label counts and the deepest nesting of the rules shape the plan and are looked up
    first: at most one small row per label count.
    """
    new = ["host", "path", "rule", "verdict"]
    ruled = nested(rules)
    shape = ruled.groupBy("labels").agg(F.max("depth").alias("depth")).orderBy("labels").collect()
    if len(shape) > 127:
        raise ValueError("a rule's host has more labels than a host name may have")
    rows = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("_row"), host_of(F.col(f"`{url}`")).alias("_host"),
        path_of(F.col(f"`{url}`")).alias("_path"), F.lit(None).cast("struct<rule:string,verdict:string,host:string>").alias("_best"),
    )
    for level in shape:
        rows = _sweep(rows, ruled, level["labels"], level["depth"], salts)
    kept = [F.col("_row")[c].alias(c) for c in urls.columns if c not in new]
    return rows.select(
        *kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def _sweep(rows: DataFrame, ruled: DataFrame, labels: int, depth: int, salts: int) -> DataFrame:
    """Replaces ``_best`` where a rule with so many labels fits and is longer."""
    columns = rows.columns
    points = rows.withColumns({
        "_at": canonical(F.col("_host"), labels), "_salt": F.pmod(F.xxhash64("_row", F.spark_partition_id()), F.lit(salts)).cast("int"),
        "_key": F.col("_path"), "_point": F.lit(1)})
    opened = ruled.where(F.col("labels") == labels).select(
        canonical(F.col("host"), labels).alias("_at"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        F.col("path").alias("_key"), F.lit(0).alias("_point"), F.col("depth").cast("int").alias("_depth"),
        F.struct("path", "rule", "verdict", "host").alias("_rule"))
    order = Window.partitionBy("_at", "_salt").orderBy("_key", "_point").rowsBetween(Window.unboundedPreceding, 0)
    swept = points.unionByName(opened, allowMissingColumns=True).withColumns({
        f"_slot{d}": F.last(F.when(F.col("_depth") == d, F.col("_rule")), ignorenulls=True).over(order)
        for d in range(1, depth + 1)})
    slots = [F.col(f"_slot{d}") for d in range(depth, 0, -1)]
    # a slot is still open if its interval holds the key
    top = F.coalesce(*[F.when(F.startswith(F.col("_key"), s["path"]), s.dropFields("path")) for s in slots])
    found = swept.where("_point = 1").withColumn("_new", top)

    def rank(rule):
        return F.struct(F.length(rule["rule"]), F.length(rule["host"]))

    longer = F.col("_new").isNotNull() & (F.col("_best").isNull() | (rank(F.col("_new")) > rank(F.col("_best"))))
    best = F.when(longer, F.col("_new")).otherwise(F.col("_best"))
    return found.withColumn("_best", best).select(*columns)


def oracle(rules=RULES, default: str = "allow") -> str:
    """DuckDB SQL for ``judge`` over ``pages``."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH rules(h, p, v) AS (VALUES {values}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path FROM pages),
k AS (SELECT DISTINCT host, path FROM u),
fit AS (SELECT host, path, h || p AS rule, v FROM k JOIN rules
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, length(h) DESC) = 1)
SELECT page_id, u.host, u.path, rule, coalesce(v, '{default}') AS verdict
FROM u LEFT JOIN fit ON fit.host = u.host AND fit.path = u.path"""
