"""Allow and block rules for URLs by a range join over reversed-host keys; built-in functions only.

A rule is a host and a path prefix. Its key is the host's labels in reverse, then a separator, then
the path; every URL of that very host under that path has a key in the interval of keys that begin
with the rule's. Intervals of rules are nested or apart. A URL asks at the key of its host and of
each parent domain, that is a handful of keys.

The sweep: interval starts and ends and the asked keys are sorted by key, range-partitioned. A start
puts its rule on top of the stack of active rules, an end uncovers the rule around it; which one that
is, is worked out beforehand among the rules. So every asked key carries the last state before it,
and the state before a partition's first row comes from the partitions before it. Of the answers for
a URL's keys the longest rule wins.

Equal URLs are judged once; so a host with a third of all rows is spread over partitions by path, and
a URL with a third of all rows is one row here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, ascii_lower, partitions_for

# Rules (fixed values): verdict, host, path prefix.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

#: Between host and path in a key; sorts before every character of a label.
_END_OF_HOST = "\x01"
#: Sorts after every character that follows a rule's key.
_AFTER_ALL = "\U0010ffff"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null and for text without ``://``."""
    after = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.substring_index(F.substring_index(F.substring_index(after, "/", 1), "?", 1), "#", 1)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return ascii_lower(host), path


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path, rule (host and path as one text), key; the first of equal rules holds."""
    rows = spark.createDataFrame([(k, *rule) for k, rule in enumerate(rules)], "place long, verdict string, host string, path string")
    rows = rows.withColumn("host", ascii_lower(F.col("host")))
    first = rows.groupBy("host", "path").agg(F.min_by("verdict", "place").alias("verdict"))
    return first.withColumns(
        {"rule": F.concat("host", "path"), "key": F.concat(_reversed_host(F.col("host")), F.lit(_END_OF_HOST), F.col("path"))}
    )


def interval_events(rules: DataFrame) -> DataFrame:
    """key, order, state: the active rule from each interval start and end on (null: none).

    The rule around a rule is the longest one whose key is a proper prefix; it is found by an equal
    join on all prefixes of each key, not by comparing rules with each other.
    """
    state = F.struct("rule", "verdict")
    prefixes = F.transform(F.sequence(F.lit(1), F.length("key") - 1), lambda n: F.substring(F.col("key"), F.lit(1), n))
    inner = rules.select("key", F.explode(prefixes).alias("outer_key"))
    outer = rules.select(F.col("key").alias("outer_key"), state.alias("outer_state"))
    around = inner.join(outer, "outer_key").groupBy("key").agg(F.max_by("outer_state", F.length("outer_key")).alias("outer_state"))
    starts = rules.select("key", F.lit(1).alias("order"), F.lit(0).alias("depth"), state.alias("state"))
    # Of ends at one key the outermost rule's counts, and it comes last.
    ends = rules.join(around, "key", "left").select(
        F.concat("key", F.lit(_AFTER_ALL)).alias("key"), F.lit(0).alias("order"), (-F.length("key")).alias("depth"), F.col("outer_state").alias("state")
    )
    return starts.unionByName(ends)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, id_column: str = "page_id") -> DataFrame:
    """One row per row of ``pages``: the id, host, path, rule (null if none fits), verdict.

    pages: an id, url; other columns are ignored. A URL that no rule fits is allowed if it has a host
    and blocked if not (null, no ``://``, empty host). Repeated rows are repeated in the result.
    """
    space = Workspace(pages.sparkSession, "url-filter")
    host, path = url_parts(F.col("url"))
    judged = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    urls = judged.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    rules = RULES if rules is None else rules
    # A host is asked with as many labels as rules have; so work grows with the labels, not with their square.
    counts = F.array(*[F.lit(n) for n in sorted({rule[1].count(".") + 1 for rule in rules}) or [1]])
    parents = F.transform(
        F.filter(counts, lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(F.reverse(labels), 1, n), "."),
    )
    asked = urls.where(F.col("host") != "").select("host", "path", F.explode(parents).alias("reversed"))
    asked = asked.select(
        F.concat("reversed", F.lit(_END_OF_HOST), "path").alias("key"),
        F.lit(2).alias("order"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("struct<rule:string,verdict:string>").alias("state"),
        "host",
        "path",
    )
    table = rule_table(pages.sparkSession, rules)
    events = interval_events(table).withColumns({"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string")})
    both = asked.unionByName(events)
    parts = both.repartitionByRange(partitions_for(judged), "key", "order", "depth", "host").withColumn("part", F.spark_partition_id())
    parts = space.store(parts, "sorted")
    is_event = F.col("order") < 2
    # The state is wrapped, so that an event with no active rule is told from no event.
    change = F.when(is_event, F.struct(F.col("state").alias("active")))
    spot = F.struct("key", "order", "depth")
    last = parts.where(is_event).groupBy("part").agg(F.max_by(F.struct(F.col("state").alias("active")), spot).alias("change"))
    numbers = parts.select("part").distinct().join(last, "part", "left")  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.select("part", F.last("change", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "order", "depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = parts.join(carried, "part").withColumn("now", F.coalesce(F.last(change, ignorenulls=True).over(sweep), F.col("carried")))
    answers = states.where(~is_event & F.col("now.active").isNotNull()).select("host", "path", "now.active.rule", "now.active.verdict")
    longest = answers.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    )
    result = judged.join(longest, ["host", "path"], "left")
    default = F.when(F.col("host") == "", "block").otherwise("allow")
    return result.select(
        id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), default).alias("verdict")
    )
