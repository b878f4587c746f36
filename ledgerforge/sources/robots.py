"""Robots rules: parsing and longest-match decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.text import wildcard_pattern
from ledgerforge.sources.shared import at_most

#: The most rules of a site's group; patterns match no key, so they are compared with every path.
SITE_RULES = 10_000


def parse(body: str) -> list[tuple[str, str, bool]]:
    """(agent, pattern, allow) of a robots file; agents in a row share what follows, an empty Disallow says nothing."""
    out, agents, open_ = [], [], False
    for line in body.splitlines():
        field, _, value = line.partition("#")[0].partition(":")
        field, value = field.strip().lower(), value.strip()
        if field == "user-agent":
            agents = [*agents, value.lower()] if open_ else [value.lower()]
            open_ = True
        elif field in ("allow", "disallow"):
            open_ = False
            if value:
                out += [(a, value, field == "allow") for a in agents]
        elif field == "crawl-delay":
            open_ = False
    return out


def crawl_delays(body: str) -> list[tuple[str, float]]:
    """(agent, seconds) of a robots file: of a group the last number that can be read."""
    out, agents, open_ = {}, [], False
    for line in body.splitlines():
        field, _, value = line.partition("#")[0].partition(":")
        field, value = field.strip().lower(), value.strip()
        if field == "user-agent":
            agents = [*agents, value.lower()] if open_ else [value.lower()]
            open_ = True
        elif field in ("allow", "disallow", "crawl-delay"):
            open_ = False
            if field == "crawl-delay":
                try:
                    out.update(dict.fromkeys(agents, float(value)))
                except ValueError:
                    continue
    return list(out.items())


def token(agent: str) -> str:
    """What of an identity counts: the product's name before its version."""
    return agent.split("/", 1)[0].strip().lower()


def delay_for(delays: list[tuple[str, float]], agents: list[str]) -> float | None:
    """The longest delay that any of our identities is asked for, each by its most specific group; null if none is."""
    asked = [max(((len(a) if a != "*" else 0, d) for a, d in delays if a == "*" or a in token(agent)), default=None) for agent in agents]
    return max((x[1] for x in asked if x), default=None)


def allowed_to_all(paths: DataFrame, rules: list[tuple[str, str, bool]], agents: list[str], key: str) -> DataFrame:
    """(key, allowed, by): whether all our identities may read the path (key, path); if not, the first of them that may not."""
    spark = paths.sparkSession
    out = None
    for n, agent in enumerate(agents):
        one = allowed(paths, rules_table(spark, group_for(rules, token(agent))), key).select(key, F.when(~F.col("allowed"), F.struct(F.lit(n).alias("n"), F.lit(agent).alias("agent"))).alias("no"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy(key).agg(F.min("no").alias("no")).select(key, F.col("no").isNull().alias("allowed"), F.col("no.agent").alias("by"))


def group_for(rules: list[tuple[str, str, bool]], agent: str) -> list[tuple[str, bool]]:
    """The rules of the most specific group that names the agent, else those of '*'."""
    names = {a for a, _, _ in rules if a != "*" and a in agent.lower()}
    best = max(names, key=len) if names else "*"
    return [(p, allow) for a, p, allow in rules if a == best]


def rules_table(spark: SparkSession, rules: list[tuple[str, bool]]) -> DataFrame:
    return spark.createDataFrame(rules, "pattern string, allow boolean")


def allowed(paths: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, allowed): by the longest pattern that matches the path; a tie allows, and so does no match. A site's rules are few."""
    if not at_most(rules, SITE_RULES):
        raise ValueError(f"more than {SITE_RULES} rules are no site's")
    dim = F.broadcast(rules.select(wildcard_pattern(F.col("pattern")).alias("__re"), F.length("pattern").alias("__n"), "allow"))
    hits = paths.join(dim, F.regexp("path", F.col("__re")), "left")
    return hits.groupBy(key).agg(F.coalesce(F.max_by("allow", F.struct("__n", "allow")), F.lit(True)).alias("allowed"))
