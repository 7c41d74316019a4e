"""URL filters: path rules, then exact host membership by a cascade of Bloom filters."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import drop_table, materialise

#: Verdict and host-and-path prefix.
RULES = [
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
]
#: Domains blocked with all their subdomains: names of unwanted hosts under each of three domains.
LISTED = [
    f"{name}.{domain}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for domain in ("example.com", "example.net", "example.org")
]
HASHES = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ://, A-Z lower-cased; path up to ? or #. Both empty for null and without ://."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.regexp_extract(url, PARTS, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. rules is a short list: it becomes one CASE."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def domains_of(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )


def positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(1000 * level + n), key), F.lit(bits)) for n in range(HASHES)]


class Cascade:
    """Levels of Bloom filters; for every key of the universe it was built over, the answer is exact.

    A level is (number of bits, a table of one row that holds them 64 to a word). The tables stay tables: each reaches
    the tasks as the value of a scalar subquery, so neither the driver's Python nor the plan's text holds them.
    """

    def __init__(self, levels: list[tuple[int, DataFrame]]):
        self.levels = levels

    def passes(self, key: Column, level: int) -> Column:
        words = self.levels[level][1].scalar()
        one = lambda p: F.get(words, F.floor(p / 64).cast("int"))
        set_bits = [F.getbit(one(p), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in positions(key, level, self.levels[level][0])]
        return reduce(lambda a, b: a & b, set_bits)

    def contains(self, key: Column) -> Column:
        """The first level that a key fails decides: odd levels hold listed keys, even ones false positives."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            verdict = F.when(~self.passes(key, level), F.lit(level % 2 == 1)).otherwise(verdict)
        return verdict


def bit_table(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the words of a Bloom filter over the column key."""
    at = keys.select(F.explode(F.array(*positions(F.col("key"), level, bits))).alias("p"))
    at = at.select(F.floor(F.col("p") / 64).alias("n"), F.expr("shiftleft(1L, CAST(pmod(p, 64) AS int))").alias("w"))
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("n"), F.lit(0).cast("long").alias("w"))
    words = at.unionByName(empty).groupBy("n").agg(F.bit_or("w").alias("w"))
    listed = F.array_sort(F.collect_list(F.struct("n", "w")))
    return materialise(words.agg(F.transform(listed, lambda x: x["w"]).alias("words")), "bits")


def build_cascade(universe: DataFrame) -> Cascade:
    """Cascade over a table of distinct (key, listed).

    Level 1 encodes the listed keys, with so many bits that about as few other keys pass as there are
    listed ones; each later level encodes the keys that the level before it got wrong, until none is.
    All levels together take about 8 bits a listed key and doubling of the other keys, of keys that the universe has: a
    million listed keys take about a megabyte, which driver and executors hold once.
    """
    left = universe
    levels: list[tuple[int, DataFrame]] = []
    while True:
        odd = len(levels) % 2 == 0  # this level holds listed keys
        yes, no = left.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
        n, m = (yes, no) if odd else (no, yes)
        if not n:
            return Cascade(levels)
        held, other = (left.where("listed"), left.where("not listed")) if odd else (left.where("not listed"), left.where("listed"))
        rate = min(0.5, max(1e-6, 0.7 * n / m if m else 0.5))
        bits = 64 * math.ceil(max(64, n * HASHES / -math.log(1 - rate ** (1 / HASHES))) / 64)
        level = len(levels)
        levels.append((bits, bit_table(held, level, bits)))
        # Keys of the other kind that pass are wrong so far; those of this kind are judged by what follows.
        wrong = other.where(Cascade(levels).passes(F.col("key"), level))
        after = materialise(held.unionByName(wrong), "cascade")
        if left is not universe:
            drop_table(left)
        left = after


def judge_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: list[tuple[str, str]] = RULES,
    listed: list[str] | DataFrame = LISTED,
) -> DataFrame:
    """Judge every url: (id, host, path, rule, verdict).

    The longest rule that fits decides. Elsewhere a url is blocked if its host or a parent domain of it
    is listed, else allowed. Membership comes from a Bloom filter cascade built over all host names of the table, whose
    listed keys are the hosts that are listed themselves or by a parent domain: it is exact for each of them and needs no
    join with the pages.

    listed: domains, or a table whose first column holds them. Null urls and urls without :// have
    empty host and path, fit no rule and are allowed. Repeated rows and ids are judged each; an empty
    table gives no rows; other columns are not read. A host name of n labels has n parent domains, so a very long
    one takes memory in proportion to the square of its length.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    if isinstance(listed, list):
        names = spark.range(1).select(F.explode(F.array(*map(F.lit, listed)).cast("array<string>")).alias("key"))
    else:
        names = listed.select(F.col(f"`{listed.columns[0]}`").alias("key"))
    hosts = rows.select("host").distinct()
    bad = hosts.select("host", F.explode(domains_of(F.col("host"))).alias("key")).join(names, "key", "left_semi")
    bad = bad.select("host").distinct().withColumn("listed", F.lit(True))
    universe = materialise(
        hosts.join(bad, "host", "left").select(F.col("host").alias("key"), F.coalesce("listed", F.lit(False)).alias("listed")), "hosts"
    )
    blocked = build_cascade(universe).contains(F.col("host"))
    drop_table(universe)
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(blocked, "block").otherwise("allow")
    return rows.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"))


ORACLE_SQL = f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path
  FROM pages
), rules(verdict, rule, domain, start) AS (
  VALUES {", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)}
), listed(domain) AS (VALUES {", ".join(f"('{x}')" for x in LISTED)}),
fit AS (
  SELECT u.page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule,
         arg_max(r.verdict, length(r.rule)) AS said
  FROM u LEFT JOIN rules r
    ON (u.host = r.domain OR ends_with(u.host, '.' || r.domain)) AND starts_with(u.path, r.start)
  GROUP BY ALL
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN EXISTS (SELECT 1 FROM listed l
                                        WHERE fit.host = l.domain OR ends_with(fit.host, '.' || l.domain))
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM fit
"""
