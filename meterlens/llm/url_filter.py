"""URL filter by a Bloom filter cascade: DataFrame functions only.

A cascade holds a set of listed keys exactly, for every key of a known
universe.  Level 1 is a Bloom filter of the listed keys; level 2 one of the
universe keys that level 1 takes for listed; level 3 one of the listed keys
that level 2 takes for unlisted; and so on until no false positive is left.
A key is listed if the first level that lacks it has an even number (or if all
of an odd number of levels have it).  The universe is every key that the
corpus's urls can ask for, so the answer is exact, and asking needs no join:
the levels are literals inside the expression.

Level 1's size follows the list; the others hold false positives, whose number
follows the universe.  Every level is counted before it is built: where the
list or a level has more than ``MAX_LISTED`` keys, none is made a literal and
the answer comes by joins (``left_semi`` on the distinct keys), exact too.

Rules are (host, path, verdict) with ``key`` = host + path.  A url's candidate
keys are the suffixes of its host (as many labels as the longest listed host)
joined with the prefixes of its path (of the lengths that the rules have);
the longest listed candidate is the rule.  A second cascade tells the blocking
keys (rules and blocked hosts) from all others; a url without a rule is blocked
if its host or a parent domain is a blocked host, and allowed otherwise.

Cases: a null url or one without ``://`` has empty host and path and fits no
rule; repeated rows give repeated results; hosts keep ports and user names as
written; extra columns are ignored; an empty table gives an empty result; equal
candidate lengths prefer the longer host.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_KEY, LEAST_BITS, HASHES, MAX_LISTED = 10, 1024, 4, 400_000

# The rules and the blocked hosts of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
BLOCKED_HOSTS = ["spam-farm.example.org"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_suffixes(host: Column, labels: int) -> Column:
    """The last 1 to ``labels`` labels of the host, longest first."""
    parts = F.split(host, r"\.")
    n = F.least(F.size(parts), F.lit(labels))
    return F.transform(F.sequence(n, F.lit(1), F.lit(-1)),
                       lambda i: F.array_join(F.slice(parts, -i, i), "."))


class Level:
    """One Bloom filter: ``bits`` positions as 64-bit words."""

    def __init__(self, keys: DataFrame, count: int, salt: int) -> None:
        self.salt, self.bits = salt, max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, count) * BITS_PER_KEY)))
        at = keys.select(F.explode(F.array(*[self._position(F.col("key"), i) for i in range(HASHES)])).alias("p"))
        words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b"))
        found = {r["w"]: r["b"] for r in words.collect()}  # bits / 64 words at most: cascade() bounds the count
        self.words = [found.get(w, 0) for w in range(self.bits // 64)]

    def _position(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.salt * HASHES + i)), F.lit(self.bits))

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one literal

        def bit(p: Column) -> Column:
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            return F.call_function("getbit", word, (p % 64).cast("int")) == 1

        out = bit(self._position(key, 0))
        for i in range(1, HASHES):
            out = out & bit(self._position(key, i))
        return out


def cascade(listed: DataFrame, universe: DataFrame) -> Callable[[Column], Column] | None:
    """Exact membership in ``listed`` (column ``key``) for keys of ``universe``;
    None if the list or a level is too long for literals (see ``MAX_LISTED``)."""
    listed = listed.select("key").filter("key IS NOT NULL").distinct()
    n = listed.count()
    if n > MAX_LISTED:
        return None
    if not n:
        return lambda key: F.lit(False)
    levels = [Level(listed, n, 1)]
    others = universe.select("key").filter(levels[0].has(F.col("key"))).distinct().join(listed, "key", "left_anti")
    inside, outside = listed, others
    while True:
        side = outside if len(levels) % 2 else inside
        n = side.count()
        if not n:
            break
        if n > MAX_LISTED:
            return None
        levels.append(Level(side, n, len(levels) + 1))
        taken = levels[-1].has(F.col("key"))
        if len(levels) % 2:
            outside = outside.filter(taken)
        else:
            inside = inside.filter(taken)

    def member(key: Column) -> Column:
        out = F.lit(len(levels) % 2 == 1)
        for i in range(len(levels) - 1, -1, -1):
            out = F.when(levels[i].has(key), out).otherwise(F.lit(i % 2 == 1))
        return out

    return member


def judge(pages: DataFrame, rules: DataFrame, blocked: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.  ``rules``: host,
    path, verdict; ``blocked``: host."""
    labels = F.size(F.split("host", r"\."))
    shape = rules.agg(F.max(labels), F.collect_set(F.length("path"))).first()
    deepest = max(shape[0] or 1, blocked.agg(F.max(labels)).first()[0] or 1)
    lengths = sorted(shape[1] or [], reverse=True)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    suffixes = host_suffixes(F.col("host"), deepest)
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
                        if lengths else F.array().cast("array<string>"), lambda p: p.isNotNull())
    urls = urls.withColumn("_hosts", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(suffixes))
    asked = F.flatten(F.transform("_hosts", lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    urls = urls.withColumn("_asked", asked)
    rule_keys = rules.select(F.concat("host", "path").alias("key"), "verdict")
    blocking = rule_keys.filter("verdict = 'block'").select("key").unionByName(
        blocked.select(F.concat(F.lit("//"), F.col("host")).alias("key")))
    hosts = urls.select(F.explode("_hosts").alias("h")).distinct().select(F.concat(F.lit("//"), F.col("h")).alias("key"))
    is_rule = cascade(rule_keys, urls.select(F.explode("_asked").alias("key")).distinct())
    blocks = cascade(blocking, hosts.unionByName(rule_keys.select("key")))
    if is_rule is None or blocks is None:
        return _judge_by_joins(urls, rule_keys, blocking)
    fits = F.filter("_asked", is_rule)
    longest = F.array_max(F.transform(fits, lambda k: F.length(k)))
    rule = F.element_at(F.filter(fits, lambda k: F.length(k) == longest), 1)
    out = urls.withColumn("rule", F.when(F.size(fits) > 0, rule))
    block = F.when(F.col("rule").isNotNull(), blocks(F.col("rule"))).otherwise(
        F.exists("_hosts", lambda h: blocks(F.concat(F.lit("//"), h))))
    return out.select("page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"))


def _judge_by_joins(urls: DataFrame, rule_keys: DataFrame, blocking: DataFrame) -> DataFrame:
    """The same answer for lists beyond ``MAX_LISTED``: distinct (host, path)
    pairs ask by semi-join, and the pairs' answers go back by join."""
    pairs = urls.select("host", "path", "_hosts", "_asked").distinct()
    listed = rule_keys.select("key").distinct()
    fits = pairs.select("host", "path", F.explode("_asked").alias("key")).join(listed, "key", "left_semi")
    host_length = F.instr(F.concat("key", F.lit("/")), "/")  # of equal lengths the longer host, also of a key without a path
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("key"), host_length, F.col("key").alias("key")))["key"].alias("rule"))
    asked = pairs.join(best, ["host", "path"], "left").select(
        "host", "path", "rule", F.explode_outer(F.when(F.col("rule").isNotNull(), F.array("rule")).otherwise(
            F.transform("_hosts", lambda h: F.concat(F.lit("//"), h)))).alias("key"))
    hit = asked.join(blocking.distinct().withColumn("_b", F.lit(1)), "key", "left").groupBy("host", "path").agg(
        F.first("rule").alias("rule"), F.max("_b").alias("_b"))
    return urls.select("page_id", "host", "path").join(hit, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.when(F.col("_b") == 1, "block").otherwise("allow").alias("verdict"))
