"""URL filter: rules on host and path, then a blocked Bloom filter before an exact join.

A list of URLs may be as long as the pages are many.  The filter holds one row of 256 bits
per block, so it is a table like any other: Spark sends it to all tasks when its measured
size allows that and joins it by block otherwise.  Only pages that the filter lets through
take part in the exact join with the list, which removes the false hits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii, numbered, staged

BITS_PER_URL = 16        # 256-bit blocks hold 16 URLs on average: about one false hit in 1,000
PROBES = 8               # bits set per URL
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"   # query parameters that do not name a page
PREFIXES = "www|m|blog"  # host prefixes under which a site shows the same pages


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
         Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a common prefix, path without a last slash or ``.html``, telling query parts.

    Null without ``://`` or host.
    """
    host = F.regexp_replace(host_of(url), f"^(?:{PREFIXES})\\.", "")
    path = F.regexp_replace(path_of(url), r"(?:/|\.html)$", "")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(
        f"^(?:{TRACKING})(?:=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does.

    Rules are a written list, at most some hundreds; the first that fits of the rules sorted
    by length is the longest.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
            for r in ordered]
    def first(value) -> Column:
        return F.coalesce(*[F.when(fit, F.lit(value(r))) for fit, r in zip(fits, ordered)],
                          F.lit(None).cast("string"))
    return first(lambda r: r.text), first(lambda r: r.verdict)


def _bits(key: Column) -> Column:
    """The 256-bit pattern of a URL as four longs: eight bits chosen by its hash."""
    spot = F.xxhash64(key, F.lit("bits"))
    at = [F.shiftrightunsigned(spot, 8 * n).bitwiseAND(F.lit(255)) for n in range(PROBES)]
    def word(w: int) -> Column:
        result = F.lit(0).cast("long")
        for a in at:
            mine = F.when(F.shiftrightunsigned(a, 6) == w,
                          F.expr("1L") * F.call_function(
                              "shiftleft", F.expr("1L"), a.bitwiseAND(F.lit(63)).cast("int")))
            result = result.bitwiseOR(F.coalesce(mine, F.lit(0).cast("long")))
        return result
    return F.array(*[word(w) for w in range(4)])


def blocked_bloom(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter: ``block`` and four words; one row per block that has a key."""
    bits = keys.select(F.pmod(F.xxhash64(column), F.lit(blocks)).alias("block"),
                       _bits(F.col(column)).alias("b"))
    return bits.groupBy("block").agg(*[F.bit_or(F.col("b")[w]).alias(f"w{w}") for w in range(4)])


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url",
               list_url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Add host, path, canonical URL, the rule that fits, whether the filter let the page
    through and whether the list has it, and the verdict.

    The verdict is the rule's; without a rule, ``block`` if the canonical URL is that of a
    row of ``listed``, else ``otherwise``.  A null URL or one without ``://`` has an empty
    host and path, is on no list and gets ``otherwise``.  Repeated rows are judged each;
    repeated list entries count once.  Columns of ``pages`` of the same names as the added
    ones are replaced; all others go through.  An empty list blocks nothing.
    """
    keys = staged(listed.select(canonical(F.col(list_url)).alias("on_list"))
                  .where("on_list is not null").distinct())
    blocks = max(1, -(-keys.count() * BITS_PER_URL // 256))
    bloom = staged(blocked_bloom(keys, "on_list", blocks))

    added = ["host", "path", "canonical", "rule", "passed_filter", "listed", "verdict"]
    rows, names = numbered(pages)
    link = F.col(names[url])
    rows = rows.withColumns({"host": host_of(link), "path": path_of(link), "canonical": canonical(link)})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "decided": verdict})
    # a page that a rule decides asks no list; it goes to a block of its own that is empty
    asks = F.col("decided").isNull() & F.col("canonical").isNotNull()
    rows = rows.withColumn("asked", F.when(
        asks, F.pmod(F.xxhash64("canonical"), F.lit(blocks))).otherwise(
        -1 - F.pmod(F.xxhash64(link), F.lit(1 << 20))))
    rows = rows.withColumn("bits", _bits(F.col("canonical")))
    rows = rows.join(bloom, F.col("asked") == F.col("block"), "left")
    hit = F.lit(True)
    for w in range(4):
        need = F.col("bits")[w]
        hit = hit & (F.col(f"w{w}").bitwiseAND(need) == need)
    rows = rows.withColumn("passed_filter", F.coalesce(hit, F.lit(False)))
    # rows that the filter stops keep a key without a partner
    rows = rows.withColumn("wanted", F.when(F.col("passed_filter"), F.col("canonical"))
                           .otherwise(F.concat(F.lit("\t"), F.pmod(F.xxhash64(
                               link, F.col("canonical")), F.lit(1 << 20)).cast("string"))))
    rows = rows.drop("block", "w0", "w1", "w2", "w3", "bits", "asked")
    rows = rows.join(keys, F.col("wanted") == F.col("on_list"), "left")
    is_listed = F.col("on_list").isNotNull()
    rows = rows.withColumns({"listed": is_listed, "verdict": F.coalesce(
        "decided", F.when(is_listed, "block").otherwise(otherwise))})
    return rows.select(*[F.col(n).alias(c) for c, n in names.items() if c not in added], *added)
