"""Operator 11: URL filters. A blocked Bloom filter of the listed canonical URLs passes possible
hits to an exact join, which removes the false positives; host and path rules decide before it.

* The verdict belongs to a URL, so distinct URLs are judged once and the rows look theirs up.
* Rules: a URL's host suffixes meet the rules' hosts, then its path's beginnings of the lengths that
  such a host's rules have meet the rules. Two equi-joins, so a list of millions of rules is
  a table like any other; the longest rule (host and path) wins, then the longer host, then block.
* Filter: a canonical URL has one block of 256 bits, chosen by one hash, and two bits in each of its
  four words, chosen by another. The filter is a table with one row a block, built by `bit_or`
  (combined before the shuffle), and probed by an equi-join on the block: Spark broadcasts it
  if its measured size allows and shuffles both by block if not. Its size follows the list:
  `BITS` bits a listed URL.
* Only possible hits, about one unlisted URL in a thousand, travel as text to the exact join.

Defined cases: a null URL or one without `://` has empty host and path, no canonical form, no rule,
and is allowed; a null in a rule's host, path or verdict, or in a listed URL, drops that rule or entry;
repeated rules and entries count once (equal rules of different verdicts: block); an empty list,
rule table or input is fine; a path shorter than a rule's does not fit it; URLs are read whole,
whatever their length; input columns named like a result are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTPUTS = ("host", "path", "canonical", "rule", "verdict")
#: Bits of the filter for each listed URL; with 8 bits set a URL about one unlisted URL in 1,000 passes.
BITS = 16
WORDS = 4
#: Query parameters that do not change a page (fixed values).
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"
#: URLs without a host are spread over so many values of a second join key.
SPREAD = 4096


def _rest(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for URLs of one page: no scheme, user, default port or fragment, host in lower
    case without `www.` and final dots, path without final slashes and index page, parameters
    sorted and without those that only track. Null without `://`."""
    host = F.regexp_replace(host_of(url), r"^.*@", "")
    host = F.regexp_replace(host, r"\.*(:(80|443)?)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"(/index\.html?)?/*$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.locate("://", url) > 0, F.concat(host, path, asked))


# ------------------------------------------------------------------ rules

def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, rule_verdict) for those of the distinct `urls` (url, host, path) that a rule
    (host, path, verdict) fits."""
    clean = (rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .where("r_host is not null and r_path is not null and r_verdict is not null")
             .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict")))  # block over allow
    most = clean.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 0  # one number
    hosts = clean.groupBy("r_host").agg(F.collect_set(F.char_length("r_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, most)))),
                       lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    near = (urls.withColumn("r_host", F.explode(ends)).join(hosts, "r_host")
            .withColumn("length", F.explode("lengths")).where(F.col("length") <= F.char_length("path"))
            .withColumn("r_path", F.substring(F.col("path"), F.lit(1), F.col("length"))))
    fits = near.join(clean, ["r_host", "r_path"])
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.char_length(rule).alias("n"), F.char_length("r_host").alias("h"),
                          rule.alias("rule"), F.col("r_verdict").alias("v")))
    return fits.groupBy("url").agg(best.alias("b")).select("url", "b.rule", F.col("b.v").alias("rule_verdict"))


# ----------------------------------------------------------------- filter

def _place(key: Column, blocks: int) -> list[Column]:
    """Block and the four 64-bit words of a key's bits."""
    bits = F.xxhash64(key, F.lit(1))
    words = []
    for w in range(WORDS):
        a, b = (F.shiftrightunsigned(bits, s).bitwiseAND(63).cast("int") for s in (12 * w, 12 * w + 6))
        one = F.lit(1).cast("long")
        words.append(F.call_function("shiftleft", one, a).bitwiseOR(F.call_function("shiftleft", one, b)))
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *[c.alias(f"bits{w}") for w, c in enumerate(words)]]


def bloom_blocks(keys: DataFrame, key: str, n: int, bits=BITS) -> tuple[DataFrame, int]:
    """The filter of the `n` distinct values of `key`: rows (block, word0 .. word3) of the blocks
    that hold any, and the number of blocks."""
    blocks = max(1, -(-n * bits // (64 * WORDS)))
    placed = keys.select(*_place(F.col(key), blocks))
    return placed.groupBy("block").agg(*[F.bit_or(f"bits{w}").alias(f"word{w}") for w in range(WORDS)]), blocks


def possible_hits(df: DataFrame, key: str, table: DataFrame, blocks: int) -> DataFrame:
    """Rows of `df` whose `key` the filter passes: all that are in it and a few that are not."""
    held = [F.col(f"bits{w}").bitwiseAND(F.col(f"word{w}")) == F.col(f"bits{w}") for w in range(WORDS)]
    passes = held[0] & held[1] & held[2] & held[3]
    return df.select("*", *_place(F.col(key), blocks)).join(table, "block").where(passes).select(*df.columns)


# ---------------------------------------------------------------- operator

def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, *, url_col="url", bits=BITS) -> DataFrame:
    """`pages` with host, path, canonical, rule and verdict: the verdict of the longest rule that
    fits, else `block` for a URL whose canonical form is that of a URL in `listed` (column url),
    else `allow`."""
    pages = without(pages, OUTPUTS, keep=(url_col,))
    entries = checkpointed(listed.select(canonical(F.col("url")).alias("canonical"))
                           .where("canonical is not null").distinct())
    table, blocks = bloom_blocks(entries, "canonical", entries.count(), bits)
    url = F.col(url_col)
    urls = checkpointed(pages.select(url.alias("url")).where(F.locate("://", url) > 0).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    ruled = match_rules(urls, rules)
    asked = urls.join(ruled, "url", "left_anti").select("url", canonical(F.col("url")).alias("canonical"))
    hits = possible_hits(asked, "canonical", table, blocks).join(entries, "canonical", "left_semi")
    judged = ruled.unionByName(hits.select("url", F.lit(None).cast("string").alias("rule"),
                                           F.lit("block").alias("rule_verdict")))
    judged = judged.select(F.col("url").alias("__url"), "rule", "rule_verdict", F.lit(0).alias("__s"))
    # URLs without a host match nothing; a spread second key keeps them out of one partition
    spread = F.when(F.locate("://", url) > 0, 0).otherwise(
        F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int") + 1)
    rows = pages.withColumn("__s", spread)
    out = rows.join(judged, (rows["__s"] == judged["__s"]) & (rows[url_col] == judged["__url"]), "left")
    return out.select(*[rows[f"`{c}`"] for c in pages.columns if c.lower() not in OUTPUTS or c == url_col],
                      host_of(rows[url_col]).alias("host"), path_of(rows[url_col]).alias("path"),
                      canonical(rows[url_col]).alias("canonical"), "rule",
                      F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"))
