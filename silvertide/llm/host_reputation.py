"""URL filters: fixed rules first, then the reputation of the host by empirical Bayes.

A page is good or not if the document that its path names is labelled. Outcomes are counted per host; a host's rate is
shrunk towards that of its registered domain, that towards its suffix, and that towards the whole, each by a beta-binomial
prior. Suffixes of several labels are those of SHARED_SUFFIXES; an address is a domain and a suffix of its own. The strength of a level's prior is estimated by moments from how much the rates below it differ beyond chance.
A host is blocked if even the upper bound of its posterior is below the bar. Everything is counted over all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize

# The rules of the filter as (verdict, host, path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Suffixes of several labels below which anybody may register a name, by what they end in.
SHARED_SUFFIXES = frozenset(
    f"{label}.{ending}" for ending, labels in {
        "uk": "ac co gov ltd me net nhs org plc police sch", "au": "asn com edu gov id net org", "nz": "ac co geek gen govt iwi kiwi maori net org school",
        "za": "ac co edu gov law net nom org school web", "br": "adv art blog com eco edu eng far gov ind inf jus leg med mil net org tur tv",
        "ar": "com edu gob gov int mil net org tur", "mx": "com edu gob net org", "co": "com edu gov mil net nom org", "pe": "com edu gob mil net nom org",
        "ve": "co com edu gob info net org web", "uy": "com edu gub mil net org", "py": "com coop edu gov mil net org", "ec": "com edu fin gob gov info med net org pro",
        "bo": "com edu gob int mil net org tv", "cl": "co gob gov mil", "cr": "ac co ed fi go or sa", "gt": "com edu gob ind mil net org", "do": "com edu gob gov mil net org web",
        "jp": "ac ad co ed go gr lg ne or", "kr": "ac co go hs kg mil ms ne or pe re sc", "cn": "ac com edu gov mil net org", "tw": "club com edu game gov idv mil net org",
        "hk": "com edu gov idv net org", "mo": "com edu gov net org", "sg": "com edu gov net org per", "my": "com edu gov mil name net org", "th": "ac co go in mi net or",
        "id": "ac biz co desa go mil my net or sch web", "ph": "com edu gov mil net ngo org", "vn": "ac biz com edu gov health info int name net org pro",
        "in": "ac co edu firm gen gov ind mil net nic org res", "pk": "biz com edu fam gob gov net org web", "bd": "ac com edu gov mil net org", "lk": "ac com edu gov net org sch",
        "np": "com edu gov mil net org", "il": "ac co gov idf k12 muni net org", "tr": "av bel biz com dr edu gen gov info k12 name net org pol web", "sa": "com edu gov med net org pub sch",
        "ae": "ac co gov mil net org sch", "qa": "com edu gov mil name net org sch", "kw": "com edu gov net org", "lb": "com edu gov net org", "jo": "com edu gov mil net org sch",
        "eg": "com edu gov mil net org sci", "ma": "ac co gov net org press", "ng": "com edu gov mil mobi net org sch", "ke": "ac co go info me mobi ne or sc", "gh": "com edu gov mil org",
        "tz": "ac co go ne or sc", "ug": "ac co com go ne or org sc", "zw": "ac co gov mil org", "pl": "com edu gov info net org waw", "hu": "co info org", "at": "ac co gv or",
        "es": "com edu gob nom org", "pt": "com edu gov int net org publ", "fr": "asso com gouv nom prd tm", "it": "edu gov", "gr": "com edu gov net org", "cy": "ac biz com gov ltd net org",
        "ua": "com edu gov in net org", "ru": "ac com edu gov int mil msk net org pp spb", "rs": "ac co edu gov in org", "ro": "arts com info nom org store www", "mt": "com edu net org",
        "se": "ac org pp", "us": "ca fl ny tx wa", "com": "appspot blogspot br cn de eu firebaseapp gb githubusercontent herokuapp jpn onrender uk us wordpress za",
        "net": "azurewebsites cloudfront gb se uk", "org": "ae eu us", "io": "github gitlab ngrok readthedocs", "app": "netlify vercel web", "dev": "deno fly pages workers",
        "sh": "surge vercel",
    }.items() for label in labels.split()
) | {"s3.amazonaws.com", "k12.ca.us", "k12.tx.us", "k12.ny.us"}
#: Share of good pages that a host must be able to have, and the width of the bound in standard deviations.
BAR, WIDTH = 0.5, 1.645
#: Strength of a prior in pages: the least, and the largest where rates differ by no more than chance.
WEAKEST, STRONGEST = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path; both are empty for a null url or one without ://."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_of() -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null if none does."""
    rule = verdict = None
    for kind, host, path in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def outcomes(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good, n): labelled pages of every host. The last number of a path names the document, unless it is no BIGINT.

    A page is good if its document has quality 1 and is not toxic; the worst label of a document counts.
    """
    document = F.regexp_extract("path", "/([0-9]+)[^/0-9]*/?$", 1)
    named = parts.select("host", document.try_cast("long").alias("doc_id"))
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good")
    )
    known = named.where("doc_id is not null").join(marks, "doc_id").groupBy("host").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
    hosts = parts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return hosts.join(known, "host", "left").select("host", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("n", F.lit(0)).alias("n"))


def strength(spread: float | None, groups: int, pages: int | None) -> float:
    """Strength a + b of the beta prior by moments.

    spread is the sum over the groups of n (rate - mean)^2 / (mean (1 - mean)), whose expectation under a correlation r
    within groups is groups (1 - r) + pages r; the strength is 1 / r - 1, within its bounds.
    """
    r = ((spread or 0.0) - groups) / (pages - groups) if pages and pages > groups else 0.0
    return min(max(1 / r - 1, WEAKEST), STRONGEST) if r > 0 else STRONGEST


def _shrunk(level: DataFrame) -> DataFrame:
    """good and n of each group with above, the rate one level up, become the posterior's mean and its weight in pages."""
    rate, above, n = F.col("good") / F.col("n"), F.col("above"), F.col("n")
    seen = level.where("n > 0").agg(
        F.sum(n * (rate - above) * (rate - above) / (above * (1 - above))).alias("spread"), F.count(F.lit(1)).alias("groups"), F.sum("n").alias("pages")
    ).first()
    k = F.lit(strength(seen.spread, seen.groups, seen.pages))
    return level.withColumns({"mean": (F.col("good") + k * above) / (n + k), "weight": n + k})


def with_domain(hosts: DataFrame) -> DataFrame:
    """hosts with domain, the registered one, and suffix; user part, port and a last dot do not count."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("host", "(?s)^.*@", ""), ":[0-9]*$", ""), r"\.$", "")
    address = F.col("bare").rlike(r"^([0-9]+\.){3}[0-9]+$|^\[")
    parts, size = F.split("bare", "\\."), F.size(F.split("bare", "\\."))
    last = lambda n: F.when(size <= n, F.col("bare")).otherwise(F.concat_ws(".", F.slice(parts, -F.least(n, size), n)))
    shared = sorted(SHARED_SUFFIXES)
    labels = F.when(last(F.lit(3)).isin(shared), 3).when(last(F.lit(2)).isin(shared), 2).otherwise(1)
    named = hosts.withColumn("bare", bare).withColumn("labels", labels)
    return named.withColumns({
        "domain": F.when(address, F.col("bare")).otherwise(last(F.col("labels") + 1)),
        "suffix": F.when(address, F.col("bare")).otherwise(last(F.col("labels"))),
    }).drop("bare", "labels")


def reputation(hosts: DataFrame) -> DataFrame:
    """(host, mean, deviation) of the posterior rate of good pages, from outcomes()."""
    named = materialize(with_domain(hosts.select("host", "good", "n")), "hosts")
    total = named.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    counts = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    suffixes = _shrunk(named.groupBy("suffix").agg(*counts).withColumn("above", F.lit(((total.good or 0) + 1) / ((total.n or 0) + 2))))
    domains = named.groupBy("domain", "suffix").agg(*counts).join(suffixes.select("suffix", F.col("mean").alias("above")), "suffix")
    own = _shrunk(named.join(_shrunk(domains).select("domain", F.col("mean").alias("above")), "domain"))
    return own.select("host", "mean", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1)).alias("deviation"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    verdict is the rule's; without a rule, block if the upper bound of the host's posterior is below the bar, else
    allow. Hosts without labelled pages have the rate of their domain. Repeated rows and null ids stay.
    """
    parts = with_parts(pages)
    known = reputation(outcomes(parts, labels))
    blocked = known.where(F.col("mean") + WIDTH * F.col("deviation") < BAR).select("host", F.lit(True).alias("poor"))
    rule, verdict = rule_of()
    return parts.join(blocked, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("poor"), "block").otherwise("allow")).alias("verdict"),
    )
