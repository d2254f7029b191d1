"""URL block and allow rules, with decisions carried over redirects and canonical links. Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.graph import components
from ledgerline.llm.store import stored

#: Query parameters that only track a visit.
TRACKERS = "utm_[a-z]+|ref|fbclid|gclid"


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # block or allow
    rule: str  # host, then the beginning of the path: example.net/en/

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for a null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without :// or for a null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains, if the path
    starts with the rule's. Rules are looked up by the host's suffixes, so their number does not matter."""
    by_host: dict[str, list[UrlRule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    one = "struct<n:int,allow:boolean,rule:string,path:string>"
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    known = F.create_map(
        *[
            x
            for h, own in by_host.items()
            for x in (
                F.lit(h),
                F.array(*[F.struct(F.lit(len(r.rule)).alias("n"), F.lit(r.verdict == "allow").alias("allow"), F.lit(r.rule).alias("rule"), F.lit(r.path).alias("path")) for r in own]).cast(f"array<{one}>"),
            )
        ]
    )
    labels = F.split(host, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = F.flatten(F.transform(tails, lambda t: F.coalesce(F.try_element_at(known, t), F.array().cast(f"array<{one}>"))))
    best = F.array_max(F.filter(found, lambda r: F.startswith(path, r["path"])))
    named = F.struct(best["rule"].alias("rule"), F.when(best["allow"], "allow").otherwise("block").alias("verdict"))
    return F.when(best.isNotNull(), named)


def canonical_url(url: Column) -> Column:
    """The address that servers redirect a page's variants to: https, host in lower case, no fragment, no tracking parameters,
    no slash, index file or .html at the end. Null where there is no ://."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(f"(?i)^(?:{TRACKERS})(?:=|$)")))
    path = F.regexp_replace(path_of(url), r"(?i)(?:/index)?\.html?$|/+$", "")
    joined = F.concat(F.lit("https://"), host_of(url), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), joined)


def declared_links(html: Column) -> Column:
    """Absolute addresses that a page names as its canonical address or redirects to (meta refresh)."""
    canonical = F.regexp_extract(html, r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']([^"'>]+)""", 1)
    refresh = F.regexp_extract(html, r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'>\s]+)""", 1)
    return F.filter(F.array(canonical, refresh), lambda u: F.contains(u, F.lit("://")))


def judged_urls(pages: DataFrame, rules: list[UrlRule], key: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """One row per input row: (key, host, path, rule, verdict, alias_of).

    A url that a rule fits has the rule's verdict: an explicit allow holds whatever its aliases are. Any other url is blocked
    if a rule blocks one of its aliases, else allowed. Aliases are the connected component of the url over three kinds of
    edges: to its canonical form, to the canonical address that its page declares, to the target of its page's redirect.
    alias_of is the smallest address of the component. A null url, or one without ://, has an empty host and path and no
    alias: allowed if no rule fits. Null html has no links. Repeated rows and keys are rows like any other.
    """
    own = [F.col(key).alias("key"), F.col(url).cast("string").alias("url")]
    seen = pages.select(*own, (declared_links(F.col(html).cast("string")) if html else F.array().cast("array<string>")).alias("links"))
    to = F.concat(F.array(canonical_url(F.col("url"))), F.coalesce("links", F.array().cast("array<string>")))
    far = F.concat(to, F.transform("links", canonical_url))
    edges = stored(
        seen.where(F.contains("url", F.lit("://"))).select("url", F.explode(far).alias("to")).where("to is not null and url <> to").distinct(), "links"
    )
    labels = components(edges, "url", "to")
    at = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    blocked = stored(labels.where(at["verdict"] == "block").select(F.col("label").alias("blocked")).distinct(), "blocked")
    found = pages.select(*own).join(labels, F.col("url") == F.col("node"), "left").join(blocked, F.col("label") == F.col("blocked"), "left")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = found.select("key", host.alias("host"), path.alias("path"), "blocked", F.coalesce("label", "url").alias("alias_of"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    passed_on = F.when(F.col("blocked").isNotNull(), "block").otherwise("allow")
    return judged.select(
        F.col("key").alias(key), "host", "path", rule["rule"].alias("rule"), F.coalesce(rule["verdict"], passed_on).alias("verdict"), "alias_of"
    )
