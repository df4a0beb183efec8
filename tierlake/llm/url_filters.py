"""URL filters with redirect equivalence: rules judge addresses, and decisions reach the aliases of a page.

A rule is a host and the start of a path; it fits its host and all subdomains, and the longest that fits decides. An
address that no rule fits takes the decision of its class of aliases: addresses are aliases if a chain of redirects
and canonical links joins them. Classes are the connected components of these edges, found by alternating stars over
tables in the shared folder (components.py). In a class, an explicit allow goes before a block, and a block before
nothing; without either the address is allowed. A rule that fits the address itself always goes first.

Addresses that differ in a way that a server or a crawler does not see are one node from the start: scheme, case of
the host, leading "www." and "m." (redirect hosts), default port, fragment, tracking parameters, and an empty path or
its last "/". Edges come from the html of pages (canonical links, refresh redirects, both absolute or relative to
the host) and from a log of redirects, if there is one.

Plan: columns, rules and links are built-in functions, so rules cost no join. Nodes on edges are 128 bits of SHA-256.
Only edges go through the components; classes are joined to the addresses that no rule fits, and only if there are
edges or blocks at all. Per class there is one row, combined in map tasks; a class that holds a third of all pages
is a skewed join, whose large side Spark splits.

Defined cases: a null address or one without "://" has an empty host and path, no node and no alias, and is allowed;
null or empty html has no links; links to nowhere in the table still join those that share them; equal rows are judged
each; an empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters that only say where a reader came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|\z)"
#: Hosts that send readers on to the one behind them.
ALIAS_HOST = r"^(www|m)\."
CANONICAL = (
    r"""(?i)<link\s[^>]*?rel\s*=\s*["']?canonical["'\s][^>]*?href\s*=\s*["']?([^"'\s>]+)""",
    r"""(?i)<link\s[^>]*?href\s*=\s*["']?([^"'\s>]+)["']?\s[^>]*?rel\s*=\s*["']?canonical["'\s/>]""",
)
REFRESH = r"""(?i)<meta\s[^>]*?http-equiv\s*=\s*["']?refresh["'\s][^>]*?url\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(text: str) -> list[Rule]:
    """Rules from "block net/, allow example.net/en/"."""
    out = []
    for line in text.split(","):
        verdict, place = line.split()
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host, slash + path))
    return out


def parts(df: DataFrame, url: str) -> DataFrame:
    """The rows with host and path."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, SMALL)
    return df.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def judge(rows: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits host and path, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rows, key=lambda r: (len(r.text), len(r.host), r.text)):  # the longest is asked first
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def plain(url: Column) -> Column:
    """The address in the form that all of its spellings share; null without "://"."""
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)^.*?://", ""), r"(?s)#.*\z", "")
    host = F.translate(F.regexp_extract(rest, r"^[^/?]*", 0), UPPER, SMALL)
    host = F.when(host.rlike(ALIAS_HOST + r"[^.]+\.[^.]"), F.regexp_replace(host, ALIAS_HOST, "")).otherwise(host)
    host = F.regexp_replace(host, r":(80|443)\z", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/\z", "")
    asked = F.split(F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)", 1), "&")
    asked = F.filter(asked, lambda q: (q != "") & ~q.rlike(TRACKING))
    asked = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(asked), "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, asked))


def node(url: Column) -> Column:
    return F.unhex(F.substring(F.sha2(plain(url), 256), 1, 32))


def _target(url: Column, link: Column) -> Column:
    """A link as a whole address; one from the host's root takes the host of the page, others that are relative are left out."""
    scheme_host = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    link = F.regexp_replace(link, "&amp;", "&")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("/"), F.concat(scheme_host, link))
    )


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): nodes of pages and of the canonical links and redirects in their html."""
    found = F.flatten(F.array(*(F.regexp_extract_all(F.col(html), F.lit(p), F.lit(1)) for p in (*CANONICAL, REFRESH))))
    asks = F.col(html).rlike("(?i)canonical|refresh")
    some = pages.where(F.col(url).isNotNull() & asks).select(F.col(url).alias("url"), F.explode(found).alias("link"))
    return some.select(node(F.col("url")).alias("a"), node(_target(F.col("url"), F.col("link"))).alias("b")).dropna()


def verdicts(
    pages: DataFrame, rows: list[Rule], redirects: DataFrame | None = None,
    id_column: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """id, host, path, rule, verdict and class (of 128 bits) per page; redirects: (from_url, to_url)."""
    edges = links(pages, url, html)
    if redirects is not None:
        edges = edges.unionAll(redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b")).dropna())
    classes = components(edges).select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    named = parts(pages.select(F.col(id_column).alias("id"), F.col(url).alias("_url")), "_url").withColumns(
        {"judged": judge(rows), "node": node(F.col("_url"))}
    )
    named = named.join(classes, F.col("node") == F.col("_node"), "left")
    named = named.withColumn("class", F.coalesce("_label", "node")).select("id", "host", "path", "judged", "class")
    # Only classes with a block and without an allow say anything: one row each.
    ruled = named.where("judged IS NOT NULL AND class IS NOT NULL")
    blocked = ruled.groupBy(F.col("class").alias("_class")).agg(
        F.bool_or(F.col("judged.verdict") == "allow").alias("allowed")
    ).where("NOT allowed").drop("allowed")
    # What a rule fits asks no class: its key, 17 bytes of its own, meets nothing and spreads.
    own = F.concat(F.unhex(F.md5(F.concat_ws(" ", F.col("id").cast("string"), "host", "path"))), F.lit(b"\0"))
    asks = F.coalesce(F.when(F.col("judged").isNull(), F.col("class")), own)
    return named.join(blocked, asks == F.col("_class"), "left").select(
        F.col("id").alias(id_column), "host", "path", F.col("judged.rule").alias("rule"),
        F.coalesce("judged.verdict", F.when(F.col("_class").isNotNull(), "block").otherwise("allow")).alias("verdict"), "class",
    )
