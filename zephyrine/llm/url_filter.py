"""URL rules whose block decisions reach aliases of a page.

Pages are aliases if redirects or canonical links connect them, over any number of steps.
Addresses that differ only in their fragment are one address, and every address is linked to
its plain form: https, no tracking parameters, no slash at the end. Connected components join all
aliases; a page no rule fits is blocked if a rule blocks one of its aliases and no rule
explicitly allows one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import written
from zephyrine.llm.components import connected_components
from zephyrine.llm.decontaminate import UPPER


@dataclass(frozen=True)
class Rule:
    """``verdict`` ("allow" or "block") for a host, its subdomains and paths under ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Elements that name another address of the page, with the quoted texts inside them, and an
# attribute's value with or without quotes.
_TAG = r"(?is)<{0}\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_VALUE = r"(?is)\s{0}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_REFRESH_URL = r"(?is)^[^;,]*[;,]\s*(?:url\s*=\s*)?[\"']?\s*([^\"'\s]+)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ADDRESS = r"(?s)^([^#]*?://)([^/?#]*)([^#]*)"


def _lower_ascii(value: Column) -> Column:
    return F.translate(value, UPPER, UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or an address without ``://``."""
    found = F.coalesce(url, F.lit(""))
    host, path = (F.regexp_extract(found, _PARTS, group) for group in (1, 2))
    return _lower_ascii(host), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, NULL without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest comes last, so it decides first; of equal lengths, an allowing one.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow", r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def address(url: Column) -> Column:
    """The address without fragment, scheme and host in lower case; NULL without ``://``."""
    scheme, host, tail = (F.regexp_extract(url, _ADDRESS, group) for group in (1, 2, 3))
    whole = F.concat(_lower_ascii(F.concat(scheme, host)), F.when(tail == "", "/").otherwise(tail))
    return F.when(scheme != "", whole)


def plain_address(address_of: Column) -> Column:
    """An address with https, without ``utm_`` parameters and without slashes at its end."""
    rest = F.regexp_replace(address_of, r"^https?://", "https://")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*[?](.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.concat(path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _without_dots(path: Column) -> Column:
    """A path after its ``.`` and ``..`` segments are carried out; none climbs above the root."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    empty = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", shorter).when(part == ".", done).otherwise(F.array_append(done, part))

    ended = F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(empty)
    return F.array_join(F.concat(F.aggregate(parts, empty, step), ended), "/")


def resolved(target: Column, url: Column) -> Column:
    """A link target against the page's own address: absolute, ``//host``, ``/path``, ``?query``
    or a path relative to the page's, dot segments carried out."""
    link = F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(url, r"^([^:/?#]*:)//", 1)
    origin = F.regexp_extract(url, r"^([^:/?#]*://[^/?#]*)", 1)
    base = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    path, rest = (F.regexp_extract(link, r"(?s)^([^?#]*)(.*)$", group) for group in (1, 2))
    folder = F.concat(F.lit("/"), F.regexp_replace(base, r"^/|[^/]*$", ""))
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(link.rlike(_SCHEME), link)
        .when(origin == "", F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(path == "", F.concat(origin, base, rest))
        .otherwise(F.concat(origin, _without_dots(whole), rest))
    )


def _node(address_of: Column) -> Column:
    """Sixteen bytes that stand for an address."""
    return F.unhex(F.md5(address_of))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag, empty without one."""
    return F.concat(*[F.regexp_extract(tag, _VALUE.format(name), group) for group in (1, 2, 3)])


def alias_links(pages: DataFrame) -> DataFrame:
    """``(from_url, to_url)`` of all canonical links and refresh redirects in the pages' html."""
    html = F.coalesce("html", F.lit(""))
    links, metas = (F.regexp_extract_all(html, F.lit(_TAG.format(tag)), F.lit(0)) for tag in ("link", "meta"))
    canonical = F.filter(links, lambda tag: _attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"))
    refresh = F.filter(metas, lambda tag: _attribute(tag, "http-equiv").rlike(r"(?i)^\s*refresh\s*$"))
    targets = F.concat(
        F.transform(canonical, lambda tag: _attribute(tag, "href")),
        F.transform(refresh, lambda tag: F.regexp_extract(_attribute(tag, "content"), _REFRESH_URL, 1)),
    )
    found = pages.select(F.col("url").alias("from_url"), F.explode(targets).alias("link"))
    return found.filter(F.trim("link") != "").select(
        "from_url", resolved(F.col("link"), F.col("from_url")).alias("to_url")
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """One row per page row: ``page_id, host, path, rule, verdict, component``.

    ``redirects`` (``from_url, to_url``) adds known redirects to the links found in ``html``.
    A page with a fitting rule gets that rule's verdict. Others are blocked if an alias is
    blocked by rule and no alias is allowed by rule, and are allowed else. NULL urls and those
    without ``://`` have no aliases and no rule. Repeated rows each get a row; ``component``
    is shared by aliases. Columns other than ``page_id, url, html`` are not read.
    """
    pages = pages.select("page_id", "url", "html")
    links = alias_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    ends = written(
        links.select(
            address(F.col("from_url")).alias("from_address"), address(F.col("to_url")).alias("to_address")
        ).filter("from_address IS NOT NULL AND to_address IS NOT NULL"),
        "links",
    )
    addressed = pages.select("page_id", "url", address(F.col("url")).alias("address"))
    known = addressed.select(F.col("address").alias("from_address")).unionByName(
        ends.select(F.explode(F.array("from_address", "to_address")).alias("from_address"))
    )
    plain = known.filter("from_address IS NOT NULL").select(
        "from_address", plain_address(F.col("from_address")).alias("to_address")
    )
    edges = ends.unionByName(plain).select(
        _node(F.col("from_address")).alias("a"), _node(F.col("to_address")).alias("b")
    )
    components = connected_components(edges)

    host, path = host_and_path(F.col("url"))
    split = addressed.select(
        "page_id", host.alias("host"), path.alias("path"), _node(F.col("address")).alias("node")
    )
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("own")).withColumnRenamed("node", "at")
    placed = written(
        ruled.join(components, F.col("at") == F.col("node"), "left").select(
            "page_id", "host", "path", "rule", "own",
            F.coalesce("component", "at").alias("component"),
        ),
        "pages",
    )
    decided = (
        placed.filter("component IS NOT NULL AND own IS NOT NULL")
        .groupBy("component")
        .agg((F.max((F.col("own") == "block").cast("int")) == 1).alias("blocked"),
             (F.max((F.col("own") == "allow").cast("int")) == 1).alias("allowed"))
        .filter("blocked AND NOT allowed")
        .select(F.col("component").alias("blocked_component"))
    )
    joined = placed.join(decided, F.col("component") == F.col("blocked_component"), "left")
    spread = F.when(F.col("blocked_component").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("own", spread).alias("verdict"),
        F.lower(F.hex("component")).alias("component"),
    )
