"""URL filters with redirect equivalence, in DataFrame functions only.

A page's address is judged by the longest rule that fits it. Addresses joined by redirects
or canonical links are one place: components over those edges carry a block decision to
every alias that no rule names, while an address that a rule allows stays allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, UPPER_AZ
from tidewatch.operators.skew import is_heavy, join_by_count

from .components import SALTS, connected_components

#: (verdict, host, path) of the production rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _after_scheme(url: Column) -> Column:
    """What follows the first ://; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """Up to /, ?, # or the end, A-Z lower-cased; empty for null or an address without ://."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER_AZ, LOWER_AZ), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def place_of(url: Column) -> Column:
    """An address without scheme and fragment: two spellings of one place are equal."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(_after_scheme(url).isNotNull(), F.concat(host_of(url), rest))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


#: What the named entities of addresses stand for.
ENTITIES = {"amp": "&", "AMP": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "sol": "/", "colon": ":", "quest": "?", "equals": "=", "num": "#", "period": "."}
_PIECES = r"(&#0*[0-9]{1,7};|&#[xX]0*[0-9a-fA-F]{1,6};|&(?:" + "|".join(ENTITIES) + ");|&|[^&]+)"


def unescaped(text: Column) -> Column:
    """A text with numeric entities and those of ENTITIES as the characters they stand for."""
    def piece(p: Column) -> Column:
        code = F.when(p.rlike("^&#[xX].*;$"), F.conv(F.regexp_extract(p, "([0-9a-fA-F]+);", 1), 16, 10)).when(
            p.rlike("^&#.*;$"), F.regexp_extract(p, "([0-9]+);", 1)).cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        sign = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        named = F.create_map(*(F.lit(x) for name, char in ENTITIES.items() for x in (f"&{name};", char)))
        return F.coalesce(F.try_element_at(named, p), sign, p)

    pieces = F.transform(F.regexp_extract_all(text, F.lit(_PIECES), 1), piece)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def _folded(path: Column) -> Column:
    """A path that starts with / without its . and .. segments."""
    def step(kept: Column, segment: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == "..", up).when(segment == ".", kept).otherwise(F.concat(kept, F.array(segment)))

    whole = F.regexp_replace(path, r"/(\.\.?)$", "/$1/")
    kept = F.aggregate(F.split(F.substr(whole, F.lit(2)), "/", -1), F.array().cast("array<string>"), step)
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(target: Column, base: Column) -> Column:
    """The address that a link on a page at ``base`` leads to; null for schemes without ://.

    Whole addresses stay as they are. The others take from ``base`` what they lack: the scheme
    (//host/x), scheme and host (/x), these and the path (?x) or its directory (x, ../x), or all but
    the fragment (#x); . and .. segments are folded.
    """
    root = F.regexp_extract(base, r"^(.*?://[^/?#]*)", 1)
    path = F.regexp_replace(path_of(base), "^$", "/")
    query = F.regexp_extract(_after_scheme(base), r"^[^?#]*(\?[^#]*)", 1)
    own, tail = F.regexp_extract(target, r"^([^?#]*)", 1), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    directory = F.regexp_extract(path, r"^(.*/)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^(.*?:)//", 1), target))
        .when(target.startswith("#"), F.concat(root, path_of(base), query, target))
        .when(target.startswith("?"), F.concat(root, path, target))
        .when(target.startswith("/"), F.concat(root, _folded(own), tail))
        .otherwise(F.concat(root, _folded(F.concat(directory, own)), tail)))


def _with(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later expressions do not write out again, as they do with ``withColumn``.

    Written out, an address's expression is in the plan hundreds of times.
    """
    return frame.select("*", F.explode(F.array(value)).alias(name))


def page_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): canonical links and refresh redirects stated in the pages' HTML.

    A tag counts wherever it stands. Entities in targets are undone; relative targets are
    resolved against the page's first base tag, or without one its address.
    """
    html, url = F.col("html").cast("string"), F.col("url").cast("string")
    quick = html.rlike(r"(?i)canonical|http-equiv")
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1)
    stated = F.regexp_extract(html, r"(?is)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'>\s]+)", 1)
    found = pages.filter(quick).select(url.alias("from_url"), stated.alias("stated"), F.explode(tags).alias("tag"))
    canonical = F.when(F.col("tag").rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b"),
                       F.regexp_extract("tag", r"(?i)\bhref\s*=\s*[\"']?([^\"'>\s]+)", 1))
    refresh = F.when(F.col("tag").rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"),
                     F.regexp_extract("tag", r"(?i)\burl\s*=\s*['\"]?([^\"'>\s]+)", 1))
    found = _with(found, "target", F.coalesce(canonical, refresh)).filter(F.length("target") > 0)
    found = _with(_with(found, "stated_url", unescaped(F.col("stated"))), "link", unescaped(F.col("target")))
    stated = F.when(F.length("stated") > 0, resolved(F.col("stated_url"), F.col("from_url")))
    found = _with(found, "base", F.coalesce(stated, F.col("from_url")))
    return _with(found, "to_url", resolved(F.col("link"), F.col("base"))).select("from_url", "to_url")


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, place, alias_of) for every row of ``pages`` (page_id, url, html).

    ``redirects`` (from_url, to_url) adds edges to those in the pages' HTML. A rule's verdict
    holds for the pages it fits. A page without a rule is blocked if any address of its
    component is blocked by a rule, else allowed. ``alias_of`` is the smallest place of the
    component (the page's own place if it has no edges). Null or odd addresses have an empty
    host and path, no rule, no aliases and are allowed. Repeated rows come back as often as
    they went in; rows without page_id keep a null; no rows: no rows; extra columns are ignored.
    """
    url = F.col("url").cast("string")
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string")))
    spots = edges.select(place_of(F.col("from_url")).alias("a"), place_of(F.col("to_url")).alias("b"))
    members = connected_components(spots)
    # A place is judged by its own address, whether or not a page has it.
    whole = F.concat(F.lit("://"), F.col("node"))
    decided = members.select("node", "component", (matched_rule(host_of(whole), path_of(whole), rules)[1] == "block").alias("bad"))
    blocked = decided.filter("bad").select("component").distinct()
    # a component with many members is dealt over SALTS places
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    blocked = blocked.select("component", every, F.lit(True).alias("spread"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    aliases = salted.join(blocked, ["component", "salt"], "left").select(
        F.col("node").alias("place"), "component", F.coalesce("spread", F.lit(False)).alias("spread"))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), place_of(url).alias("place"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", "place", rule.alias("rule"), verdict.alias("own"))
    places = rows.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    heavy = places.filter(F.col("place").isNotNull() & is_heavy(F.col("n"), places.agg(F.sum("n")).scalar())).select("place")
    return join_by_count(rows, aliases, heavy, ["place"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(F.col("spread"), F.lit("block")), F.lit("allow")).alias("verdict"),
        "place", F.coalesce("component", "place").alias("alias_of"))
