"""Host and path rules for urls, carried over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved
from .components import connected_components

ALLOW, BLOCK = "allow", "block"
Rule = tuple[str, str, str]
"""(verdict, host, path)"""

#: Up to this many rules are one expression; a longer list is joined by host.
INLINE_RULES = 200

TRACKING = r"^(utm_|ref=|gclid=|fbclid=)"
LINK_TAG = r"(?i)(<link\b[^>]*>)"
META_TAG = r"(?i)(<meta\b[^>]*>)"
CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
DOTS = r"(^|/)\.\.?(/|$)"
# The character references that urls in attributes hold, the ampersand's last.
REFERENCES = (("&quot;|&#34;|&#[xX]22;", "\""), ("&apos;|&#39;|&#[xX]27;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;|&#38;|&#[xX]26;", "&"))
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """Host in lower-case ASCII; empty for a null url or one without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """Path up to ``?``, ``#`` or the end; empty for a null url or one without ``://``."""
    return F.coalesce(F.regexp_extract(url_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` segments followed; those above the root are left out."""
    none = F.array().cast("array<string>")
    segments = F.split(path, "/")

    def followed(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.lit(1), F.size(kept) - 1))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    # a path that ends in such a segment is that of a folder
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    return F.when(path.rlike(DOTS), F.array_join(F.aggregate(ended, none, followed), "/")).otherwise(path)


def url_node(url: Column) -> Column:
    """What urls of one resource share: no scheme, fragment, tracking parameter, dot segment or closing slash."""
    given = F.split(F.regexp_extract(url_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.array_join(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    query = F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    node = F.concat(url_host(url), F.regexp_replace(without_dots(url_path(url)), "/+$", ""), query)
    return F.when(url_rest(url).isNotNull(), node)


def resolved(target: Column, base: Column) -> Column:
    """An absolute url, its dot segments followed, for a link target found on the page ``base``."""
    folder = F.regexp_extract(url_path(base), r"^(.*/)", 1)
    root = F.concat(F.lit("http://"), url_host(base))
    url = (
        F.when(F.instr(target, F.lit("://")) > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("#") | target.startswith("?"), F.concat(root, url_path(base), target))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )
    before, path, after = (F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$", i) for i in (1, 2, 3))
    return F.when(url_path(url).rlike(DOTS), F.concat(before, without_dots(path), after)).otherwise(url)


def decoded(target: Column) -> Column:
    """A link target with its character references resolved."""
    for reference, character in REFERENCES:
        target = F.regexp_replace(target, reference, character)
    return target


def link_targets(html: Column) -> Column:
    """Targets of all canonical links and refresh redirects in a page, as an array."""
    links = F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG)), lambda t: t.rlike(CANONICAL))
    metas = F.filter(F.regexp_extract_all(html, F.lit(META_TAG)), lambda t: t.rlike(REFRESH))
    found = F.concat(
        F.transform(links, lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(metas, lambda t: F.regexp_extract(t, REFRESH_URL, 1)),
    )
    found = F.transform(F.coalesce(found, F.array().cast("array<string>")), decoded)
    return F.filter(found, lambda t: t != "")


def _ranked(rules: Sequence[Rule]) -> list[Rule]:
    """Longest first; of equal length allow first, then by text."""
    return sorted({tuple(r) for r in rules}, key=lambda r: (-len(r[1] + r[2]), r[0] != ALLOW, r[1] + r[2]))


def matched(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add rule (host and path) and rule_verdict of the longest fitting rule to rows with host and path.

    ``rows`` must have a column ``row`` that tells rows apart if there are more than
    ``INLINE_RULES`` rules; the rules are then joined on the suffixes of the host.
    """
    ranked = _ranked(rules)
    if len(ranked) <= INLINE_RULES:
        picked: Column | None = None
        for verdict, host, path in ranked:
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
            picked = F.when(fits, value) if picked is None else picked.when(fits, value)
        if picked is None:
            return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("rule_verdict"))
        return rows.select("*", picked.alias("_p")).select("*", F.col("_p.rule").alias("rule"), F.col("_p.verdict").alias("rule_verdict")).drop("_p")

    listed = rows.sparkSession.createDataFrame(
        [(h, p, v, h + p, -i) for i, (v, h, p) in enumerate(ranked)], "rule_host string, rule_path string, verdict string, rule string, strength int"
    )
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    urls = rows.select("host", "path").distinct()
    best = (
        urls.select("host", "path", F.explode(suffixes).alias("rule_host"))
        .join(listed, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), "strength").alias("_p"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[rows[c] for c in rows.columns], F.col("_p.rule").alias("rule"), F.col("_p.verdict").alias("rule_verdict")
    )


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    default: str = ALLOW,
) -> DataFrame:
    """Verdicts for pages: by the longest fitting rule, else by the aliases of the url.

    Aliases are the urls of one connected component of the graph of redirects (refresh
    tags) and canonical links found in the pages; urls of one ``url_node`` are one node.
    A page to which no rule fits is allowed if a rule allows any alias, else blocked if a
    rule blocks one, else ``default``. Link targets that aren't pages count as aliases.

    Returns (id, host, path, rule, verdict, by): by is ``rule``, ``alias`` or
    ``default``. A null url or one without ``://`` has empty host and path, no rule, no
    aliases, and gets the default. A null page has no links. Repeated rows each get
    their row, ties of rules go to allow, other columns are left out, an empty table
    gives no rows. Only DataFrame functions; the html is read once.
    """
    url = F.col(url_col)
    base = pages.select(
        F.col(id_col).alias("id"),
        url_host(url).alias("host"),
        url_path(url).alias("path"),
        url_node(url).alias("node"),
        F.transform(link_targets(F.col(html_col)), lambda t: resolved(t, url)).alias("targets"),
    )
    base = saved(matched(base, rules), "judged-pages")

    targets = base.where(F.col("node").isNotNull() & (F.size("targets") > 0)).select("node", F.explode("targets").alias("target"))
    targets = targets.select("node", url_host(F.col("target")).alias("host"), url_path(F.col("target")).alias("path"), url_node(F.col("target")).alias("other"))
    components = connected_components(targets, "node", "other")
    votes = (
        base.where("node is not null and rule_verdict is not null")
        .select("node", "rule_verdict")
        .union(matched(targets, rules).where("rule_verdict is not null").select(F.col("other"), F.col("rule_verdict")))
        .groupBy("node")
        .agg(F.max(F.col("rule_verdict") == ALLOW).alias("allow"), F.max(F.col("rule_verdict") == BLOCK).alias("block"))
    )
    member = votes.join(components, "node", "left").select(F.coalesce("component", "node").alias("component"), "allow", "block")
    group = member.groupBy("component").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    group = group.select("component", F.when(F.col("allow"), ALLOW).otherwise(F.lit(BLOCK)).alias("group_verdict"))
    # back to nodes, so that pages need one join on their node
    linked = components.join(group, "component").select("node", "group_verdict")
    alone = votes.join(components, "node", "left_anti").select("node", F.when(F.col("allow"), ALLOW).otherwise(F.lit(BLOCK)).alias("group_verdict"))
    by_node = linked.union(alone)

    ruled = base.where("rule_verdict is not null").withColumn("group_verdict", F.lit(None).cast("string"))
    free = base.where("rule_verdict is null").join(by_node, "node", "left")
    return (
        ruled.unionByName(free)
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            "rule",
            F.coalesce("rule_verdict", "group_verdict", F.lit(default)).alias("verdict"),
            F.when(F.col("rule_verdict").isNotNull(), "rule").when(F.col("group_verdict").isNotNull(), "alias").otherwise(F.lit("default")).alias("by"),
        )
    )
