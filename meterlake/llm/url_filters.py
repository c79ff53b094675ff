"""URL filters by host and path rules, with decisions carried over redirects and canonical links.

Pages that lead to one another by redirects or canonical links are aliases of one
resource: the connected components over those edges. A page that a rule fits gets
that rule's verdict. Any other page gets what the rules say of its aliases; an
explicit allow among them takes precedence over a block. All of it is DataFrame
functions, joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import components
from meterlake.llm.shared import materialize, release

# The ASCII letters that are lower-cased, and the patterns of link elements.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = r"[\t\n\f\r ]"
LINK_TAG = rf"(?i)<link{BLANK}[^>]*>"
META_TAG = rf"(?i)<meta{BLANK}[^>]*>"
IS_CANONICAL = rf"(?i){BLANK}rel{BLANK}*={BLANK}*[\"']?canonical[\"'/>\t\n\f\r ]"
IS_REFRESH = rf"(?i){BLANK}http-equiv{BLANK}*={BLANK}*[\"']?refresh[\"'/>\t\n\f\r ]"
HREF = rf"(?i){BLANK}href{BLANK}*={BLANK}*(?:\"([^\"]*)\"|'([^']*)'|([^\t\n\f\r \"'>]+))"
REFRESH_URL = rf"(?i)[;,\"'\t\n\f\r ]url{BLANK}*={BLANK}*[\"']?([^\"'>\t\n\f\r ]+)"

RULE_SCHEMA = "verdict string, host string, path string"


def host_path(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query with its ``?``) of a url; all empty without ``://``. The host's A-Z are lower-cased."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return host, path, query


def address(host: Column, path: Column, query: Column) -> Column:
    """What a server is asked for: scheme and fragment do not count, an empty path is ``/``. Null without a host."""
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def resolve(link: Column, host: Column, path: Column) -> Column:
    """The absolute form of a link on a page; relative ones are taken from the page's folder, dot segments stay."""
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(F.instr(F.regexp_extract(link, r"^[^/?#]*:?//", 0), "://") > 0, link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("any:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(F.lit("any://"), host, link))
        .when(F.startswith(link, F.lit("?")), F.concat(F.lit("any://"), host, path, link))
        .otherwise(F.concat(F.lit("any://"), host, folder, link))
    )


def _link_of(tag: str, kind: str, link: str, groups: int) -> Column:
    """The link in the first element of ``html`` that is of the kind, trimmed and with ``&amp;`` as ``&``; null if none or empty.

    ``link`` has the link in one of its groups.
    """
    element = F.get(F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: t.rlike(kind)), F.lit(0))
    text = F.concat(*[F.regexp_extract(element, link, g + 1) for g in range(groups)])
    return F.nullif(F.replace(F.trim(text), F.lit("&amp;"), F.lit("&")), F.lit(""))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url) of the first canonical link and the first refresh of each page that has one."""
    html = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    near = pages.select(pages[url_col].cast("string").alias("from_url"), html.alias("html"))
    near = near.where(F.col("html").rlike("(?i)canonical|http-equiv") & (F.instr("from_url", "://") > 0))
    found = [_link_of(LINK_TAG, IS_CANONICAL, HREF, 3), _link_of(META_TAG, IS_REFRESH, REFRESH_URL, 1)]
    host, path, _ = host_path(F.col("from_url"))
    links = near.select("from_url", F.explode(F.array_compact(F.array(*found))).alias("link"), host.alias("h"), path.alias("p"))
    # the explode keeps later filters on to_url from being rewritten into copies of all these expressions
    return links.select("from_url", F.explode(F.array(resolve(F.col("link"), F.col("h"), F.col("p")))).alias("to_url"))


def rules_of(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules from (verdict, ``host/path``) pairs."""
    rows = []
    for verdict, text in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        host, slash, path = text.partition("/")
        rows.append((verdict, host.lower(), slash + path))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def fitting_rule(forms: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, says) of each distinct form (host, path) that a rule fits: the longest rule.

    A form meets rules by the last labels of its host, as many as the longest rule
    host has; rules of equal length go by the longer host, and allow goes before block.
    """
    rules = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("says")
    ).where("r_host <> ''")
    labels = rules.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 0
    parts = F.split("host", r"\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    forms = forms.select("host", "path").where("host <> ''").distinct()
    met = forms.withColumn("end", F.explode(ends)).join(rules, F.col("end") == F.col("r_host"))
    met = met.where(F.startswith("path", "r_path"))
    text = F.concat("r_host", "r_path")
    order = F.struct(F.length(text).alias("n"), F.length("r_host").alias("h"), (F.col("says") == "allow").alias("allow"), text.alias("rule"))
    best = met.groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("says"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Sequence[tuple[str, str]],
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """Per page: page_id, url, host, path, rule, verdict, by_alias.

    ``rules``: (verdict, ``host/path``) pairs, or a table (verdict, host, path) of any
    size. ``redirects``: a table (from_url, to_url), as a crawler logs them; canonical
    links and refreshes are taken from ``html_col`` unless that is None. ``by_alias``
    marks verdicts that come from aliases. Aliases need not be pages of the table.

    A null url or one without ``://`` has an empty host and path, no aliases, and is
    allowed; repeated rows and null ids each keep their row; a null html has no links.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = rules_of(spark, rules)
    url = pages[url_col].cast("string")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), url.alias("url"))
    parts = dict(zip(("host", "path", "query"), host_path(F.col("url"))))
    rows = rows.withColumns(parts)

    links = page_links(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        logged = redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string"))
        links = logged if links is None else links.unionByName(logged)
    edges = materialize(_edges(links), "url-edges") if links is not None else None
    if edges is not None and edges.isEmpty():
        release(edges)
        edges = None

    forms = rows.select("host", "path")
    if edges is not None:
        for end in "ab":
            forms = forms.unionByName(edges.select(F.col(f"{end}_host").alias("host"), F.col(f"{end}_path").alias("path")))
    fits = fitting_rule(forms, rules)
    node = address(F.col("host"), F.col("path"), F.col("query")).alias("node")
    judged = materialize(rows.join(fits, ["host", "path"], "left").select("page_id", "url", "host", "path", node, "rule", "says"), "url-judged")

    said = judged.select("node", "says")
    if edges is not None:
        both = [edges.select(F.col(f"{e}_host").alias("host"), F.col(f"{e}_path").alias("path"), F.col(e).alias("node")) for e in "ab"]
        said = said.unionByName(both[0].unionByName(both[1]).distinct().join(fits, ["host", "path"]).select("node", "says"))
    said = said.where(F.col("says").isNotNull() & F.col("node").isNotNull())
    said = said.groupBy("node").agg(F.max(F.col("says") == "allow").alias("allows"))
    if edges is None:
        decided = said
    else:
        roots = materialize(components(edges.select("a", "b")), "url-roots")
        found = said.join(roots, "node", "left")
        by_root = found.groupBy(F.coalesce("root", "node").alias("root")).agg(F.max("allows").alias("allows"))
        alone = said.join(roots, "node", "left_anti")
        decided = alone.unionByName(roots.join(by_root, "root").select("node", "allows"))
    # pages without a rule ask by their address; the others need not travel
    settled = judged.where("says IS NOT NULL OR node IS NULL").withColumn("allows", F.lit(None).cast("boolean"))
    asked = judged.where("says IS NULL AND node IS NOT NULL").join(decided, "node", "left")
    alias = F.when(F.col("allows"), "allow").when(~F.col("allows"), "block")
    return settled.unionByName(asked).select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("says", alias, F.lit("allow")).alias("verdict"),
        F.col("allows").isNotNull().alias("by_alias"),
    )


def _edges(links: DataFrame) -> DataFrame:
    """Distinct edges (a, b) between addresses, each with the host and path of both ends."""
    out = links
    for end, col in (("a", "from_url"), ("b", "to_url")):
        host, path, query = host_path(F.col(col))
        out = out.withColumns({f"{end}_host": host, f"{end}_path": path, end: address(host, path, query)})
    out = out.where("a <> b OR a_path <> b_path").select("a", "b", "a_host", "a_path", "b_host", "b_path")
    return out.distinct()
