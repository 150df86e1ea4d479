"""URL filter with redirect equivalence.

A rule is a host and a path; it fits its host and all subdomains if the url's
path starts with the rule's. The longest rule that fits decides a page. Pages
that redirect or point to one another (meta refresh, canonical link, og:url)
are aliases: connected components over these edges, found by distributed joins,
carry decisions to the pages that no rule fits. In a component an allow goes
before any block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import lower_ascii, remove, stored
from samewise.llm.components import connected_components

#: The rules of the query: verdict by rule.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Up to so many rules become one expression; more are joined by host suffix.
MOST_INLINE = 64

_TARGETS = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bproperty\s*=\s*["']?og:url\b)[^>]*\bcontent\s*=\s*["']?([^"'\s>]+)""",
)
_HINT = r"(?i)\b(canonical|refresh|og:url)\b"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if the url is null or has no ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: str) -> Column:
    domain, _, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)


def with_rule(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``urls`` (with columns host, path and a unique key) with the longest rule that fits (null if none) as ``rule``; ties go to the rule that sorts first."""
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    if len(rules) <= MOST_INLINE:
        found = F.lit(None).cast("string")
        for rule in reversed(ordered):
            found = F.when(_fits(F.col("host"), F.col("path"), rule), F.lit(rule)).otherwise(found)
        return urls.withColumn("rule", found)
    spark = urls.sparkSession
    listed = spark.createDataFrame([(r.partition("/")[0], "/" + r.partition("/")[2], r) for r in rules], "domain string, prefix string, rule string")
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host", "path").distinct()
    fits = hosts.withColumn("domain", F.explode(domains)).join(listed, "domain").where(F.col("path").startswith(F.col("prefix")))
    best = fits.groupBy("host", "path").agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule")).alias("best")).select("host", "path", "best.rule")
    return urls.join(best, ["host", "path"], "left")


def node_of(url: Column) -> Column:
    """What stands for a url among aliases: host, path and query, whatever the scheme and fragment."""
    return F.concat(host_of(url), path_of(url), F.regexp_extract(_after_scheme(url), r"(\?[^#]*)", 1))


def alias_edges(pages: DataFrame) -> DataFrame:
    """node, target and target's url for each redirect or canonical link in a page's html; relative targets are resolved against the page."""
    hinted = pages.select("url", "html").where(F.col("url").contains("://") & F.col("html").rlike(_HINT))
    targets = F.flatten(F.array(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in _TARGETS]))
    found = hinted.select("url", F.explode(targets).alias("raw")).withColumn("raw", F.replace("raw", F.lit("&amp;"), F.lit("&")))
    root = F.concat(F.regexp_extract("url", r"^(.*?://)", 1), host_of(F.col("url")))
    scheme = F.regexp_extract("url", r"^(.*?:)//", 1)
    folder = F.regexp_extract(path_of(F.col("url")), r"^(.*/)", 1)
    target = (
        F.when(F.col("raw").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("raw"))
        .when(F.startswith("raw", F.lit("//")), F.concat(scheme, "raw"))
        .when(F.startswith("raw", F.lit("/")), F.concat(root, "raw"))
        .when(F.col("raw").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^#"), F.lit(None).cast("string"))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("raw")))
    )
    return found.select(node_of(F.col("url")).alias("node"), "url", target.alias("target_url")).where(F.col("target_url").isNotNull()).withColumn("target", node_of(F.col("target_url")))


def judged(pages: DataFrame, rules: dict[str, str], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict and alias_verdict of each page.

    The verdict is the rule's; where no rule fits, that of the page's aliases
    (allow before block); else ``default``. Rules also judge link targets that
    are no page here. A null url, or one without ``://``, has empty host and
    path, no rule and no alias. Rows stay as they are; repeated urls are one
    node. Without any edge no join is made; an empty table gives no rows. Very long
    urls are nodes like others, and only the columns named above are read.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = with_rule(rows, rules)
    verdicts = F.create_map(*[F.lit(x) for item in rules.items() for x in item]) if rules else F.create_map(F.lit(""), F.lit(""))
    edges, edges_at = stored(alias_edges(pages), "alias-edges")
    if edges.isEmpty():
        remove(pages.sparkSession, [edges_at])
        found = rows.withColumn("alias_verdict", F.lit(None).cast("string"))
    else:
        nodes = connected_components(edges, "node", "target")
        ends = edges.select("node", "url").unionByName(edges.select(F.col("target").alias("node"), F.col("target_url").alias("url"))).dropDuplicates(["node"])
        ends = with_rule(ends.select("node", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules).withColumn("said", verdicts[F.col("rule")])
        said = ends.join(nodes, "node").groupBy("component").agg(F.min("said").alias("alias_verdict"))  # allow sorts before block
        by_node = nodes.join(said, "component").select(F.col("node").alias("alias_node"), "alias_verdict")
        keyed = rows.withColumn("alias_key", F.when(F.col("url").contains("://"), node_of(F.col("url"))))
        found = keyed.join(by_node, keyed["alias_key"] == by_node["alias_node"], "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], "alias_verdict", F.lit(default)).alias("verdict"), "alias_verdict")


def _oracle(rules: dict[str, str]) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    fits = "\n".join(
        f"when (host = '{d}' or ends_with(host, '.{d}')) and starts_with(path, '/{p}') then '{r}'" for r in ordered for d, _, p in [r.partition("/")]
    )
    said = " ".join(f"when '{r}' then '{v}'" for r, v in rules.items())
    return rf"""
with recursive cut as (
  select page_id, url, html, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as tail from pages
), parts as (
  select page_id, url, html, coalesce(translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(tail, '^[^/?#]*([^?#]*)', 1), '') as path, coalesce(regexp_extract(tail, '(\?[^#]*)', 1), '') as query from cut
), ruled as (
  select *, host || path || query as node, case {fits} else null end as rule from parts
), links as (
  select node, unnest(list_concat(
    regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract_all(html, '(?is)<meta\b[^>]*\bproperty\s*=\s*["'']?og:url\b[^>]*\bcontent\s*=\s*["'']?([^"''\s>]+)', 1))) as target
  from ruled where contains(url, '://') and html is not null
), targets as (
  select node, substr(target, strpos(target, '://') + 3) as tail from links where contains(target, '://')
), edges as (
  select node as a, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(tail, '^[^/?#]*([^#]*)', 1) as b from targets
), both_ways as (select a, b from edges union select b, a from edges),
reach as (select a as node, b as other from both_ways union select r.node, e.b from reach r join both_ways e on e.a = r.other),
ends as (
  select distinct b as node, regexp_extract(b, '^([^/?#]*)', 1) as host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) as path from both_ways
), judged as (select node, case case {fits} else null end {said} end as verdict from ends),
aliases as (select r.node, min(j.verdict) as alias_verdict from reach r join judged j on j.node = r.other group by r.node)
select page_id, host, path, rule, coalesce(case rule {said} end, alias_verdict, 'allow') as verdict, alias_verdict
from ruled left join aliases on aliases.node = ruled.node and contains(ruled.url, '://')
"""


ORACLE_SQL = _oracle(RULES)
