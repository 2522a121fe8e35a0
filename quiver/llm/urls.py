"""Operator 10: URL filters by redirect equivalence. DataFrame functions only.

Rules decide urls directly. URLs that are the same page are aliases: those
with one normal form (no scheme, fragment, ``utm_`` parameters or trailing
slash), those whose page names a canonical link, and those that redirect by
``meta refresh``. Aliases form the connected components of these edges, and
a block decision reaches every alias without a rule of its own; an allow
rule always stands for the urls that it fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import connected_components, lower_ascii, materialize
from quiver.session import tune

# The contract's rules (verdict, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Rules up to which they are a literal in the plan; a longer list is a table that suffixes of the hosts join.
MAX_RULES = 2000
_ATTR = r"""=\s*["']?"""


def with_parts(df: DataFrame, url: str, out: str = "") -> DataFrame:
    """Adds {out}host, {out}path and {out}node (the normal form) of a url column.

    The normal form has host without its scheme's port, path without dot segments and
    trailing slash, and query without ``utm_`` parameters; it is null for a url without a host.
    """
    at = F.instr(url, "://")
    df = df.withColumn(f"{out}rest", F.when(at > 0, F.substr(F.col(url), at + F.lit(3))).otherwise(F.lit("")))
    df = df.withColumn(f"{out}rest", F.coalesce(f"{out}rest", F.lit("")))
    df = df.withColumn(f"{out}host", lower_ascii(F.regexp_extract(f"{out}rest", r"^([^/?#]*)", 1)))
    df = df.withColumn(f"{out}path", F.regexp_extract(f"{out}rest", r"^[^/?#]*([^?#]*)", 1))
    query = F.regexp_replace(F.regexp_extract(f"{out}rest", r"^[^?#]*([^#]*)", 1), r"(?<=[?&])utm_[^&]*&?", "")
    df = df.withColumn(f"{out}query", F.regexp_replace(query, r"[?&]$", ""))
    scheme, host = F.lower(F.substr(F.col(url), F.lit(1), at - 1)), F.col(f"{out}host")
    site = (F.when((scheme == "https") & F.endswith(host, F.lit(":443")), F.regexp_replace(host, ":443$", ""))
            .when((scheme == "http") & F.endswith(host, F.lit(":80")), F.regexp_replace(host, ":80$", "")).otherwise(host))
    node = F.concat(site, F.regexp_replace(without_dots(F.col(f"{out}path")), "/$", ""), F.col(f"{out}query"))
    return df.withColumn(f"{out}node", F.when(host != "", node)).drop(f"{out}rest", f"{out}query")


def without_dots(path: Column) -> Column:
    """A path whose ``.`` and ``..`` segments are resolved."""
    parts = F.split(F.regexp_replace(path, r"/\.\.?$", "$0/"), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(
        x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x))))
    return F.when(F.contains(path, F.lit("/.")), F.array_join(kept, "/")).otherwise(path)


def _ranked(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))


def with_fit(df: DataFrame, host: str, path: str, rules: Sequence[tuple[str, str, str]], max_rules: int = MAX_RULES) -> DataFrame:
    """``df`` with ``fit``, the struct of ``fitting_rule``. Of more than ``max_rules`` rules a
    url tries those of its host's suffixes, found by a join."""
    if len(rules) <= max_rules:
        return df.withColumn("fit", fitting_rule(F.col(host), F.col(path), rules))
    table = df.sparkSession.createDataFrame([(i, h + p, v, h, p) for i, (v, h, p) in enumerate(_ranked(rules))],
                                            "rank long, rule string, verdict string, host string, path string")
    urls = df.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = urls.select("h", "p", F.explode(F.array_distinct(tails)).alias("tail")).join(table, F.col("tail") == F.col("host"))
    best = tried.where(F.startswith("p", F.col("path"))).groupBy("h", "p").agg(
        F.min_by(F.struct("rule", "verdict", "host", "path"), "rank").alias("fit"))
    d = df.alias("d")
    return d.join(best, F.col(f"d.{host}").eqNullSafe(F.col("h")) & F.col(f"d.{path}").eqNullSafe(F.col("p")), "left").select("d.*", "fit")


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. Of
    equally long ones the first by text, allow before block."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string,host:string,path:string>")
    ranked = _ranked(rules)
    literal = F.array(*[F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"),
                                 F.lit(p).alias("path")) for v, h, p in ranked])
    fits = F.filter(literal, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    return F.get(fits, F.lit(0))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b, to_host, to_path): normal forms joined by a canonical link or a
    redirect, and the target's own host and path, which rules are tried on.

    All links of a page count; ``&amp;`` is read as ``&``; targets are resolved
    against the page's url (``?`` alone, ``/``, ``//``, folders with dots)."""
    url, html = F.col(url_col).cast("string"), F.regexp_replace(F.col(html_col).cast("string"), r"(?s)<!--.*?(-->|$)", "")
    link = F.regexp_extract_all(html, F.lit(rf"""(?is)<link\b(?=[^>]*\brel{_ATTR}canonical\b)[^>]*\bhref{_ATTR}([^"'\s>]+)"""), 1)
    meta = F.regexp_extract_all(html, F.lit(rf"""(?is)<meta\b(?=[^>]*\bhttp-equiv{_ATTR}refresh\b)[^>]*\burl\s*=\s*['"]?([^"'\s>]+)"""), 1)
    found = pages.select(url.alias("url"), F.explode(F.concat(link, meta)).alias("t")).where("url is not null")
    found = found.withColumn("t", F.regexp_replace("t", "&(amp|#38|#x26);", "&")).where(~F.startswith("t", F.lit("#")))
    found = with_parts(found, "url")
    scheme = F.regexp_extract("url", r"^([^:/?#]+)://", 1)
    site = F.concat(scheme, F.lit("://"), F.col("host"))
    page = F.coalesce(F.nullif(F.col("path"), F.lit("")), F.lit("/"))
    folder = F.coalesce(F.nullif(F.regexp_extract("path", r"^(.*/)?", 1), F.lit("")), F.lit("/"))
    target = (F.when(F.rlike("t", F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), F.col("t"))
              .when(F.startswith("t", F.lit("//")), F.concat(scheme, F.lit(":"), F.col("t")))
              .when(F.startswith("t", F.lit("/")), F.concat(site, F.col("t")))
              .when(F.startswith("t", F.lit("?")), F.concat(site, page, F.col("t")))
              .otherwise(F.concat(site, folder, F.col("t"))))
    both = with_parts(found.withColumn("target", target), "target", "to_")
    both = both.withColumn("to_host", F.regexp_replace("to_host", ":(80|443)$", "")).withColumn("to_path", without_dots(F.col("to_path")))
    return both.select(F.col("node").alias("a"), F.col("to_node").alias("b"), "to_host", "to_path")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
               url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, component.

    The rule's verdict stands where one fits. Otherwise the verdict is block
    if any alias is blocked by a rule, else allow: an allowed alias does not
    lift a block from others, and a block never overrides an allow rule.
    component is the smallest normal form of the alias group, null without a
    host. Null urls and those without ``://`` have empty host and path, fit
    no rule unless one is empty, and are allowed. Null and empty html has no links;
    a long one is read whole, in time proportional to its length.
    Repeated rows are judged alike; empty input gives no rows; extra columns
    are ignored. ``html_col`` None: the table has no html.
    """
    tune(pages.sparkSession)
    url = F.col(url_col).cast("string")
    judged = with_parts(pages.select(F.col(id_col).alias("page_id"), url.alias("url")), "url")
    judged = with_fit(judged, "host", "path", rules)
    judged = judged.select("page_id", "host", "path", "node", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("own"))
    judged = materialize(judged, "judged-urls")
    if html_col is None:
        named = judged.withColumn("component", F.col("node"))
    else:
        # written first: a filter on the edges would be pushed into every parsing step
        edges = materialize(alias_edges(pages, url_col, html_col), "alias-edges")
        comp = connected_components(edges)
        comp = materialize(comp, "aliases")
        # targets of links that are not pages themselves have a verdict, too
        named = judged.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
        targets = edges.select(F.col("b").alias("node"), "to_host", "to_path").distinct()
        targets = with_fit(targets, "to_host", "to_path", rules).where("fit.verdict = 'block'")
        # a target may have no alias but the page that names it
        outside = targets.select("node").distinct().join(comp, "node", "left").select(F.coalesce("component", "node").alias("component"))
    blocked = named.where("own = 'block'").select("component")
    if html_col is not None:
        blocked = blocked.union(outside)
    blocked = blocked.distinct().withColumn("blocked", F.lit(True))
    return named.join(blocked, "component", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"), "component")
