"""URL filters (operator 3): rules by host and path, and decisions carried over redirects.

Only DataFrame functions.  A rule fits its host and all subdomains when the path starts with the
rule's path; the longest rule wins.  Canonical links and meta refreshes in a page's head are edges
between URLs (host, path and query; scheme and fragment dropped).  Connected components of those
edges are found by alternating large-star and small-star steps, each written to the shared folder.
A page without a rule of its own is allowed if its component holds an explicitly allowed URL, else
blocked if it holds a blocked one, else allowed.

Defined results: a url that is null or without ``://`` has empty host and path, no rule, verdict
``allow``; null html has no edges; repeated pages are judged row by row; heads of any
length are read whole; an empty table gives none; other columns are unread.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import lower_ascii, materialize, table
from palimpsest.llm.components import components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules.
RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Up to so many rules are one expression; more are joined by host suffix.
INLINE_RULES = 200

#: Tags of a head, and their attributes one after the other, so that what stands in one's value isn't taken for another.
_LINK, _META, _BASE = r"(?is)<link[\s/][^>]*>", r"(?is)<meta[\s/][^>]*>", r"(?is)<base[\s/][^>]*>"
_ATTRIBUTE = r"""(?s)[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+))?"""
_NAME, _BEFORE, _QUOTES = r"^([^\s=]+)", r"(?s)^[^=]*=\s*", r"""^["']|["']$"""
_TARGET = r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?([^"']+)"""
#: Links with a scheme of their own: with a host, or of another kind, which is no alias.
_ABSOLUTE, _SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://", r"^[A-Za-z][A-Za-z0-9+.-]*:"
#: Character references that links hold, the ampersand last.
_REFERENCES = (("&#47;", "/"), ("&#x2F;", "/"), ("&#61;", "="), ("&#63;", "?"), ("&#38;", "&"), ("&amp;", "&"))
#: What holds no tags of the head, closed or not; the head ends where the body begins.
_HIDDEN = "(?is)<!--.*?(?:-->|\\z)|" + "|".join(rf"<{t}[\s/>].*?(?:</{t}[\s/>]|\z)" for t in ("script", "style", "noscript", "title", "textarea", "template"))
_BODY = r"(?is)<body[\s/>].*\z"


#: Host, path and query after the first ``://``.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"


def host_of(url: Column) -> Column:
    """Empty, like the path, for null and for urls without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL without scheme and fragment, host lower-cased; null where there is none."""
    return F.nullif(F.concat(host_of(url), F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://([^#]*)", 1), r"^[^/?#]*", "")), F.lit(""))


def with_rule(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` (null where none fits) to rows with host and path."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    if len(ordered) <= INLINE_RULES:
        fits = [(r, ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)) for r in ordered]
        pick = lambda part: F.coalesce(*(F.when(cond, F.lit(part(r))) for r, cond in fits), F.lit(None).cast("string"))
        return rows.withColumns({"rule": pick(lambda r: r.text), "rule_verdict": pick(lambda r: r.verdict)})
    spark = rows.sparkSession
    known = spark.createDataFrame([(r.host, r.path, r.text, r.verdict) for r in ordered], "suffix string, prefix string, text string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = (
        rows.select("host").distinct().withColumn("suffix", F.explode(suffixes)).join(known, "suffix")
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.length("text")).alias("n"), "text", "prefix", "verdict"))).alias("fit"))
    )
    out = rows.join(by_host, "host", "left").withColumn("best", F.get(F.filter("fit", lambda r: F.col("path").startswith(r["prefix"])), F.lit(0)))
    return out.withColumns({"rule": F.col("best.text"), "rule_verdict": F.col("best.verdict")}).drop("fit", "best")


def without_dots(path: Column) -> Column:
    """``.`` and ``..`` resolved; a path that ends in one ends in a slash."""
    parts = F.split(path, "/")
    start = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(x == "..", up).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    resolved = F.array_join(F.aggregate(parts, start, step), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(resolved, F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""))).otherwise(path)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name, without quotes and with character references decoded; null if there is none."""
    own = F.get(F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0)), lambda m: lower_ascii(F.regexp_extract(m, _NAME, 1)) == name), F.lit(0))
    value = F.when(F.instr(own, "=") > 0, F.regexp_replace(F.regexp_replace(own, _BEFORE, ""), _QUOTES, ""))
    for told, mark in _REFERENCES:
        value = F.replace(value, F.lit(told), F.lit(mark))
    return F.nullif(F.trim(value), F.lit(""))


def resolved(link: Column, base: Column) -> Column:
    """The URL that ``link`` means in a page or base ``base``; null for a scheme without a host."""
    scheme, host, path = F.substring_index(base, "://", 1), host_of(base), path_of(base)
    root, folder = F.concat(scheme, F.lit("://"), host), F.regexp_extract(path, r"^(.*/)?", 0)
    in_path = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    rest = F.substr(link, F.length(in_path) + 1)
    return (
        F.when(link.rlike(_ABSOLUTE), link)
        .when(link.rlike(_SCHEME), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, without_dots(in_path), rest))
        .when(link.startswith("?"), F.concat(root, path, link))
        .when(link.startswith("#"), base)
        .otherwise(F.concat(root, without_dots(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), in_path)), rest))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) nodes from all canonical links and meta refreshes in the heads.

    A link is canonical if one of the words of its ``rel`` is; links are relative to the first ``<base href>``, or the page.
    """
    low = lower_ascii(F.col("html"))
    some = pages.where(low.contains("canonical") | low.contains("refresh")).select("url", "html")
    head = F.regexp_replace(F.regexp_replace("html", _HIDDEN, " "), _BODY, "")
    tags = lambda tag: F.regexp_extract_all("head", F.lit(tag), F.lit(0))
    words = lambda x: F.split(lower_ascii(F.coalesce(x, F.lit(""))), r"\s+")
    canonical = F.transform(F.filter(tags(_LINK), lambda x: F.array_contains(words(attribute(x, "rel")), "canonical")), lambda x: attribute(x, "href"))
    refresh = F.transform(F.filter(tags(_META), lambda x: lower_ascii(attribute(x, "http-equiv")) == "refresh"), lambda x: F.trim(F.regexp_extract(attribute(x, "content"), _TARGET, 1)))
    base = F.get(F.filter(F.transform(tags(_BASE), lambda x: attribute(x, "href")), lambda x: x.isNotNull()), F.lit(0))
    shown = some.select("url", head.alias("head")).select("url", F.concat(canonical, refresh).alias("links"), base.alias("base"))
    links = shown.select("url", "base", F.explode("links").alias("link")).where("link <> ''")
    links = links.withColumn("base", F.coalesce(resolved(F.col("base"), F.col("url")), "url"))
    found = links.select(node_of(F.col("url")).alias("src"), node_of(resolved(F.col("link"), F.col("base"))).alias("dst"))
    return found.where("src <> dst").distinct()


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, *, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) for every row of ``pages``.

    ``edges`` (src, dst URLs as from ``node_of``) replaces the links found in the html.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    judged = with_rule(parsed, rules)
    edges = materialize(alias_edges(pages) if edges is None else edges, "aliases")
    if edges.isEmpty():
        judged = judged.withColumns({"component": F.lit(None).cast("string"), "method": F.lit("allow")})
    else:
        member = components(edges)
        url = F.concat(F.lit("x://"), F.col("node"))
        ruled = with_rule(member.select("node", "component", host_of(url).alias("host"), path_of(url).alias("path")), rules)
        decided = ruled.groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked"))
        method = F.when(F.col("blocked") & ~F.coalesce("allowed", F.lit(False)), "block").otherwise("allow")
        by_node = member.join(decided, "component").select("node", "component", method.alias("method"))
        # rows without a node have no decision to meet: they are dealt out evenly
        dealt = F.coalesce("node", F.concat(F.lit("#"), F.rand(7).cast("string")))
        judged = judged.withColumn("node", dealt).join(materialize(by_node, "decisions"), "node", "left")
    verdict = F.coalesce("rule_verdict", "method", F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """DuckDB SQL of the same result; components by a recursive closure."""
    quote = lambda x: x.replace("'", "''")

    def parts(url: str) -> tuple[str, str, str]:
        host = rf"translate(regexp_extract({url}, '{_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        tail = rf"regexp_replace(regexp_extract({url}, '(?s)^.*?://([^#]*)', 1), '^[^/?#]*', '')"
        return host, rf"regexp_extract({url}, '{_PARTS}', 2)", f"nullif({host} || {tail}, '')"

    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    case = lambda part: "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{part(r)}'" for r in ordered) + " END"
    host, path, node = parts("coalesce(url, '')")
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def own(tag: str, name: str) -> str:
        found = f"list_filter(regexp_extract_all({tag}, '{quote(_ATTRIBUTE)}'), lambda m: {low(f"regexp_extract(m, '{_NAME}', 1)")} = '{name}')[1]"
        value = f"CASE WHEN strpos({found}, '=') > 0 THEN regexp_replace(regexp_replace({found}, '{_BEFORE}', ''), '{quote(_QUOTES)}', '', 'g') END"
        for told, mark in _REFERENCES:
            value = f"replace({value}, '{told}', '{mark}')"
        return f"nullif(trim({value}), '')"

    def means(link: str, base: str) -> str:
        h, p_, _ = parts(base)
        folder = f"CASE WHEN regexp_extract({p_}, '^(.*/)?', 0) = '' THEN '/' ELSE regexp_extract({p_}, '^(.*/)?', 0) END"
        inp = f"regexp_extract({link}, '(?s)^([^?#]*)', 1)"
        whole = f"(CASE WHEN starts_with({link}, '/') THEN {inp} ELSE {folder} || {inp} END)"
        dots = rf"""CASE WHEN regexp_matches({whole}, '(^|/)\.\.?(/|$)') THEN array_to_string(list_reduce(list_transform(string_split({whole}, '/'), lambda s: [s]), lambda a, x:
            CASE WHEN x[1] = '..' THEN a[1:greatest(len(a) - 1, 1)] WHEN x[1] = '.' THEN a ELSE list_concat(a, x) END), '/') || CASE WHEN regexp_matches({whole}, '/\.\.?$') THEN '/' ELSE '' END ELSE {whole} END"""
        scheme = f"split_part({base}, '://', 1)"
        return f"""CASE WHEN regexp_matches({link}, '{_ABSOLUTE}') THEN {link} WHEN regexp_matches({link}, '{_SCHEME}') THEN NULL WHEN starts_with({link}, '//') THEN {scheme} || ':' || {link}
            WHEN starts_with({link}, '?') THEN {scheme} || '://' || {h} || {p_} || {link} WHEN starts_with({link}, '#') THEN {base}
            ELSE {scheme} || '://' || {h} || {dots} || substring({link}, length({inp}) + 1) END"""

    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    case = lambda part: "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{part(r)}'" for r in ordered) + " END"
    target, node_host, node_path = parts("dst_url")[2], parts("'x://' || node")[0], parts("'x://' || node")[1]
    return rf"""
WITH RECURSIVE p AS (SELECT page_id, url, {host} AS host, {path} AS path, {node} AS node FROM pages),
q AS MATERIALIZED (SELECT url, {node} AS src, regexp_replace(regexp_replace(html, '{quote(_HIDDEN)}', ' ', 'g'), '{_BODY}', '') AS head FROM pages),
g AS MATERIALIZED (SELECT url, src, list_filter(list_transform(regexp_extract_all(head, '{_BASE}'), lambda x: {own("x", "href")}), lambda x: x IS NOT NULL)[1] AS told,
    list_concat(list_transform(list_filter(regexp_extract_all(head, '{_LINK}'), lambda x: list_contains(regexp_split_to_array({low(f"coalesce({own('x', 'rel')}, '')")}, '\s+'), 'canonical')), lambda x: {own("x", "href")}),
    list_transform(list_filter(regexp_extract_all(head, '{_META}'), lambda x: {low(own("x", "http-equiv"))} = 'refresh'), lambda x: trim(regexp_extract({own("x", "content")}, '{quote(_TARGET)}', 1)))) AS links FROM q),
l AS MATERIALIZED (SELECT src, coalesce({means("told", "url")}, url) AS base, unnest(links) AS link FROM g),
t AS MATERIALIZED (SELECT src, {means("link", "base")} AS dst_url FROM l WHERE link <> ''),
e AS (SELECT DISTINCT src, {target} AS dst FROM t WHERE src <> {target}),
both_ways AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach(node, other) AS (SELECT a, a FROM both_ways UNION SELECT r.node, b FROM reach r JOIN both_ways ON r.other = a),
member AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
ruled AS (SELECT component, {case(lambda r: r.verdict)} AS v FROM (SELECT component, {node_host} AS host, {node_path} AS path FROM member)),
decided AS (SELECT component, coalesce(bool_or(v = 'allow'), false) AS allowed, coalesce(bool_or(v = 'block'), false) AS blocked FROM ruled GROUP BY component)
SELECT page_id, host, path, {case(lambda r: r.text)} AS rule,
    coalesce({case(lambda r: r.verdict)}, CASE WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END) AS verdict, component
FROM p LEFT JOIN member USING (node) LEFT JOIN decided USING (component)
"""
