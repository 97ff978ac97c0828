"""Operator 3 against a plain version over redirects, and rules one by one."""

import random
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import duckdb

from palimpsest.llm.url_filter import RULES, Rule, alias_edges, judge_urls, oracle_sql, query, with_rule

PAGES = "page_id long, url string, html string"


def page(kind, to):
    return {"c": f'<html><head><link rel="canonical" href="{to}"></head><body>x</body></html>', "r": f'<head><meta http-equiv=refresh content="0; url={to}"></head>', "": "<html><head></head></html>"}[kind]


def judged(spark, rows, **more):
    return {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, PAGES), **more).collect()}


def test_rules(spark):
    urls = ["http://a.NET/x", "https://www.example.net/en/1", "http://example.com/de/", "http://example.com/en/", "ftp://x.org/fr/?q", "http://netx/", "nothing", None, "http://net", "http://u.net?x://y", "a://b.net/en#://c"]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [got[i].rule for i in range(11)] == ["net/", "example.net/en/", "example.com/de/", None, "org/fr/", None, None, None, None, None, "net/"]
    assert [got[i].verdict for i in range(11)] == ["block", "allow", "block"] + ["allow"] * 7 + ["block"]
    assert (got[0].host, got[0].path, got[6].host, got[7].path, got[9].host) == ("a.net", "/x", "", "", "u.net")


def test_decisions_travel_over_aliases(spark):
    rows = [
        (1, "http://a.com/1", page("c", "http://bad.net/1")),
        (2, "http://b.com/2", page("r", "http://a.com/1")),
        (3, "http://c.com/3", page("c", "/4")),
        (4, "http://c.com/4", page("r", "http://x.org/fr/1")),
        (5, "http://c.com/5", page("c", "http://bad.net/5")),
        (6, "http://c.com/4", page("c", "http://c.com/5")),
        (7, "http://d.com/7", page("", "")),
        (8, "http://bad.net/1", page("c", "http://x.org/fr/1")),
    ]
    got = judged(spark, rows[:7])
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow"}
    got = judged(spark, rows)  # an allowed alias sets its component free, but not a page with a rule of its own
    assert {got[k].verdict for k in (1, 2)} == {"allow"} and got[8].verdict == "block"


def test_a_long_chain(spark):
    rows = [(i, f"http://e.com/{i}", page("c", f"http://e.com/{i + 1}")) for i in range(70)] + [(70, "http://e.com/70", page("c", "http://z.net/"))]
    assert {r.verdict for r in judged(spark, rows).values()} == {"block"}


def test_many_rules_join(spark):
    rules = [*RULES, *(Rule("block", f"h{i}.example.se", "/p/") for i in range(300))]
    frame = spark.createDataFrame([("h7.example.se", "/p/1"), ("a.h7.example.se", "/q"), ("z.net", "/"), ("example.net", "/en/x"), ("", "")], "host string, path string")
    few, many = with_rule(frame, RULES).collect(), with_rule(frame, rules).orderBy("host").collect()
    assert {r.host: r.rule for r in many} == {r.host: r.rule for r in few} | {"h7.example.se": "h7.example.se/p/"}


def test_links_as_browsers_read_them(spark):
    """Upper-case body, several links, references, dots: who is an alias of whom."""
    body = lambda head, inside="": f"<HTML><HEAD>{head}</HEAD><BODY>{inside}</BODY></HTML>"
    link = lambda to: f"<link rel=canonical href='{to}'>"
    rows = [
        (1, "http://a.com/x/y/1", body(link("../z/./2"))), (2, "http://b.com/1", body("", link("http://c.com/"))), (3, "http://d.com/1", body(link("http://e.com/") + link("http://f.com/"))),
        (4, "http://g.com/1", body(link("/a&#47;b?x=1&amp;y=2"))), (5, "http://h.com/a/b/", body(link(".."))), (6, "http://i.com", body(link("../../k"))),
    ]
    got = {(r.src, r.dst) for r in alias_edges(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {
        ("a.com/x/y/1", "a.com/x/z/2"), ("d.com/1", "e.com/"), ("d.com/1", "f.com/"), ("g.com/1", "g.com/a/b?x=1&y=2"), ("h.com/a/b/", "h.com/a/"), ("i.com", "i.com/k"),
    }


class Links(HTMLParser):
    """Canonical links and refreshes of a head by another parser."""

    def __init__(self, url):
        super().__init__()
        self.base, self.found, self.over, self.based, self.hidden = url, [], False, False, 0

    def handle_starttag(self, tag, attrs):
        own = {}
        for k, v in attrs:
            own.setdefault(k, v)
        if tag in ("noscript", "template", "title"):  # this parser reads tags in a title, browsers don't
            self.hidden += 1
        self.over = self.over or tag == "body" and not self.hidden
        if self.over or self.hidden:
            return
        if tag == "base" and own.get("href") and not self.based:
            self.base, self.based = urljoin(self.base, own["href"].strip()), True
        to = (own.get("href") or "").strip() if tag == "link" and "canonical" in (own.get("rel") or "").lower().split() else None
        if tag == "meta" and (own.get("http-equiv") or "").strip().lower() == "refresh":
            to = re.sub(r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?([^"']+).*""", r"\1", own["content"]).strip() if re.search("(?i)[;,]\\s*url", own.get("content") or "") else None
        if to:
            self.found.append(to)

    def handle_endtag(self, tag):
        self.hidden -= tag in ("noscript", "template", "title")


def test_heads_against_another_parser(spark, tmp_path):
    r = random.Random(17)
    targets = ["/go?next=https://bad.net/x", "https://bad.net/a", "//c.com/b?x=1&amp;y=2", "../up/./x", "?q=1", "#top", "mailto:a@b.net", "javascript:void(0)", "https:x", "plain", "HTTP://D.NET/e#f", "a/b:c/d", " /spaced "]
    make = [
        lambda t: f'<link rel="canonical" href="{t}">', lambda t: f"<link href='{t}' rel=canonical />", lambda t: f'<LINK REL="alternate Canonical" HREF="{t}">', lambda t: f'<link rel="canonical-ish" href="{t}">', lambda t: f'<link data-href="http://no.net/" rel="canonical" href="{t}">',
        lambda t: f'<link rel="canonical" title="x href=http://no.net/ y" href="{t}">', lambda t: f'<link rel="canonical" data-href="{t}">', lambda t: f'<link data-rel="canonical" href="{t}">', lambda t: f'<meta http-equiv="refresh" content="5; url={t}">',
        lambda t: f"<meta http-equiv=Refresh content=\"0;URL='{t}'\">", lambda t: f'<meta name="refresh" content="0; url={t}">', lambda t: '<meta http-equiv="refresh" content="30">', lambda t: f'<script>var s = "<body><link rel=canonical href={t}>";</script>', lambda t: f'<!-- <link rel="canonical" href="{t}"> -->',
        lambda t: f'<noscript><link rel="canonical" href="{t}"></noscript>', lambda t: f'<title>about <body> and <link rel="canonical" href="{t}"></title>', lambda t: '<base href="http://base.se/d/e">', lambda t: '<base target=_top>', lambda t: '<base href="sub/">', lambda t: f'<linker rel="canonical" href="{t}">',
    ]
    rows, edges = [], set()
    for i in range(1500):
        url = r.choice(["http://a.com/x/y/1", "https://b.com", "http://c.com/p?q=1", "http://D.com/z/"]) + r.choice(["", f"?i={i}"])
        head = "".join(r.choice(make)(r.choice(targets)) for _ in range(r.randrange(4)))
        html = f"<html><head>{head}</head>" + r.choice(["<body>", "<BODY class=x>", "<body\n>"]) + '<link rel="canonical" href="http://inbody.net/"></body></html>'
        rows.append((i, url, html))
        parser = Links(url)
        parser.feed(html)
        node = lambda u: (lambda rest: re.sub("^[^/?#]*", lambda m: m[0].lower(), rest.partition("#")[0]))(u.partition("://")[2])
        for to in parser.found:
            full = urljoin(parser.base, to)
            if re.match("^[a-zA-Z][a-zA-Z0-9+.-]*:(?!//)", to) is None and "://" in full and node(url) != node(full):
                edges.add((node(url), node(full)))
    frame = spark.createDataFrame(rows, PAGES)
    got = {(e.src, e.dst) for e in alias_edges(frame).collect()}
    assert got == edges, (sorted(got - edges)[:5], sorted(edges - got)[:5])
    assert len(got) > 200 and not any("no.net" in b or "inbody" in b for _, b in got)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = db.execute(oracle_sql())
    at = {c[0]: k for k, c in enumerate(found.description)}
    assert {x.page_id: (x.rule, x.verdict, x.component) for x in query(spark, str(tmp_path)).collect()} == {x[at["page_id"]]: (x[at["rule"]], x[at["verdict"]], x[at["component"]]) for x in found.fetchall()}


def linked_pages(n, seed):
    """Dense links: a hub that a third of the pages name, chains, random links, rules on some."""
    r = random.Random(seed)
    urls = [f"http://s{r.randrange(40)}.{r.choice(['com', 'net', 'org', 'example.net', 'se'])}/{r.choice(['en', 'fr', 'x'])}/{i}" for i in range(n)]
    rows = []
    for i, u in enumerate(urls):
        how = r.random()
        to = urls[0] if how < 0.33 else urls[i - 1] if how < 0.5 else r.choice(urls) if how < 0.6 else f"/moved/{i}" if how < 0.7 else None
        rows.append((i, u, page(r.choice("cr"), to) if to else page("", "")))
    return rows + [(n + k, None, None) for k in range(n // 10)] + [(2 * n + k, urls[1], page("c", urls[2])) for k in range(n // 10)]


def test_dense_links_against_union_find_and_sql(spark, tmp_path):
    rows = linked_pages(1500, 3)
    frame = spark.createDataFrame(rows, PAGES)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict, r.component) for r in query(spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = db.execute(oracle_sql())
    at = {c[0]: k for k, c in enumerate(found.description)}
    assert got == {r[at["page_id"]]: (r[at["rule"]], r[at["verdict"]], r[at["component"]]) for r in found.fetchall()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for e in alias_edges(frame).collect():
        a, b = sorted((root(e.src), root(e.dst)))
        parent[b] = a
    sizes = {}
    for x in list(parent):
        sizes.setdefault(root(x), []).append(x)
    least = {root(x): min(xs) for x, xs in ((x, sizes[root(x)]) for x in list(parent))}
    for i, u, _ in rows:
        node = u and u.partition("://")[2]
        assert got[i][2] == (least[root(node)] if node in parent else None)
    assert max(map(len, sizes.values())) > 500 and len(sizes) > 20


def test_native_and_odd_rows(spark, sf_dir):
    from palimpsest.llm.common import table

    assert not any(k in query(spark, sf_dir)._jdf.queryExecution().toString() for k in ("Python", "Arrow", "Pandas"))
    assert query(spark, sf_dir).count() == table(spark, sf_dir, "pages").count()
    rows = [(None, None, None), (1, "http://a.com", None), (1, "http://a.com", ""), (2, "", page("c", "http://x.net/"))]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS component", "'x' AS verdict", "0 AS src")
    assert sorted(r.verdict for r in judge_urls(frame).collect()) == ["allow"] * 4
    assert judge_urls(frame.limit(0)).count() == 0 and alias_edges(frame).count() == 0
