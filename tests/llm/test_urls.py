"""URL filter: rules and decisions that links hand on."""

import duckdb

from cartloom.llm import urls

BAD = "http://x.net/fr/bad"
CASES = [
    (f'<!-- <link rel="canonical" href="{BAD}"> -->', None),
    (f'<!--><link rel="canonical" href="{BAD}">', BAD),
    (f'<!-- never closed <link rel="canonical" href="{BAD}">', None),
    (f'<script>var x = \'<link rel="canonical" href="{BAD}">\';</script><p>', None),
    (f'<title><link rel="canonical" href="{BAD}"></title><link rel="canonical" href="/ok">', "http://free.org/ok"),
    (f'<link rel="shortlink canonical" href="{BAD}">', BAD),
    (f'<link title="rel=canonical" rel=icon href="{BAD}">', None),
    (f'<link data-rel="canonical" href="{BAD}">', None),
    (f'<LINK HREF={BAD} REL=Canonical>', BAD),
    (f'<link rel="canonical" data-href="/no" href=" {BAD} " />', BAD),
    ('<link rel="canonical" href="/fr/&#121;&#x79;&amp;z&eacute;">', "http://free.org/fr/yy&z&eacute;"),
    ('<link rel="canonical" href="/&#233;&#x1F600;&#xD800;&#9999999;">', "http://free.org/é\U0001f600&"),
    (f'<meta http-equiv="refresh" content="0; url=\'{BAD}\'">', BAD),
    (f"<meta http-equiv='refresh' content='0;URL=\"{BAD}\"'>", BAD),
    (f'<meta content="5, {BAD}" http-equiv="Refresh">', BAD),
    (f'<meta http-equiv="refresh" content="0;url=&#39;{BAD}&#39;">', BAD),
    ('<meta http-equiv="refresh" content="30">', None),
    ('<meta http-equiv="refresh" content="0;url=">', None),
    (f'<meta name="description" content="0;url={BAD}">http-equiv', None),
    (f'<base href=""><base href="//x.net/fr/q"><base href="/no/"><link rel="canonical" href="bad">', BAD),
    ('<linked rel="canonical" href="/x">', None),
]


def test_rules_and_links(spark):
    link = '<link href="{}" rel=canonical>'
    rows = [
        (1, "http://A.Example.COM/en/x?y#z", ""), (2, "https://www.example.com/en/1", ""), (3, "http://x.net/es/1", None), (4, "http://notcom/es/", ""),
        (5, None, ""), (6, "no scheme", ""), (7, "http://com", ""), (8, "ftp://net/fr/a://b", ""), (9, "http://free.org/a", link.format("http://x.net/fr/bad")),
        (10, "http://free.org/b#top", '<meta http-equiv="refresh" content="0; url=http://free.org/a">'), (11, "http://free.org/c", link.format("http://other.org/")),
        (12, "http://ok.com/p", link.format("http://x.net/fr/bad")), (10, "http://free.org/b#top", ""), (13, "http://example.com/en", link.format("/relative")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'h' AS host", "'p' AS path", "1 AS n")
    out = urls.judge(pages, urls.rule_table(spark), urls.link_edges(pages))
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    assert got == sorted([
        (1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (3, "x.net", "/es/1", "net/es/", "block"),
        (4, "notcom", "/es/", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "com", "", None, "allow"), (8, "net", "/fr/a://b", "net/fr/", "block"),
        (9, "free.org", "/a", None, "block"), (10, "free.org", "/b", None, "block"), (10, "free.org", "/b", None, "block"), (11, "free.org", "/c", None, "allow"),
        (12, "ok.com", "/p", "com/", "allow"), (13, "example.com", "/en", "com/", "allow"),
    ])
    assert urls.judge(pages.where("false"), urls.rule_table(spark), urls.link_edges(pages.where("false"))).count() == 0


def test_relative_links_and_letter_case(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://free.org/promo", link.format("/fr/1")), (2, "http://a.net/promo", link.format("/fr/promo")), (3, "http://a.net/x/y", link.format("../fr/./2?q=1")),
        (4, "https://b.org/p", link.format("//x.net/fr/bad")), (5, "http://c.net/es", '<meta http-equiv="refresh" content="0;url=es/x">'),
        (6, "HTTP://A.Example.ORG/x", link.format("http://x.net/es/1")), (7, "http://a.example.org/x", ""), (8, "http://a.example.org/X", ""),
        (9, "http://d.org/k/l", '<base href="http://x.net/fr/">' + link.format("1")), (10, "http://e.net/fr", link.format("?p=/fr/")), (11, "http://f.org/y", link.format("#top")),
        (12, "no scheme", link.format("/fr/x")), (13, "http://g.net/q", link.format("/es/..")), (14, "http://h.net/q", link.format("/r?to=http://x.net/fr/1")),
        (15, "http://i.net", link.format("fr/3")), (16, "http://j.net/es?x=/fr/", link.format("mailto:a@b.c")), (17, "http://k.org/a", link.format("HTTP://X.NET/es/1")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {(r.a, r.b) for r in urls.link_edges(pages).collect()}
    assert edges == {
        ("http://free.org/promo", "http://free.org/fr/1"), ("http://a.net/promo", "http://a.net/fr/promo"), ("http://a.net/x/y", "http://a.net/fr/2?q=1"),
        ("https://b.org/p", "https://x.net/fr/bad"), ("http://c.net/es", "http://c.net/es/x"), ("http://a.example.org/x", "http://x.net/es/1"),
        ("http://d.org/k/l", "http://x.net/fr/1"), ("http://e.net/fr", "http://e.net/fr?p=/fr/"), ("http://f.org/y", "http://f.org/y"),
        ("http://g.net/q", "http://g.net/"), ("http://h.net/q", "http://h.net/r?to=http://x.net/fr/1"), ("http://i.net", "http://i.net/fr/3"), ("http://k.org/a", "http://x.net/es/1"),
    }


def test_relative_links_hand_on_blocks(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://free.org/a", link.format("//x.net/fr/bad")), (2, "http://a.net/promo", link.format("/fr/promo")), (3, "HTTP://Free.org/a", ""), (4, "http://free.org/A", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = urls.judge(pages, urls.rule_table(spark), urls.link_edges(pages))
    assert sorted((r.page_id, r.verdict) for r in out.collect()) == [(1, "block"), (2, "block"), (3, "block"), (4, "allow")]


def test_what_counts_as_a_link(spark):
    rows = [(i, f"http://free.org/p{i}", html) for i, (html, _) in enumerate(CASES)]
    pages = spark.createDataFrame([*rows, (-1, None, CASES[5][0]), (-2, "http://free.org/n", None)], "page_id long, url string, html string")
    got = {r.a: r.b for r in urls.link_edges(pages).collect()}
    assert got == {f"http://free.org/p{i}": to for i, (_, to) in enumerate(CASES) if to is not None}


def test_sql_follows_the_same_links(spark):
    """Planted pages through the query and its SQL: every case, relative targets, letter case, chains."""
    link = '<link rel="canonical" href="{}">'
    more = [
        "/fr/1", "../fr/./2?q=1", "//x.net/fr/bad", "?p=/fr/", "#top", "/es/..", "/r?to=http://x.net/fr/1", "fr/3", "mailto:a@b.c", "HTTP://X.NET/es/1", "..", ".", "a/../../fr/", "http://free.org/p5",
    ]
    hosts = ["http://free.org/p{}", "HTTP://U@A.Example.ORG/x/y{}?z#k", "http://net{}.net", "http://b.net/{}/", "http://net/fr{}", "none/{}"]
    rows = [(f"http://free.org/p{i}", html) for i, (html, _) in enumerate(CASES)]
    rows += [(host.format(i), link.format(to)) for i, to in enumerate(more) for host in hosts]
    rows += [("http://a.example.org/x/y3?z", ""), ("http://u@a.example.org/x/y3?z", ""), (None, link.format(BAD)), ("http://x.com/es/", None), rows[5], rows[5]]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    out = urls.judge(pages, urls.rule_table(spark), urls.link_edges(pages))
    table = pages.toPandas()
    db = duckdb.connect()
    db.register("pages", table)
    want = sorted(db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({urls.SQL})").fetchall())
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()) == want
    assert sum(w[3] is None and w[4] == "block" for w in want) > 20
