from collections import Counter

from pyspark.sql import functions as F

from tillroll.llm import url_filter as U

SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "rule", "address", "group", "host")})


def verdicts(spark, rows, **options):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(pages(spark, rows), **options).collect()}


def test_rules_hosts_and_paths(spark):
    got = verdicts(spark, [
        (1, "http://Example.COM/en/1?x#y", ""), (2, "https://www.example.com/en/", ""), (3, "http://notexample.com/en/", ""),
        (4, "http://a.b.net/es/x", ""), (5, "http://net/fr/", ""), (6, "http://example.com", ""), (7, "http://example.com?q=/", ""),
        (8, None, None), (9, "no scheme", ""), (10, "", ""), (11, "http://x/://example.com/en/", ""), (12, "http://É.com/", ""),
        (13, "http://sub.www.example.com/en/z#a/b", ""), (14, "x://h://example.com/en/", "")])
    assert got == {
        1: ("example.com", "/en/1", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("notexample.com", "/en/", "com/", "allow"), 4: ("a.b.net", "/es/x", "net/es/", "block"),
        5: ("net", "/fr/", "net/fr/", "block"), 6: ("example.com", "", None, "allow"), 7: ("example.com", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("x", "/://example.com/en/", None, "allow"), 12: ("É.com", "/", "com/", "allow"),
        13: ("sub.www.example.com", "/en/z", "www.example.com/en/", "allow"), 14: ("h:", "//example.com/en/", None, "allow")}


def link(href):
    return f'<html><head><LINK rel="canonical" HREF="{href}"></head></html>'


def refresh(href):
    return f"<meta http-equiv='refresh' content='0; url={href}'>"


def test_blocks_reach_aliases(spark):
    got = verdicts(spark, [
        (1, "http://a.org/x", link("http://b.org/y")), (2, "http://b.org/y/", refresh("http://evil.net/es/1")),  # 1 -> 2 -> blocked
        (3, "http://evil.net/es/1", ""), (4, "https://c.org/z", link("//a.org/x#top")),                          # joins the chain
        (5, "http://d.com/", link("http://b.org/y")),                                                            # own allow rule wins
        (6, "http://e.org/p/q", link("../r")), (7, "http://f.org/", link("http://www.example.com/en/1")),         # alias of an allowed url
        (8, "http://g.org/a?utm=1", link("/a")), (9, "http://g.org/a", refresh("http://example.com/en/gone&amp;x=1")),
        (10, "http://h.org/", link("mailto:x@example.com")), (11, "http://i.org/", link("http://i.org/")),
        (1, "http://a.org/x", link("http://b.org/y"))])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow",
                                                7: "allow", 8: "block", 9: "block", 10: "allow", 11: "allow"}


def test_repeats_empty_and_given_redirects(spark):
    rows = [(1, "http://a.org/", None), (1, "http://a.org/", None), (None, "http://b.org/", "<p>")]
    redirects = spark.createDataFrame([("http://b.org/", "http://x.net/fr/1"), (None, "http://x"), ("http://y", None)],
                                      "src string, dst string")
    out = Counter((r["page_id"], r["verdict"]) for r in U.judge(pages(spark, rows), redirects=redirects).collect())
    assert out == {(1, "allow"): 2, (None, "block"): 1}
    assert U.judge(pages(spark, [])).count() == 0


def test_hot_canonical(spark):
    rows = [(i, f"http://s{i}.org/", link("http://hub.org/")) for i in range(400)] + [(999, "http://hub.org/", link("http://bad.net/es/"))]
    assert Counter(v[3] for v in verdicts(spark, rows).values()) == {"block": 401}


def targets(spark, url, html):
    return {r["dst"] for r in U.page_links(spark.createDataFrame([(url, html)], "url string, html string")).collect()}


def test_links_are_read_as_browsers_read_them(spark):
    at = "http://h.org/a/b/c?q#f"
    html = """<head><!-- <link rel=canonical href=/comment> --><script>x = '<link rel="canonical" href="/script">'</script>
    <link rel="canonical" href="../one"><LINK href='./two' REL='alternate canonical'><link rel=canonical href=../../../../three>
    <link data-rel="canonical" href="/no"><link rel="stylesheet" href="/no"><link rel="canonical" data-href="/no" href="/./four/../five">
    <meta http-equiv="refresh" content="3;URL='?page=2&amp;x=&#49;&#x2f;'"><meta http-equiv=Refresh content="0; url=http://o.org/x/../y?z=..">
    <link rel="canonical" href="/&#xe9;&#128512;&bogus;&#1114112;&"></head><!-- <link rel=canonical href=/unclosed>"""
    assert targets(spark, at, html) == {
        "http://h.org/a/one", "http://h.org/a/b/two", "http://h.org/three", "http://h.org/five", "http://h.org/a/b/c?page=2&x=1/",
        "http://o.org/y?z=..", "http://h.org/\u00e9\U0001f600&bogus;\ufffd&"}


def test_base_element_and_bare_hosts(spark):
    html = '<base href="//b.org/x/"><link rel=canonical href="y/../z">'
    assert targets(spark, "https://h.org/a", html) == {"https://b.org/x/z"}
    assert targets(spark, "http://h.org", '<link rel="canonical" href="../..">') == {"http://h.org"}  # as address() has it
    assert targets(spark, "http://h.org/a", '<link rel="canonical" href="">') <= {None}
    assert targets(spark, None, link("/x")) <= {None} and not targets(spark, "http://h.org/", None)


def test_second_link_and_dots_carry_blocks(spark):
    got = verdicts(spark, [
        (1, "http://a.org/x", link("http://a.org/self") + link("http://evil.net/es/1")),
        (2, "http://a.org/p/q/r", link("../../x")), (3, "http://c.org/", "<!--" + link("http://evil.net/es/1") + "-->"),
        (4, None, link("http://evil.net/es/1")), (None, "http://a.org/p/q/r", None)])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", None: "block"}


def test_many_pages_without_address(spark):
    rows = [(i, None if i % 3 else "x", link("http://evil.net/es/1")) for i in range(300)] + [(900, "http://evil.net/es/1", "")]
    got = verdicts(spark, rows)
    assert len(got) == 301 and {v[3] for k, v in got.items() if k < 900} == {"allow"} and got[900][3] == "block"
