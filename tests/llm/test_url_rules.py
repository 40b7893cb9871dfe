import pytest

from millrace.llm import op2_url_rules as u

URLS = [
    "http://Example.COM/en/1", "https://www.example.com/en/x?q=/fr/", "http://a.b.net/fr/", "http://net/es/1", "http://xnet/es/1",
    "http://example.com", "http://example.com?x=/en/", "no scheme", "", None, "ftp://h.org/a#b", "http://a.com:80/en/", "http:///x",
    "http://example.org/en/english", "http://www.example.com/en/x?q=/fr/", "http://x.example.com/en/\n/z", "://net/es/",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path


def brute(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]))
    return host, path, best[0] + best[1], best[2]


@pytest.mark.parametrize("rules", [list(u.RULES), [("org", "/en/eng", "block"), ("example.org", "/", "allow"), ("com", "", "block"), ("com", "", "allow")], []])
def test_against_brute_force(spark, rules):
    pages = spark.createDataFrame([(i, x, 7) for i, x in enumerate(URLS * 2)], "page_id long, url string, rest int")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = u.judge(pages, table).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in found] == [brute(x, rules) for x in URLS * 2]
    assert all(r["rest"] == 7 for r in found)


def test_empty_and_clash(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(list(u.RULES), "host string, path string, verdict string")
    assert u.judge(pages, rules).count() == 0
    with pytest.raises(ValueError):
        u.judge(spark.createDataFrame([], "url string, rule string"), rules)
