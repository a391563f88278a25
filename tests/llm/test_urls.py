import random

from shelfsense.llm import urls
from shelfsense.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def brute(url, listed, rules):
    host, path = split(url)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    bare = next((host[len(x) :] for x in ("www.", "m.") if host.startswith(x)), host)
    parts = host.split(".")
    own = {".".join(parts[i:]) + "/" for i in range(len(parts))} | {bare + path.rstrip("/")}
    return host, path, None, "block" if host and own & listed else "allow"


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/1?x#y", "http://example.org", "http://a.example.org/es/", "x://ÄB.com/fr/é", "ftp://notorg/", "http://xorg/a", "http://h.net?a=://b/c", "http://h.net#://b/c", "http://h.net/a://b", "http://example.org/en/12\n/x", "://h.net/", "http://bad.net/", "http://m.bad.net/x/", "http://notbad.net/x", "http://www.one.net/p/q//?z", "http://one.net/p/q/r"]


def test_against_brute_force(spark):
    pick = random.Random(0)
    hosts = ["a.net", "www.a.net", "b.a.net", "c.com", "example.org", "x.example.org", "m.d.net"]
    many = [f"http://{pick.choice(hosts)}/{pick.choice(['en', 'fr', 'de'])}/{pick.randrange(300)}{pick.choice(['', '/', '?a', '#b'])}" for _ in range(2000)]
    listed = {"bad.net/", "one.net/p/q", None} | {f"a.net/en/{i}" for i in range(0, 300, 3)} | {f"q.net/{i}" for i in range(500)}
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(ODD + many + ODD[:6])], "page_id long, url string, verdict string")
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, keys, URL_RULES).collect()}
    for i, u in enumerate(ODD + many + ODD[:6]):
        assert got[i] == brute(u, listed, URL_RULES), u
    none = urls.judge(pages, keys.limit(0), URL_RULES).where("rule IS NULL AND verdict <> 'allow'")
    assert none.count() == 0 and urls.judge(pages.limit(0), keys, URL_RULES).count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(3000).selectExpr("concat('h', id) AS key")
    rows = spark.range(30000).selectExpr("concat('h', id) AS key", "id")
    passed = urls.possible(rows, listed)
    assert passed.where("id < 3000").count() == 3000
    assert passed.where("id >= 3000").count() < 300
