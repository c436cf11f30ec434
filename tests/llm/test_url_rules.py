from tidewater.llm.queries import HOST_RULES
from tidewater.llm.url_rules import PATTERN_RULES, judge_urls, rule_index

SCHEMA = "page_id long, url string, rule string, token string"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


def test_rules_equal_brute_force(spark):
    urls = [None, "", "example.org/en/1", "http://example.org", "http://Example.ORG/en/1234?x=/es/", "https://a.b.example.org/es/", "http://notexample.org/es/1",
            "http://example.org/en/2#/en/1", "http://x.com/fr/", "http://com/fr/x", "http://x.com/FR/", "http://xcom/fr/", "ftp://x.com/de/1", "http://x.com?/de/",
            "http://x.org/", "http://x.org:80/", "http://u@x.com/fr/a b", "http://É.com/de/é", "http://http://x.com/de/", "http://x.net/fr/", "http://\norg/", "http://x.com/de/1"]
    rows = [(i if i % 5 else None, u, "old", "t") for i, u in enumerate(urls)] + [(50, "http://x.com/de/1", None, None)] * 3
    out = judge_urls(spark.createDataFrame(rows, SCHEMA), HOST_RULES + PATTERN_RULES)
    assert out.columns == ["page_id", "url", "token", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    assert got == sorted([(i, u, *brute(u)) for i, u, _, _ in rows], key=str)


def test_pattern_rules_and_empty_table(spark):
    cases = {"http://m.ads-track.example.net/en/1": "block", "http://x.net/user/login": "block", "http://x.net/user/logins": "allow",
             "http://x.net/wp-admin/x.php": "block", "http://adserver.x.net/a": "block", "http://x.net/ads-track.html": "allow"}
    frame = spark.createDataFrame([(1, u, None, None) for u in cases], SCHEMA)
    got = {r.url: r.verdict for r in judge_urls(frame, HOST_RULES + PATTERN_RULES).collect()}
    assert got == cases
    assert judge_urls(frame.limit(0), HOST_RULES).isEmpty()


def test_rules_are_indexed_by_their_rarest_token(spark):
    tokens = spark.createDataFrame([("example",)] * 3 + [("org",)] * 5 + [("en",)] * 2 + [("es",)] * 9, "token string")
    got = {r.name: r.token for r in rule_index(spark, HOST_RULES, tokens).collect()}
    assert got["example.org/es/"] == "example" and got["example.org/en/1"] == "en" and got["org/"] == "org"
