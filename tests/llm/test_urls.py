import random
import re

import pytest

from loomline.llm import urls

SCHEMA = "page_id long, url string"


def brute(url):
    """host, path, base rule and its verdict."""
    base = [
        ("org", "/", "allow"),
        ("example.org", "/es/", "block"),
        ("example.org", "/en/1", "block"),
        ("com", "/fr/", "allow"),
        ("com", "/de/", "block"),
    ]
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in base if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def addresses():
    rng = random.Random(1)
    hosts = [
        "example.org",
        "a.example.org",
        "badexample.org",
        "ORG",
        "x.com",
        "com",
        "WWW.Casino-Win.example.com",
        "free-bets.com",
        "my.freebets.net",
        "é.org",
        "org.",
        "a b.org",
        "x\ny.com",
        "",
    ]
    paths = [
        "",
        "/",
        "/es/",
        "/es",
        "/en/1",
        "/en/12/x",
        "/en/2",
        "/fr/a",
        "/de/",
        "/ads/x",
        "/x/ad/",
        "/DE/",
        "/de?x=/fr/",
        "#/fr/",
        "?a://b",
        "/cgi-bin/x",
        "/de/\n",
    ]
    out = [None, "", "no scheme", "://", "http://", "http:///path", "a://b://c/d", "mailto:x@y.org"]
    return out + [rng.choice(["http", "https", "FTP", ""]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]


def test_base_rules_follow_the_contract(spark):
    rows = list(enumerate(addresses())) + [(None, "http://x.org/"), (1, "http://x.org/")]
    found = urls.base_verdicts(urls.url_filter(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(found) == len(rows)
    for row, (page, url) in zip(found, rows, strict=True):
        host, path, rule, verdict = brute(url)
        assert (row["page_id"], row["host"], row["path"], row["rule"]) == (page, host, path, rule), url
        if rule:
            assert row["verdict"] == verdict


def test_index_loses_no_rule():
    """All rules run on all urls give what the candidates give."""
    rules = urls.DEFAULT_RULES
    compiled = [re.compile(x.pattern) for x in rules]
    counts = {"org": 500, "com": 500, "example": 900, "casino": 3}
    index, always = urls.rarest(rules, counts)
    assert not always
    assert sum(map(len, index.values())) == len(rules)
    for url in addresses():
        host, path, _, _ = brute(url)
        whole = f"{host}?{path}?"
        fits = [r for r, c in zip(rules, compiled, strict=True) if c.search(whole)]
        want = max(fits, key=lambda x: (x.rank, len(x.name), x.name), default=None)
        assert urls.decide(whole, rules, compiled, index, always) == want


@pytest.mark.parametrize(
    ("url", "verdict", "pattern"),
    [
        ("http://m.casino-win.example.net/x", "block", "casino-win"),
        ("http://x.net/ads/banner", "block", "path:ads"),
        ("http://downloads.net/loads/x", "allow", None),
        ("http://occasino.net/", "allow", None),
    ],
)
def test_pattern_rules(spark, url, verdict, pattern):
    row = urls.base_verdicts(urls.url_filter(spark.createDataFrame([(1, url)], SCHEMA))).first()
    assert (row["verdict"], row["pattern"], row["rule"]) == (verdict, pattern, None)


def test_rarest_token_and_rules_without_one():
    rules = [urls.Rule("a", "block", "/common/rare/"), urls.Rule("b", "block", ".*")]
    index, always = urls.rarest(rules, {"common": 10, "rare": 1})
    assert index == {"rare": [0]} and always == [1]


@pytest.mark.parametrize(
    ("pattern", "tokens"),
    [
        ("ads", ()),  # may lie within a longer token
        ("^ads", ()),
        ("^ads$", ("ads",)),
        ("/ads/", ("ads",)),
        ("/ads[/?]", ("ads",)),
        ("/ads[/0]", ()),
        ("/ads/?x", ("ads",)[:0]),
        ("/ads(?:/x)?/", ("ads",)),
        ("/ads(?:x/)?/", ()),
        ("^(?:[^?]*[.])?Example[.]org", ("example",)),
        ("/(?:a|b)c/", ()),
        ("/a{2}/", ()),
        (r"\.co\.uk\?", ("co", "uk")),
        ("(?i)/ads/", ()),
        ("(?ai)/ADS/", ("ads",)),
        (r"/ads\b", ()),
        ("/x(?=/)/y/", ("x", "y")),
    ],
)
def test_tokens_come_from_the_pattern(pattern, tokens):
    assert urls.literal_tokens(pattern) == tokens


def test_tokens_of_a_pattern_are_in_every_match():
    rng = random.Random(5)
    parts = ["a", "x", "/", "/", "-", ".*", "[^a-z]", "[a-z]", "(?:/a)?", "(?:a/)?", "(?:x|/a)", "^", "$", "a+", "7"]
    texts = ["".join(rng.choices("ax7///-", k=rng.randint(1, 12))) for _ in range(600)]
    seen = 0
    for _ in range(1500):
        pattern = "".join(rng.choices(parts, k=rng.randint(1, 6)))
        tokens = urls.literal_tokens(pattern)
        for text in texts if tokens else ():
            if re.search(pattern, text):
                seen += 1
                assert set(tokens) <= urls.url_tokens(text), (pattern, text)
    assert seen > 500


def test_filter_lists(spark):
    lines = ["[Adblock Plus 2.0]", "! comment", "||ads.example.com^", "@@||ads.example.com/ok/", "/banner/*", "|http://start.net/x", "-promo.gif|", "##.ad", "||opt.com^$third-party", ""]
    rules = urls.read_rules(lines)
    assert [r.verdict for r in rules] == ["block", "allow", "block", "block", "block"]
    assert rules[0].tokens == ("ads", "example", "com") and rules[2].tokens == ("banner",)
    cases = {
        "http://ads.example.com/": "block",
        "http://ADS.example.com": "block",
        "http://x.ads.example.com/a": "block",
        "http://ads.example.com/ok/a": "allow",
        "http://bads.example.com/": "allow",
        "http://ads.example.community/": "allow",
        "http://h.org/a/Banner/x": "block",
        "http://h.org/a/banners/x": "allow",
        "http://start.net/xy": "block",
        "http://a.start.net/xy": "allow",
        "http://h.org/a-promo.gif": "block",
        "http://h.org/a-promo.gif.html": "allow",
        "http://opt.com/": "allow",
    }
    found = urls.url_filter(spark.createDataFrame(list(enumerate(cases)), SCHEMA), rules).collect()
    assert {list(cases)[x["page_id"]]: x["verdict"] for x in found} == cases
    with pytest.raises(ValueError, match="regular expression"):
        urls.read_rules(["/ads[0-9]+/"])


def test_empty_table_long_url_and_clashing_columns(spark):
    assert urls.url_filter(spark.createDataFrame([], SCHEMA)).count() == 0
    row = urls.url_filter(spark.createDataFrame([(1, "http://x.org/" + "a/" * 200_000, 5, 6)], SCHEMA + ", host int, rule int")).first()
    assert row["rule"] == "org/" and len(row["path"]) == 400_001
