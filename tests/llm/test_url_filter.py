import random
import re

import pytest

from kindred.llm.queries import URL_RULES
from kindred.llm.url_filter import ALLOW, BLOCK, Automaton, HostRule, host_and_path, judge_urls


def as_regex(glob):
    units = re.findall(r"\\.|\*\*|\*|\?|[^*?\\]", glob, re.S)
    table = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(
        table.get(u) or re.escape(u[1] if u[0] == "\\" else u) for u in units
    ).encode("latin-1"), re.S)


def test_automaton_equals_regular_expressions():
    chance = random.Random(9)
    globs = ["".join(chance.choices(["a", "b", "/", "*", "**", "?", r"\*"], k=chance.randint(1, 40)))
             for _ in range(60)]
    texts = ["".join(chance.choices("ab/*", k=chance.randint(0, 60))).encode() for _ in range(400)]
    found = Automaton(globs).matches(texts)
    for column, glob in enumerate(globs):
        plain = as_regex(glob)
        for row, text in enumerate(texts):
            assert found[row, column] == bool(plain.fullmatch(text)), (glob, text)


@pytest.mark.parametrize(("url", "wanted"), [
    (None, ("", "")), ("", ("", "")), ("example.com/x", ("", "")), ("http://", ("", "")),
    ("http://A.ÉX.com", ("a.Éx.com", "")), ("a://b://c/d?e#f", ("b:", "//c/d")),
    ("x://h?q/p", ("h", "")), ("x://h#q/p", ("h", "")), ("x://h/p#q?r", ("h", "/p")),
])
def test_host_and_path(url, wanted):
    assert host_and_path(url) == wanted


def plain_verdict(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host))
            and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.name))
        return rule.name, rule.verdict
    both = host + path
    bad = both.startswith("ads.") or "/cgi-bin/" in both or "/wp-login.php" in both
    return None, BLOCK if bad else ALLOW


def test_verdicts(spark):
    chance = random.Random(4)
    hosts = ["com", "net", "example.com", "WWW.example.com", "a.www.example.com", "xnet", "b.net",
             "ads.example.org", "x.ads.org", "badexample.com", "net.org"]
    paths = ["", "/", "/en", "/en/", "/en/1?x=/es/", "/es/", "/fr/9#a", "/x.net/es/", "/a/cgi-bin/b",
             "/net/fr/", "/wp-login.php"]
    urls = [f"{chance.choice(['http', 'x'])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "no scheme", "http://a.net/es/" + "long/" * 20_000, urls[3], urls[3]]
    pages = spark.createDataFrame(
        [(i, url, "h") for i, url in enumerate(urls)], "page_id bigint, url string, rule string"
    )
    found = {r.page_id: r for r in judge_urls(pages, URL_RULES).collect()}
    assert len(found) == len(urls)
    for number, url in enumerate(urls):
        host, path = host_and_path(url)
        rule, verdict = plain_verdict(host, path)
        row = found[number]
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_rule_text_is_literal_and_null_ids_stay(spark):
    pages = spark.createDataFrame([(None, "x://a*b/?"), (1, "x://aab/")], "page_id bigint, url string")
    found = judge_urls(pages, [HostRule(BLOCK, "a*b", "/")], globs=()).collect()
    assert {(r.page_id, r.verdict) for r in found} == {(None, BLOCK), (1, ALLOW)}
