import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import url_rules as ur
from tarmac.llm.queries import URL_RULES


@pytest.mark.parametrize("url,host,path", [
    ("http://Ex.COM/A/b?q=1#f", "ex.com", "/A/b"), ("https://x.org", "x.org", ""), ("x.org/a", "", ""), (None, "", ""), ("", "", ""),
    ("a://b://c/d", "b:", "//c/d"), ("http://h?x/y", "h", ""), ("http://h#x/y", "h", ""), ("://", "", ""), ("http://ÄB.de/ü", "Äb.de", "/ü"),
])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "u string").select(F.coalesce(ur.host(F.col("u")), F.lit("")), F.coalesce(ur.path(F.col("u")), F.lit(""))).first()
    assert tuple(row) == (host, path)


@pytest.mark.parametrize("url,rule,verdict", [
    ("http://a.net/x", "net/", "block"), ("http://a.example.net/en/1", "example.net/en/", "allow"), ("http://example.net/de/", "net/", "block"),
    ("http://m.example.com/de/1", "example.com/de/", "block"), ("http://example.com/en/1", None, "allow"), ("http://x.org/fr/", "org/fr/", "allow"),
    ("http://net", None, "allow"), ("http://net/", "net/", "block"), ("http://fakenet/", None, "allow"), ("http://badexample.com/de/", None, "allow"), (None, None, "allow"),
])
def test_longest_rule_wins(spark, url, rule, verdict):
    pages = spark.createDataFrame([(1, url, "k")], "page_id int, url string, key string")
    labels = spark.createDataFrame([], "doc_id int, quality int, toxic int")
    row = ur.judge(pages, labels, URL_RULES).first()
    assert (row["rule"], row["verdict"], row["n_mined"]) == (rule, verdict, 0)


def plain_tokens(url):
    rest = (url or "").partition("://")[2].lower()
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    names = re.findall("&([a-z0-9_]+)", "&" + query[1]) if query else []
    return {*("h:" + t for t in re.findall("[a-z0-9_]+", host)), *("p:" + t for t in re.findall("[a-z0-9_]+", path)), *("q:" + n for n in names)}


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        bad = rng.random() < 0.3
        host = rng.choice(["casino", "win", "free"] if bad and rng.random() < 0.7 else ["news", "blog", "free"])
        rows.append((i, f"http://{host}.{rng.choice(['example', 'site'])}.com/{rng.choice(['en', 'de'])}/{rng.randint(1, 3)}{rng.choice(['', '?ref=x&a=1', '?ad=1'])}"))
        if i % 2:
            labels += [(i, 0 if bad else 1, 0)] * rng.randint(1, 2)
    rows += [(None, "http://casino.example.com/"), (5000, None), (3, "http://news.site.com/en/1"), (5001, "")]
    labels += [(None, 0, 1), (7, None, None), (9, 1, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    options = {"support": 0.05, "least_urls": 5, "confidence": 0.6}
    found = sorted((str(r["page_id"]), str(r["host"]), r["verdict"], r["n_mined"]) for r in ur.judge(pages, marks, [], **options).collect())
    bad_of = {}
    for i, q, t in labels:
        if i is not None and (q is not None or t is not None):
            bad_of[i] = max(bad_of.get(i, False), q == 0 or t == 1)
    known = [(plain_tokens(u), bad_of[i]) for i, u in rows if i in bad_of]
    bad_sets = [t for t, b in known if b and t]
    least = max(5, -(-len(bad_sets) * 5 // 100))
    rules = []
    for combination in {c for t in bad_sets for n in (1, 2) for c in itertools.combinations(sorted(t), n)}:
        have = [b for t, b in known if t.issuperset(combination)]
        if sum(have) >= least and sum(have) >= 0.6 * len(have):
            rules.append(set(combination))
    assert rules
    want = []
    for i, u in rows:
        n = sum(plain_tokens(u) >= r for r in rules)
        host = re.match("[^/?#]*", (u or "").partition("://")[2])[0]
        want.append((str(i), host, "block" if n else "allow", n))
    assert found == sorted(want)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert ur.judge(pages, labels, URL_RULES).count() == 0


def test_three_tokens_together(spark):
    # each pair of the three is as common among good URLs
    bad = [f"http://shop.x/{i}/b?c=1" for i in range(30)]
    good = [u for i in range(30) for u in (f"http://shop.x/{i}/b", f"http://shop.x/{i}/d?c=1", f"http://news.x/{i}/b?c=1")]
    rows = list(enumerate(bad + good + ["http://shop.x/new/b?c=2", "http://shop.x/new/b"]))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i >= 30), 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    found = {r["url"]: (r["verdict"], r["n_mined"]) for r in ur.judge(pages, labels, [], most_tokens=None).join(pages, "page_id").collect()}
    # one rule: those of four tokens and more contain it
    assert all(found[u] == ("block", 1) for u in [*bad, "http://shop.x/new/b?c=2"])
    assert all(found[u] == ("allow", 0) for u in [*good, "http://shop.x/new/b"])


def test_letters_of_all_scripts(spark):
    row = spark.createDataFrame([("http://Ä1.de/é/東京?ü=1&b=2",)], "u string").select(ur.tokens(F.col("u"))).first()
    assert set(row[0]) == {"h:ä1", "h:de", "p:é", "p:東京", "q:ü", "q:b"}


@pytest.mark.parametrize("spoiled", [0, 30])
def test_many_tokens_that_occur_together(spark, spoiled):
    """Twelve bad URLs share 40 tokens, which good ones may have too: one class, not two to the fortieth combinations."""
    long = "http://h.test/" + "/".join(f"t{i}" for i in range(38))
    urls = [(i, f"{long}?x{i}=1", 0) for i in range(12)] + [(100 + i, f"http://g{i}.org/p", 1) for i in range(40)]
    urls += [(200 + i, f"{long}?y{i}=1", 1) for i in range(spoiled)]
    pages = spark.createDataFrame([u[:2] for u in urls], "page_id bigint, url string")
    labels = spark.createDataFrame([(u[0], u[2], 0) for u in urls], "doc_id bigint, quality int, toxic int")
    found = {r["page_id"]: (r["verdict"], r["n_mined"]) for r in ur.judge(pages, labels, [], most_tokens=None).collect()}
    bad = ("allow", 0) if spoiled else ("block", 40 + 40 * 39 // 2)
    assert all(found[i] == bad for i in range(12)) and all(found[100 + i] == ("allow", 0) for i in range(40))
