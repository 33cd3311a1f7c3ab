"""URL filters: parsing, rules, shrinkage towards the parents, hot hosts, defined cases."""

import pytest
from pyspark.sql import functions as F

from spindle.llm import hosts, queries

Rule = hosts.Rule


def judged(df):
    return {r.page_id: r for r in df.collect()}


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_host_and_path(spark):
    cases = {"http://A.Example.ORG/x/Y?q#f": ("a.example.org", "/x/Y"), "https://h.com?q=/z": ("h.com", ""),
             "h://u@B.net:80#/a": ("u@b.net:80", ""), "x://y://z/p": ("y:", "//z/p"), "no scheme": ("", ""), None: ("", ""),
             "": ("", ""), "://": ("", ""), "http://É.com/é": ("É.com", "/é"), "a\nb://c.com/d\ne": ("c.com", "/d\ne")}
    got = judged(hosts.judge_pages(pages(spark, list(cases)), []))
    assert [(got[i].host, got[i].path) for i in range(len(cases))] == list(cases.values())
    assert all(r.rule is None and r.verdict == "allow" for r in got.values())


def test_the_longest_rule_wins(spark):
    urls = ["http://a.org/x", "http://example.org/es/1", "http://b.example.org/en/12", "http://example.org/en/2",
            "http://notexample.org/es/", "http://example.com/fr/", "http://x.y.com/de/1?z", "http://com/de/", "http://x.com/en",
            "http://org", "http://a.org:80/x"]
    got = judged(hosts.judge_pages(pages(spark, urls), queries.PAGE_RULES))
    assert [got[i].rule for i in range(len(urls))] == [
        "org/", "example.org/es/", "example.org/en/1", "org/", "org/", "com/fr/", "com/de/", "com/de/", None, None, None]
    assert [got[i].verdict for i in range(8)] == ["allow", "block", "block", "allow", "allow", "allow", "block", "block"]


def test_equal_rules_block_and_incomplete_rules_do_not_fit(spark):
    rules = [Rule("a.com", "/", False), Rule("a.com", "/", True), Rule(None, "/", True), Rule("b.com", None, True)]
    got = judged(hosts.judge_pages(pages(spark, ["http://a.com/x", "http://b.com/x"]), rules, outcome=F.lit(None)))
    assert (got[0].verdict, got[1].verdict, got[1].rule) == ("block", "allow", None)


def test_registered_domains(spark):
    names = ["a.b.example.com", "example.com", "com", "x.shop.co.uk", "shop.co.uk", "co.uk", "1.2.3.4", ""]
    row = spark.createDataFrame([(n,) for n in names], "h string").select(
        hosts.registered_domain(F.col("h")).alias("d"), hosts.suffix(F.col("h")).alias("s")).collect()
    assert [(r.d, r.s) for r in row] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("shop.co.uk", "co.uk"), ("shop.co.uk", "co.uk"),
        ("co.uk", "co.uk"), ("1.2.3.4", ""), ("", "")]


def records(spark, rows):
    return spark.createDataFrame(rows, "host string, n bigint, k bigint")


def test_records_shrink_towards_domain_and_suffix(spark):
    rows = [(f"good{i}.fine.com", 200, 2) for i in range(8)] + [(f"bad{i}.spam.net", 200, 190) for i in range(8)]
    rows += [("new.spam.net", 0, 0), ("new.fine.com", 0, 0), ("once.fine.com", 1, 1), ("once.spam.net", 1, 0),
             ("other.com", 0, 0), ("away.org", 0, 0)]
    got = {r.host: r for r in hosts.host_reputations(records(spark, rows)).collect()}
    assert got["bad0.spam.net"].bad and not got["good0.fine.com"].bad
    assert got["new.spam.net"].bad and not got["new.fine.com"].bad  # from the domain
    assert not got["once.fine.com"].bad  # one bad page does not outweigh the domain
    assert got["new.spam.net"].bound > got["once.spam.net"].bound > got["away.org"].bound > got["new.fine.com"].bound
    assert (got["bad0.spam.net"].labelled, got["bad0.spam.net"].blocked) == (200, 190)


def test_uneven_hosts_keep_their_own_record(spark):
    rows = [(f"h{i}.x.com", 400, 400 * (i % 2)) for i in range(10)]
    got = {r.host: r for r in hosts.host_reputations(records(spark, rows)).collect()}
    assert all(got[f"h{i}.x.com"].bad == bool(i % 2) for i in range(10))


def by_hand(rows, z=1.645):
    """The posterior bounds of rows (host, n, k), from the formulas of the docstring in plain Python."""
    from math import floor, sqrt
    level = [{}, {}, {}]
    for h, n, k in rows:
        for at, key in zip(level, [(), (h.split(".")[-1],), (h.split(".")[-1], ".".join(h.split(".")[-2:]))], strict=True):
            a = at.setdefault(key, [0, 0])
            a[0], a[1] = a[0] + n, a[1] + k

    def strength(groups):
        seen = chance = most = 0
        for n, k, pn, pk in groups:
            if n:
                mean, rest = pk / pn, 1 - n / pn
                seen += floor(1e6 * (n * (k / n - mean) * (k / n - mean)))
                chance += floor(1e6 * (mean * (1 - mean) * rest))
                most += floor(1e6 * (mean * (1 - mean) * n * rest))
        rho = (seen - chance) / (most - chance) if most > chance else 0.001
        return 1 / min(max(rho, 0.001), 0.95) - 1

    s1 = strength([(*v, *level[0][()]) for v in level[1].values()])
    s2 = strength([(*v, *level[1][key[:1]]) for key, v in level[2].items()])
    domain = lambda h: (h.split(".")[-1], ".".join(h.split(".")[-2:]))
    s3 = strength([(n, k, *level[2][domain(h)]) for h, n, k in rows])
    out = {}
    for h, n, k in rows:
        mean = level[0][()][1] / level[0][()][0]
        for s, at, key in ((s1, level[1], domain(h)[:1]), (s2, level[2], domain(h))):
            mean = (at[key][1] + s * mean) / (at[key][0] + s)
        a, b = k + s3 * mean, n - k + s3 * (1 - mean)
        m = a / (a + b)
        out[h] = m - z * sqrt(m * (1 - m) / (a + b + 1))
    return out


def test_bounds_equal_the_formulas(spark):
    rows = [(f"h{i}.d{i % 4}.{'com' if i % 3 else 'net'}", (i * 7) % 23, min((i * 7) % 23, (i * 5) % 11)) for i in range(60)]
    got = {r.host: r.bound for r in hosts.host_reputations(records(spark, rows)).collect()}
    assert got == pytest.approx(by_hand(rows), abs=1e-9)


def test_a_hot_host_is_judged_like_any_other(spark):
    urls = ["http://hot.com/bad"] * 400 + ["http://hot.com/x"] * 200 + [f"http://h{i}.com/x" for i in range(300)]
    rules = [Rule("hot.com", "/bad", True)]
    plain = hosts.judge_pages(pages(spark, urls), rules, hot_share=1)  # no host is hot
    split = hosts.judge_pages(pages(spark, urls), rules, hot_share=1000)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, split.collect()), key=repr)
    got = judged(split)
    assert len(got) == 900 and got[500].verdict == "block" and got[500].rule is None
    assert hosts.allowed_pages(pages(spark, urls), rules).filter("host = 'hot.com'").count() == 0


def test_outcomes_of_the_caller(spark):
    rows = pages(spark, ["http://a.com/1"] * 30 + ["http://b.com/1"] * 30 + ["http://a.com/2", "http://b.com/2"])
    rows = rows.withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash"))
    bad = F.when(F.col("url").endswith("1"), F.col("url").contains("a.com"))
    got = judged(hosts.judge_pages(rows, [], outcome=bad))
    assert (got[60].verdict, got[61].verdict, got[60].labelled, got[60].blocked) == ("block", "allow", 30, 30)


def test_empty_and_repeated_and_null_rows(spark):
    none = hosts.judge_pages(pages(spark, []), queries.PAGE_RULES)
    assert none.count() == 0 and none.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    rows = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id bigint, url string")
    assert hosts.judge_pages(rows, queries.PAGE_RULES).count() == 3
    assert hosts.judge_pages(pages(spark, ["http://" + "a" * 200_000 + ".com/" + "b" * 200_000]), []).count() == 1
