"""URL filter: parts and rules against SQL and plain text work, the tree against one grown host by host."""

import random
import re
from collections import defaultdict

import pytest
from compare import duck
from conftest import TESTDATA

from claimloom.llm import url_filter as u
from claimloom.llm.registry import QUERIES, URL_RULES

PARTS = r"""
SELECT page_id, host, path,
       CASE WHEN fits_com AND host_ex AND en AND www THEN 'www.example.com/en/' WHEN host_ex AND en THEN 'example.com/en/'
            WHEN net AND starts_with(path, '/es/') THEN 'net/es/' WHEN net AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN fits_com AND starts_with(path, '/') THEN 'com/' END AS rule
FROM (
    SELECT *, host = 'com' OR ends_with(host, '.com') AS fits_com, host = 'net' OR ends_with(host, '.net') AS net,
           host = 'example.com' OR ends_with(host, '.example.com') AS host_ex,
           host = 'www.example.com' OR ends_with(host, '.www.example.com') AS www, starts_with(path, '/en/') AS en
    FROM (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
    )
)
"""


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_parts_and_rules_against_sql(spark, sf):
    folder = f"{TESTDATA}/sf{sf}"
    rows = QUERIES["op11_url_filter"](spark, folder).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"] or "") for r in rows) == sorted(
        (*row[:3], row[3] or "") for row in duck(folder, ["pages"]).execute(PARTS).fetchall()
    )
    verdicts = {r.text: r.verdict for r in URL_RULES}
    assert all(r["verdict"] == verdicts[r["rule"]] for r in rows if r["rule"])
    assert {r["verdict"] for r in rows if not r["rule"]} == {"allow", "block"}


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in host), re.match("[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def shape(path):
    segments = [s for s in path.split("/") if s]
    shaped = ["*" if len(s) > u.LONG else re.sub("[0-9]+", "#", re.sub(r"([\\*{}|#])", r"\\\1", s)) for s in segments]
    return tuple(shaped if len(shaped) <= u.DEPTH else [*shaped[: u.DEPTH - 1], "**"])


def plain_tree(urls, rules, kind):
    """Template and blocked share of each (host, shape), host by host and level by level."""
    hosts = defaultdict(list)
    for url in urls:
        host, path = split_url(url)
        rule = plain_rule(host, path, rules)
        hosts[host].append((shape(path), rule.verdict if rule else None))
    found = {}
    for host, members in hosts.items():
        frontier = [(host, 0, members, u.PRIOR)]
        while frontier:
            node, level, members, parent = frontier.pop()
            blocked = sum(v == "block" for _, v in members)
            labelled = sum(v is not None for _, v in members)
            share = (blocked + u.WEIGHT * parent) / (labelled + u.WEIGHT)
            below = [m for m in members if len(m[0]) > level]
            for segments, _ in members:
                if len(members) < u.SPLIT or len(segments) <= level:
                    found[host, segments] = node, share
            if len(members) < u.SPLIT or not below:
                continue
            names = defaultdict(list)
            for m in below:
                size = sum(x[0][level] == m[0][level] for x in below)
                names[m[0][level] if size >= u.BRANCH and size * u.LITERALS >= len(below) else "*"].append(m)
            branches = []
            for name, own in names.items():
                kinds = [0] * u.KINDS
                for segments, _ in own:
                    kinds[kind(segments[level + 1] if len(segments) > level + 1 else None)] += 1
                counts = {"n": len(own), "blocked": sum(v == "block" for _, v in own), "allowed": sum(v == "allow" for _, v in own)}
                branches.append({"name": name, "kinds": kinds, **counts})
            for group in u.merged(branches):
                pooled = [m for name in group["names"] for m in names[name]]
                frontier.append((f"{node}/{u.label(group['names'])}", level + 1, pooled, share))
    return found


def odd_urls(seed):
    pick = random.Random(seed)
    hosts = ["a.com", "www.A.com", "b.net", "c.org:80", "x@c.org", "spam.org", ""]
    words = ["en", "es", "fr", "news", "tag{x}", "a*b", "**", "7", "#no", "p9", "x" * 70, "é", "12.html", ""]
    urls = [
        f"http://{pick.choice(hosts * 2 + hosts[:1] * 9)}/" + "/".join(pick.choices(words, [9, 9, 6, 5, 1, 1, 1, 9, 1, 5, 1, 1, 5, 1], k=pick.choice([0, 1, 2, 2, 3, 3, 20])))
        for _ in range(1500)
    ]
    urls += [f"https://shop.org/item{chr(97 + n % 26)}{chr(97 + n // 26)}/view" for n in range(400)] * 2
    return urls + [None, "", "no scheme", "http://", "x://y://z/q", "ftp://h?q/x#y", "http://h#f?x", "http://h/p?x/y#z", "http://a.com\n/en/x"] + [urls[0]] * 500


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 9)])
def test_tree_against_one_grown_in_memory(spark, seed, parts):
    from pyspark.sql import functions as F

    rules = (u.Rule("block", "a.com", "/es/"), u.Rule("allow", "com"), u.Rule("block", "spam.org", "/"), u.Rule("block", "a.com", "/en"), u.Rule("allow", "c.org", "/fr"))
    urls = odd_urls(seed)
    segments = sorted({s for url in urls for s in shape(split_url(url)[1])})
    frame = spark.createDataFrame([(s,) for s in [None, *segments]], "s string")
    kinds = dict(frame.select("s", u.kind_of(F.col("s")).cast("int")).collect())
    expected = plain_tree(urls, rules, kinds.__getitem__)
    df = spark.createDataFrame([(n, url, "h", 1) for n, url in enumerate(urls)], "page_id long, url string, host string, n int")
    rows = u.judge(df.repartition(parts), rules).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = split_url(r["row"]["url"])
        rule = plain_rule(host, path, rules)
        template, share = expected[host, shape(path)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert (r["template"], round(r["blocked_share"], 9)) == (template, round(share, 9))
        assert r["verdict"] == (rule.verdict if rule else "block" if share >= u.BLOCK_AT else "allow")
    assert any("{" in r["template"].replace("\\{", "") for r in rows) and any(r["template"].endswith("/*/view") for r in rows)


def test_no_rows_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert u.judge(df.limit(0), URL_RULES).collect() == []
    assert [r["verdict"] for r in u.judge(df, ()).collect()] == ["allow"]
