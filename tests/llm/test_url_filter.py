import re
from collections import Counter, defaultdict

import pytest

from quipu.llm import url_filter
from quipu.llm.queries import ORACLE_SQL, op11_url_filters
from tests.helpers import duck, sparked

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    assert sparked(op11_url_filters(spark, f"/root/testdata/{sf}")) == duck(sf, ORACLE_SQL["op11_url_filters"])


def brute(rows, rules, damping=85, rounds=20, threshold=1):
    """Verdicts by plain loops over dictionaries."""
    judged = []
    for key, url, html in rows:
        host = path = ""
        if url is not None and "://" in url:
            host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url.split("://", 1)[1], re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        judged.append((key, host, path, max(fits, key=lambda r: len(r.text)) if fits else None, html))
    pages, allowed, blocked, links = Counter(), Counter(), Counter(), Counter()
    for _, host, _, r, html in judged:
        if host:
            pages[host] += 1
            allowed[host] += r is not None and r.verdict == "allow"
            blocked[host] += r is not None and r.verdict == "block"
            targets = {m.lower() for m in re.findall(r"""<a\s+(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)""", html or "", re.I)}
            links.update((host, t) for t in targets if t != host)
    unit = min(1 << 20, (1 << 42) // max(1, len(pages)))

    def rank(seeds, edges):
        total = Counter()
        for (a, _), n in edges.items():
            total[a] += n
        score = {h: s * (100 - damping) // 100 for h, s in seeds.items()}
        for _ in range(rounds):
            new = Counter({h: s * (100 - damping) for h, s in seeds.items()})
            for (a, b), n in edges.items():
                new[b] += score.get(a, 0) * (n * (1 << 20) // total[a]) // (1 << 20) * damping
            score = {h: x // 100 for h, x in new.items()}
        return defaultdict(int, score)

    trust = rank({h: unit * allowed[h] // n for h, n in pages.items() if 2 * allowed[h] >= n}, links)
    distrust = rank({h: unit * blocked[h] // n for h, n in pages.items() if 2 * blocked[h] >= n}, Counter({(b, a): n for (a, b), n in links.items()}))
    bar = unit * (100 - damping) // 100 * threshold
    out = []
    for key, host, path, r, _ in judged:
        t, d = trust[host], distrust[host]
        out.append((key, host, path, r and r.text, r.verdict if r else "block" if d > t and d * 100 > bar else "allow", t, d))
    return sorted(out, key=str)


def link(*hosts):
    return "".join(f'<p><a class=x href="https://{h}/p?q=1">x</a>' for h in hosts)


RULES = (url_filter.rule("good.net/", "allow"), url_filter.rule("bad.net/", "block"), url_filter.rule("good.net/no/", "block"), url_filter.rule("deep.bad.net/ok", "allow"))
WEB = [
    (1, "http://good.net/a", link("near.io", "near.io")),
    (2, "https://WWW.Good.net/no/x?y#z", link("farm1.io")),
    (3, "https://bad.net/", link("victim.io")),
    (4, "https://deep.bad.net/ok/1", None),
    (5, "https://near.io/1", link("far.io") + "<A HREF=//Far.IO:80/x>" + "<a data-href='http://no.io'>" + "<a href='/own'>" + '<a href="http://near.io/2">'),
    (6, "https://far.io", "<a href="),
    *[(100 + k, f"https://farm{k}.io/page?x=1", link("bad.net", f"farm{(k + 1) % 6}.io")) for k in range(6)],
    (7, "https://victim.io/p", ""),
    (8, None, link("bad.net")),
    (9, "no scheme", None),
    (10, "x://", link("bad.net")),
    (None, "https://farm1.io/again", link("bad.net")),
    (7, "https://victim.io/p", ""),
    (11, "https://notgood.net/a", ""),
    (12, "https://good.net", ""),
    (13, "https://farm1.io/#://good.net/", ""),
    (14, "https://" + "a." * 3000 + "good.net/" + "b" * 50_000, "<a " * 20_000),
]


def test_the_graph_against_plain_loops(spark):
    df = spark.createDataFrame([(*r, "clash") for r in WEB], "page_id long, url string, html string, host string").repartition(5)
    got = sorted((tuple(r) for r in url_filter.judge_urls(df, RULES).collect()), key=str)
    assert got == brute(WEB, RULES)
    verdicts = {(r[0], r[1]): r[4] for r in got}
    assert all(verdicts[100 + k, f"farm{k}.io"] == "block" for k in range(6))  # no rule names them
    assert verdicts[7, "victim.io"] == verdicts[5, "near.io"] == verdicts[6, "far.io"] == "allow"
    trust = {r[1]: r[5] for r in got}
    assert trust["near.io"] > trust["far.io"] > 0 == trust["victim.io"]


def test_rounds_end_early_only_where_nothing_changes(spark):
    chain = [(k, f"http://h{k}.io/", link(f"h{k + 1}.io")) for k in range(12)] + [(99, "http://good.net/", link("h0.io"))]
    df = spark.createDataFrame(chain, "page_id long, url string, html string")
    for rounds in (1, 5, 20):
        got = sorted((tuple(r) for r in url_filter.judge_urls(df, RULES, url_filter.Params(rounds=rounds)).collect()), key=str)
        assert got == brute(chain, RULES, rounds=rounds)


def test_no_rows_and_only_nulls(spark):
    schema = "page_id long, url string, html string"
    df = spark.createDataFrame([(1, "http://a.org/", None)], schema).repartition(4)
    assert url_filter.judge_urls(df.filter("spark_partition_id() < 0")).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (None, None, None)], schema)
    assert [tuple(r) for r in url_filter.judge_urls(nulls).collect()] == [(None, "", "", None, "allow", 0, 0)] * 2
