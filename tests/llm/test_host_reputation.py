import duckdb
import pytest

from silvertide.llm import host_reputation
from silvertide.llm.oracle import OP3

URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://a.example.org/en/12", "http://example.org/en/2", "http://b.org",
    "http://b.org/", "http://x.com/fr/9?q=://y", "http://x.com/de/", "http://xcom/fr/3", "http://com/fr/3", "http://notexample.org/es/", "ftp://Ü.Net#f",
    "a://b://c/d", "http://h.net/p\nq/7", "http://h.net/en/123456789012345678901", "http://h.net?x/fr/1", "http://u:p@h.net:80/en/4.html",
]


def rows():
    out = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://bad.net/en/1"), (3, URLS[3])]
    out += [(1000 + i, f"http://{'bad' if i % 3 == 0 else 'good' + str(i % 7)}.zone{i % 2}.net/en/{i}") for i in range(300)]
    return out


def test_rows_equal_sql(spark, labels):
    marks = [(i, int(i % 3 != 0 or i % 10 == 0), int(i % 50 == 1)) for i in range(260)] + [(None, 1, 0), (5, 0, None), (6, None, 1)]
    pages = spark.createDataFrame([(i, u, "") for i, u in rows()], "page_id long, url string, html string")
    got = sorted(map(str, (tuple(r) for r in host_reputation.judge(pages, labels(marks)).collect())))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows())
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", marks)
    assert got == sorted(map(str, con.execute(OP3).fetchall()))
    verdicts = {(eval(r)[1], eval(r)[4]) for r in got if eval(r)[3] is None}
    assert ("bad.zone0.net", "block") in verdicts and ("good1.zone1.net", "allow") in verdicts


def test_parts_and_rules(spark, labels):
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r.page_id: r for r in host_reputation.judge(pages, labels([])).collect()}
    assert [(got[i].host, got[i].path) for i in (0, 2, 3, 9, 15)] == [("", ""), ("", ""), ("", ""), ("x.com", "/fr/9"), ("b:", "//c/d")]
    assert [got[i].rule for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)] == [
        "example.org/es/", "example.org/en/1", "org/", None, "org/", "com/fr/", "com/de/", None, "com/fr/", "org/",
    ]
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert host_reputation.judge(pages.limit(0), labels([])).count() == 0


def test_strength_by_moments():
    assert host_reputation.strength(None, 0, None) == host_reputation.STRONGEST
    assert host_reputation.strength(10.0, 10, 1000) == host_reputation.STRONGEST
    assert host_reputation.strength(10 + 0.1 * 990, 10, 1000) == pytest.approx(9.0)
    assert host_reputation.strength(1e9, 10, 1000) == host_reputation.WEAKEST


@pytest.mark.parametrize("host, domain, suffix", [
    ("www.shop.co.uk", "shop.co.uk", "co.uk"), ("shop.com.br", "shop.com.br", "com.br"), ("co.uk", "co.uk", "co.uk"), ("me.github.io", "me.github.io", "github.io"),
    ("u:p@a.h.net:80", "h.net", "net"), ("h.net.", "h.net", "net"), ("192.168.0.1:8080", "192.168.0.1", "192.168.0.1"), ("10.0.0.1", "10.0.0.1", "10.0.0.1"),
    ("[2001:db8::1]:80", "[2001:db8::1]", "[2001:db8::1]"), ("b.s3.amazonaws.com", "b.s3.amazonaws.com", "s3.amazonaws.com"), ("", "", ""), ("net", "net", "net"),
    ("a.b.example.org", "example.org", "org"),
])
def test_registered_domain(spark, host, domain, suffix):
    row = host_reputation.with_domain(spark.createDataFrame([(host,)], "host string")).first()
    assert (row.host, row.domain, row.suffix) == (host, domain, suffix)


def test_owners_below_a_shared_suffix_do_not_share_a_prior(spark, labels):
    urls = [f"http://{h}.bad.co.uk/en/{i}" for i in range(200) for h in "ab"] + [f"http://good{i % 9}.net/en/{500 + i}" for i in range(400)]
    urls += [f"http://fine{i % 30}.co.uk/en/{500 + i}" for i in range(400)] + ["http://new.bad.co.uk/x", "http://other.co.uk/x"]
    marks = [(i, 0, 0) for i in range(200)] + [(500 + i, 1, 0) for i in range(400)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.host: r.verdict for r in host_reputation.judge(pages, labels(marks)).collect()}
    assert got["new.bad.co.uk"] == "block" and got["other.co.uk"] == "allow"


def test_suffixes_ports_and_addresses_equal_sql(spark, labels):
    hosts = [
        "a.bad.co.uk", "b.bad.co.uk:8080", "u:p@bad.co.uk", "fine.co.uk", "co.uk", "x.bad.github.io", "me.github.io.", "10.0.0.1", "10.0.0.1:81", "10.0.0.2",
        "[2001:db8::1]:80", "b.s3.amazonaws.com", "c.s3.amazonaws.com", "net", "h.net.", "H.Net:1", "a.b.c.school.net.bad.com.br", "a@b@bad.com.br", "", ".", "..co.uk",
    ]
    rows = [(i, f"http://{h}/en/{(j * 40 + i) if i % 3 else 'x'}") for j, h in enumerate(hosts) for i in range(40)] + [(None, f"http://new.{h}/q") for h in hosts]
    marks = [(d, int("bad" not in hosts[d // 40] or d % 11 == 0), int(d % 17 == 0)) for d in range(40 * len(hosts))]
    got = [tuple(r) for r in host_reputation.judge(spark.createDataFrame([(*r, "") for r in rows], "page_id long, url string, html string"), labels(marks)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", marks)
    assert sorted(map(str, got)) == sorted(map(str, con.execute(OP3).fetchall()))
    verdicts = {r[1]: r[4] for r in got}
    assert verdicts["new.a.bad.co.uk"] == "block" and verdicts["new.fine.co.uk"] == "allow"


def test_ids_of_nineteen_digits_count_and_longer_ones_do_not(spark, labels):
    first = 9_000_000_000_000_000_000
    rows = [(i, f"http://bad.net/en/{first + i}", "") for i in range(100)] + [(1000 + i, f"http://good.net/en/{i}", "") for i in range(300)]
    rows += [(2000, f"http://bad.net/en/{first}0", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    marks = [(first + i, 0, 0) for i in range(100)] + [(i, 1, 0) for i in range(300)]
    found = {r.host: (r.good, r.n) for r in host_reputation.outcomes(host_reputation.with_parts(pages), labels(marks)).collect()}
    assert found == {"bad.net": (0, 100), "good.net": (300, 300)}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", marks)
    got = [tuple(r) for r in host_reputation.judge(pages, labels(marks)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, con.execute(OP3).fetchall()))
    assert {(r[1], r[4]) for r in got} == {("bad.net", "block"), ("good.net", "allow")}
