import random
import re

from pyspark.sql import functions as F

from ledgerlift.llm import url_rules as ur
from ledgerlift.llm.common import prepared
from ledgerlift.llm.queries import SITE_RULES

URLS = [
    "http://a.Example.ORG/en/12?x=/es/",
    "http://example.org/es/",
    "http://example.org/ES/",
    "http://notexample.org/en/1",
    "https://x.org",
    "https://x.org?y",
    "org/en/1",
    "http://ORG/es/1#z",
    "http://www.site.com/fr/a",
    "http://com/de/",
    "http://com.net/de/",
    "x://y://example.org/en/1",
    "http://casino-win.net/a",
    "http://casinos.net/a",
    "http://clean.net/casino",
    "http://a.net/cgi-bin/run.exe?x",
    "http://a.net/get.exe",
    "http://a.net/get.exe?x",
    "http://a.net/docs/web/login",
    "http://a.net/LOGIN?next",
    "http://a.net/logins",
    "http://doubleclick.net.a.net/",
    "http://ad.doubleclick.net/é",
    "http://a.net/?Q=1&sessionid=3",
    "http://a.net/\n.zip",
    "http://é.net/login\n",
    "",
    "://",
    "http://",
    None,
]


def expected(url, sites, hosts, patterns, regexes, default="allow"):
    """All rules against one url, patterns character by character."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = []
    for rule, verdict in sites:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(rule), rule, verdict))
    if fit:
        return host, path, max(fit)[1], max(fit)[2], None

    def found(pattern, subject, whole):
        edge = lambda i: i == 0 or i == len(subject) or not re.match("[a-z0-9]", subject[i])

        def at(i, p):
            if not p:
                return True
            if p == "|":
                return i == len(subject)
            if p[0] == "*":
                return any(at(j, p[1:]) for j in range(i, len(subject) + 1))
            if p[0] == "^":
                return (i < len(subject) and not re.match("[a-z0-9]", subject[i]) and at(i + 1, p[1:])) or (i in (0, len(subject)) and at(i, p[1:]))
            return i < len(subject) and subject[i] == p[0] and at(i + 1, p[1:])

        if pattern.startswith("||"):
            begin = subject.find("://") + 3
            end = begin + len(re.split("[/?#]", subject[begin:])[0])
            labels = [begin] + [i + 1 for i in range(begin, end) if subject[i] == "."] if re.match("[^:/?#]*://", subject) else []
            return any(at(i, pattern[2:]) for i in labels)
        if pattern.startswith("|"):
            return at(0, pattern[1:])
        return any(at(i, pattern) for i in range(len(subject) + 1))

    verdict_of = lambda p: "allow" if p.startswith("@@") else "block"
    for kinds, subject in ((hosts, host), (patterns, low)):
        fit += [(verdict_of(p) == "allow", len(p.removeprefix("@@")), p.removeprefix("@@"), verdict_of(p)) for p in kinds if url is not None and found(p.removeprefix("@@"), subject, low)]
    fit += [(v == "allow", len(r), r, v) for r, v in regexes if url is not None and re.search(r, low)]
    return (host, path, None, max(fit)[3], max(fit)[2]) if fit else (host, path, None, default, None)


def check(spark, urls, sites, hosts, patterns, regexes):
    frame = prepared(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = ur.rules(frame.sparkSession, sites, hosts, patterns, regexes)
    got = {r[0]: tuple(r)[1:] for r in ur.judged(frame, table).collect()}
    assert got == {i: expected(u, sites, hosts, patterns, regexes) for i, u in enumerate(urls)}


def test_verdicts_equal_every_rule_tried(spark):
    check(spark, URLS, SITE_RULES, ur.HOSTS, ur.PATTERNS, [("[0-9]{4}", "block"), ("get.*x$", "allow")])


def test_random_rules_and_urls(spark):
    picker = random.Random(3)
    word = lambda: "".join(picker.choice("ab1") for _ in range(picker.randrange(1, 3)))
    path = lambda: "".join(picker.choice("/.-_?=") + word() for _ in range(picker.randrange(4)))
    urls = [f"{picker.choice(['http', 'x'])}://{'.'.join(word() for _ in range(picker.randrange(1, 4)))}{path()}" for _ in range(150)]
    sites = list({f"{word()}/{picker.choice(['', word(), word() + '/' + word()])}": picker.choice(["allow", "block"]) for _ in range(20)}.items())
    piece = lambda: "".join(picker.choice(["*", "^", "/", ".", "-", word(), word(), word()]) for _ in range(picker.randrange(1, 5)))
    patterns = list({picker.choice(["", "@@"]) + picker.choice(["", "||", "|"]) + piece() + picker.choice(["", "|"]) for _ in range(40)})
    hosts = [p for p in {piece() for _ in range(10)}]
    patterns = [p for p in patterns if p.removeprefix("@@") not in hosts and (("@@" + p) not in patterns)]
    check(spark, urls, sites, hosts, patterns, [])


def test_rules_stand_under_their_rarest_token(spark):
    urls = prepared(spark).createDataFrame([(f"http://common.net/{'rare' if i == 0 else 'often'}/{i}",) for i in range(9)], "url string")
    table = ur.rules(urls.sparkSession, [("common.net/rare/", "block"), ("common.net/often", "block"), ("never.net/", "allow")], ["^ads^"], ["*x*", "||net^rare"], [("a+", "block")])
    got = {r["rule"]: r["token"] for r in ur.index(urls, table).collect()}
    # The last token of a site rule may be the start of a longer one; so may an open end of a pattern.
    assert got == {"common.net/rare/": "rare", "common.net/often": "common", "never.net/": "never", "^ads^": "ads", "*x*": "", "||net^rare": "net", "a+": ""}


def test_a_url_meets_only_rules_under_its_tokens(spark):
    """Many rules: the join by token meets few of them, none is tried against every url."""
    urls = prepared(spark).createDataFrame([(i, f"http://h{i}.net/p{i}/") for i in range(200)], "page_id long, url string")
    sites = [(f"h{i}.net/p{i}/", "block") for i in range(0, 2000, 3)]
    table = ur.rules(urls.sparkSession, sites, (), ())
    entries = ur.index(urls.select("url"), table)
    met = urls.select(F.explode(ur.tokens_of(F.col("url"))).alias("token")).join(entries, "token").count()
    got = ur.judged(urls, table).where("verdict = 'block'").count()
    assert got == 67 and met <= 2 * got


def test_odd_rows(spark):
    schema = "page_id long, url string, host string, path string, rule string, token string, t string, u string, id long, `a.b` int"
    rows = [(1, "http://x.org/", "h", "p", "r", "k", "t", "u", 5, 6)] * 3 + [(None, None, "h", "p", "r", "k", "t", "u", 5, 6), (None, "http://b.com/de/", "h", "p", "r", "k", "t", "u", 5, 6), (2, "http://y.net/" + "a/" * 50_000, *("x" * 6), 1, 1)]
    frame = prepared(spark).createDataFrame(rows, schema)
    table = ur.rules(frame.sparkSession, SITE_RULES)
    got = sorted((str(r["page_id"]), r["host"], r["rule"], r["verdict"]) for r in ur.judged(frame, table).collect())
    assert got == [("1", "x.org", "org/", "allow")] * 3 + [("2", "y.net", None, "allow"), ("None", "", None, "allow"), ("None", "b.com", "com/de/", "block")]
    assert ur.judged(frame.limit(0), table).collect() == []
    bare = table.limit(0).unionByName(frame.sparkSession.createDataFrame([(None, "site", "block"), ("a/", None, "block"), ("a/", "site", None)], table.schema))
    assert {r["verdict"] for r in ur.judged(frame, bare).collect()} == {"allow"}
