import math
import random
import re
from collections import Counter

import pytest

from trendloom.llm import url_filter
from trendloom.llm.url_filter import RULES, Rule

SCHEMA = "page_id long, url string, html string, host string, verdict string, score double, words string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1.0, "z") for r in rows], SCHEMA)


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host) :])[0]


def rule_of(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def vocabulary(rows):
    words = Counter()
    for _, url, html in rows:
        text, opened = [], False
        for c in html or "":
            opened = (c == "<") or (opened and c != ">")
            text.append(" " if opened or c == ">" else c)
        for w in re.findall("[a-zA-Z]+", "".join(text)):
            words[w.lower()] += len(w) <= 20
        for label in parsed(url)[0].split("."):
            if "-" in label:
                words.update(w for w in re.findall("[a-z]+", label) if len(w) <= 20)
    return +words


def split(run, words):
    """All ways to cut a run, by plain recursion with memory."""
    total, memo = sum(words.values()) or 1, {0: (0.0, [])}

    def p(w):
        return math.log(words[w] / total) if w in words else math.log(10 / total) - len(w) * math.log(10)

    for end in range(1, len(run) + 1):
        memo[end] = max(
            ((memo[s][0] + p(run[s:end]), -s, [*memo[s][1], run[s:end]]) for s in range(max(0, end - 20), end)), key=lambda x: x[:2]
        )
        memo[end] = (memo[end][0], memo[end][2])
    return memo[len(run)][1] if len(run) <= 63 else [run]


def judged(rows):
    words = vocabulary(rows)
    bag = {}
    for _, url, _ in rows:
        host, path = parsed(url)
        shape = re.sub("[0-9]+", "0", path)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in path)
        runs = [("h", r) for r in re.findall("[a-z]+", host)] + [("p", r) for r in re.findall("[a-z]+", low)]
        if runs:
            bag[host, shape] = [f"{k}:{w}" for k, r in runs for w in split(r, words)]
    count = {True: Counter(), False: Counter()}
    for (host, path), ws in bag.items():
        rule, seeded = rule_of(host, path), any(f"h:{s}" in ws for s in url_filter.SEEDS)
        if rule:
            used = [f"h:{x}" for x in re.findall("[a-z]+", rule.host)] + [f"p:{x}" for x in re.findall("[a-z]+", rule.path)]
            ws = [w for w in dict.fromkeys(ws) if w not in used]
        if 1 <= len(ws) <= url_filter.MAX_WORDS:
            count[seeded or bool(rule and rule.verdict == "block")].update(ws)
    known = set(count[True]) | set(count[False])
    n = {b: sum(c.values()) + len(known) for b, c in count.items()}
    ready = count[True] and count[False]
    odds = {w: math.log((count[True][w] + 1) / n[True]) - math.log((count[False][w] + 1) / n[False]) for w in known} if ready else {}
    out = []
    for page, url, _ in rows:
        host, path = parsed(url)
        score = math.fsum(odds.get(w, 0.0) for w in bag.get((host, re.sub("[0-9]+", "0", path)), []))
        rule = rule_of(host, path)
        verdict = rule.verdict if rule else "block" if score >= url_filter.MARGIN else "allow"
        out.append((page, host, path, rule.name if rule else None, verdict, pytest.approx(score, abs=1e-9)))
    return out


def order(r):
    return tuple((x is None, str(x)) for x in r[:5])


def same(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=order)
    assert got == sorted(judged(rows), key=order)


ODD = [
    (1, None, None), (2, "", ""), (3, "no scheme/net/", "<p>no scheme"), (4, "http://", "a < b > c"), (5, "http://net", "free bets"),
    (5, "http://net/", "free win win"), (None, "HTTP://WWW.Example.NET/EN/", "<b>casino</b>"), (6, "http://a.example.net/en/x?y#z", None),
    (7, "https://example.com/de", "x"), (8, "https://notexample.com/de/", "word <unclosed word"), (9, "a://b://c.org/fr/", "> word"),
    (10, "http://freebets.example.com/en/" + "long" * 30, "free free bets casino win"), (11, "http://casino-win.example.com/1", "win"),
    (12, "http://casinowin.org#x/fr/", "casino"), (13, "http://é.org/fr/ü?", "Straße"), (13, "http://é.org/fr/ü?", "Straße"),
    (14, "http://" + "a1-" * 3000 + "x.net/", "a x"), (15, "http://x\n.org/fr/", "x"), (16, "http://a.b/" + "q/" * 100, "q " * 50_000),
]


def test_odd_urls(spark):
    same(url_filter.judge(pages_of(spark, ODD)), ODD)
    assert url_filter.judge(pages_of(spark, [])).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    same(url_filter.judge(pages), [tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_unseen_names_of_known_words(spark):
    """Names written together are judged by their words, also by words that are no seeds."""
    draw = random.Random(5)
    clean = ["garden", "school", "river", "museum", "bread", "letter"]
    bad = ["jackpot", "bonus", "lucky"]
    text = " ".join(draw.choice(clean + bad + ["casino", "poker"]) for _ in range(4000))
    rows = [(i, f"http://{draw.choice(clean)}{draw.choice(clean)}.example.com/a/{i}", text if i < 2 else None) for i in range(300)]
    rows += [(300 + i, f"http://casino{draw.choice(bad)}.example.com/a/{i}", None) for i in range(60)]
    held_out = [(1000, "http://luckybonusjackpot.example.com/a/1", None), (1001, "http://riverbreadgarden.example.com/a/1", None)]
    got = {r.page_id: r.verdict for r in url_filter.judge(pages_of(spark, rows + held_out)).collect()}
    assert got[1000] == "block" and got[1001] == "allow"
    assert {got[i] for i in range(300)} == {"allow"} and {got[i] for i in range(300, 360)} == {"block"}


def test_longest_rule_wins(spark):
    rules = (Rule("com", "/", "block"), Rule("a.com", "/", "allow"), Rule("com", "/xyz/", "block"))
    rows = [(1, "http://a.com/y", None), (2, "http://a.com/xyz/", None), (3, "http://b.a.com/", None), (4, "http://b.com/", None)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages_of(spark, rows), rules).collect()}
    assert got == {1: ("a.com/", "allow"), 2: ("com/xyz/", "block"), 3: ("a.com/", "allow"), 4: ("com/", "block")}
