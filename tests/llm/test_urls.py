"""URL filter: parts and rules by hand, segmentation against all splits, naive Bayes by counts."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import pytest

from aislane.llm import urls
from aislane.llm.queries import op10_urls

PAGES = "page_id long, url string, html string, host string, path string, rule string"


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return host.translate({c: c + 32 for c in range(65, 91)}), rest[:end]


def brute_rule(host, path):
    fitting = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(str(r)), default=None)


URLS = [
    "http://WWW.Example.COM/en/a?b#c", "https://example.com/en", "https://sub.example.com/en/x", "ftp://a.net/es/1",
    "x://a.net/fr/#y", "http://anet/es/", "http://notexample.com/en/", "http://example.com", "http://com/", "//a/b", None, "",
    "http://a://b/c", "http://a.org?x=/en/", "http://ÄB.com/é/", "http://www.example.com/en/\n", "http://casino-win.net/es/play",
    "http://blog.casinowin.org/play", "http://goodnews.com/story", "http://goodnews.org/story", "http://a.b.net/es/", "http:///path",
]


def pages(spark):
    html = "<p>good news story</p><script>var evil='casinowin'</script> casino win play <b>casino</b> win"
    rows = [(i, u, html if i % 3 else None, "x", "y", "z") for i, u in enumerate(URLS)]
    rows += [(None, "http://casino.net/es/", html, None, None, None), (3, URLS[3], None, None, None, None)]
    return spark.createDataFrame(rows, PAGES), rows


def test_rules_like_brute_force(spark):
    frame, rows = pages(spark)
    got = urls.judge_urls(frame).collect()
    want = []
    for page_id, url, *_ in rows:
        host, path = brute_parts(url)
        rule = brute_rule(host, path)
        want.append((page_id, host, path, str(rule) if rule else None, rule.verdict if rule else None))
    assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in got) == sorted(str(w[:4]) for w in want)
    for r in got:
        rule = brute_rule(r.host, r.path)
        assert r.verdict == (rule.verdict if rule else "block" if r.block_odds > 0 else "allow")


def test_the_method_learns_from_decided_urls(spark):
    frame, _ = pages(spark)
    found = {r.host: r for r in urls.judge_urls(frame).collect()}
    assert found["blog.casinowin.org"].verdict == "block"
    assert found["goodnews.org"].verdict == "allow"


def test_segments_are_the_likeliest():
    counts = {"the": 50, "rapist": 1, "therapist": 9, "a": 30, "at": 20, "them": 10, "me": 8, "his": 5, "hi": 4, "s": 1}
    segment = urls.Segmenter(counts, sum(counts.values()))
    for letters in ("therapist", "themathis", "hisa", "xyz", "thexme", "a"):
        ways = []
        for cuts in itertools.product([0, 1], repeat=len(letters) - 1):
            words, last = [], 0
            for i, cut in enumerate([*cuts, 1], 1):
                if cut:
                    words.append(letters[last:i])
                    last = i
            ways.append(sum(map(segment.word_cost, words)))
        words = segment(letters)
        assert "".join(words) == letters
        assert sum(map(segment.word_cost, words)) == pytest.approx(min(ways))


def brute_judged(rows):
    """The whole method in plain Python with every word and token: page_id, host, path, verdict, odds."""
    words = Counter()
    for _, _, html, *_ in rows:
        text = re.sub(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ", html or "")
        words.update(re.findall("[a-z]+", text.lower()))
    segment = urls.Segmenter({w: n for w, n in words.items() if len(w) <= 24}, words.total())

    def tokens(host, path):
        out = []
        for part in re.findall(r"[a-z]+|[0-9]+|[^a-z0-9.\-]+", host):
            out += [f"h:{w}" for w in (segment(part) if re.fullmatch("[a-z]+", part) else [part])]
        return out + [f"p:{t}" for t in re.findall(r"[^\W_]+", path.lower())]

    parts = [(r[0], *brute_parts(r[1])) for r in rows]
    verdicts = [(x := brute_rule(h, p)) and x.verdict for _, h, p in parts]
    seen, urls_of = {v: Counter() for v in ("allow", "block")}, Counter(filter(None, verdicts))
    for (_, h, p), v in zip(parts, verdicts, strict=True):
        if v:
            seen[v].update(tokens(h, p))
    size = max(1, len(seen["allow"] | seen["block"]))
    prior = math.log(urls_of["block"] + 1) - math.log(urls_of["allow"] + 1)
    out = []
    for (i, h, p), v in zip(parts, verdicts, strict=True):
        odds = prior
        for t in tokens(h, p):
            odds += math.log((seen["block"][t] + 1) / (seen["block"].total() + size))
            odds -= math.log((seen["allow"][t] + 1) / (seen["allow"].total() + size))
        out.append((i, h, p, v, odds))
    return out


def compare(found, rows):
    want = sorted(brute_judged(rows), key=lambda w: (str(w[:3]), w[4]))
    got = sorted(found.collect(), key=lambda r: (str((r.page_id, r.host, r.path)), r.block_odds))
    assert len(got) == len(want)
    for g, (i, host, path, verdict, odds) in zip(got, want, strict=True):
        assert (g.page_id, g.host, g.path) == (i, host, path)
        assert g.block_odds == pytest.approx(odds, abs=1e-6)
        if verdict or abs(odds) > 1e-6:
            assert g.verdict == (verdict or ("block" if odds > 0 else "allow"))


def test_whole_method_like_brute_force(spark):
    frame, rows = pages(spark)
    compare(urls.judge_urls(frame), rows)


def test_whole_method_with_many_words(spark):
    """Far more words, labels and tokens, each with its own count; a host and a label that a third of all pages have."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 9))) for _ in range(4000)] + ["w" * 24, "v" * 25]
    rows = []
    for i in range(900):
        label = "".join(rng.choices(words, k=rng.randint(1, 3))) + rng.choice(["", "7", "-x"])
        host = rng.choice([f"{label}.net", f"{label}.com", f"www.{label}.org", "hot.example.org"])
        path = "/" + "/".join(rng.choices(["es", "fr", "en", *words[:400]], k=rng.randint(0, 4)))
        rows.append((i, f"http://{host}{path}", "<p>" + " ".join(rng.choices(words, k=40)) + "</p>", None, None, None))
    rows.append((900, "http://" + "ab" * 500 + ".org/" + "x" * 3000, "w" * 24 + " " + "v" * 25, None, None, None))
    compare(urls.judge_urls(spark.createDataFrame(rows, PAGES)), rows)


def test_odds_by_hand():
    odds = urls.Odds.of((2, 3), (3, 5), 2)
    assert odds.prior == round(math.log(4 / 3) * 1e9) and odds.unseen == round(math.log(5 / 7) * 1e9)
    assert urls.Odds.of((0, 0), (0, 0), 0) == urls.Odds(0, 0)


def test_empty_table_and_query(spark, sf_dir):
    frame, _ = pages(spark)
    assert urls.judge_urls(frame.limit(0)).count() == 0
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in op10_urls(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    compare(op10_urls(spark, sf_dir), [(r.page_id, r.url, r.html) for r in rows])
    for row in rows:
        host, path = brute_parts(row.url)
        rule = brute_rule(host, path)
        mine = got[row.page_id]
        assert (mine.host, mine.path, mine.rule) == (host, path, str(rule) if rule else None)
        assert mine.verdict in ("allow", "block") and (rule is None or mine.verdict == rule.verdict)
