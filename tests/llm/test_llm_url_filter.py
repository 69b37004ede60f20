"""Rules and language models against plain versions."""

import math
import re
from collections import Counter

import pytest

from creaseline.llm import url_filter

URLS = (
    [f"https://good{k}.example.com/de/{k}.html" for k in range(20)]
    + [f"http://shop.bad{k}.net/es/win-{k * 37}" for k in range(20)]
    + ["https://EXAMPLE.com/en/1", "https://www.example.com/en/1?x", "https://www.example.com/fr#a", "http://com", "http://xcom/", None]
    + ["no scheme", "", "https://shop.bad3.net/de/win-1", "https://good7.example.org/de/7.html", "https://a.b.net/fr/", "x://y.com/?/en/"]
)


def plain_site(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fit = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def plain_scores(urls, decided, order=url_filter.ORDER, smoothing=url_filter.SMOOTHING):
    counts = {v: Counter() for v in ("allow", "block")}
    totals = {v: Counter() for v in ("allow", "block")}
    chars = set()
    for url, verdict in zip(urls, decided):
        text = url_filter.START * order + (url or "") + url_filter.END
        for k in range(order, len(text)):
            chars.add(text[k])
            for n in range(order + 1):
                if verdict:
                    counts[verdict][text[k - n : k + 1]] += 1
                    totals[verdict][(n, text[k - n : k])] += 1

    def chance(v, context, c):
        p = 1 / (len(chars) + 1)
        for n in range(len(context) + 1):
            ctx = context[len(context) - n :]
            p = (counts[v][ctx + c] + smoothing * p) / (totals[v][(n, ctx)] + smoothing)
        return p

    out = []
    for url in urls:
        text = url_filter.START * order + (url or "") + url_filter.END
        places = range(order, len(text))
        gain = sum(math.log(chance("allow", text[k - order : k], text[k]) / chance("block", text[k - order : k], text[k])) for k in places)
        out.append(gain / len(places))
    return out


def test_rules_and_models(rows):
    pages = rows("page_id long, url string, host int", *((k, u, 1) for k, u in enumerate(URLS)), (0, URLS[0], 1))
    urls = [*URLS, URLS[0]]
    sites = [plain_site(u) for u in urls]
    rules = [plain_rule(*s) for s in sites]
    scores = plain_scores(urls, [r[0] for r in rules])
    found = sorted(url_filter.judged(pages).collect(), key=lambda r: r.page_id)
    assert len(found) == len(urls)
    undecided = []
    for r in found:
        assert (r.host, r.path) == sites[r.page_id]
        verdict, rule = rules[r.page_id]
        assert r.rule == rule
        if rule:
            assert r.verdict == verdict and r.score is None
        else:
            assert r.score == pytest.approx(scores[r.page_id])
            undecided.append((r.score, r.verdict))
    undecided.sort()
    assert [v for _, v in undecided] == sorted((v for _, v in undecided), reverse=True)  # block below, allow above
    by_url = {r.page_id: r.verdict for r in found}
    assert by_url[urls.index("https://shop.bad3.net/de/win-1")] == "block"
    assert by_url[urls.index("https://good7.example.org/de/7.html")] == "allow"


def test_without_examples_of_both_kinds(rows):
    pages = rows("page_id long, url string", (1, "http://a.org/"), (2, None))
    assert {(r.verdict, r.score) for r in url_filter.judged(pages).collect()} == {("allow", 0.0)}
    assert url_filter.judged(pages.limit(0)).collect() == []
