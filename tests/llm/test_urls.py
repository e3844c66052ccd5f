import re
from collections import Counter, defaultdict

from tallylake.llm.urls import MERGE_Z, MIN_SUPPORT, PRIOR, REJECT_AT, RULES, SHARE_CLASSES, SMOOTHING, Rule, judge_urls, op7_url_filter

CASES = [
    ("http://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("x://b.com/fr/?a/de/", "b.com", "/fr/", "com/fr/", "allow"), ("x://b.com/de/a", "b.com", "/de/a", "com/de/", "block"),
    ("x://b.com?x=/fr/", "b.com", "", None, None), ("x://b.com#/fr/", "b.com", "", None, None), ("no scheme.com/fr/", "", "", None, None),
    (None, "", "", None, None), ("", "", "", None, None), ("://", "", "", None, None), ("a://h://x/y", "h:", "//x/y", None, None),
    ("x://org", "org", "", None, None), ("x://org/", "org", "/", "org/", "allow"), ("x://ÄB.net/Ö", "Äb.net", "/Ö", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "z") for i, c in enumerate(CASES)] * 2, "page_id long, url string, host string")
    rows = judge_urls(pages, RULES).collect()
    assert len(rows) == 2 * len(CASES)
    for r in rows:
        _, host, path, rule, verdict = CASES[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule), CASES[r.page_id]
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert judge_urls(pages.limit(0), RULES).count() == 0


def test_templates_learn_from_labelled_neighbours(spark):
    bad = [f"http://h.com/de/{i}/spam{i}" for i in range(60)]
    good = [f"http://k.com/fr/{i}" for i in range(60)]
    asked = ["http://h.com/xx/7/spam", "http://k.com/xx/9"]
    pages = spark.createDataFrame(list(enumerate(bad + good + asked)), "page_id long, url string")
    rows = {r.page_id: r for r in judge_urls(pages, RULES).collect()}
    assert rows[0].template == "/de/*/*" and rows[60].template == "/fr/*"
    assert (rows[120].verdict, rows[121].verdict) == ("block", "allow")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return lower(host), slash + path


def ruled(host, path, rules):
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: (len(r.host) + len(r.path), r.host, r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def segments(path, depth):
    found = (path[1:] if path.startswith("/") else path).split("/", depth - 1)
    variable = r"([0-9]+(\.[A-Za-z]+)?|[0-9a-fA-F-]{16,}|[0-9]{4}-[0-9]{2}(-[0-9]{2})?)/?"
    return tuple("*" if re.fullmatch(variable, s) else s for s in found)


def brute(urls, rules, depth=6):
    """host, path, rule, verdict of each url, by a tree in memory."""
    read = [(*parts(u),) for u in urls]
    rule = [ruled(h, p, rules) for h, p in read]
    segs = [segments(p, depth) for _, p in read]
    templates = [()] * len(urls)
    for d in range(depth):
        support = Counter((h, t, s[d]) for (h, _), t, s in zip(read, templates, segs) if len(s) > d)
        templates = [
            t if len(s) <= d else (*t, s[d] if support[h, t, s[d]] >= MIN_SUPPORT else "*") for (h, _), t, s in zip(read, templates, segs)
        ]
    counts = defaultdict(lambda: [0, 0])
    for (h, _), t, (_, verdict) in zip(read, templates, rule):
        for i in range(len(t) + 1):
            node = counts[h, t[:i]]
            node[0] += verdict is not None
            node[1] += verdict == "block"
    everywhere = (sum(v == "block" for _, v in rule) + PRIOR) / (sum(v is not None for _, v in rule) + 1)
    children = defaultdict(list)
    for h, t in counts:
        if t:
            children[h, t[:-1]].append((h, t))
    share = {}

    def visit(node):
        classes = defaultdict(lambda: [0, 0])
        class_of = {}
        for child in children[node]:
            n, bad = counts[child]
            if n:
                class_of[child] = c = int((bad + PRIOR) / (n + 1) * SHARE_CLASSES)
                classes[c][0] += n
                classes[c][1] += bad
        groups, where = [], {}
        for c in sorted(classes, key=lambda c: ((classes[c][1] + PRIOR) / (classes[c][0] + 1), c)):
            n, bad = classes[c]
            if groups:
                m, b = groups[-1]
                p = (bad + b + PRIOR) / (n + m + 1)
                near = MERGE_Z * (p * (1 - p) * (1 / (n + 1) + 1 / (m + 1))) ** 0.5
                if abs((bad + PRIOR) / (n + 1) - (b + PRIOR) / (m + 1)) < near:
                    groups[-1] = [m + n, b + bad]
                    where[c] = len(groups) - 1
                    continue
            groups.append([n, bad])
            where[c] = len(groups) - 1
        for child in children[node]:
            if child in class_of:
                n, bad = groups[where[class_of[child]]]
                share[child] = (bad + SMOOTHING * share[node]) / (n + SMOOTHING)
            else:
                share[child] = everywhere if len(groups) > 1 else share[node]
            visit(child)

    for h, t in list(counts):
        if not t:
            n, bad = counts[h, t]
            share[h, t] = (bad + SMOOTHING * everywhere) / (n + SMOOTHING)
            visit((h, t))
    return [
        (h, p, r, v or ("block" if share[h, t] >= REJECT_AT else "allow")) for (h, p), (r, v), t in zip(read, rule, templates)
    ]


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    want = Counter((p.page_id, *row) for p, row in zip(pages, brute([p.url for p in pages], RULES)))
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in op7_url_filter(spark, sf).collect())
    assert got == want and sum(want.values()) == len(pages)


SECTIONS = [Rule("block", "h.net", "/a/x"), Rule("allow", "h.net", "/b/x"), Rule("block", "h.net", "/c/q/x"), Rule("allow", "h.net", "/c/r/x")]


def test_wide_and_deep_trees_equal_brute_force(spark):
    """Sixty sections beside each other, some labelled, some with a few labels, some deep, some seen once."""
    urls = [f"x://h.net/{s}/{k}{i}" for s in ("a", "b", "c/q", "c/r") for i in range(12) for k in "xyz"]
    urls += [f"x://h.net/s{j}/{i}/{i % 3}/same/y/deep/{i % 2}/z" for j in range(60) for i in range(j % 9)]
    urls += [f"x://h.net/c/{i}" for i in range(8)] + ["x://h.net", "x://h.net/", "x://h.net//", "x://H.net/a//y", "x://i.net/a/y", "x://h.net/" + "l/" * 3000, None]
    for depth in (6, 2, 9):
        got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), SECTIONS, depth).collect()
        assert [(r.host, r.path, r.rule, r.verdict) for r in sorted(got, key=lambda r: r.page_id)] == brute(urls, SECTIONS, depth)


def test_verdicts_stay_when_another_section_grows(spark):
    urls = [f"x://h.net/{s}/{k}{i}" for s in ("a", "b") for i in range(30) for k in "xy"]
    more = [f"x://h.net/other{i % 40}/{i}" for i in range(400)]

    def verdicts(some):
        rows = judge_urls(spark.createDataFrame(list(enumerate(some)), "page_id long, url string"), SECTIONS).collect()
        return {r.page_id: r.verdict for r in rows if r.page_id < len(urls)}

    alone = verdicts(urls)
    assert verdicts(urls + more) == alone
    assert all(alone[i] == ("block" if u.startswith("x://h.net/a/") else "allow") for i, u in enumerate(urls))
