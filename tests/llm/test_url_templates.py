from collections import defaultdict

from pyspark.sql import functions as F

from lakestrata.llm import url_templates as op

PAGES = "page_id long, url string, html string"
ODD = [None, "", "no scheme", "http://", "http://A.Example.NET", "x://net/", "https://net/a?b/c", "http://net", "http://h.net#/x", "a://b://c/d",
       "http://example.com/de/1", "http://m.example.com/de", "http://anexample.com/de/1", "http://x.org/fr/1?q=http://net/", "http://É.org/fr/",
       "http://example.net/en/1", "http://w.example.net/en/", "http://example.net/enx", "HTTP://ORG/fr/é#"]


def parse(url):
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([len(rest), *(rest.find(c) for c in "?#" if c in rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    best = None
    for kind, text in op.RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[1])):
            best = (kind, text)
    return best


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES).repartition(3)


def test_rules_equal_brute_force(spark, llm_scratch):
    df = pages(spark, ODD + ODD).select("*", *(F.lit(1).alias(c) for c in ("host", "path", "id", "rule", "template", "n")))
    got = {r["page_id"]: r for r in op.judge_urls(df, llm_scratch()).collect()}
    assert len(got) == 2 * len(ODD)
    for i, u in enumerate(ODD + ODD):
        host, path = parse(u)
        best = rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best[1] if best else None), u
        assert got[i]["verdict"] == (best[0] if best else "allow")


def test_templates(spark, llm_scratch):
    """A template whose labelled urls are blocked takes its unlabelled ones along; numbers, hex runs and
    rare children become placeholders, and alike branches one branch."""
    rules = tuple(("block", f"h.com/{x}/bad") for x in "ab") + tuple(("allow", f"h.com/{x}/good") for x in "cd")
    urls = [f"http://h.com/{x}/{w}{i}/p.html" for x, w in zip("abcd", ("bad", "bad", "good", "good")) for i in range(40)]
    urls += [f"http://h.com/{x}/{i}/p.html" for x in "abcd" for i in range(7)]
    urls += [f"http://many.com/u/n{'abcdefghij'[i % 10]}{chr(97 + i // 10)}/x" for i in range(200)] + ["http://h.com/z/deadbeef00112233"]
    got = op.judge_urls(pages(spark, urls), llm_scratch(), rules=rules).collect()
    by_url = {urls[r["page_id"]]: r for r in got}
    assert by_url["http://h.com/a/3/p.html"]["rule"] is None
    # /a and /b are one blocked branch, /c and /d one allowed branch
    first = defaultdict(set)
    for u, r in by_url.items():
        first[r["template"].split("/")[1] if r["template"] else ""].add(u.split("/")[3])
    assert first["*blocked"] == {"a", "b"} and first["*allowed"] == {"c", "d"}
    assert by_url["http://many.com/u/naa/x"]["template"] == "/u/*/x"
    assert by_url["http://h.com/z/deadbeef00112233"]["template"].endswith("{h}")


def test_purity_rejects_unlabelled(spark, llm_scratch):
    """Labels come from one host's rule; its template also holds urls that no rule fits."""
    rules = (("block", "s.com/p1"), ("allow", "t.com/p1"))
    urls = [f"http://{h}/p{i}" for h in ("s.com", "t.com") for i in [1] * 60 + [2] * 5]
    got = op.judge_urls(pages(spark, urls), llm_scratch(), rules=rules).collect()
    assert {(r["host"], r["rule"] is None, r["verdict"]) for r in got} == {
        ("s.com", False, "block"), ("s.com", True, "block"), ("t.com", False, "allow"), ("t.com", True, "allow")}


def test_empty_table(spark, llm_scratch):
    assert op.judge_urls(pages(spark, ODD).limit(0), llm_scratch()).collect() == []


def test_deep_branches_are_told_apart(spark, llm_scratch):
    """What follows the eighth segment counts, and a long path is one template of its real depth."""
    deep = "/".join("abcdefghi")
    rules = (("block", f"h.com/{deep}/bad/x"), ("allow", f"h.com/{deep}/good/x"))
    urls = [f"http://h.com/{deep}/{k}/{w}" for k in ("bad", "good") for w in [f"x{chr(97 + i)}" for i in range(20)] + ["y"]]
    long = "/".join(f"s{chr(97 + i % 26)}" for i in range(300))
    urls += [f"http://one.com/{long}", f"http://h.com/{deep}"]
    got = {urls[r["page_id"]]: r for r in op.judge_urls(pages(spark, urls), llm_scratch(), rules=rules).collect()}
    assert len(got) == len(urls)
    bad, good = got[f"http://h.com/{deep}/bad/y"], got[f"http://h.com/{deep}/good/y"]
    assert (bad["rule"], good["rule"]) == (None, None) and bad["template"] != good["template"]
    assert got[f"http://one.com/{long}"]["template"] == f"/{long}"
    assert got[f"http://h.com/{deep}"]["template"].count("/") == 9


def test_templates_equal_level_by_level(spark, llm_scratch):
    """The tree of every shape, grown by plain Python one segment at a time."""
    import random
    rnd = random.Random(5)
    rules = (("block", "h.com/a/"), ("allow", "h.com/b/a/"), ("block", "h.com/b/b/"), ("allow", "i.com/c"))
    urls = [f"http://{rnd.choice('hhi')}.com/" + "/".join(rnd.choice("aabbc") for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    urls += [f"http://h.com/w{chr(97 + i // 26)}{chr(97 + i % 26)}/" + "/".join("xy"[: i % 3]) for i in range(150)] * 2
    shapes = defaultdict(lambda: [0, 0, 0])
    for u in urls:
        host, path = parse(u)
        fits = [(len(t), k) for k, t in rules for h, _, p in [t.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        row = shapes[host, tuple(x for x in path.split("/") if x)]
        row[0] += 1
        row[1] += bool(fits)
        row[2] += bool(fits) and max(fits)[1] == "block"
    want = {k: "" for k in shapes}
    prior, went, going = {k: 0.5 for k in shapes}, set(), set()
    for d in range(max(len(s) for _, s in shapes)):
        child = defaultdict(lambda: [0, 0, 0])
        for (h, s), row in shapes.items():
            if len(s) > d:
                child[h, want[h, s], s[d]] = [x + y for x, y in zip(child[h, want[h, s], s[d]], row)]
        new, below = dict(want), dict(prior)
        for (h, s), t in want.items():
            if len(s) > d:
                kin = [r for (h2, t2, _), r in child.items() if (h2, t2) == (h, t)]
                n, lab, bad = child[h, t, s[d]]
                name = s[d]
                if lab >= op.MIN_LABELS:
                    p, z2 = bad / lab, op._Z ** 2
                    mid, off = p + z2 / (2 * lab), op._Z * (p * (1 - p) / lab + z2 / (4 * lab * lab)) ** 0.5
                    name = "*blocked" if (mid - off) / (1 + z2 / lab) > 0.5 else "*allowed" if (mid + off) / (1 + z2 / lab) < 0.5 else name
                if len(kin) > op.MAX_CHILDREN and n < op.RARE * sum(r[0] for r in kin):
                    name = "*"
                new[h, s] = f"{t}/{name}"
                # a step takes the whole way that all shapes below a node have in common, and its prior once
                under = [s2 for (h2, s2), t2 in want.items() if (h2, t2) == (h, t) and len(s2) > d]
                skipped = len(kin) == 1 and d > 0 and (h, t) in went
                rates = [r[2] / r[1] for r in kin if r[1]]
                if not skipped:
                    below[h, s] = (sum(rates) + op.BRANCH_WEIGHT * prior[h, s]) / (len(rates) + op.BRANCH_WEIGHT)
                if len(kin) == 1 and all(len(s2) > d + 1 for s2 in under) and len({s2[d + 1] for s2 in under}) == 1:
                    going.add((h, new[h, s]))
        want, prior, went, going = new, below, going, set()
    sums = defaultdict(lambda: [0, 0])
    for k, row in shapes.items():
        sums[k[0], want[k]][0] += row[1]
        sums[k[0], want[k]][1] += row[2]
    for r in op.judge_urls(pages(spark, urls), llm_scratch(), rules=rules).collect():
        host, path = parse(urls[r["page_id"]])
        k = host, tuple(x for x in path.split("/") if x)
        assert r["template"] == want[k], urls[r["page_id"]]
        labelled, bad = sums[host, want[k]]
        assert abs(r["purity"] - (bad + op.PRIOR_WEIGHT * prior[k]) / (labelled + op.PRIOR_WEIGHT)) < 1e-9
        best = [(len(t), kind) for kind, t in rules for h, _, p in [t.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        assert r["verdict"] == (max(best)[1] if best else "block" if r["purity"] >= op.REJECT else "allow")


def test_branches_beside_decide_without_labels(spark, llm_scratch):
    """Ten blocked branches take an unlabelled one along, one does not; a long common way is one step; ``*`` is no wildcard."""
    rules = tuple(("block", f"many.com/x/{w}/") for w in "abcdefghij") + (("block", "few.com/x/a/"),)
    urls = [f"http://many.com/x/{w}/p" for w in "abcdefghij" for _ in range(6)] + ["http://many.com/x/k/p", "http://few.com/x/a/p", "http://few.com/x/b/p", "http://none.com/x/b/p"]
    deep = "/".join(["trap"] * 500)
    urls += [f"http://trap.com/{deep}/{w}" for w in "ab"] + ["http://star.com/*blocked/a", "http://star.com/*/a"]
    got = {urls[r["page_id"]]: r for r in op.judge_urls(pages(spark, urls), llm_scratch(), rules=rules).collect()}
    assert {u: got[u]["verdict"] for u in urls[-8:-4]} == {"http://many.com/x/k/p": "block", "http://few.com/x/a/p": "block", "http://few.com/x/b/p": "allow", "http://none.com/x/b/p": "allow"}
    assert got[f"http://trap.com/{deep}/a"]["template"] == f"/{deep}/a"
    assert got["http://star.com/*blocked/a"]["template"] == "/%2Ablocked/a" and got["http://star.com/*/a"]["template"] == "/%2A/a"


def test_very_long_url(spark, llm_scratch):
    urls = ["http://h.com/" + "x" * 1_000_000, "http://h.com/" + "y/" * 2_000, "http://h.com/z"]
    assert {r["verdict"] for r in op.judge_urls(pages(spark, urls), llm_scratch()).collect()} == {"allow"}
