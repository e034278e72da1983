from collections import Counter

from llm_fixtures import clash, corpus, frame, words

from lakestrata.llm import line_quality as op


def brute(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    wins = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if wins[tuple(w[i: i + 5])] > 1 for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def texts():
    return [t for _, t in corpus(40)] + [
        "a b c d e a b c d e", "a a a a a a", "a a a a a", "x " * 500, "l one.\nl one.\n\n \nl one.", "😀 é#*$%&|<>", "\n\n\n", "a|b|c",
        "a b c d e f a b c d e f g h i j k l m n o p q r s t u v w x y z", "same line here.\r\nsame line here.\n same line here."]


def test_base_equals_brute_force(spark, llm_scratch):
    llm_scratch()
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in op.quality_rules(clash(frame(spark, rows))).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t), t
        assert r["kept"] == (not r["base_failed"] and not r["lines_failed"]) and r["text"] == t


def test_lines(spark, llm_scratch):
    good = "This is a plain sentence of some words, and it ends well.\nAnother one follows here, as long as the first.\n" \
           "Nothing in these three lines is said twice; every rule lets them pass."
    bad = ["Home", "a | b | c | d", "### *** $$$ %%% abc", "THIS IS ALL SHOUTED AT THE READER!!", "Please enable JavaScript.", "two words"]
    rows = [(1, good + "\n" + "\n".join(bad) + "\n\n"), (2, "\n".join(["LOUD WORDS ALL OVER THE PLACE!!"] * 3 + ["small words that end well and stay."])),
            (3, good), (4, good + "\nLicensed under CC BY-NC 4.0."), (5, None)]
    got = {r["doc_id"]: r for r in op.quality_rules(frame(spark, rows)).collect()}
    assert got[1]["clean_text"] == good + "\n\n" and got[1]["n_bad_lines"] == len(bad) and got[1]["kept"]
    assert got[2]["lines_failed"] and not got[2]["kept"]
    assert (got[3]["clean_text"], got[3]["n_lost_words"], got[3]["kept"]) == (good, 0, True)
    assert got[4]["n_bad_lines"] == 0
    assert (got[5]["n_words"], got[5]["clean_text"], got[5]["kept"]) == (0, "", False)


def test_clean_documents_stay(spark):
    """Of the labelled good texts of ten words and more, nearly all stay; most junk goes."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [(quality[r["doc_id"]], r["kept"]) for r in op.quality_rules(docs).select("doc_id", "n_words", "kept").collect()
            if r["n_words"] >= 10 and r["doc_id"] in quality]
    kept = {q: [k for x, k in rows if x == q] for q in (0, 1)}
    assert sum(kept[1]) >= 0.97 * len(kept[1]) and sum(kept[0]) <= 0.4 * len(kept[0])


def test_native_plan_and_empty_table(spark):
    df = op.quality_rules(frame(spark, corpus(5)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.split("RoundRobin")[0] for x in ("Python", "Arrow", "Pandas", "Exchange hash"))
    assert op.quality_rules(frame(spark, corpus(5)).limit(0)).collect() == []
