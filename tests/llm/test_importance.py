import numpy as np
import pytest
from llm_fixtures import clash, corpus, frame
from pyspark.sql import functions as F

from lakestrata.llm import importance as op

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 2.0, None], [5.0] * 40, list(np.random.default_rng(1).normal(size=3000)),
                                    [1.0, np.nextafter(1.0, 2.0), 1.0, np.nextafter(1.0, 2.0)], [0.0, 1e300, -1e300, 1e-300]])
def test_kth_largest(spark, values):
    keys = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "key double")
    ranked = sorted((v for v in values if v is not None), reverse=True)
    for k in {1, 2, len(ranked) // 2, len(ranked)} - {0}:
        assert op.kth_largest(keys, k) == ranked[k - 1]
    assert op.kth_largest(keys, len(ranked) + 1) is None


def test_weights_equal_the_models(spark, llm_scratch):
    """Log weights are the sums of the smoothed log ratios, over every row."""
    rows = [(i, f"{t} {'zork ' * 40}" if t and j % 4 == 0 else t) for j, (i, t) in enumerate(corpus(30))]
    labels = spark.createDataFrame([(i, int(j % 4 > 0), 0) for j, (i, _) in enumerate(rows)], LABELS)
    got = {r["doc_id"]: r for r in op.resample(clash(frame(spark, rows)), labels, llm_scratch(), buckets=2048).collect()}
    import pyarrow as pa
    from lakestrata.llm.words import word_slices
    held = {r["id"] for r in op.label_sample(labels).filter("held").collect()}
    good = [j % 4 > 0 and i not in held for j, (i, _) in enumerate(rows)]
    per_doc = []
    for _, t in rows:
        _, _, w = next(word_slices(pa.array([t])))
        per_doc.append(op.ngram_buckets(w, 2048)[0])
    raw = np.bincount(np.concatenate(per_doc), minlength=2048)
    target = np.bincount(np.concatenate([b for b, g in zip(per_doc, good) if g]), minlength=2048)
    s = target.sum() / raw.sum()
    plain = np.log((target + op.SMOOTHING) / (raw * s + op.SMOOTHING))
    ratio = np.where(np.abs(target - s * raw) >= op.SIGNIFICANT * np.sqrt(np.maximum(raw * s * (1 - s), 1e-9)), plain, 0)
    assert (ratio != 0).any()
    for (i, t), b in zip(rows, per_doc):
        if len(b):
            assert got[i]["log_weight"] == pytest.approx(ratio[b].sum())
        else:
            assert got[i]["log_weight"] is None and not got[i]["kept"]
    kept, gone = ([r["key"] for r in got.values() if r["key"] is not None and r["kept"] == k] for k in (True, False))
    assert kept and (not gone or min(kept) > max(gone))


def test_a_given_k_is_drawn(spark, llm_scratch):
    rows = corpus(30)
    labels = spark.createDataFrame([(i, j % 2, 0) for j, (i, _) in enumerate(rows)], LABELS)
    got = op.resample(frame(spark, rows), labels, llm_scratch(), k=11).collect()
    kept = [r["key"] for r in got if r["kept"]]
    assert len(kept) == 11 and min(kept) > max(r["key"] for r in got if not r["kept"] and r["key"] is not None)


def test_gumbel_draw_follows_the_weights():
    """The largest key is document 0 with the probability of its weight."""
    import pyarrow as pa
    ratio = np.zeros(64)
    wins, texts = 0, pa.array(["a", "b c d e"])
    from lakestrata.llm.words import word_slices
    _, _, w = next(word_slices(pa.array(["a"])))
    ratio[op.ngram_buckets(w, 64)[0]] = 1.0
    for seed in range(4000):
        _, weight, key, _ = op.batch_keys(texts, pa.array([seed, -seed - 1], pa.int64()), ratio, 3, 1.0)
        wins += key[0] > key[1]
    assert abs(wins / 4000 - 1 / (1 + np.exp(weight[1] - weight[0]))) < 0.03


def test_held_out_accuracy(spark, llm_scratch):
    """Fitted on half of the labels, most held-out junk is rejected and clean text kept."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fit = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    got = op.resample(docs, fit, llm_scratch()).join(labels.join(fit.select("doc_id"), "doc_id", "left_anti"), "doc_id")
    share = {r["quality"]: r["kept"] for r in got.filter("toxic = 0").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.1 and share[1] > 0.95


def test_accepted_rows_and_reruns(spark, llm_scratch):
    rows = corpus(30) + [(1, "again the same id"), (1, "again the same id"), (None, "no id here")]
    docs = clash(frame(spark, rows))
    labels = spark.createDataFrame([(i, j % 3, None) for j, (i, _) in enumerate(rows)], LABELS)
    one = op.accepted(docs, labels, llm_scratch())
    assert one.schema == docs.schema
    a = sorted((r["doc_id"] or 0, r["text"]) for r in one.collect())
    b = sorted((r["doc_id"] or 0, r["text"]) for r in op.accepted(docs.repartition(7), labels, llm_scratch()).collect())
    c = op.resample(docs, labels, llm_scratch()).filter("kept").count()
    assert a == b and len(a) == c


def test_no_labels_and_empty_table(spark, llm_scratch):
    rows = corpus(8)
    none = spark.createDataFrame([], LABELS)
    got = op.resample(frame(spark, rows), none, llm_scratch()).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in got if r["n_words"]}
    assert op.resample(frame(spark, rows).limit(0), none, llm_scratch()).collect() == []
    assert op.accepted(frame(spark, rows).limit(0), none, llm_scratch()).collect() == []
