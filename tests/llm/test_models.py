"""Quality classifier, exact top-k, decontamination and the pipeline."""

import random

import numpy as np
import pytest
import reference as R
from conftest import SF
from oracle_compare import assert_same
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeledger.llm import decontaminate, quality, registry, vafile
from lakeledger.llm.registry import vocabulary


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(spark, name):
    assert_same(registry.QUERIES[name](spark, SF), registry.ORACLE[name], SF)


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = registry.op7_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [[s for s, y in held if y == v] for v in (1, 0)]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.95 * len(held)
    assert sum(a > b for a in good for b in bad) >= 0.97 * len(good) * len(bad)


def test_held_out_labels_never_train(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lied = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                             .otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in quality.quality_scores(documents, x).collect()) for x in (labels, lied))
    assert a == b


def test_quality_edges(spark, hard, empty, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 0), (5, None, None), (5, 7, 0), (6, 1, 0), (6, 0, 0)],
                                                   labels.schema))
    assert quality.quality_scores(hard, odd).count() == hard.count()
    assert quality.quality_scores(empty, labels).count() == 0
    none = quality.quality_scores(hard, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    one = quality.quality_scores(documents, labels.withColumn("quality", F.lit(1)))
    assert one.filter("predicted = 0").count() == 0
    assert quality.keep_good(hard, labels).columns == hard.columns


def test_flat_forest_equals_walking_the_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    forest = quality.fit(x, y, trees=20, least=1.0)
    bins = forest.bins(x)
    for i in range(0, 400, 37):
        margin = forest.start
        for t in range(20):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + int(bins[i, forest.feature[t, node]] > forest.cut[t, node])
            margin += forest.leaf[t, node - forest.feature.shape[1]]
        assert abs(forest.margin(bins[i:i + 1])[0] - margin) < 1e-9
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.9


def brute_top(rows, k):
    rows = {(i, tuple(v)) for i, v in rows
            if i is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    vec = [(i, np.floor(256 * np.array(v, np.float64)).astype(int)) for i, v in rows]
    out = []
    for qi, qv in vec:
        if qi % 50 == 0:
            best = sorted((-int(v @ qv), i) for i, v in vec if i != qi and len(v) == len(qv))[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(40)]  # ties
    rows += [(50, rows[50][1]), (400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8),
             (None, rows[0][1]), (450, []), (500, [0.5, 0.25]), (501, [1.0, -1.0]), (550, [0.0] * 8), (551, [3000.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cells", F.lit(1)).repartition(5)
    for block in (16384, 4):
        got = sorted(tuple(r) for r in vafile.top_k(df, F.col("vec_id") % 50 == 0, 5, block).collect())
        assert got == brute_top(rows, 5)
    assert vafile.nearest(df.limit(0)).count() == 0


def test_wand_retrieves_what_scoring_all_does():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 90)))) for i in range(150)]
    index = decontaminate.Index(items)
    for threshold in (0.1, 0.3, 0.6):
        for _ in range(20):
            terms = sorted({index.term[w] for w in (v.encode() for v in rng.sample(vocab, 25)) if w in index.term})
            score = np.zeros(len(index.item_of))
            for t in terms:
                score[index.ids[t]] += index.impact[t]
            got = index.wand(terms, threshold)
            assert [u for u, _ in got] == np.flatnonzero(score >= threshold).tolist()
            assert np.allclose([s for _, s in got], score[[u for u, _ in got]])


def brute_leaks(docs, items, overlap=0.8):
    out = set()
    for d, t in docs:
        joined = b" " + b" ".join(decontaminate.words_of(t or "")) + b" "
        for i, x in items:
            q, a = decontaminate.question_answer(x or "")
            if q + a and all(decontaminate.contained(p, joined) >= overlap for p in (q, a)):
                out.add((d, i))
    return out


def test_decontamination_finds_all_contained_items(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = brute_leaks(docs, items)
    assert {(d, i) for d, t in docs for i, x in items if x in t} <= want
    for chars in (decontaminate.SHARD_CHARS, 2000):
        got = decontaminate.contaminated(documents, bench, shard_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
        kept = {r.doc_id for r in decontaminate.decontaminate(documents, bench, shard_chars=chars).collect()}
        assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_decontamination_edges(spark, hard, empty, edge):
    question = " ".join(f"word{i}" for i in range(150))
    items = spark.createDataFrame([(1, f"{question}. The answer is forty two indeed."), (2, None), (3, ""), (4, " !! "),
                                   (None, "A null item of seven words here."), (1, f"{question}. The answer is forty two indeed.")],
                                  "item_id long, text string")
    filler = " ".join(f"other{i}" for i in range(33))
    docs = edge([(1, f"{filler} {question.upper()}!\n the ANSWER is -- forty two, indeed {filler}", "a"),
                 (2, question, "a"), (3, f"{filler} the answer is forty two indeed", "a"),
                 (None, "see a null item of seven words here", "a"), (5, None, "a")])
    got = sorted([(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()], key=repr)
    assert got == sorted([(1, 1), (1, 1), (None, None)], key=repr)
    assert decontaminate.contaminated(hard, items).count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, items).columns == docs.columns


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, SF)
        after = sorted([tuple(r) for r in out.collect()], key=repr)
        if n < 4:
            assert out.columns == docs.columns, name
        if name.startswith("quality"):
            scores = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            bad = {r.doc_id for r in scores.filter("predicted = 0").collect()}
            assert bad and after == sorted([r for r in before if r[0] not in bad], key=repr)
        elif name.startswith("line"):
            want = R.lines([r[:2] for r in before])
            assert sorted([(r[0], R.sha(r[1])) for r in after]) == sorted((w[0], w[3]) for w in want)
            assert all(r[4] == len(r[1]) for r in after)
        elif name.startswith("SimHash"):
            keep = {c for _, _, c in R.components([r[:2] for r in before])}
            assert after == sorted([r for r in before if r[0] in keep], key=repr)
        elif name.startswith("benchmark"):
            leaks = {d for d, _ in brute_leaks([r[:2] for r in before], benchmark)}
            assert after == sorted([r for r in before if r[0] not in leaks], key=repr)
        else:
            assert after == R.bpe([r[:2] for r in before], Tokenizer.from_file(vocabulary("word_bpe_49k.json")))
        docs = spark.createDataFrame(after, out.schema)


def test_pipeline_runs_on_nothing(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_question_and_answer_far_apart_are_found(spark, edge):
    question = " ".join(f"ask{i}" for i in range(30))
    answer = " ".join(f"reply{i}" for i in range(30))
    long = " ".join(f"part{i}" for i in range(200))
    items = [(1, f"{question}. {answer}."), (2, f"{long}. Yes indeed."), (3, "Short one? No."), (4, "alone")]
    gap = " ".join(f"gap{i}" for i in range(400))
    cut = long.split()
    scattered = f" {gap} ".join(" ".join(cut[i:i + 60]) for i in range(0, 200, 60))
    docs = [(1, f"{question} {gap} {answer}"), (2, f"yes indeed {gap} {scattered}"), (3, f"no {gap} short one"),
            (4, f"{question} {gap}"), (5, f"{gap} {answer}"), (6, f"x alone {gap}"), (7, gap)]
    want = brute_leaks(docs, items)
    assert want == {(1, 1), (2, 2), (3, 3), (6, 4)}
    table = spark.createDataFrame(items, "item_id long, text string")
    for chars in (decontaminate.SHARD_CHARS, 500):
        got = decontaminate.contaminated(edge([(*d, "a") for d in docs]), table, shard_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == 4
        assert all(0 < r.score <= 1 + 1e-9 for r in got)


def test_top_k_keeps_vectors_of_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(200)]
    rows += [(201, [4096.0, 1.0, -2.0, 0.5]), (250, [-5000.0, 3.5, 1e6, 2.0]), (251, [1e6, 1e6, 1e6, -1e6]),
             (300, [3000.0] * 4), (301, [4096.0, 4096.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for block in (16384, 4):
        got = sorted(tuple(r) for r in vafile.top_k(df, F.col("vec_id") % 50 == 0, 5, block).collect())
        assert got == brute_top(rows, 5)
    huge = spark.createDataFrame([(0, [1.0]), (1, [1e300]), (2, [1e308]), (3, [-1e308]), (4, [2.0])],
                                 "vec_id long, embedding array<double>")
    got = [r.vec_id for r in vafile.top_k(huge, F.col("vec_id") == 0, 4).orderBy("rank").collect()]
    assert got == [2, 1, 4, 3]


def test_scores_do_not_depend_on_the_number_of_shards(spark, edge):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["red", "green", "blue", f"w{i}", f"v{i}"]) for _ in range(12 + 7 * i)) for i in range(12)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = edge([(i, " ".join(t.split()[:-1]), "a") for i, t in enumerate(texts)])
    one, many = ({(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, items, shard_chars=c).collect()}
                 for c in (decontaminate.SHARD_CHARS, 700))
    assert one.keys() == many.keys() and len(one) >= 5 and min(one.values()) < 1
    assert all(abs(one[k] - many[k]) < 1e-9 for k in one)
