"""Decontamination: independent brute force, thresholds that lose nothing, scattered shingles, scores."""

from __future__ import annotations

import math
import random
import re

import pytest

from lakeledger.llm import decontaminate

VOCAB = [f"w{i}" for i in range(80)]


def split(text):
    return re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())


def halves(text):
    parts = [w for p in re.split(r"(?<=[.!?])\s+|\n", text or "") if (w := split(p))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def runs(words, n=5):
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def share(part, words):
    own = runs(part)
    if not own:
        return 1.0
    n = len(next(iter(own)))
    return len(own & {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}) / len(own)


def brute(docs, items):
    out = {}
    for d, text in docs:
        words = split(text)
        for i, item in items:
            q, a = halves(item)
            if q + a and share(q, words) >= 0.8 and share(a, words) >= 0.8:
                out[d, i] = (share(q, words), share(a, words))
    return out


def brute_scores(docs, items, pairs):
    """BM25 of each part (one unit each) against whole documents, as shares of its own score."""
    parts = {i: [p for p in halves(t) if p] for i, t in items}
    units = [p for ps in parts.values() for p in ps]
    mean, texts, out = sum(map(len, units)) / len(units), dict(docs), {}
    for d, i in pairs:
        held, best = set(split(texts[d])), 0.0
        for p in parts[i]:
            weight = {}
            for w in set(p):
                n, tf = sum(w in u for u in units), p.count(w)
                idf = math.log(1 + (len(units) - n + 0.5) / (n + 0.5))
                weight[w] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(p) / mean))
            best = max(best, sum(x for w, x in weight.items() if w in held) / sum(weight.values()))
        out[d, i] = best
    return out


def damaged(rng, words, most):
    """``words`` with up to ``most`` replaced, cut into pieces that keep whole shingles, far apart."""
    words = [rng.choice(VOCAB) if rng.random() < most else w for w in words]
    pieces, at = [], 0
    while at < len(words):
        size = rng.randrange(5, 30)
        pieces.append(" ".join(words[max(0, at - 4):at + size]))
        at += size
    rng.shuffle(pieces)
    gap = " ".join(f"gap{i}" for i in range(150))
    return f" {gap} ".join(pieces)


def planted(seed, n=60):
    rng = random.Random(seed)
    items = [(i, ". ".join(" ".join(rng.choices(VOCAB, k=rng.choice([1, 3, 5, 9, 20, 90])))
                           for _ in range(rng.randrange(1, 4))) + ".") for i in range(n)]
    docs = []
    for d in range(150):
        i = rng.randrange(n)
        q, a = halves(items[i][1])
        docs.append((d, damaged(rng, q, rng.choice([0, 0.01, 0.03])) + " tail " + damaged(rng, a, rng.choice([0, 0.02]))))
    docs += [(200 + i, " ".join(rng.choices(VOCAB, k=rng.choice([0, 4, 60, 600])))) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_all_items_that_verify_are_retrieved(seed):
    docs, items = planted(seed)
    want = brute(docs, items)
    assert len(want) > 40
    index = decontaminate.Index(items)
    got = {(d, index.items[m[0]][0]): m[2:] for (d, _), ms in
           zip(docs, decontaminate.matches(index, [t for _, t in docs], 0.8)) for m in ms}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-12 for k in want for x, y in zip(got[k], want[k]))


def test_threshold_is_under_what_containment_leaves():
    rng = random.Random(1)
    for _ in range(300):
        words = [w.encode() for w in rng.choices(VOCAB[:rng.choice([6, 20, 80])], k=rng.randrange(1, 60))]
        weights = {w: rng.random() + 0.01 for w in words}
        own = decontaminate.shingles(words)
        need = decontaminate.needed(weights, own, 0.8)
        assert 0 < need <= 1 + 1e-12
        least = next(c for c in range(1, len(own) + 1) if c / len(own) >= 0.8)
        for _ in range(10):
            left = rng.sample(sorted(own), least)
            held = {w for s in left for w in s.split()}
            assert sum(weights[w] for w in held) / sum(weights.values()) >= need - 1e-12


def test_units_share_out_a_parts_shingles():
    rng = random.Random(2)
    for size in (0, 1, 4, 5, 6, 67, 68, 69, 200, 400):
        text = " ".join(rng.choices(VOCAB[:12], k=size))
        units = decontaminate.units_of(text)
        for number, part in enumerate(decontaminate.question_answer(text)):
            mine = [own for p, _, own in units if p == number]
            assert sum(map(len, mine)) == len(set().union(*mine)) and set().union(*mine) == decontaminate.shingles(part)
            assert all(len(own) <= decontaminate.UNIT for own in mine)


def test_scores_against_brute_force(spark, edge):
    docs, items = planted(9)
    items = [(i, t) for i, t in items if all(len(p) <= 60 for p in halves(t))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in
           decontaminate.contaminated(edge([(*d, "a") for d in docs]), table, shard_chars=1500).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys()
    scores = brute_scores(docs, items, want)
    assert all(got[k].score <= scores[k] + 1e-9 for k in got)  # shares of the parts that were retrieved
    assert all(abs(got[k].score - scores[k]) < 1e-9 for k in got)


def test_long_texts_and_ties(spark, edge):
    rng = random.Random(3)
    item = " ".join(f"q{i}" for i in range(20)) + ". " + " ".join(f"a{i}" for i in range(9)) + "."
    noise = " ".join(rng.choices(VOCAB, k=200_000))
    docs = [(1, noise), (2, f"{noise} {item} {noise}"), (3, item), (3, item), (4, item.split(". ")[0])]
    items = spark.createDataFrame([(7, item), (8, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in
                 decontaminate.contaminated(edge([(*d, "a") for d in docs]), items).collect())
    assert got == [(2, 7), (2, 8), (3, 7), (3, 7), (3, 8), (3, 8)]
    kept = decontaminate.decontaminate(edge([(*d, "a") for d in docs]), items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
