"""Spelling variants, ranked search, packing against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import reference as R
from conftest import SF
from tokenizers import Tokenizer

from lakeledger.llm import packing, ranked, spelling
from lakeledger.llm.registry import ORACLE

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_spelling_variants(request, kind):
    docs = request.getfixturevalue(kind)
    assert rows(spelling.spelling_variants(docs)) == R.spelling(pairs(docs))


@pytest.mark.parametrize("group_words", [1, 3, 50])
def test_spelling_of_crowded_prefixes(edge, group_words):
    """One prefix, one first letter or a family of variants holds most words: frontiers go deeper, links stay."""
    rng = random.Random(5)
    stem = "abababababab"
    words = [stem + "".join(rng.choice("abÀÿ") for _ in range(rng.randint(0, 4))) for _ in range(150)]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(4, 7))) for _ in range(150)]
    words += ["aaaaa" + "a" * i for i in range(8)] + ["x" * 3000, "x" * 2999 + "y", "x" * 2999]
    docs = edge([(None if i % 7 == 0 else i, " ".join(words[i % 5:] + words[:i % 5]), "a") for i in range(5)])
    got = spelling.spelling_variants(docs, group_words=group_words)
    assert rows(got) == R.spelling(pairs(docs))


def test_spelling_ties_chains_and_repeats(edge):
    text = "abcdefg " * 3 + "abcdefx " * 6 + "abcdefy " * 6 + "abcdyfy " * 13 + "abzdyfy " * 40 + "ABCDE " * 2 + "abcde"
    docs = edge([(None, text, "a"), (None, text, "a")])
    got = {r.word: r for r in spelling.spelling_variants(docs).collect()}
    assert (got["abcdefg"].form, got["abcdefg"].root, got["abcdefg"].n_near) == ("abcdefx", "abcdefx", 2)
    assert (got["abcdefy"].form, got["abcdefy"].root) == ("abcdyfy", "abzdyfy")
    assert rows(spelling.spelling_variants(docs)) == R.spelling(pairs(docs))


def test_minimal_acceptor_and_composition():
    rng = random.Random(1)
    for _ in range(30):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(40)})
        a = spelling.Acceptor(words)
        reached, stack = {0}, [0]
        while stack:
            for s in a.arcs[stack.pop()].values():
                if s not in reached:
                    reached.add(s)
                    stack.append(s)
        rights = {}

        def right(s):
            if s not in rights:
                rights[s] = frozenset([""] * a.final[s] + [x + w for x, t in a.arcs[s].items() for w in right(t)])
            return rights[s]

        assert right(0) == set(words)
        assert len({right(s) for s in reached}) == len(reached)  # minimal
        got = [tuple(sorted(p)) for p in spelling.Composition(a).pairs()]

        def near(x, y):
            x, y = sorted((x, y), key=len)
            if len(x) == len(y):
                return sum(i != j for i, j in zip(x, y)) == 1
            return any(y[:i] + y[i + 1:] == x for i in range(len(y)))

        want = sorted(tuple(sorted(p)) for p in itertools.combinations(words, 2) if near(*p))
        assert sorted(got) == want


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_ranked_search(spark, request, kind):
    docs = request.getfixturevalue(kind)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert rows(ranked.rank(docs, items)) == R.ranked(pairs(docs), asked)


def test_ranked_edges(spark, edge):
    docs = edge([(i % 20 if i % 11 else None, f"{'common ' * (i % 4)}word{i % 6} É{'x' * (i % 3)} tail", "a") for i in range(90)])
    items = spark.createDataFrame([
        (1, "common WORD3 tail", 1), (1, "common WORD3 tail", 2), (None, "word1 word1 éx", 3), (2, None, 4), (3, "", 5),
        (4, "absent", 6), (5, "tail", 7), (6, "tail common common word5 Éxx word2 word4", 8)], "item_id long, text string, row int")
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert rows(ranked.rank(docs, items)) == R.ranked(pairs(docs), asked)
    assert rows(ranked.rank(docs, items, 3)) == R.ranked(pairs(docs), asked, 3)
    assert ranked.rank(docs, items.limit(0)).count() == 0


def test_query_blocks_and_small_segments(spark, documents, monkeypatch):
    """Many segments in a task and many blocks of queries: the threshold goes along, results stay."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(ranked, "build_index", lambda d, f=ranked.build_index: f(d.coalesce(2), 3000))
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert rows(ranked.rank(documents, items)) == R.ranked(pairs(documents), asked)


@pytest.mark.parametrize("short", [0, 5, 40, 10_000])
def test_hybrid_is_exact(short):
    rng = np.random.default_rng(3)
    for _ in range(60):
        lists = []
        for _ in range(rng.integers(1, 9)):
            docs = np.sort(rng.choice(200, rng.integers(1, 120), replace=False))
            scores = rng.integers(0, 30, len(docs))
            lists.append((int(scores.max()), docs, scores))
        total = np.zeros(200, np.int64)
        for _, d, s in lists:
            total[d] += s
        want = sorted(total[total > 0], reverse=True)[:5]
        top, least = [], 1
        found = ranked.hybrid(lists, 5, least, short)
        entry = next(found, None)
        while entry:
            assert total[entry[0]] == entry[1]
            top = sorted([*top, entry[1]], reverse=True)[:5]
            least = max(1, top[-1]) if len(top) == 5 else 1
            try:
                entry = found.send(least)
            except StopIteration:
                entry = None
        assert [x for x in top if x > 0] == want


def test_ranked_oracle_is_registered():
    assert "op12_ranked" in ORACLE


def test_capacities_find_the_tightest():
    rng = random.Random(2)
    tree, held = packing.Capacities(100), set()
    for _ in range(3000):
        c = rng.randint(0, 100)
        if rng.random() < 0.5:
            tree.set(c)
            held.add(c)
        elif c in held:
            tree.clear(c)
            held.discard(c)
        need = rng.randint(0, 100)
        assert tree.tightest(need) == min((x for x in held if x >= need), default=None)


def test_best_fit_decreasing_against_a_plain_scan():
    rng = random.Random(4)
    for _ in range(20):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        free = []
        for n in sorted(lengths, reverse=True):
            fits = [(room, i) for i, room in enumerate(free) if room >= n]
            if fits:
                free[min(fits)[1]] -= n
            else:
                free.append(64 - n)
        got = packing.best_fit_decreasing(lengths, 64)
        assert sorted(64 - sum(lengths[i] for i in w) for w in got) == sorted(free)
        assert sorted(i for w in got for i in w) == list(range(len(lengths)))


def check_packed(got, docs, window=1024, end=0):
    tok = Tokenizer.from_file(VOCABULARY)
    want = sorted([(i, *ids) for i, t in docs for ids in [tok.encode(t or "", add_special_tokens=False).ids + [end]]], key=repr)
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0  # full, or a power of two: no padding
    pieces = sorted(x[:2] + (x[2],) for v in by_doc.values() for x in v)
    starts = {}
    for i, *ids in want:  # repeated documents: a piece for each
        starts.setdefault((i, len(ids)), []).append(ids)
    assert set(starts) == set(by_doc)
    for key, copies in starts.items():
        for ids in copies:
            assert key[1] == len(ids)
        assert sum(length for _, length, _ in by_doc[key]) == key[1] * len(copies)
        crcs = {}
        for start, length, crc in by_doc[key]:
            crcs[start, length, crc] = crcs.get((start, length, crc), 0) + 1
        for (start, length, crc), n in crcs.items():
            same = sum(zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) == crc for ids in copies)
            assert same >= n or len(copies) > 1 and same
        for at in range(key[1]):  # each id in one piece of each copy
            assert sum(s <= at < s + n for s, n, _ in by_doc[key]) == len(copies)
            if key[1] > 3000 and at > 50:
                break
    return pieces


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_packing(request, kind):
    docs = request.getfixturevalue(kind)
    check_packed(packing.packed_pieces(docs, VOCABULARY).collect(), pairs(docs))


def test_packing_in_small_batches(documents):
    docs = documents.limit(60)
    got = packing.pack(docs, VOCABULARY, 0, 128, batch_ids=500)
    total = 0
    for s in got.collect():
        assert s.n_tokens <= 128 and s.n_tokens & (s.n_tokens - 1) == 0 and len(s.ids) == 4 * s.n_tokens
        assert [p.offset for p in s.pieces] == list(itertools.accumulate([p.length for p in s.pieces], initial=0))[:-1]
        total += s.n_tokens
    tok = Tokenizer.from_file(VOCABULARY)
    assert total == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs(docs))


def test_packing_rebuilds_documents(documents):
    """Ids taken from the sequences by their pieces are the documents' ids."""
    tok = Tokenizer.from_file(VOCABULARY)
    built = {}
    for s in packing.pack(documents, VOCABULARY).collect():
        ids = np.frombuffer(s.ids, "<u4")
        for p in s.pieces:
            built.setdefault(p.doc_id, []).append((p.start, ids[p.offset:p.offset + p.length].tolist()))
    for i, t in pairs(documents):
        assert [x for _, part in sorted(built[i]) for x in part] == tok.encode(t or "", add_special_tokens=False).ids + [0]
