"""Line dedup, SimHash, secrets, PII against brute force over whole tables and hard rows."""

import itertools
import random

import numpy as np
import pytest
import reference as R
from conftest import HARD
from pyspark.sql import functions as F

from lakeledger.llm import lines, pii, secrets, simhash
from lakeledger.llm.components import connected_components


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_line_dedup(request, kind):
    docs = request.getfixturevalue(kind)
    assert rows(lines.line_digests(docs)) == R.lines(pairs(docs))


def test_line_dedup_keeps_other_columns(hard):
    out = lines.dedup_lines(hard)
    assert set(hard.columns) <= set(out.columns) and out.count() == len(HARD)
    assert {(r._row, r._id) for r in out.collect()} == {("x", "y")}


def test_line_dedup_runs_no_python(documents):
    plan = lines.line_digests(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_simhash_components(request, kind):
    docs = request.getfixturevalue(kind)
    assert rows(simhash.simhash_components(docs)) == R.components(pairs(docs))


def test_bit_planes_find_all_links():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    for radius in (0, 1, 2, 3, 5):
        values, group = [], []
        for g, size in enumerate([1, 2, 3, 70, 200, 64, 1]):
            for _ in range(size):
                v = int(base[rng.integers(0, 40)])
                for b in rng.integers(0, 64, rng.integers(0, 5)):
                    v ^= 1 << int(b)
                values.append(v)
                group.append(g)
        values, group = np.array(values, np.uint64), np.array(group)
        got = {tuple(sorted((int(a), int(b)))) for x, y in simhash.links(values, group, radius) for a, b in zip(x, y)}
        want = {(i, j) for i, j in itertools.combinations(range(len(values)), 2)
                if group[i] == group[j] and (int(values[i]) ^ int(values[j])).bit_count() <= radius}
        assert got == want


@pytest.mark.parametrize("bucket_rows", [2, 2048])
def test_large_buckets_are_dealt_again(spark, bucket_rows):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(4)]
    fps = {base[0], base[1]}
    for _ in range(200):
        v = base[rng.randrange(4)]
        for _ in range(rng.randrange(6)):
            v ^= 1 << rng.randrange(64)
        fps.add(v - (1 << 64) if v >> 63 else v)
    fps = sorted(fps)
    got = simhash.similar_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, bucket_rows)
    comp = {r.node: r.component for r in connected_components(got).collect()}
    root = {f: f for f in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in itertools.combinations(fps, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: comp.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 60)} | {199: 199, 200: 199}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_least_neighbours_are_a_table_when_they_are_joined(spark):
    """So AQE can split the rows of a hub; it can't beside an aggregate."""
    from lakeledger.llm import components
    n = 200_000
    edges = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        star = components._star(edges.repartition(8, "v"), True)
        assert star.count() == n and star.filter("u = 0").count() == n
        plan = star._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == 1  # the distinct alone
        got = connected_components(edges.limit(20_000))
        assert got.filter("component = 0").count() == got.count() == 20_001
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_keep_one_of_each_group(edge, hard):
    docs = edge([(5, "a b c d e f", "s"), (3, "A b c d e f", "s"), (3, "A b c d e f", "s"), (3, "other text here", "s"),
                 (None, "lonely words only", "s"), (None, "and more lonely ones", "s"), (9, "OTHER text here", "s")])
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=repr)
    assert got == sorted([(3, "A b c d e f"), (3, "other text here"), (None, "lonely words only"),
                          (None, "and more lonely ones")], key=repr)
    assert simhash.keep_one(hard).columns == hard.columns
    assert simhash.keep_one(hard.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_secret_base_spans(request, kind):
    docs = request.getfixturevalue(kind)
    got = sorted([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.secret_spans(docs).collect()],
                 key=repr)
    want = []
    for i, t in pairs(docs):
        base = R.secrets_base(t)
        want.append((i, *[sum(s[0] == k for s in base) for k in ("assign", "access", "hex")], R.span_digest(base)))
    assert got == sorted(want, key=repr)


def test_ownership_separates_copies_from_live_secrets(edge):
    live, copied, example = "q7Zp2Lw9Xc4Vb8Nm3Kd6", "m4Rt8Yk2Wq6Zx1Cv5Bn9", "EXAMPLE1example2example3"
    docs = edge([(1, f"see {live} here", "a"), (2, f"and {live}", "a"), (3, f"x {copied}", "a"), (4, f"y {copied}", "b"),
                 (5, f"z {example}", "c"), (6, "password=k9j8h7g6f5d4", "d"), (7, "password=k9j8h7g6f5d4", "e"),
                 (8, "token=p0o9i8u7y6t5", "a"), (8, "token=p0o9i8u7y6t5", "a")])
    got = {r.doc_id: (r.spans, r.n_live, r.n_copied) for r in secrets.secret_spans(docs).collect()}
    assert got == {1: ("opaque:4:24", 1, 0), 2: ("opaque:4:24", 1, 0), 3: ("", 0, 0), 4: ("", 0, 0), 5: ("", 0, 0),
                   6: ("assign:0:21", 0, 1), 7: ("assign:0:21", 0, 1), 8: ("assign:0:18", 1, 0)}


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_personal_base_spans(request, kind):
    docs = request.getfixturevalue(kind)
    got = sorted([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
                  for r in pii.personal_spans(docs).collect()], key=repr)
    want = []
    for i, t in pairs(docs):
        base = R.pii_base(t)
        want.append((i, *[sum(s[0] == k for s in base) for k in pii.KINDS], R.span_digest(base)))
    assert got == sorted(want, key=repr)


def test_patterns_discover_unseen_identifiers(edge):
    rows = [(i, f"please phone me: +1 555 010 {1000 + i} now", "a") for i in range(6)]
    rows += [(10, "please phone me: 555-0101999 now", "a"), (11, "the year of 20240101 was fine", "a"),
             (12, "please phone me: 555-0101999 or not", "b")]
    got = {r.doc_id: r.spans for r in pii.personal_spans(edge(rows)).collect()}
    assert got[10] == "phone:17:28" and got[12] == "phone:17:28" and got[11] == ""
    assert got[0] == "phone:17:32"


def test_a_pattern_of_mixed_use_discovers_nothing(edge):
    rows = [(i, f"see also +1 555 010 {1000 + i} now", "a") for i in range(3)]
    rows += [(100 + i, f"see also {20000 + i} pages", "a") for i in range(30)]
    got = pii.personal_spans(edge(rows)).filter(F.col("doc_id") >= 100)
    assert {r.spans for r in got.collect()} == {""}


def test_discovered_values_are_seeds_and_marked_everywhere(edge):
    rows = [(i, f"please phone me: +1 555 010 {1000 + i} thanks", "a") for i in range(30)]
    rows += [(100 + i, f"please phone me: 555 123 {4560 + i} today", "a") for i in range(8)]
    rows += [(200 + i, f"reach my desk on 555-123-{4560 + i} if needed", "a") for i in range(8)]  # a pattern of found ones
    rows += [(300, "reach my desk on 777 888 9999 tomorrow", "a"), (301, "I wrote down 555.123.4561 somewhere", "a"),
             (302, "I wrote down 555.999.4561 somewhere", "a"), (303, "please phone me: 4567", "a")]
    rows += [(400 + i, f"please write to u{i}@mail.example.org soon", "a") for i in range(9)]
    rows += [(500, "please write to jane (at) mail dot org soon", "a"), (501, "please write to @jane_doe soon", "a")]
    got = {r.doc_id: r.spans for r in pii.personal_spans(edge(rows)).collect()}
    assert got[100] == "phone:17:29" and got[200] == "phone:17:29" and got[300] == "phone:17:29"
    assert got[301] == "phone:13:25" and got[302] == "" and got[303] == "phone:17:21"
    assert got[500] == "email:16:38" and got[501] == "email:16:25"


def test_doubt_does_not_add_up_over_rounds(edge):
    number = "55512{:05d}".format
    rows = [(i, f"kindly dial: +1 555 12 {i:05d} a{i} b{i}", "a") for i in range(72)]
    rows += [(100 + i, f"kindly dial: {number(500 + i)} c{i} d{i}", "a") for i in range(25)]      # 72 seeds of 97
    rows += [(200 + i, f"room was {number(500 + i)} e{i} f{i}", "a") for i in range(25)]
    rows += [(300 + i, f"room was {number(700 + i)} g{i} h{i}", "a") for i in range(9)]           # 25 found ones of 34
    rows += [(400 + i, f"lot has {number(700 + i)} i{i} j{i}", "a") for i in range(9)]
    rows += [(500 + i, f"lot has {number(900 + i)} k{i} l{i}", "a") for i in range(2)]            # none near
    got = {r.doc_id: bool(r.spans) for r in pii.personal_spans(edge(rows)).collect()}
    marked = [sum(got[i] for i in got if a <= i < b) for a, b in ((0, 200), (200, 300), (300, 400), (400, 500), (500, 600))]
    assert marked == [97, 25, 0, 0, 0]


def test_bootstrap_against_brute_force(edge):
    rng = random.Random(3)
    leads = ["phone me at", "mail goes to", "server on", "id is", "see", "x" * 300 + " at", "y" * 299 + "z at", ""]
    tails = ["now", "or " + "w" * 400, "please do", "then\n", ""]
    digits = [f"{rng.randrange(10**9, 10**10)}" for _ in range(12)]
    values = {"phone": lambda: f"+{rng.choice(digits)}", "plain": lambda: rng.choice(digits),
              "mail": lambda: f"u{rng.randrange(9)}@mail.example.org", "handle": lambda: f"@name_{rng.randrange(6)}",
              "year": lambda: str(rng.randrange(1990, 2030)), "spelt": lambda: f"u{rng.randrange(9)} at mail dot org"}
    liked = {"phone me at": ["phone"] * 12 + ["plain", "plain"], "mail goes to": ["mail"] * 9 + ["handle", "spelt"],
             "id is": ["plain", "year"], "x" * 300 + " at": ["phone"] * 9 + ["plain"]}
    rows = []
    for i in range(260):
        lead = rng.choice(leads)
        rows.append((i, f"{lead} {values[rng.choice(liked.get(lead, list(values)))]()} {rng.choice(tails)}", "a"))
    rows += [(900, None, "a"), (901, "", "a"), (900, None, "a"), (None, rows[0][1], None)]
    got = sorted([(r.doc_id, r.spans) for r in pii.personal_spans(edge(rows)).collect()], key=repr)
    want = R.pii_spans([r[:2] for r in rows], pii.slots, pii.identity, pii.distinctive)
    assert got == sorted([(r[0], w) for r, w in zip(rows, want)], key=repr)
    assert any(w and w != ",".join(f"{k}:{s}:{e}" for k, s, e in R.pii_base(r[1] or "")) for r, w in zip(rows, want))


def test_contexts_hold_whole_words():
    long = "Path/" * 60
    words = pii.Words(f"one {long} 12345 {long} two")
    at = words.text.index(" 12345") + 1
    left, right = pii.contexts(words, at, at + 5)
    assert left.startswith("< one #300:") and right.startswith("> #300:") and right.endswith(" two")
    other = pii.Words(f"one X{long[1:]} 12345 {long} two")
    assert pii.contexts(other, at, at + 5)[0] != left and pii.contexts(other, at, at + 5)[1] == right
    assert pii.contexts(pii.Words(f"one {long.upper()} 12345"), at, at + 5) == (left, "")
    words = pii.Words("12345," * 30_000)
    assert all(pii.contexts(words, i * 6, i * 6 + 5) for i in range(30_000))


def test_slots_are_shapes():
    text = "call (555) 123-4567 or 4111 1111 1111 1112, 12 eggs, in 2024, x_y z.w @me bob [at] a [dot] b 1 2"
    assert [(k, text[s:e]) for k, s, e in pii.slots(text, [])] == [
        ("handle", "x_y"), ("handle", "z.w"), ("handle", "@me"), ("handle", "bob [at] a [dot] b"),
        ("number", "555) 123-4567"), ("number", "4111 1111 1111 1112"), ("number", "2024")]
    assert pii.slots("9 " * 50000 + "a.b" * 50000 + " at" * 50000, [])


@pytest.mark.parametrize("share", [35, 60])
def test_a_pattern_with_a_third_or_half_of_seeds_discovers_nothing(edge, share):
    rows = [(i, f"number was +1 555 010 {1000 + i} then", "a") for i in range(share)]
    rows += [(1000 + i, f"number was {2000000 + i} so", "a") for i in range(100 - share)]
    got = pii.personal_spans(edge(rows)).filter(F.col("doc_id") >= 1000)
    assert {r.spans for r in got.collect()} == {""}


def test_ownership_counts_documents_and_copies_of_a_document_once(edge):
    mirrored, pasted, few = "q7Zp2Lw9Xc4Vb8Nm3Kd6", "m4Rt8Yk2Wq6Zx1Cv5Bn9", "h5Jt7Rw3Ys9Dk2Fg8Lp4"
    docs = edge([(1, f"see {mirrored} here", "a"), (2, f"see  {mirrored} here\n", "b"), (3, f"see {mirrored} here", "c")]
                + [(100 + i, f"note {i} on {pasted}", "a") for i in range(30)]
                + [(200 + i, f"page {i} on {few}", "a") for i in range(3)])
    got = {r.doc_id: (r.spans, r.n_live, r.n_copied) for r in secrets.secret_spans(docs).collect()}
    assert got[1] == got[3] == ("opaque:4:24", 1, 0) and got[2] == ("opaque:5:25", 1, 0)
    assert {got[100 + i] for i in range(30)} == {("", 0, 0)}
    assert {got[200 + i] for i in range(3)} == {("opaque:10:30", 1, 0)}


def test_counts_are_written_before_they_are_joined(documents):
    plan = secrets.scan_secrets(documents)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan
