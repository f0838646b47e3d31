"""Chat formatting, token files and BPE: exact round trips against the library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
import reference as R
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeledger.llm import bpe, chat, pieces, tokenfile
from lakeledger.llm.registry import vocabulary

BYTE, WORD = (vocabulary(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
HARD_ENCODER = bpe.ChunkEncoder(WORD)
HARD_TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] x [/INST]"), (1, 1, "assistant", "tie"),
              (1, 1, "assistant", "tie"), (2, None, None, None), (2, 3, "system", "<<SYS>> a <<|>> b <</SYS>>"),
              (2, 4, "a <<|>> b", "<\\s> [\\INST] <\\\\/s>"), (None, 0, "assistant", ""), (3, 0, "user", "[INST"),
              (3, 1, "assistant", " lead and trail "), (3, 2, "user", "x" * 200_000), (4, 0, "", "é퟿")]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_chat_round_trip(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    hard = "</s>[INST] ok [/INST]"
    for df in (conv, spark.createDataFrame(HARD_TURNS, "conv_id long, turn long, role string, text string"), conv.limit(0)):
        want = R.conversations([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
                               + [(-7, 0, "user", hard), (-7, 1, "assistant", hard)])
        got = sorted([tuple(r) for r in chat.chat_digests(df).collect()], key=repr)
        assert [g[:5] for g in got] == want and all(g[5] > 0 for g in got)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a <<|>>"]),
                          st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "INST]", "/", " ", "a", "s>", "|>>"]),
                                   max_size=8).map("".join)), max_size=5))
def test_any_turns_parse_back(turns):
    assert chat.parse("".join(chat.render(r, t) for r, t in turns)) == turns


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=300), st.integers(0, 1 << 40))
def test_elias_fano(steps, scale):
    values = np.cumsum([0, *[s * scale // 3000 for s in steps]])
    ef = tokenfile.EliasFano.build(values)
    assert ef.select(np.arange(len(values))).tolist() == values.tolist()
    assert ef.select(np.array([len(values) - 1])).tolist() == [values[-1]]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(0, 1000, 10000))
    ef = tokenfile.EliasFano.build(values)
    assert len(ef.lower) + len(ef.upper) + ef.samples.nbytes < 10000 * 12 / 8


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_token_file(request, spark, kind):
    docs = request.getfixturevalue(kind)
    got = sorted([tuple(r) for r in tokenfile.token_offsets(docs, BYTE).collect()], key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda i: (i is not None, i or 0))
    tok = Tokenizer.from_file(BYTE)
    # ties of doc_id may come in any order of their texts: compare places, then each document's ids
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    key = lambda r: (repr(r[0]), r[2], r[3])
    want = [(i, 0, n, c) for i, _, n, c in R.tokens_file(pairs(docs), tok)]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_small_segments(spark, documents, tmp_path):
    tokenfile.write_tokens(documents, f"{tmp_path}/t", BYTE, 2, 50257, segment_ids=700)
    got = sorted([tuple(r) for r in tokenfile.read_tokens(spark, f"{tmp_path}/t").collect()])
    assert got == R.tokens_file(sorted(pairs(documents)), Tokenizer.from_file(BYTE))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab1.' \n\t\x85　\x1cé,'s")), max_size=30))
def test_cut_before_blanks_is_exact(text):
    memo = pieces.Memo(BYTE)
    got = np.frombuffer(pieces.encode_texts(memo, [text])[0], "<u4").tolist()
    assert got == pieces.tokenizer(BYTE).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["documents", "hard", "empty"])
def test_bpe(request, kind):
    docs = request.getfixturevalue(kind)
    got = sorted([tuple(r) for r in bpe.encode_documents(docs, WORD).collect()], key=repr)
    assert got == R.bpe(pairs(docs), Tokenizer.from_file(WORD))


def test_shared_chunks_are_encoded_once():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    passage = " ".join(rng.choice(words) for _ in range(6000))
    encoder, tok = bpe.ChunkEncoder(WORD), Tokenizer.from_file(WORD)
    for lead in ("", "some words before ", "x"):
        raw = (lead + passage).encode()
        (ids, decoded), = encoder.encode([raw], [bpe.boundaries(np.frombuffer(raw, np.uint8))])
        want = tok.encode(raw.decode(), add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == tok.decode(want, skip_special_tokens=False)
    assert encoder.reused > 1.5 * encoder.encoded


def test_simple_texts_need_no_normalizer():
    encoder = bpe.ChunkEncoder(WORD)
    assert encoder.latin is not None and encoder.ascii is not None
    every = [chr(c) for c in range(0x3100) if bpe.SIMPLE.fullmatch(chr(c))]
    texts = ["".join(every), *[f"A{c}b {c}{c} 1{c}" for c in every], "<|STARTOFTEXT|> x <|endoftext|> Y", "it's  IT'S\t'S\r\n\nno"]
    texts += ["é" + c + "a" for c in map(chr, range(0x20, 0x400))]
    for t, got in zip(texts, encoder.library([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tok.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "word", "tion", " ", "\n\t", "'s", "'re", "'l", "''", "'", "-", "\u2019", "7", "½",
                                          "é", "ß", "ª", "\u20ac", "İ"]), max_size=40).map("".join), max_size=5))
def test_simple_texts_go_through_the_library_unsplit(texts):
    encoder = HARD_ENCODER
    assert encoder.latin.pre_tokenizer is None  # no split by words, which took most of the time
    lows = [t.lower() for t in texts]
    # a mark (from U+0180 on) at each word's end, and nothing else lost but blanks
    words = [[w for w, _ in encoder.tok.pre_tokenizer.pre_tokenize_str(t)] for t in lows]
    plain = bpe.byte_level()
    assert bpe.marked(lows) == ["".join(w[:-1] + chr(0x180 + plain.index(w[-1])) for w in ws) for ws in words]
    for t, got in zip(texts, encoder.library([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tok.encode(t, add_special_tokens=False).ids, t


def test_a_model_that_merges_over_words_is_split():
    spec = json.loads(HARD_ENCODER.tok.to_str())
    assert bpe.unsplit(spec) is not None
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    over = spec["model"] | {"vocab": vocab | {"a</w>b": len(vocab)}, "merges": [*merges, ["a</w>", "b"]]}
    lacking = spec["model"] | {"vocab": {t: i for t, i in vocab.items() if t != "a</w>"}}
    assert bpe.unsplit(spec | {"model": over}) is None and bpe.unsplit(spec | {"model": lacking}) is None


def test_a_join_that_disagrees_is_widened():
    tok, encoder = Tokenizer.from_file(WORD), bpe.ChunkEncoder(WORD)
    left, right = b"some words lead to a run of " + b"!" * 40, b"!" * 20 + b" more words, and more of them then"
    raw = left + right
    # the window's left end stands within the run: its own ids aren't the end of the left chunk's
    own = dict(zip((left, right), encoder.library([left, right])))
    a, b, both = encoder.repair(own, {(left, right)})[left, right]
    assert encoder.widened > 0
    want = tok.encode(raw.decode(), add_special_tokens=False).ids
    assert np.frombuffer(own[left][:len(own[left]) - a] + both + own[right][b:], "<u4").tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "word", "tion", " ", "  ", "\n", "'s", "'", "--", "!", "1", "é", "é", "\u0301", "ß",
                                 "İ", "漢", "<|endoftext|>", "_", "\u00a0"]), max_size=120).map("".join),
       st.lists(st.integers(0, 300), max_size=9))
def test_any_cuts_give_the_whole_text(text, cuts):
    raw, least = text.encode(), bpe.LEAST
    bpe.LEAST = 1
    try:
        (ids, decoded), = HARD_ENCODER.encode([raw], [np.array(sorted({c for c in cuts if c < len(raw)}), np.int64)])
    finally:
        bpe.LEAST = least
    want = HARD_ENCODER.tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded.decode() == HARD_ENCODER.tok.decode(want, skip_special_tokens=False)


def test_a_full_memo_changes_nothing():
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdé.") for _ in range(rng.randrange(1, 7))) for _ in range(800))
             for _ in range(12)]
    tok = Tokenizer.from_file(WORD)
    encoder = bpe.ChunkEncoder(WORD, entries=50, chunk_bytes=4000)
    for t in texts:
        raw = t.encode()
        (ids, decoded), = encoder.encode([raw], [bpe.boundaries(np.frombuffer(raw, np.uint8))])
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded.decode() == tok.decode(want)
    memo, tok = pieces.Memo(BYTE, entries=50), pieces.tokenizer(BYTE)
    for got, t in zip(sum((pieces.encode_texts(memo, texts[i:i + 3]) for i in range(0, 12, 3)), []), texts):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_bpe_ids_and_text(edge):
    r = bpe.encode_documents(edge([(1, "Hello  World", "s")]), WORD, summary=False).first()
    tok = Tokenizer.from_file(WORD)
    assert r.ids == tok.encode("Hello  World", add_special_tokens=False).ids and r.decoded == tok.decode(r.ids)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.ChunkEncoder(str(public_tokenizers.path("byte_bpe_50k.json")))
