"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it where the hash of the last 32
bytes has a given form, so that equal passages give equal chunks wherever they
stand.  A chunk is encoded by the library, as a whole and once, while a worker's memo
holds it; documents are first dealt by range of (a hash of) the least hash of
their lines, so that copies and near copies meet in one task (the second sort
key splits a large group of copies over many tasks).

A chunk's own ids may be wrong at its ends, as the cut may stand inside a word, a
run of signs or a character with its marks.  At each join a window, the end of
the left chunk and the beginning of the right one, is encoded by the library in
three ways: both together, and each end on its own.  The window counts only if
the left chunk's ids end with those of its end, and the right chunk's begin with
those of its beginning; if not, it doubles, up to both chunks whole.  Chunks whose
two windows meet are encoded again as one.

Exactness: each end of a window holds a blank, and no token of a tokenizer
accepted here goes over a blank (checked when it is loaded), so what stands
before the first and behind the last blank of a window does not depend on the
other side.  Agreement shows that the chunks' ids outside the window, together
with the window's up to those blanks, are the ids of the text.  Cuts without a
blank on both sides are given up.

Texts of simple characters (most Latin ones) are lower-cased and their words'
ends marked here, many at a time by numpy; the library then takes a chunk as one
sequence through the same model spelled with these marks.  Its normalizer would
change nothing else in them, and its split by words takes most of its time.

Decoding follows the library for a tokenizer without a decoder: tokens joined by
one blank.

Edge cases: null text is empty and gives no ids; a null ``doc_id`` is kept; a
text of any length is cut the same way; repeated rows give repeated results; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import tokenizer

WINDOW, LEAST, MASK = 32, 256, 1023
_FACTOR = 0x9E3779B97F4A7C15


def boundaries(data: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last ``WINDOW`` bytes has its low bits zero.

    The polynomial hash of 2w bytes is that of the first w times the factor to
    the w, plus that of the last w: five doublings for 32 bytes.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    h = data.astype(np.uint64) + np.uint64(1)
    width, factor = 1, _FACTOR
    while width < WINDOW:
        h[width:] = h[width:] + h[:-width] * np.uint64(factor)
        width, factor = 2 * width, factor * factor % (1 << 64)
    mixed = h ^ (h >> np.uint64(29))
    return np.flatnonzero((mixed >> np.uint64(13) & np.uint64(MASK)) == 0) + 1


def chunks(raw: bytes, cuts: np.ndarray) -> list[bytes]:
    """``raw`` in chunks of ``LEAST`` bytes and more, each with a blank; cuts don't split characters."""
    out, start = [], 0
    for cut in cuts.tolist():
        while cut < len(raw) and raw[cut] & 0xC0 == 0x80:
            cut += 1
        if cut - start >= LEAST and cut < len(raw) and raw.find(b" ", start, cut) >= 0:
            out.append(raw[start:cut])
            start = cut
    if out and raw.find(b" ", start) < 0:
        out[-1] += raw[start:]
    else:
        out.append(raw[start:])
    return out


def _edge(byte: int) -> bool:
    """Whether a window may begin or end here: an ASCII sign, blank or control character."""
    return byte < 0x80 and not (0x30 <= byte <= 0x39 or 0x41 <= byte <= 0x5A or 0x61 <= byte <= 0x7A)


def tail(raw: bytes, width: int) -> bytes | None:
    """The last ``width`` bytes of a chunk from their first edge on; None if that holds no blank."""
    if width >= len(raw):
        return raw
    start = len(raw) - width
    while start < len(raw) and not _edge(raw[start]):
        start += 1
    return raw[start:] if raw.find(b" ", start) >= 0 else None


def head(raw: bytes, width: int) -> bytes | None:
    """The first ``width`` bytes of a chunk up to their last edge; None if that holds no blank."""
    if width >= len(raw):
        return raw
    end = width
    while end and not _edge(raw[end - 1]):
        end -= 1
    return raw[:end] if raw.find(b" ", 0, end) >= 0 else None


# characters that NFC leaves as they are, whatever stands beside them, and whose lower case has no context
SIMPLE = re.compile(r"[\t\n\r -~\u00a1-\u02ff\u2010-\u2027\u20ac]*")
# The steps before the model, which `marked` does for simple texts.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True}
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
BLANK, LETTER, DIGIT, SIGN = range(4)
LAST = 256  # added to the last byte of a word

_POINTS = [chr(c) for c in range(0x10000)]  # simple characters and their lower case are among them
KINDS = np.array([BLANK if c in "\t\n\r " else {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], SIGN)
                  for c in _POINTS], np.uint8)
SIZES = np.array([1 if c < "\x80" else 2 if c < "\u0800" else 3 for c in _POINTS], np.int64)


def byte_level() -> list[str]:
    """The character that stands for each byte in a byte-level tokenizer: itself if it can be seen, else one from 256 on."""
    seen = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    return [chr(b if s else 256 + b - sum(seen[:b])) for b, s in enumerate(seen)]


# the signs of bytes as code points: byte-level characters, from LAST on those of last bytes, 0 for blanks
SIGNS = np.array([*map(ord, byte_level()), *range(0x180, 0x280)], "<u2")
SIGNS[[b + i for b in b"\t\n\r " for i in (0, LAST)]] = 0


def marked(texts: list[str]) -> list[str]:
    """Lower-case simple texts in byte signs: without blanks, and words (pre-tokens) told by their last bytes."""
    joined = "\n" + "\n".join(texts) + "\n\n"
    units, raw = np.frombuffer(joined.encode("utf-16-le"), "<u2"), np.frombuffer(joined.encode(), np.uint8)
    kind = KINDS[units]
    last = kind == DIGIT
    last[:-1] |= kind[:-1] != kind[1:]
    quote = np.flatnonzero(units == ord("'"))
    quote = quote[kind[quote - 1] != SIGN]  # within a run of signs it is one of them
    a, b = units[quote + 1], units[quote + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = np.isin(a, [ord("r"), ord("v")]) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    last[quote[one | two]] = False
    last[quote[one] + 1] = last[quote[two] + 2] = True
    at = np.flatnonzero(last)
    if len(raw) > len(units):
        at = np.cumsum(SIZES[units])[at] - 1
    codes = raw.astype(np.int64)
    codes[at] += LAST
    signs = SIGNS[codes]
    kept = signs > 0
    starts = np.cumsum([1, *[len(t.encode()) + 1 for t in texts]])
    ends = np.cumsum(np.add.reduceat(kept, starts, dtype=np.int64)).tolist()
    flat = signs[kept].tobytes().decode("utf-16-le")
    return [flat[s:e] for s, e in zip([0, *ends], ends[:-1])]


def unsplit(spec: dict):
    """The tokenizer for :func:`marked` texts, which takes each as one sequence; None if the tokenizer is unfit.

    Its model is the same with another spelling: the end of a word is part of its
    last byte's sign.  No merge goes on behind such a sign (checked), so that words
    do not meet, and neither a normalizer nor a split by words is needed.
    """
    model, steps = spec["model"], spec["pre_tokenizer"].get("pretokenizers", [])
    end, added = model.get("end_of_word_suffix"), {t["content"] for t in spec["added_tokens"]}
    if (spec["normalizer"] or {}).get("normalizers") != NORMALIZERS or steps != [SPLIT, BYTE_LEVEL] \
            or model["type"] != "BPE" or not end or any(model.get(k) for k in (
                "continuing_subword_prefix", "unk_token", "dropout", "byte_fallback", "ignore_merges")):
        return None
    plain = byte_level()
    ends = {c: chr(0x180 + b) for b, c in enumerate(plain)}

    def spelled(token: str) -> str:
        return token[:-len(end) - 1] + ends[token[-len(end) - 1]] if token.endswith(end) else token

    words = [t for t in model["vocab"] if t not in added]
    if any(t == end or not ends.keys() >= set(t) for t in words) or any(a.endswith(end) for a, _ in model["merges"]) \
            or not {*plain, *[c + end for c in plain]} <= set(words):
        return None
    from tokenizers import Tokenizer
    return Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "model": model | {
        "vocab": {t if t in added else spelled(t): i for t, i in model["vocab"].items()},
        "merges": [[spelled(a), spelled(b)] for a, b in model["merges"]], "end_of_word_suffix": None}}))


class ChunkEncoder:
    """Encodes texts; remembers chunks (``chunk_bytes``) and joins' windows (``entries``) up to a bound."""

    def __init__(self, path: str, entries: int = 100_000, chunk_bytes: int = 24 << 20):
        self.tok = tokenizer(path)
        spec = json.loads(self.tok.to_str())
        pre = json.dumps(spec["pre_tokenizer"])
        if spec["decoder"] is not None or '"behavior": "Removed"' not in pre or "[^\\\\s" not in pre \
                or any(" " in t["content"] for t in spec["added_tokens"]):
            raise ValueError("chunk reuse needs a tokenizer whose pre-tokens hold no blank")
        self.latin = self.ascii = unsplit(spec)
        self.added = [t["content"].lower() for t in spec["added_tokens"]]
        self.entries, self.chunk_bytes = entries, chunk_bytes
        size = max(self.tok.get_vocab().values()) + 1
        self.names = [(self.tok.id_to_token(i) or "").encode() for i in range(size)]
        self.known: dict[bytes, bytes] = {}  # ids of chunks, the younger half of the memo
        self.older: dict[bytes, bytes] = {}
        self.windows: dict[bytes, bytes] = {}
        self.held = self.encoded = self.reused = self.widened = self.merged = 0

    def library(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts on their own, little-endian unsigned 32-bit integers."""
        rest, simple = ([], []), ([], [])  # places and texts
        for i, raw in enumerate(texts):
            text, to = raw.decode("utf-8", "surrogatepass"), rest
            if self.latin is not None and SIMPLE.fullmatch(text):
                low = text.lower()
                if not any(t in low for t in self.added):
                    text, to = low, simple
            to[0].append(i)
            to[1].append(text)
        out = [b""] * len(texts)
        for by, at, own in ((self.tok, *rest), (self.latin, simple[0], marked(simple[1]))):
            for i, e in zip(at, by.encode_batch_fast(own, add_special_tokens=False) if own else []):
                out[i] = array("I", e.ids).tobytes() if sys.byteorder == "little" else np.array(e.ids, "<u4").tobytes()
        return out

    def keep(self, chunk: bytes, ids: bytes) -> None:
        """Remember a chunk; when half the bound is full, the older half makes room."""
        size = len(chunk) + len(ids) + 200
        if self.held + size > self.chunk_bytes // 2:
            self.older, self.known, self.held = self.known, {}, 0
        self.known[chunk] = ids
        self.held += size

    def encode_chunks(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct chunks; those that the memo lacks go through the library in one call."""
        found, new = {}, []
        for c in wanted:
            if (ids := self.known.get(c)) is not None:
                found[c] = ids
            elif (ids := self.older.get(c)) is not None:
                found[c] = ids
                self.keep(c, ids)
            else:
                new.append(c)
        for c, ids in zip(new, self.library(new)):
            found[c] = ids
            self.keep(c, ids)
        self.encoded += len(new)
        return found

    def repair(self, ids: dict[bytes, bytes], joins: set[tuple[bytes, bytes]]) -> dict[tuple, tuple[int, int, bytes]]:
        """Per join: bytes of ids that go at the left chunk's end and the right one's beginning, and what replaces both."""
        done, width = {}, WINDOW
        while joins:
            tried = {(a, b): (tail(a, width), head(b, width)) for a, b in joins}
            tried = {j: (x, y, x + y) for j, (x, y) in tried.items() if x is not None and y is not None}
            wanted = {t for w in tried.values() for t in w}
            got = {t: self.windows[t] for t in wanted if t in self.windows}
            new = list(wanted - got.keys())
            fresh = dict(zip(new, self.library(new)))
            got |= fresh
            if width == WINDOW:  # wider ones are rare and long
                if len(self.windows) + len(fresh) > self.entries:
                    self.windows = {}
                self.windows.update(list(fresh.items())[:self.entries])
            for (a, b), (x, y, both) in tried.items():
                if ids[a].endswith(got[x]) and ids[b].startswith(got[y]):
                    done[a, b] = len(got[x]), len(got[y]), got[both]
            joins = joins - done.keys()
            self.widened += len(joins)
            width *= 2
        return done

    def encode(self, texts: list[bytes], cuts: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded text) of each text in UTF-8; chunks that are known, or come twice, are encoded once."""
        parts = [chunks(t, c) for t, c in zip(texts, cuts)]
        before, total = self.encoded, sum(map(len, parts))
        out: list[bytes] = [b""] * len(texts)
        open_now = list(range(len(texts)))
        while open_now:
            ids = self.encode_chunks({c for i in open_now for c in parts[i]})
            joined = self.repair(ids, {j for i in open_now for j in zip(parts[i], parts[i][1:])})
            again = []
            for i in open_now:
                p = parts[i]
                ends = [joined[j] for j in zip(p, p[1:])]
                lost = list(zip([0, *[e[1] for e in ends]], [*[e[0] for e in ends], 0]))
                if all(a + b <= len(ids[c]) for c, (a, b) in zip(p, lost)):
                    own = [ids[c][a:len(ids[c]) - b] for c, (a, b) in zip(p, lost)]
                    out[i] = b"".join([x for o, e in zip(own, ends) for x in (o, e[2])] + own[-1:])
                else:  # the windows of a chunk meet: it and its right neighbour are one from now on
                    parts[i] = self.merge(p, [a + b > len(ids[c]) for c, (a, b) in zip(p, lost)])
                    again.append(i)
            open_now = again
        self.reused += max(0, total - self.encoded + before)
        names = self.names
        return [(x, b" ".join([names[t] for t in np.frombuffer(x, "<u4").tolist()])) for x in out]

    def merge(self, parts: list[bytes], full: list[bool]) -> list[bytes]:
        """Each chunk marked ``full`` in one with its right neighbour (the last one with its left)."""
        runs: list[list[bytes]] = []
        open_run = False
        for c, f in zip(parts, full):
            if open_run:
                runs[-1].append(c)
            else:
                runs.append([c])
            open_run = f
        if open_run and len(runs) > 1 and len(runs[-1]) == 1:
            runs[-2:] = [runs[-2] + runs[-1]]
        self.merged += len(parts) - len(runs)
        return [b"".join(r) for r in runs]


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker, kept from task to task."""
    return ChunkEncoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, summary: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, or with ``summary=False`` ``doc_id, ids, decoded``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        for b in slices(batches, "text", 2 << 20):
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            cuts = boundaries(np.frombuffer(b"".join(texts), np.uint8))
            at = np.searchsorted(cuts, np.concatenate(([0], ends)))
            own = [cuts[at[i]:at[i + 1]] - (int(ends[i]) - len(t)) for i, t in enumerate(texts)]
            out = encoder.encode(texts, [c[c >= WINDOW] for c in own])
            if summary:
                yield pa.record_batch([
                    b.column("doc_id"), pa.array([len(x) // 4 for x, _ in out], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x, _ in out]),
                    pa.array([hashlib.sha256(d).hexdigest() for _, d in out])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.record_batch([
                    b.column("doc_id"), pa.array([np.frombuffer(x, "<i4") for x, _ in out], pa.list_(pa.int32())),
                    pa.array([d.decode("utf-8", "replace") for _, d in out])], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # hashed again: the least hash of many lines is small, and long texts would share a range
    near = F.xxhash64(F.array_min(F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x))))
    return (rows.repartitionByRange(near, F.xxhash64("text", "doc_id"))
            .mapInArrow(scan, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if summary
                        else "doc_id long, ids array<int>, decoded string"))
