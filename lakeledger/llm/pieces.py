"""Whole texts to token ids with a memo of blank-separated pieces.

A tokenizer whose pre-tokens never go from a non-blank over a blank can be cut
before single blanks; each distinct piece is encoded by the library once per
worker while the memo (bounded, emptied when full) holds it.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

_HARD = re.compile(r"[^\S ] [^\S ]")
_CUT = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Memo:
    """The ids of pieces as little-endian integers of ``width`` bytes.

    Holds ``entries`` pieces; the first ones seen hold the frequent ones.  Once
    full it stays as it is until it has missed four times as many, as it does
    when the texts change, and then starts anew.
    """

    def __init__(self, path: str, width: int = 4, entries: int = 1_000_000):
        self.tok, self.code, self.entries = tokenizer(path), "H" if width == 2 else "I", entries
        self.missed = 0
        self.begins = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), bool)  # tokens that begin with a blank
        self.begins[[i for t, i in self.tok.get_vocab().items() if t.startswith("Ġ")]] = True
        self.after_blank: dict[str, bytes] = {}  # word -> ids of a blank and the word
        self.at_start: dict[str, bytes] = {}

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, in one call of the library."""
        code, swap = self.code, sys.byteorder == "big"
        out = [array(code, e.ids) for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        if swap:
            for a in out:
                a.byteswap()
        return [a.tobytes() for a in out]

    def ids_after_blank(self, pieces: list[str]) -> list[bytes]:
        """The ids of a blank and each piece: pieces without blanks are encoded as one text.

        Only a piece's first token can begin with a blank, so these tokens say where it begins.
        """
        plain = [p for p in pieces if " " not in p]
        ids = np.array(self.tok.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)[0].ids
                       if plain else [], np.int64)
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(plain) or len(at) and at[0]:
            return self.ids_of([" " + p for p in pieces])
        width = 2 if self.code == "H" else 4
        flat, ends = ids.astype(f"<u{width}").tobytes(), (np.append(at, len(ids)) * width).tolist()
        parts = [flat[s:e] for s, e in zip(ends, ends[1:])]
        if len(plain) < len(pieces):
            known = dict(zip(plain, parts))
            rest = [p for p in pieces if " " in p]
            known.update(zip(rest, self.ids_of([" " + p for p in rest])))
            parts = [known[p] for p in pieces]
        return parts

    def learn(self, memo: dict[str, bytes], lead: str, new: list[str]) -> dict[str, bytes]:
        """Encode pieces that ``memo`` lacks and keep them where there is room."""
        fresh = dict(zip(new, self.ids_after_blank(new) if lead else self.ids_of(new))) if new else {}
        if len(memo) + len(new) <= self.entries:
            memo.update(fresh)
        else:
            self.missed += len(new)
            if self.missed > 4 * self.entries:
                memo.clear()
                self.missed = 0
        return fresh


@lru_cache(maxsize=2)
def worker_memo(path: str, width: int) -> Memo:
    """The memo of this Python worker, kept from task to task."""
    return Memo(path, width)


def blank_cut(text: str) -> list[str]:
    """The text cut at blanks: the ids of the first part, and of each other one after a blank, are the text's.

    A run of white space stays whole where the byte-level pattern reads it as
    one: around double blanks, blanks among other white space, and at the end.
    """
    if text.endswith(" ") or "  " in text or _HARD.search(text):
        return _CUT.split(text)
    return text.split(" ")


def encode_texts(memo: Memo, texts: list[str]) -> list[bytes]:
    """The ids of each text, as bytes; only parts that the memo lacks are encoded.

    Equal parts of these texts are looked up once and their ids dealt out by
    position, so pass several megabytes of text at a time.
    """
    cut = [blank_cut(t) for t in texts]
    firsts = [c[0] for c in cut]
    start = {p: i for p in set(firsts) if (i := memo.at_start.get(p)) is not None}
    start |= memo.learn(memo.at_start, "", list(set(firsts) - start.keys()))
    parts = pa.array([p for c in cut for p in c[1:]], pa.string()).dictionary_encode()
    distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
    found = list(map(memo.after_blank.get, distinct))
    if None in found:
        gaps = [i for i, f in enumerate(found) if f is None]
        new = memo.learn(memo.after_blank, " ", [distinct[i] for i in gaps])
        for i in gaps:
            found[i] = new[distinct[i]]
    width = 2 if memo.code == "H" else 4
    flat = np.frombuffer(b"".join(found), f"<u{width}")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // width
    at = parts.indices.to_numpy()
    n = sizes[at]
    ends = np.cumsum(n)
    # place in ``flat`` of each id: its part's place there, less the part's place in the texts, plus its own
    ids = flat[np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - n), n) + np.arange(n.sum())].tobytes()
    bounds = (np.append(0, ends)[np.cumsum([0] + [len(c) - 1 for c in cut])] * width).tolist()
    return [start[first] + ids[s:e] for first, s, e in zip(firsts, bounds, bounds[1:])]
