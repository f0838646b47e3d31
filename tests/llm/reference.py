"""Brute-force versions of the contracts, in plain Python over all rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import xxhash


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def lines(docs):
    """docs: [(doc_id, text)] -> sorted rows of the line-dedup query."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(low)
    held = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in docs:
        ls = (t or "").split("\n")
        gone = [len(h := held.get(key(x), ())) >= 3 and i != max(h, key=lambda v: (v is not None, v or 0)) for x in ls]
        out.append((i, len(ls), sum(gone), sha("\n".join(x for x, g in zip(ls, gone) if not g))))
    return sorted(out, key=repr)


def fingerprint(text, n=3):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(docs, radius=2):
    """[(doc_id, fingerprint hex, component)]"""
    fp = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        if i is not None:
            r = find(a)
            least[r] = min(i, least.get(r, i))
    return sorted([(i, f"{fp[a]:016x}", least.get(find(a))) for a, (i, _) in enumerate(docs)], key=repr)


def secrets_base(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    return [(k, s, e) for s, _, k, e in sorted(found)]


def pii_base(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


def pii_spans(docs, slots, identity, distinctive, min_seeds=3, accept=0.7, trust=0.6):
    """All spans of each (doc_id, text) by a plain bootstrap; the shapes of slots and values are given."""
    found, instances = [], []
    for n, (_, text) in enumerate(docs):
        text = text or ""
        base = pii_base(text)
        found.append({tuple(s) for s in base})
        for kind, shape, s, e in [(k, "", s, e) for k, s, e in base] + [("", k, s, e) for k, s, e in slots(text, base)]:
            left, right = text[:s].split()[-2:], text[e:].split()[:2]
            value = identity(kind or shape, text[s:e])
            sides = [("L", " ".join(left).lower())] * bool(left) + [("R", " ".join(right).lower())] * bool(right)
            instances.append((n, kind, shape, s, e, value, bool(kind) or distinctive(shape, value), sides))
    score = {(v, kind): Fraction(1) for _, kind, _, _, _, v, _, _ in instances if kind}
    members = {}  # (pattern, shape) -> value -> may be found
    for _, kind, shape, _, _, v, strong, sides in instances:
        for p in sides:
            for x in [shape] if shape else ["number", "handle"]:
                members.setdefault((p, x), {}).setdefault(v, False)
                members[p, x][v] |= bool(shape) and strong
    taken = {}
    while True:
        fresh = {}
        for p, values in members.items():
            if p in taken:
                continue
            for kind in ("email", "ip", "card", "phone"):
                known = [score[v, kind] for v in values if (v, kind) in score]
                share = Fraction(sum(known) * 10**6 // len(values), 10**6)
                if len(known) >= min_seeds and len(known) / (len(values) + 1) >= accept and share >= Fraction(str(trust)):
                    fresh[p] = max(fresh.get(p, (Fraction(0), "")), (share, kind))
        if not fresh:
            break
        taken |= fresh
        for p, (share, kind) in fresh.items():
            for v, slot in members[p].items():
                if slot:
                    score[v, kind] = max(score.get((v, kind), Fraction(0)), share)
    for n, kind, shape, s, e, v, strong, sides in instances:
        if not kind:
            marks = [taken[p, shape] for p in sides if (p, shape) in taken]
            marks += [(w, k) for (u, k), w in score.items() if u == v and strong]
            if marks:
                found[n].add((max(marks)[1], s, e))
    order = ["email", "ip", "card", "phone"]
    return [",".join(f"{k}:{s}:{e}" for k, s, e in sorted(f, key=lambda x: (order.index(x[0]), x[1], x[2]))) for f in found]


def span_digest(spans):
    return sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))


def conversations(rows):
    """rows: (conv_id, turn, role, text) -> sorted (conv_id, n, turns sha, loss chars, loss sha)."""
    convs = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for c, t, r, x in sorted(rows, key=lambda v: (low(v[0]), low(v[1]), v[2] or "", v[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    out = []
    for c, turns in convs.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def tokens_file(docs, tok, end_id=2):
    """docs in file order -> (doc_id, start, n, crc)."""
    at, out = 0, []
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end_id]
        out.append((i, at, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        at += len(ids)
    return out


def bpe(docs, tok):
    out = []
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(b"".join(x.to_bytes(4, "little") for x in ids)),
                    sha(tok.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def spelling(docs):
    """[(doc_id, text)] -> sorted (word, form, root, n, n_near, form_n), every pair of words compared."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = {}
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(low)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 97 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            count[w] = count.get(w, 0) + 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted([(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()], key=repr)


def ranked(docs, items, k=10):
    """[(doc_id, text)], [(item_id, text)] -> sorted (item_id, rank, doc_id, score); every document is scored."""
    import math
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    texts = [(i, w) for i, t in docs if (w := split(t))]
    big_n, big_l = len(texts), sum(len(w) for _, w in texts)
    tfs = []
    df = {}
    for _, w in texts:
        c = {}
        for x in w:
            c[x] = c.get(x, 0) + 1
        tfs.append(c)
        for x in c:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, t in items:
        found = []
        for (i, w), c in zip(texts, tfs):
            m = 100 - 75 + (75 * len(w) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1)))
                        * ((1000000000 * c[x]) // (1000 * c[x] + 8 * m)) for x in split(t) if x in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)
