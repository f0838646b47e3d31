"""Secret scan with corpus-wide ownership frequency.

Each whole text is scanned for three kinds of secrets (``assign``, ``access``,
``hex``, the base spans, which always stay) and for opaque tokens: words of 20
and more characters of a key's alphabet with letters and digits.  Every
candidate value is hashed, and the hashes are aggregated over the corpus into
the numbers of distinct repositories and owners that hold the value.  Copies of
a document (texts equal but for white space) are one repository and one owner,
the least of the group: a mirror is no second holder.  A document that is
nothing but such values counts by itself, as nothing else tells a copy of it
from a second use.  A value of more than ``max_owners`` owners or ``max_repos``
repositories is a widely copied example; a value of few of both that looks
random is a live-looking credential.  Opaque tokens
with such a value are added as spans of kind ``opaque``; spans inside a base
span are not added again.

Only (hash, text, repository, owner) rows are shuffled; they are made distinct
before they are counted, with partial aggregation.  The counts are written
before they are joined, so that AQE can split a value that fills a third of all
rows.

Edge cases: a null text is the empty text; a null owner or repository counts as
one more of its kind; repeated rows are scanned each, and count once as owners;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, strings
from .spans import join_spans

KINDS = ("assign", "access", "hex", "opaque")

# The forms of the base kinds and the placeholders of examples.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}+")
HINTS = (b"passw", b"secret", b"token", b"api")
PLACEHOLDERS = ("example", "changeme", "placeholder", "sample", "dummy", "xxxx", "your", "12345678")


def looks_random(value: str, min_bits: float = 3.0) -> bool:
    """Digits among letters, no placeholder word, and ``min_bits`` of entropy a character."""
    low = value.lower()
    if not any(c.isdigit() for c in low) or not any(c.isalpha() for c in low):
        return False
    if any(p in low for p in PLACEHOLDERS):
        return False
    n = len(value)
    return -sum(k / n * log2(k / n) for k in Counter(value).values()) >= min_bits


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start and kind; offsets in code points."""
    found = []
    raw = text.encode("utf-8", "surrogatepass").lower()
    if any(h in raw for h in HINTS):
        found += [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def opaque_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    return [("opaque", m.start(), m.end(), m[0]) for m in OPAQUE.finditer(text)
            if looks_random(m[0]) and not any(s < m.end() and m.start() < e for _, s, e, _ in taken)]


def digest_of(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans).encode()).hexdigest()


CANDIDATE = "array<struct<kind:string,start:int,end:int,hash:string,live:boolean>>"
SCAN_SCHEMA = (f"doc_id long, repo string, owner string, _text string, _row string, n_assign long, n_access long, "
               f"n_hex long, base_sha256 string, found {CANDIDATE}")
FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("hash", pa.string()), ("live", pa.bool_())]))


def _hash(s: str) -> str:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _copies(text: str, found: list[dict]) -> str | None:
    """What copies of a document share; nothing if it has no word beside the values found."""
    end = 0
    for s in sorted(found, key=lambda f: f["start"]) + [{"start": len(text), "end": len(text)}]:
        if any(c.isalnum() for c in text[end:s["start"]]):
            return _hash(" ".join(text.split())) if found else None
        end = max(end, s["end"])
    return None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    task, n = TaskContext.get().partitionId(), 0
    for b in slices(batches, "text"):
        counts, shas, found, rows, whole = [], [], [], [], []
        for text in strings(b, "text"):
            base = base_spans(text)
            kinds = Counter(s[0] for s in base)
            counts.append([kinds[k] for k in KINDS[:3]])
            shas.append(digest_of(base))
            found.append([{"kind": k, "start": s, "end": e, "live": k == "opaque" or looks_random(v),
                           "hash": _hash(v)}
                          for k, s, e, v in base + opaque_spans(text, base)])
            rows.append(f"{task}-{n}")
            whole.append(_copies(text, found[-1]) or rows[-1])
            n += 1
        yield pa.record_batch(
            [b.column("doc_id"), b.column("repo"), b.column("owner"), pa.array(whole), pa.array(rows),
             *[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)],
             pa.array(shas), pa.array(found, FOUND_TYPE)],
            names=["doc_id", "repo", "owner", "_text", "_row", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def scan_secrets(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source",
                 max_owners: int = 1, max_repos: int = 20) -> tuple[DataFrame, DataFrame]:
    """(rows of documents with base counts, all their spans with verdicts).

    The spans have ``_row, kind, start, end, hash, n_repos, n_owners, verdict``;
    the verdict is ``copied``, ``live`` or ``plain``.
    """
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"), "text").mapInArrow(_scan, SCAN_SCHEMA), "secrets")
    each = rows.select("_row", "_text", F.coalesce("repo", F.lit("\0")).alias("repo"),
                       F.coalesce("owner", F.lit("\0")).alias("owner"),
                       F.explode("found").alias("f")).select("_row", "_text", "repo", "owner", "f.*")
    # one holder for each group of equal texts
    held = each.groupBy("hash", "_text").agg(F.min(F.struct("repo", "owner")).alias("h")).select("hash", "h.*")
    counts = materialise(_counts(held), "counts")
    spans = each.drop("_text", "repo", "owner").join(counts, "hash").withColumn(
        "verdict", F.when((F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos), "copied")
        .when(F.col("live"), "live").otherwise("plain"))
    return rows.drop("found", "_text"), spans.filter((F.col("kind") != "opaque") | (F.col("verdict") == "live"))


def _counts(held: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each hash."""
    return held.groupBy("hash").agg(F.count_distinct("repo").alias("n_repos"),
                                    F.count_distinct("owner").alias("n_owners"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """The query: repositories are documents, owners are sources, one owner is owner-specific."""
    rows, spans = scan_secrets(docs)
    live = spans.groupBy("_row").agg(*[F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}")
                                       for v in ("live", "copied")])
    out = join_spans(rows, spans, KINDS, by_kind=False).join(live, "_row", "left")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                      *[F.coalesce(f"n_{v}", F.lit(0)).cast("long").alias(f"n_{v}") for v in ("live", "copied")])
