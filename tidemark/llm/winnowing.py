"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken, 2003).

Of every ``GUARANTEE - K + 1`` consecutive k-grams of words, the one with the smallest hash
is kept as a fingerprint (the last of equal ones). Which one that is depends on those words
only, so a document and a benchmark item that share ``GUARANTEE`` consecutive words
share a fingerprint at the same place of the shared words. Fingerprints are joined, and each
hit is extended word by word to both sides, comparing the words themselves; a shared span
of at least ``GUARANTEE`` words marks its words as hit. An item of fewer words is one span of
its full length, fingerprinted without winnowing (window 1).

The benchmark is the small side, but not assumed to be: it is measured first and cut
into blocks of bounded bytes. A block goes to every task, which fingerprints it and joins
its documents against it where they are read: no document text is shuffled, and a passage
that a third of all documents hold costs no more than any other. One block is the usual
case; with more, the blocks' hits are united per document.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, small_batches, stage
from .wordhash import U64, Words, batches, grams, whole

K, GUARANTEE = 5, 10
BLOCK_BYTES = 32 << 20
MAX_BROADCAST_HITS = 500_000  # digests of 32 bytes
_FILTER_BITS = 20

HITS = "struct<n_words: bigint, spans: array<struct<s: int, e: int>>, items: array<string>>"
_HITS_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
    ("items", pa.list_(pa.string()))])


def winnowed(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of the texts with word hashes ``h``."""
    g = grams(h, K)
    w = GUARANTEE - K + 1
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    least = g[:n].copy()
    for j in range(1, w):
        np.minimum(least, g[j:j + n], out=least)
    left = whole(first, len(h), GUARANTEE)
    chosen = np.zeros(len(g), bool)
    for j in range(w - 1, -1, -1):  # the last of equal ones
        found = left & (g[j:j + n] == least)
        chosen[j:j + n] |= found
        left &= ~found
    at = np.flatnonzero(chosen)
    return at, g[at]


class Prints:
    """Fingerprints of one kind, sorted by hash, with a bitmap that rules out most others."""

    def __init__(self, h: np.ndarray, item: np.ndarray, at: np.ndarray):
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.at = h[order], item[order], at[order]
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[h >> U64(64 - _FILTER_BITS)] = True

    def join(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``h``, item, place in the item) of all equal pairs."""
        keep = np.flatnonzero(self.maybe[h >> U64(64 - _FILTER_BITS)])
        lo = np.searchsorted(self.hash, h[keep], "left")
        n = np.searchsorted(self.hash, h[keep], "right") - lo
        mine = np.repeat(keep, n)
        theirs = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return mine, self.item[theirs], self.at[theirs]


class Block:
    """Index over some benchmark items: their words and fingerprints."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids: list[str] = []
        self.words: list[list[bytes]] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        for a, b, w in batches(pa.array(texts, pa.string())):
            for t in range(a, b):
                i, j = int(w.first[t - a]), int(w.first[t - a + 1])
                if i == j:
                    continue
                no, h = len(self.ids), w.hash[i:j]
                self.ids.append(ids[t])
                self.words.append([w.word(x) for x in range(i, j)])
                if j - i >= GUARANTEE:
                    at, fp = winnowed(h, np.array([0, j - i]))
                    found[0].append((fp, np.full(len(at), no), at))
                else:
                    found[j - i].append((grams(h, j - i), np.array([no]), np.array([0])))
        #: by length of short items; 0: items of at least GUARANTEE words
        self.prints = {k: Prints(*[np.concatenate(x) for x in zip(*v, strict=True)])
                       for k, v in found.items()}


def _extend(w: Words, lo: int, hi: int, p: int, item: list[bytes], q: int) -> tuple[int, int]:
    """Longest shared span through word p of the text [lo, hi) and word q of the item."""
    a, b, m = p, p, len(item)
    while a > lo and q - (p - a) > 0 and w.word(a - 1) == item[q - (p - a) - 1]:
        a -= 1
    while b < hi and q + (b - p) < m and w.word(b) == item[q + (b - p)]:
        b += 1
    return a, b


def scan(texts: pa.Array, block: Block) -> pa.Array:
    """Per text: number of words, hit spans (in words, merged) and ids of the items found."""
    out: list[dict] = []
    for a, b, w in batches(texts):
        owner = w.text_of()
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[str]] = defaultdict(set)
        for k, prints in block.prints.items():
            if k == 0:
                at, fp = winnowed(w.hash, w.first)
            else:
                at = np.flatnonzero(whole(w.first, len(w.hash), k))
                fp = grams(w.hash, k)[at]
            mine, item, place = prints.join(fp)
            reached: dict[tuple[int, int, int], int] = {}
            for p, no, q in zip(at[mine].tolist(), item.tolist(), place.tolist(), strict=True):
                t = int(owner[p])
                line = (t, no, p - q)
                if reached.get(line, -1) > p:
                    continue  # inside a span already extended along this alignment
                lo, hi = _extend(w, int(w.first[t]), int(w.first[t + 1]), p, block.words[no], q)
                reached[line] = max(hi, p + 1)
                if hi - lo >= (k or GUARANTEE):
                    spans[t].append((lo, hi))
                    items[t].add(block.ids[no])
        for t in range(b - a):
            base, merged = int(w.first[t]), []
            for s, e in sorted(spans.get(t, ())):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            out.append({"n_words": int(w.first[t + 1]) - base,
                        "spans": [{"s": s - base, "e": e - base} for s, e in merged],
                        "items": sorted(items.get(t, ()))})
    return pa.array(out, _HITS_ARROW)


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast (ids, texts) of all items, each of at most about ``block_bytes``.

    A NULL item id is written as 'null'; items without words never match.
    """
    sc = items.sparkSession.sparkContext
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id") + 16), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / block_bytes))
    out = []
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        got = part.collect()
        out.append(sc.broadcast(([r["id"] for r in got], [r["text"] for r in got])))
    return out


def hits(text: Column, block) -> Column:
    """Struct column with the hits of one block in a text."""
    index: list[Block] = []  # built once per task

    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        if not index:
            index.append(Block(*block.value))
        return scan(texts, index[0])

    return find(text)


def n_hit(spans: Column) -> Column:
    """Words covered by spans that may overlap."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"),
                              (a["sum"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("sum")),
        lambda a: a["sum"].cast("long"))


def decontamination_rows(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    NULL and empty texts have no words and are never hit. Repeated rows are judged alike.
    Items that share an id count once. Empty documents give an empty result, an empty
    benchmark no hits. Other columns of ``docs`` are ignored.
    """
    index = blocks(items, block_bytes)
    if len(index) == 1:
        found = docs.select("doc_id", hits(F.col("text"), index[0]).alias("r")).select("doc_id", "r.*")
    else:
        base = stage(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"))
        parts = [base.select("uid", "doc_id", hits(F.col("text"), b).alias("r")) for b in index]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        found = every.groupBy("uid", "doc_id").agg(
            F.max("r.n_words").alias("n_words"), F.flatten(F.collect_list("r.spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("r.items")))).alias("items"))
    return found.select(
        "doc_id", "n_words", n_hit(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "spans")


def decontaminate(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit, with exactly its columns.

    A text alone decides. Texts, not whole rows, are scanned first, in small batches and one
    block at a time; the digests of those hit are staged, and rows with such a text are left
    out. A NULL text is never hit.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    with small_batches(docs.sparkSession):
        found = [packed(docs.select("text").filter(F.size(hits(F.col("text"), b)["spans"]) > 0)
                        .select(digest.alias("__hit")).distinct()) for b in blocks(items, block_bytes)]
    for hit, n in found:
        docs = docs.join(F.broadcast(hit) if n <= MAX_BROADCAST_HITS else hit, digest == F.col("__hit"), "left_anti")
    return docs
