"""Substring deduplication by content-defined chunking with a gear rolling hash.

A text is cut after a byte where the gear hash of the last ``WINDOW`` bytes has ``CUT_BITS``
zero bits (and no other such byte lies in the last ``MIN_CHUNK`` bytes). Cuts depend on the
bytes around them only, so an insertion moves the chunks behind it but does not
change them. A run with a short period ('and and and ...') has such a byte in every period or in
none, so it would get no cut; inside a gap of more than ``MAX_GAP`` bytes, it is cut where the gear
hash is smallest in each period, which is the same place of the period in every text. Such chunks
count as repeats only if another row has them too: a run that goes on is no copy of itself. Chunks are deduplicated by a 128-bit digest: a chunk that occurs before, in
the order of (doc_id, row, position), is a repeat. Neighbouring chunks that occur more than
once form a run; runs of at least ``min_bytes`` are passages, shorter ones (stock phrases,
single lines) are left alone.

Scale: chunking and hashing run where texts are read, and only 40 bytes per chunk are
staged. Occurrences per digest are a map-side combined aggregate, and only digests that
occur more than once are joined back, by a plain equi-join, whose hot keys (a line that a
third of all documents hold) adaptive execution splits. Runs are formed per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import small_batches
from .wordhash import U64, _powers, mix64, pieces, raw_bytes

WINDOW_STEPS = 4  # the gear hash covers 1 << WINDOW_STEPS bytes
WINDOW = 1 << WINDOW_STEPS
CUT_BITS = 5
MIN_CHUNK, MAX_CHUNK = 16, 1024
MAX_GAP = 64  # longer chunks are searched for periods
_REACH = MIN_CHUNK - 1  # bytes on both sides over which a hash is the smallest
_LAGS = 8  # periods have at most so many smallest places
MIN_PASSAGE = 100

_GEAR = mix64(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F)).astype(np.uint32)
_FIRST = mix64(np.arange(1, 257, dtype=U64) * U64(0xE7037ED1A0B428DB))
_SECOND = mix64(np.arange(1, 257, dtype=U64) * U64(0x8EBC6AF09C88C6E3))


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash (sum of gear values, each shifted by its distance) of the last WINDOW bytes.

    Only the lowest WINDOW bits are used for cuts, to which farther bytes add nothing. The
    sum is built by doubling: the hash of 2n bytes is that of the last n plus that of the n
    before, shifted by n.
    """
    h = _GEAR[data]
    for step in range(WINDOW_STEPS):
        n = 1 << step
        shifted = h[:-n] << np.uint32(n)
        h = h.copy()
        h[n:] += shifted
    return h


def _smallest(h: np.ndarray) -> np.ndarray:
    """Places whose hash is not above any other at most _REACH away, equal ones included."""
    n, width, low = len(h), 2 * _REACH + 1, np.full(len(h) + 2 * _REACH, 0xFFFFFFFF, np.uint32)
    low[_REACH:_REACH + n] = h
    step = 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = width - step
    return np.flatnonzero(h == np.minimum(low[:len(low) - rest], low[rest:]))


def _period_cuts(data: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cuts inside the chunks longer than MAX_GAP, where these repeat with a period.

    A smallest place counts if its hash comes back at one of the next or last _LAGS ones of
    the same chunk. Cuts are at least MIN_CHUNK apart; where periods are shorter, a chunk holds several of them.
    """
    long = np.flatnonzero(ends - starts > MAX_GAP)
    if not len(long):
        return long
    h = h.copy()
    h[:-1][(data[1:] & 0xC0) == 0x80] = 0xFFFFFFFF  # never inside a character
    at = _smallest(h) + 1
    gap = np.searchsorted(starts[long], at, side="right") - 1
    first, last = starts[long][gap] + WINDOW, ends[long][gap] - MIN_CHUNK
    inside = (gap >= 0) & (at >= first) & (at <= last)
    at, gap = at[inside], gap[inside]
    again = np.zeros(len(at), bool)
    for lag in range(1, min(_LAGS, len(at) - 1) + 1):
        same = (h[at[lag:] - 1] == h[at[:-lag] - 1]) & (gap[lag:] == gap[:-lag])
        again[lag:] |= same
        again[:-lag] |= same
    at, gap = at[again], gap[again]
    out, end, of = [], 0, -1
    for x, g in zip(at.tolist(), gap.tolist()):
        if g != of or x - end >= MIN_CHUNK:
            out.append(x)
            end, of = x, g
    return np.array(out, np.int64)


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Chunk ends (exclusive), ascending, of the texts that ``bounds`` marks in ``data``."""
    return _cuts(data, bounds)[0]


def _cuts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``cuts``, and which of them lie inside a run with a period."""
    top = np.uint32(((1 << CUT_BITS) - 1) << (WINDOW - CUT_BITS))
    n = len(data)
    h = gear(data) if n else np.zeros(0, np.uint32)
    wanted = np.flatnonzero(h & top == 0) + 1
    far = np.ones(len(wanted), bool)
    far[1:] = np.diff(wanted) >= MIN_CHUNK
    wanted = wanted[far & (wanted < n)]
    wanted = wanted[(data[wanted] & 0xC0) != 0x80]  # never inside a character
    # The hash of a text's first bytes sees the text before it: no cut there.
    owner = np.searchsorted(bounds, wanted, side="right") - 1
    wanted = wanted[wanted - bounds[owner] >= WINDOW]
    ends = np.union1d(wanted, bounds[1:][np.diff(bounds) > 0])
    starts = np.concatenate(([0], ends[:-1]))
    within = _period_cuts(data, h, starts, ends)
    if len(within):
        ends = np.union1d(ends, within)
        starts = np.concatenate(([0], ends[:-1]))
    long = np.flatnonzero(ends - starts > MAX_CHUNK)
    extra = []
    for i in long:  # cut at fixed distances, before a character
        for at in range(int(starts[i]) + MAX_CHUNK, int(ends[i]), MAX_CHUNK):
            while data[at] & 0xC0 == 0x80:
                at -= 1
            extra.append(at)
    ends = np.union1d(ends, np.array(extra, np.int64)) if extra else ends
    return ends, np.isin(ends, within)


def _chunks(batches):
    """Batches of (uid, doc_id, text) -> (uid, doc_id, start, end, n_bytes, d1, d2, run) per chunk."""
    for batch in batches:
        uid, doc_id = batch.column(0).to_numpy(), batch.column(1)
        data, bounds = raw_bytes(batch.column(2))
        for a, b in pieces(bounds):
            base = int(bounds[a])
            part, mine = data[base:int(bounds[b])], bounds[a:b + 1] - base
            if not len(part):
                continue
            end, inside = _cuts(part, mine)
            start = np.concatenate(([0], end[:-1]))
            run = inside & np.concatenate(([False], inside[:-1]))
            owner = np.searchsorted(mine, start, side="right") - 1
            up, down = _powers(len(part) + 1)
            digest = []
            for values in (_FIRST, _SECOND):
                sums = np.zeros(len(part) + 1, U64)
                np.cumsum(values[part] * up[:-1], out=sums[1:])
                digest.append(mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(U64)).view(np.int64))
            chars = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
            first = chars[mine[owner]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[a + owner]), doc_id.take(pa.array(a + owner)),
                 pa.array((chars[start] - first).astype(np.int32)), pa.array((chars[end] - first).astype(np.int32)),
                 pa.array((end - start).astype(np.int32)), pa.array(digest[0]), pa.array(digest[1]), pa.array(run)],
                names=["uid", "doc_id", "start", "end", "n_bytes", "d1", "d2", "run"])


def chunk_table(docs: DataFrame) -> DataFrame:
    """Every chunk of every text, staged; positions are code points, ``uid`` numbers the rows."""
    return _staged_chunks(docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "text"))


def _staged_chunks(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "chunks")
    kind = rows.schema["doc_id"].dataType.simpleString()
    chunks = rows.mapInArrow(_chunks, f"uid long, doc_id {kind}, start int, end int, n_bytes int, d1 long, d2 long, run boolean")
    with small_batches(rows.sparkSession):
        chunks.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def repeated_passages(chunks: DataFrame, min_bytes: int = MIN_PASSAGE) -> DataFrame:
    """Passages that occur more than once: uid, doc_id, start, end, n_bytes, n_repeat_bytes,
    first_doc_id, removable.

    A passage with ``removable`` true consists of chunks that all occurred before; where only
    a part did, n_repeat_bytes tells how much. ``first_doc_id`` is the smallest id that holds
    its first chunk.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "start")
    owner = F.when(F.col("run"), F.col("uid")).otherwise(F.lit(-1))
    seen = (chunks.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("first"),
                                           F.min(owner).alias("low"), F.max(owner).alias("high"))
            .filter("n > 1 AND (low < 0 OR low < high)").select("d1", "d2", "first"))
    shared = chunks.join(seen, ["d1", "d2"]).select(
        "uid", "doc_id", "start", "end", "n_bytes", F.col("first.doc_id").alias("first_doc_id"),
        ((F.col("first.uid") != F.col("uid")) | (F.col("first.start") != F.col("start"))).alias("again"))
    order = Window.partitionBy("uid").orderBy("start")
    runs = (shared.withColumn("fresh", (F.coalesce(F.lag("end").over(order), F.lit(-1)) != F.col("start")).cast("int"))
            .withColumn("run", F.sum("fresh").over(order)))
    return (runs.groupBy("uid", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.sum("n_bytes").alias("n_bytes"), F.sum(F.when(F.col("again"), F.col("n_bytes")).otherwise(0)).alias("n_repeat_bytes"),
        F.min(F.struct("start", "first_doc_id"))["first_doc_id"].alias("first_doc_id"))
        .filter(F.col("n_bytes") >= min_bytes)
        .withColumn("removable", F.col("n_repeat_bytes") == F.col("n_bytes")).drop("run"))


def repeat_rows(docs: DataFrame, min_bytes: int = MIN_PASSAGE) -> DataFrame:
    """One row per repeated passage of a document; documents without any have no row.

    NULL and empty texts have no chunks. Repeated rows repeat each other's whole text. A
    NULL id is reported as NULL and comes last in the order; ids keep their type and order
    (strings bytewise). An empty table gives an empty result. Other columns are ignored.
    """
    return repeated_passages(chunk_table(docs), min_bytes).select(
        "doc_id", "start", "end", F.col("n_bytes").cast("long").alias("n_bytes"),
        F.col("n_repeat_bytes").cast("long").alias("n_repeat_bytes"), "first_doc_id", "removable")


def without_repeats(docs: DataFrame, min_bytes: int = MIN_PASSAGE) -> DataFrame:
    """``docs`` (columns unchanged) whose texts lack every removable passage.

    Spans go to their texts by row number of a staged copy. A text that repeats another one
    from end to end becomes empty; NULL texts stay NULL, an empty table stays empty. Of equal
    rows the first one in the order of ids (NULL last) and rows keeps its text.
    """
    path = scratch_path(docs.sparkSession, "chunked-texts")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    docs.select(F.monotonically_increasing_id().alias("uid"), whole).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    chunks = _staged_chunks(rows.select(
        "uid", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text")))
    gone = (repeated_passages(chunks, min_bytes).filter("removable")
            .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.col("doc.text")

    def cut(s, x):
        kept = F.substring(body, s["at"] + 1, x["start"] - s["at"])
        return F.struct(x["end"].alias("at"), F.concat(s["out"], kept).alias("out"))

    text = F.aggregate("gone", start, cut, lambda s: F.concat(
        s["out"], F.substring(body, s["at"] + 1, F.char_length(body) - s["at"])))
    return rows.join(gone, "uid", "left").select(*[
        F.coalesce(text, body).alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
