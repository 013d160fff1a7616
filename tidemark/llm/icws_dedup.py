"""Near-duplicate detection by improved consistent weighted sampling (Ioffe, 2010).

Texts are weighted sets of five-word shingles. A shingle's weight is its count in the
text times the mean inverse document frequency of its words. (Frequencies are taken per
word, because a shingle of a large group of copies would otherwise lose its weight to
the group's size.) Each of ``BANDS * ROWS`` samplers draws one shingle per text such that
two texts draw the same with the probability of their weighted Jaccard similarity; texts
that agree on a whole band are candidates, and a candidate pair is a link if the weighted
Jaccard similarity of the two whole texts is at least 0.8.

Scale:

* document frequencies are counted over all documents. Only words in more than 1 of
  1024 documents need an entry, all others share the weight of that bound; there are at
  most 1024 times as many such words as a document has distinct words on average, at any
  corpus size, and never more than ``MAX_WORDS`` (the bound rises, if it must).
* equal texts are one node, whatever their number.
* a bucket's members are compared with one leader, which links large groups of copies with
  one comparison each. Texts of buckets that then still hold several components are joined on
  their rarest shingles (prefix filter with weights): no pair of similar texts among them is
  missed, and texts that are not similar rarely meet, however many share a bucket.
* buckets are split by the texts' total weight, which loses no pair of similar texts, so
  texts that share only a common passage rarely meet.
* components are found by distributed star contraction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import packed, parts, small_batches, stage, stage_in_few
from .components import components
from .wordhash import U64, batches, grams, mix64

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 5
RARE = 1024  # words in fewer than one of so many documents weigh the same
MAX_WORDS = 2_000_000
MAX_BROADCAST_IDS = 2_000_000
MEMBERS = 1000  # texts to a file of shingles
CLASS = 0.95  # a weight class of the prefix join is one such factor wide
SLACK = 1e-6  # rounding of summed weights
_TABLE_BITS = 16


# ---- word weights ---------------------------------------------------------------------

def _count_words(it):
    """Arrow batches of texts -> (word, number of texts with it), summed per batch."""
    for batch in it:
        found = [np.zeros(0, U64)]
        for _, _, w in batches(batch.column(0)):
            owner = w.text_of().astype(U64)
            _, at = np.unique(mix64(w.hash + owner * U64(0x9E3779B97F4A7C15)), return_index=True)
            found.append(w.hash[at])
        words, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))],
                                         names=["word", "n"])


@dataclass
class Weights:
    """Inverse document frequencies of the common words, sorted by hash, and of all others."""

    word: np.ndarray
    idf: np.ndarray
    rare: float

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.word):
            return np.full(len(h), self.rare)
        at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        return np.where(self.word[at] == h, self.idf[at], self.rare)


def word_weights(texts: DataFrame) -> Weights:
    """Weights 1 + ln(N / df), at most those of a word in one of ``RARE`` documents."""
    counts = texts.select("text").mapInArrow(_count_words, "word long, n long")
    with small_batches(texts.sparkSession, 1024):
        df = stage(counts.groupBy("word").agg(F.sum("n").alias("df")))
    n_docs = texts.count()
    occurrences = df.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    floor = max(n_docs / RARE, occurrences / MAX_WORDS)
    rows = df.filter(F.col("df") > floor).toPandas()  # fewer than occurrences / floor rows
    word = rows["word"].to_numpy(np.int64).view(U64)
    order = np.argsort(word)
    idf = 1 + np.log(max(n_docs, 1) / rows["df"].to_numpy(float))
    return Weights(word[order], idf[order], 1 + float(np.log(max(n_docs, 1) / max(floor, 1e-9))) if n_docs else 1.0)


def vector(h: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of one text and their weights. A text of fewer than five
    words is one shingle."""
    k = min(SHINGLE, len(h))
    if k == 0:
        return np.zeros(0, U64), np.zeros(0)
    sums = np.concatenate(([0.0], np.cumsum(weights.of(h))))
    mean = (sums[k:] - sums[:-k]) / k
    g, at, n = np.unique(grams(h, k), return_index=True, return_counts=True)
    return g, np.round(mean[at], 6) * n  # rounding: equal shingles weigh the same in any text


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; two texts without words: 0."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    either = float(a[1].sum() + b[1].sum()) - both
    return both / either if either > 0 else 0.0


# ---- consistent weighted samples ------------------------------------------------------

class Sampler:
    """Draws (shingle, level) per sampler; gamma and uniform variates come from one table,
    which every sampler addresses by its own hash of the shingle."""

    def __init__(self, seed: int = 11):
        n = 1 << _TABLE_BITS
        u = mix64(np.arange(1, 5 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        u = ((u >> U64(11)).astype(float) + 0.5) / 2.0**53
        r = -np.log(u[:n] * u[n:2 * n])
        self.r, self.inverse = r.astype(np.float32), (1 / r).astype(np.float32)
        self.log_c = np.log(-np.log(u[2 * n:3 * n] * u[3 * n:4 * n])).astype(np.float32)
        self.beta = u[4 * n:].astype(np.float32)
        odd = mix64(np.arange(1, BANDS * ROWS + 1, dtype=U64) + U64(seed << 20))
        self.odd = (odd | U64(1))[:, None]

    def draw(self, g: np.ndarray, w: np.ndarray, piece: int = 1024) -> np.ndarray:
        """Hash of what each sampler draws from a non-empty vector."""
        best, chosen, level = None, None, None
        log_w = np.log(w).astype(np.float32)
        every = np.arange(len(self.odd))
        for i in range(0, len(g), piece):
            cell = ((self.odd * g[i:i + piece]) >> U64(64 - _TABLE_BITS)).astype(np.int32)
            beta = self.beta.take(cell)
            t = np.floor(log_w[i:i + piece] * self.inverse.take(cell) + beta)
            a = self.log_c.take(cell) - self.r.take(cell) * (t - beta + np.float32(1))
            at = a.argmin(axis=1)
            a, t, s = a[every, at], t[every, at], g[i + at]
            if best is None:
                best, chosen, level = a, s, t
            else:
                less = a < best
                best, chosen, level = np.where(less, a, best), np.where(less, s, chosen), np.where(less, t, level)
        return mix64(chosen + level.astype(np.int64).astype(U64) * U64(0x9E3779B97F4A7C15))

    def bands(self, g: np.ndarray, w: np.ndarray) -> np.ndarray:
        drawn = self.draw(g, w).reshape(BANDS, ROWS)
        out = np.arange(1, BANDS + 1, dtype=U64)
        for j in range(ROWS):
            out = mix64(out * U64(0xD1342543DE82EF95) + drawn[:, j])
        return out.view(np.int64)


def band_column(text: Column, weights, threshold: float) -> Column:
    """Bucket keys of a text: its bands, each with its two weight classes (none without words).

    Texts of similarity s weigh at least s times each other. A class is one factor of the
    similarity wide and a text belongs to the next one as well, so similar texts share a
    class, and texts that only share a passage are mostly kept apart.
    """
    made: list = []

    @F.arrow_udf("array<bigint>")
    def sign(texts: pa.Array) -> pa.Array:
        if not made:
            made.extend((Sampler(), Weights(*weights.value)))
        values, sizes = [], []
        for a, b, w in batches(texts):
            for t in range(b - a):
                g, v = vector(w.hash[w.first[t]:w.first[t + 1]], made[1])
                sizes.append(2 * BANDS if len(g) else 0)
                if len(g):
                    values.append(keys(made[0].bands(g, v), float(v.sum()), threshold))
        flat = np.concatenate(values) if values else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return sign(text)


def keys(bands: np.ndarray, total: float, threshold: float) -> np.ndarray:
    level = int(np.floor(np.log(total) / -np.log(threshold * 0.999)))
    classes = np.array([level, level + 1], np.int64).astype(U64)
    return mix64(bands.view(U64)[:, None] + classes * U64(0x9E3779B97F4A7C15)).ravel().view(np.int64)


def similarity_column(left: Column, right: Column, weights) -> Column:
    """Similarity of two texts. Made once for a filter and the rows that pass it: a deterministic
    function would be copied into the filter, and a task would compare every pair twice, in
    two Python workers."""
    def vectors(texts: pa.Array, table: Weights) -> list:
        """Vectors of a few texts; equal ones, such as a leader's, are made once."""
        known = texts.dictionary_encode()
        out = []
        for a, b, w in batches(known.dictionary):
            out += [vector(w.hash[w.first[t]:w.first[t + 1]], table) for t in range(b - a)]
        return [out[i] for i in known.indices.to_pylist()]

    @F.arrow_udf("double")
    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        step = 256  # bounds the vectors held at once
        out, table = [], Weights(*weights.value)
        for i in range(0, len(a), step):
            pairs = zip(vectors(a.slice(i, step), table), vectors(b.slice(i, step), table), strict=True)
            out += [similarity(x, y) for x, y in pairs]
        return pa.array(out, pa.float64())

    return compare.asNondeterministic()(left, right)


# ---- candidates, links, classes -------------------------------------------------------

def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def links(pairs: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """The pairs (a, b) of ``texts`` rows (node, text) that are similar enough, staged."""
    pairs, n = packed(pairs.distinct())
    if not n:
        return pairs.withColumn("similarity", F.lit(1.0))
    ids, _ = packed(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    used = texts.join(_few(ids), "node")
    both = (used.select(F.col("node").alias("a"), F.col("text").alias("left"))
            .join(F.broadcast(pairs) if n <= MAX_BROADCAST_IDS else pairs, "a")
            .join(used.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"))
    scored = both.select("a", "b", similarity_column(F.col("left"), F.col("right"), weights).alias("similarity"))
    with small_batches(texts.sparkSession):
        return packed(scored.filter(F.col("similarity") >= threshold))[0]


def _united(found: DataFrame, roots: DataFrame) -> DataFrame:
    """Components (node, root) of the links ``found`` and the components ``roots``, staged."""
    return packed(components(found.select("a", "b").unionByName(
        roots.select(F.col("node").alias("a"), F.col("root").alias("b")))))[0]


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def element_column(text: Column, weights) -> Column:
    """The weighted shingles of a text: their total weight and an array of (g, w)."""
    kind = pa.struct([("g", pa.int64()), ("w", pa.float64())])

    @F.arrow_udf("struct<total: double, bag: array<struct<g: bigint, w: double>>>")
    def elements(texts: pa.Array) -> pa.Array:
        table = Weights(*weights.value)
        hashes, values = [np.zeros(0, U64)], [np.zeros(0)]
        for a, b, w in batches(texts):
            for t in range(b - a):
                g, v = vector(w.hash[w.first[t]:w.first[t + 1]], table)
                hashes.append(g)
                values.append(v)
        ends = np.cumsum([0] + [len(g) for g in hashes[1:]]).astype(np.int32)
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(values))], fields=list(kind))
        total = pa.array([float(v.sum()) for v in values[1:]], pa.float64())
        return pa.StructArray.from_arrays([total, pa.ListArray.from_arrays(pa.array(ends), flat)], names=["total", "bag"])

    return elements(text)


def prefixes(members: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """Prefix rows (node, root, total, before, g) of ``members`` (node, root), staged.

    All shingles are put in one order, the same for every text: first those that only one
    component holds, then by number of holders. ``before`` is the weight of a text's shingles
    ahead of ``g``. Texts of similarity s share at least s of the heavier one's weight, so the
    first shingle that two similar texts of different components share has at most
    ``1 - threshold`` of either text's weight ahead of it; only such shingles are returned.
    """
    # Members are often few among the texts: no file for each task of the scan.
    width = max(3 * texts.sparkSession.sparkContext.defaultParallelism, parts(members.count(), MEMBERS))
    used = texts.join(_few(members), "node").coalesce(width)
    # Written once, in the shared folder: the count of holders and the join both read it.
    path = scratch_path(texts.sparkSession, "near-duplicate-shingles")
    with small_batches(texts.sparkSession):
        used.select("node", "root", element_column(F.col("text"), weights).alias("e")).select(
            "node", "root", "e.*").write.parquet(path)
    rows = texts.sparkSession.read.parquet(path).select("node", "root", "total", F.inline("bag"))
    held = (rows.groupBy("g").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
            .filter("low <> high").select("g", "n"))
    node = Window.partitionBy("node")
    ahead = node.orderBy("n", "g").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.join(held, "g")
            .withColumn("shared", F.sum("w").over(node))
            .withColumn("before", F.col("total") - F.col("shared") + F.coalesce(F.sum("w").over(ahead), F.lit(0.0))))
    return stage(rows.filter(F.col("before") <= F.col("total") * (1 - threshold + SLACK))
                 .select("node", "root", "total", "before", "g"))


def _weight_class(weight: Column) -> Column:
    return F.floor(F.log(weight) / float(-np.log(CLASS)))


def prefix_keys(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Keys (shingle, weight class of the lighter text) of prefix rows: as the lighter text of
    a pair, and as the heavier one.

    The two texts share ``threshold / (1 + threshold)`` of their joint weight or more, all of
    it from the first shared shingle on. So the lighter one has at most
    ``1 - 2 * threshold / (1 + threshold)`` of its weight ahead of that shingle, and the more the
    heavier one has ahead, the lighter its partner must be.
    """
    part = threshold / (1 + threshold)
    key = lambda c: F.xxhash64("g", c).alias("key")
    columns = ["node", "root", "total", "before"]
    light = (rows.filter(F.col("before") <= F.col("total") * (1 - 2 * part + SLACK))
             .select(key(_weight_class(F.col("total"))), *columns))
    most = F.least(F.col("total"), ((F.col("total") - F.col("before")) / part - F.col("total")) * (1 + SLACK))
    least = F.col("total") * threshold * (1 - SLACK)
    heavy = (rows.filter(most >= least)
             .withColumn("class", F.explode(F.sequence(_weight_class(least), _weight_class(most))))
             .select(key(F.col("class")), *columns))
    return light, heavy


def _pairs(light: DataFrame, heavy: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts in different components that meet in a key and may be similar."""
    x, y = light.alias("x"), heavy.alias("y")
    common = F.least(F.col("x.total") - F.col("x.before"), F.col("y.total") - F.col("y.before"))
    fits = common >= (F.col("x.total") + F.col("y.total")) * (threshold / (1 + threshold)) * (1 - SLACK)
    both = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & fits)
    return both.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))


def link_buckets(buckets: DataFrame, texts: DataFrame, weights, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links and components (node, root) of ``buckets`` (band, node), staged.

    First every member of a bucket is compared with its leader: the member with most company
    over all its buckets. The text that a group was copied from meets every copy more often
    than copies meet each other, so it leads. Buckets that still hold several components are
    not paired off: their texts are joined on the rarest of their shingles (prefix filter), which
    finds every pair of similar texts among them, and hardly any other. Here too all that meet in
    a key are compared with one leader first, then the components that are left with each other.
    """
    session = buckets.sparkSession
    sizes = buckets.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = buckets.join(sizes, "band")
    company = stage(buckets.groupBy("node").agg(F.sum("n").alias("company")))
    buckets = stage(buckets.join(company, "node").select("band", "node", "company"))
    most = F.max(F.struct("company", (-F.col("node")).alias("minus")))["minus"]
    leaders = buckets.groupBy("band").agg((-most).alias("leader"))
    pairs = (buckets.join(leaders, "band").filter("node <> leader")
             .select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")))
    found = links(pairs, texts, weights, threshold)
    # No local list: that is read by Python workers of their own, which stay for a while.
    roots = _united(found, session.range(0).select(F.col("id").alias("node"), F.col("id").alias("root")))

    member = _rooted(buckets, roots)
    open_buckets = (member.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                    .filter("low <> high").select("band"))
    rows = prefixes(stage(member.join(open_buckets, "band").select("node", "root").distinct()), texts, weights, threshold)
    if rows.isEmpty():
        return found, roots
    light, heavy = prefix_keys(rows, threshold)
    met = light.select("key").distinct()
    leaders = (heavy.join(met, "key").join(company, "node").groupBy("key").agg((-most).alias("node")))
    lead = stage(heavy.join(leaders, ["key", "node"]))
    more = links(_pairs(light, lead, threshold), texts, weights, threshold)
    if not more.isEmpty():
        found, roots = found.unionByName(more), _united(more, roots)
        light, heavy = (_rooted(k.drop("root"), roots) for k in (light, heavy))
    more = links(_pairs(light, heavy, threshold), texts, weights, threshold)
    return found.unionByName(more), _united(more, roots)


def _classes(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``rows`` (uid, doc_id, text) -> staged (uid, doc_id, root, n_links)."""
    found = word_weights(rows)
    weights = rows.sparkSession.sparkContext.broadcast((found.word, found.idf, found.rare))
    signed = rows.filter("text is not null").select(
        "uid", "doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
        band_column(F.col("text"), weights, threshold).alias("bands"))
    with small_batches(rows.sparkSession):
        signed = stage_in_few(signed)
    nodes = stage(signed.groupBy("digest").agg(F.min("uid").alias("node")))
    signed = signed.join(nodes, "digest")
    buckets = signed.filter("uid = node").select("node", F.explode("bands").alias("band"))
    found, roots = link_buckets(buckets, texts, weights, threshold)
    degree = (found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count("*").alias("n_links")))
    known = nodes.join(roots, "node", "left").join(degree, "node", "left")
    named = signed.select("uid", "doc_id", "digest").join(
        known.select("digest", F.coalesce("root", "node").alias("root"),
                     F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "digest")
    alone = rows.filter("text is null").select(
        "uid", "doc_id", F.col("uid").alias("root"), F.lit(0).cast("long").alias("n_links"))
    return stage_in_few(named.select("uid", "doc_id", "root", "n_links").unionByName(alone))


def _staged_texts(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """A copy with a row id, in the shared folder: rows need an identity that survives
    recomputation, and equal rows have none of their own."""
    path = scratch_path(docs.sparkSession, "near-duplicates")
    with small_batches(docs.sparkSession):
        docs.select(F.monotonically_increasing_id().alias("uid"), *columns).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _grouped(classes: DataFrame) -> DataFrame:
    """Per class: size, smallest id, and the row that stays (smallest id, then first row)."""
    return classes.groupBy("root").agg(
        F.count("*").alias("class_size"), F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))["uid"].alias("stays"))


def near_duplicate_rows(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, n_links, stays.

    * class_id is the smallest doc_id of the class; ``stays`` marks the one row of it to keep.
    * n_links counts verified links of the row's text to different texts (leaders and
      members that were compared, not all pairs).
    * equal texts, also empty ones, are one class; a NULL text is a class of its own.
    * texts without words are linked to equal texts only. Other columns are ignored.
    """
    rows = _staged_texts(docs, [F.col("doc_id"), F.col("text")])
    texts = rows.select(F.col("uid").alias("node"), "text")
    classes = _classes(rows, texts, threshold)
    return classes.join(_grouped(classes), "root").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "class_size", "n_links",
        (F.col("uid") == F.col("stays")).alias("stays"))


def deduplicated(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` per class, with exactly its columns.

    The row with the smallest doc_id stays (a NULL id last; the first of equal ids). Equal rows
    are one class, a NULL text is always kept, an empty table gives an empty result.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = _staged_texts(docs, [F.col("doc_id"), F.col("text"), whole])
    rows = rows.select("uid", "doc_id", F.col("doc.text").alias("text"), "doc")
    texts = rows.select(F.col("uid").alias("node"), "text")
    classes = _classes(rows.select("uid", "doc_id", "text"), texts, threshold)
    stays = stage(_grouped(classes).select(F.col("stays").alias("uid")))
    gone = stage(classes.select("uid").join(stays, "uid", "left_anti"))
    return rows.join(_few(gone), "uid", "left_anti").select("doc.*")
