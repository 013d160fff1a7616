"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with FTRL-proximal (McMahan et al., 2013) under elastic-net penalties
and calibrated by one temperature (Guo et al., 2017).

Features are character 1- to 3-grams of the lower-cased text, in which everything but
letters is a blank, hashed to ``1 << BITS`` cells. A cell's value is its share of the text's
n-grams times its inverse document frequency.

* Document frequencies are counted over all learnable documents, one count per cell.
* The regression is fitted on a bounded sample: at most ``PER_LANGUAGE`` different documents of
  each of the ``MAX_LANGUAGES`` most frequent languages, those of the least hash of id and text,
  whose cell counts go to the driver. A quarter of the sample is kept apart for the temperature.
* The fitted weights (cells x languages) go to every task; each whole text is scored where it
  is read, in pieces of bounded size, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash60, held_out, least_rows
from .wordhash import pieces

BITS = 16
CELLS = 1 << BITS
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1000
MAX_LANGUAGES = 256  # learned ones; rarer values of lang are taken for noise
PIECE_CHARS = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Ftrl:
    """Learning rate and elastic-net penalties; features are scaled by ``scale``."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01
    epochs: int = 3
    scale: float = 20.0


class _Letters(dict):
    """Lookup tables that travel empty."""

    def __reduce__(self):
        return _Letters, ()


_LETTERS = _Letters()


def _is_letter(code: np.ndarray) -> np.ndarray:
    if "low" not in _LETTERS:
        _LETTERS["low"] = np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)
    out = _LETTERS["low"][np.minimum(code, 0xFFFF)]
    for c in np.unique(code[code > 0xFFFF]).tolist():
        out[code == c] = chr(c).isalpha()
    return out


def char_batches(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, character codes, bounds) of pieces of a batch; blanks are 0. Every
    text stands between two blanks of its own, and a null text is empty."""
    strings = [("" if t is None else t.lower()) for t in texts.to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(t) + 2 for t in strings]))).astype(np.int64)
    for a, b in pieces(bounds, PIECE_CHARS):
        code = np.frombuffer("".join(f"\n{t}\n" for t in strings[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(_is_letter(code), code, np.uint32(0))
        yield a, b, code, bounds[a:b + 1] - bounds[a]


def cells(code: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell of the n-gram that starts at each character, and whether it counts: an n-gram of
    blanks only does not, nor one that runs on into the next text."""
    n = max(len(code) - order + 1, 0)
    h = np.full(n, order, np.uint64)
    some = np.zeros(n, bool)
    for j in range(order):
        c = code[j:j + n]
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        some |= c != 0
    # Two blanks separate texts, so with a letter in the middle no n-gram spans two texts.
    if order == 3:
        some &= code[1:1 + n] != 0
    elif order == 1:
        some = code[:n] != 0
    return (h >> np.uint64(64 - BITS)).astype(np.int32), some


def count_cells(texts: pa.Array) -> Iterator[np.ndarray]:
    """Cell counts of each text, one dense row at a time."""
    for a, b, code, bounds in char_batches(texts):
        parts = [cells(code, k) for k in ORDERS]
        for t in range(b - a):
            lo, hi = int(bounds[t]), int(bounds[t + 1])
            yield np.bincount(np.concatenate([c[lo:hi][ok[lo:hi]] for c, ok in parts]), minlength=CELLS)


def _document_frequencies(batches):
    seen, n = np.zeros(CELLS, np.int64), 0
    for batch in batches:
        for counts in count_cells(batch.column(0)):
            seen += counts > 0
            n += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1], at)).astype(np.int32)), pa.array(np.concatenate(([n], seen[at])))],
        names=["cell", "df"])


def _sparse(texts: Column) -> Column:
    @F.arrow_udf("struct<cell: array<int>, n: array<int>>")
    def sparse(x: pa.Array) -> pa.Array:
        out = []
        for counts in count_cells(x):
            at = np.flatnonzero(counts)
            out.append({"cell": at, "n": counts[at]})
        return pa.array(out, pa.struct([("cell", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))

    return sparse(texts)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # cells x languages, with the document frequencies worked in
    bias: np.ndarray
    temperature: float


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int, how: Ftrl,
             seed: int = 5) -> np.ndarray:
    """Weights (cells + 1 for the bias) x classes; exact zeros where the l1 penalty wins."""
    z = np.zeros((CELLS + 1, n_classes))
    n = np.zeros((CELLS + 1, n_classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zz, nn = z[at], n[at]
        w = (np.sign(zz) * how.l1 - zz) / ((how.beta + np.sqrt(nn)) / how.alpha + how.l2)
        return np.where(np.abs(zz) <= how.l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(how.epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            p = softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the smallest log loss, on a grid of 2 % steps from 1/20 to 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(-3, 3, 301))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, how: Ftrl = Ftrl(), per_language: int = PER_LANGUAGE) -> Model | None:
    """Model from rows with text, lang and doc_id that are not held out; None without such rows."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    df = (rows.select("text").mapInArrow(_document_frequencies, "cell int, df long")
          .groupBy("cell").agg(F.sum("df").alias("df")).toPandas())  # at most CELLS + 1 rows
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    languages = sorted(r["lang"] for r in most.collect())
    if not languages:
        return None
    idf = np.zeros(CELLS)
    n_docs = int(df.df[df.cell == -1].sum())
    known = df[df.cell >= 0]
    idf[known.cell] = np.log((1 + n_docs) / (1 + known.df.to_numpy(float))) + 1
    place = hash60(F.lit("language"), F.col("doc_id"), F.md5(F.col("text").cast("binary")))
    placed = rows.filter(F.col("lang").isin(languages)).select("lang", "text", place.alias("place"))
    chosen = least_rows(placed.select("lang", "place"), "lang", "place", per_language)
    # at most MAX_LANGUAGES * per_language rows; equal documents are one
    sample = (placed.join(F.broadcast(chosen), ["lang", "place"]).dropDuplicates(["lang", "place"])
              .select("lang", "place", _sparse(F.col("text")).alias("x")).toPandas())
    sample = sample.sort_values("place", kind="stable")
    x, y = [], []
    for lang, cell in zip(sample["lang"], sample["x"], strict=True):
        at, n = np.asarray(cell["cell"], np.int64), np.asarray(cell["n"], float)
        if len(at):
            value = how.scale * n / n.sum() * idf[at]
            x.append((np.append(at, CELLS), np.append(value, 1.0)))
            y.append(languages.index(lang))
    y = np.array(y, int)
    apart = np.arange(len(x)) % 4 == 3
    w = fit_ftrl([r for r, a in zip(x, apart, strict=True) if not a], y[~apart], len(languages), how)
    kept = [r for r, a in zip(x, apart, strict=True) if a]
    logits = np.array([v @ w[at] for at, v in kept]) if kept else np.zeros((0, len(languages)))
    scaled = (w[:CELLS] * idf[:, None] * how.scale).astype(np.float32)
    return Model(languages, scaled, w[CELLS].astype(np.float32), best_temperature(logits, y[apart]))


def predict(texts: pa.Array, languages: list[str], weights: np.ndarray, bias: np.ndarray,
            temperature: float) -> pa.Array:
    lang, score = [], []
    for _, _, code, bounds in char_batches(texts):
        total = np.zeros((len(bounds) - 1, len(languages)))
        count = np.zeros(len(bounds) - 1)
        for k in ORDERS:
            cell, ok = cells(code, k)
            at = np.flatnonzero(ok)
            first = np.searchsorted(at, bounds)
            sums = np.zeros((len(at) + 1, len(languages)))
            np.cumsum(weights[cell[at]], axis=0, dtype=np.float64, out=sums[1:])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
        p = softmax((total / np.maximum(count, 1)[:, None] + bias) / temperature)
        best = p.argmax(axis=1)
        lang += [languages[j] if c else UNKNOWN for j, c in zip(best, count, strict=True)]
        score += [float(p[i, j]) if count[i] else 0.0 for i, j in enumerate(best)]
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])


def language(text: Column, model: Model | None, spark) -> Column:
    """Struct (lang, score) of a text: the likeliest learned language and its calibrated
    probability; ``und`` and 0 for a NULL text or one without a letter, or without a model."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.bias, model.temperature))

    @F.arrow_udf("struct<lang: string, score: double>")
    def identify(x: pa.Array) -> pa.Array:
        return predict(x, *shared.value)

    return identify(text)


def language_rows(docs: DataFrame, how: Ftrl = Ftrl(), per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from rows whose hash of the id does not hold them out (a NULL id does). Repeated
    rows are predicted alike; an empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, how, per_language)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      language(F.col("text"), model, docs.sparkSession).alias("r"))
    return out.select("doc_id", "held_out", F.col("r.lang").alias("lang_pred"), "r.score")
