"""Token ids in binary files with Elias-Fano encoded document boundaries.

Texts become token ids (an end id closes every document), and all ids of a dataset form one
array in key order. It is cut into blocks of about ``block_ids`` ids at document ends; a block
holds

* a header: its place (partition, number), how many documents, ids and NULL keys it has;
* the documents' ends inside the block, Elias-Fano encoded: the low ``l`` bits of each value
  packed, the rest as a unary bitmap, 2 + log2(ids / documents) bits per document, and one
  32-bit select sample per ``SAMPLE`` documents. ``EliasFano.select`` returns any end from
  these without a table of offsets;
* the keys: ascending integers, Elias-Fano encoded relative to the first one, or strings as
  their bytes with Elias-Fano encoded ends;
* the ids, as 16-bit numbers if the vocabulary allows it, else 32-bit.

Texts are range-partitioned and sorted by key, tokenized where they arrive, and the blocks
are written by Spark's own file writer (one block per row and a line feed after it), so a
lost executor's files are written anew and never half kept. ``max_blocks`` bounds a file.
Reading takes one file per row; where a block starts in the whole array follows from the
blocks' id counts.

Tokenizing: a tokenizer with word ends that drops white space, lower-cases, and splits texts into
runs of letters, single digits and runs of other characters, encodes these pieces independently
of each other. Texts of plain characters are then cut into pieces here, a batch of texts at a
time, pieces met before are looked up in a bounded table, and the library encodes the new ones,
many at a time. Texts with any other character, and texts for other tokenizers, are encoded whole.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, stage

MAGIC = b"TIDEMRK1"
HEADER = "<8sIIIIIBBH"  # magic, part, number, documents, NULL keys, ids, id bytes, key kind, spare
SAMPLE = 64
INT_KEYS, TEXT_KEYS = 0, 1
MAX_BROADCAST_BLOCKS = 200_000  # a block's row is under 100 bytes


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file and how it is used.

    ``by_piece``: the tokenizer splits texts as the module's docstring says. ``kept_pieces``
    bounds the table of pieces.
    """

    path: str
    end_id: int = 1
    by_piece: bool = False
    kept_pieces: int = 1_000_000


class EliasFano:
    """Ascending integers from 0 on in about 2 + log2(last / count) bits each."""

    HEAD = "<IB3xI"  # values, low bits, bytes of the bitmap

    def __init__(self, data: bytes | memoryview, at: int = 0):
        self.n, self.low_bits, high = struct.unpack_from(self.HEAD, data, at)
        at += struct.calcsize(self.HEAD)
        self.low = np.frombuffer(data, np.uint8, (self.n * self.low_bits + 7) // 8, at)
        at += len(self.low)
        self.high = np.frombuffer(data, np.uint8, high, at)
        at += high
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at)
        self.end = at + self.samples.nbytes

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return struct.pack(cls.HEAD, 0, 0, 0)
        l = max((int(v[-1]) // n).bit_length() - 1, 0)
        low = ((v[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        bitmap = np.zeros(int(ones[-1]) + 1, np.uint8)
        bitmap[ones] = 1
        high = np.packbits(bitmap, bitorder="little")
        return b"".join((struct.pack(cls.HEAD, n, l, len(high)), np.packbits(low.ravel(), bitorder="little").tobytes(),
                         high.tobytes(), ones[::SAMPLE].astype("<u4").tobytes()))

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[first // 8:(last + 7) // 8].tobytes(), "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i``: its one in the bitmap is sought from the sample before it."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, bit = divmod(at, 8)
        word = int(self.high[byte]) >> bit << bit
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return ((byte * 8 + (word & -word).bit_length() - 1 - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        """Every value, as unsigned 64-bit numbers."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        out = ones.astype(np.uint64) << np.uint64(self.low_bits)
        for j in range(self.low_bits):
            out |= bits[:, j].astype(np.uint64) << np.uint64(j)
        return out


def encode_block(part: int, number: int, keys: list, ids: list[bytes], width: int) -> bytes:
    """One block: ``keys`` ascending, NULLs first; per document its ids in ``width`` bytes each."""
    some = [k for k in keys if k is not None]
    kind = TEXT_KEYS if some and isinstance(some[0], str) else INT_KEYS
    if kind == TEXT_KEYS:
        raw = [k.encode() for k in some]
        stored = EliasFano.encode(np.cumsum([len(x) for x in raw])) + b"".join(raw)
    else:
        first = some[0] if some else 0
        stored = struct.pack("<q", first) + EliasFano.encode(np.array([k - first for k in some], np.uint64))
    ends = np.cumsum([len(x) // width for x in ids])
    total = int(ends[-1])
    head = struct.pack(HEADER, MAGIC, part, number, len(keys), len(keys) - len(some), total, width, kind, 0)
    return b"".join((head, EliasFano.encode(ends), stored, *ids))


class Block:
    """A block of a file, read in place; ``end`` is where the next one may start."""

    def __init__(self, data: bytes | memoryview, at: int = 0):
        magic, self.part, self.number, self.n_docs, nulls, self.n_ids, width, kind, _ = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        self.ends = EliasFano(data, at + struct.calcsize(HEADER))
        at = self.ends.end
        if kind == TEXT_KEYS:
            bounds = EliasFano(data, at)
            ends = [0, *bounds.all().tolist()]
            raw = bytes(data[bounds.end:bounds.end + ends[-1]])
            some, at = [raw[a:b].decode() for a, b in zip(ends, ends[1:])], bounds.end + ends[-1]
        else:
            (first,), offsets = struct.unpack_from("<q", data, at), EliasFano(data, at + 8)
            some, at = [first + x for x in offsets.all().tolist()], offsets.end
        self.keys = [None] * nulls + some
        self.ids = np.frombuffer(data, "<u2" if width == 2 else "<u4", self.n_ids, at)
        self.end = at + self.ids.nbytes

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``, found by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


def blocks(content: bytes) -> Iterator[Block]:
    """The blocks of a file: each is followed by one line feed."""
    at, data = 0, memoryview(content)
    while at < len(data):
        block = Block(data, at)
        yield block
        at = block.end + 1


# Latin-1 letters, whose lower case and composed form are one letter each, and all ASCII but the
# apostrophe (clitics) and "<" (special tokens).
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9 \n\t!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~¡¿]*")
_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[9, 10, 32]] = _BLANK
_KINDS[48:58] = _DIGIT
_KINDS[[*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_AT_ONCE = 2000
_PORTION = 4 << 20


def split_pieces(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of lower-case plain text (Latin-1 bytes) start and end."""
    kind = _KINDS[np.frombuffer(data, np.uint8)]
    edge = np.empty(len(kind) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    solid = kind != _BLANK
    return np.flatnonzero(edge[:-1] & solid), np.flatnonzero(edge[1:] & solid) + 1


def number_pieces(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """(number of each piece, the distinct pieces).

    Pieces of up to 16 bytes are told apart by two 64-bit words that hold them; longer ones, which
    are rare, as strings.
    """
    size = ends - starts
    words = np.ndarray(len(data) + 8, "<u8", data + bytes(16), strides=(1,))
    low = words[starts] & _MASKS[np.minimum(size, 8)]
    high = words[np.minimum(starts + 8, len(data))] & _MASKS[np.clip(size - 8, 0, 8)]
    long: dict[bytes, int] = {}
    for i in np.flatnonzero(size > 16).tolist():
        low[i], high[i] = long.setdefault(data[starts[i]:ends[i]], len(long)), 0
    few = np.minimum(size, 17).astype(np.uint64)
    numbers, _ = pd.factorize((low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F)) ^ few)
    first = np.empty(int(numbers.max(initial=-1)) + 1, np.int64)
    first[numbers[::-1]] = np.arange(len(numbers))[::-1]
    for part in (low, high, few):
        if not np.array_equal(part, part[first][numbers]):  # two pieces of one hash: tell them apart by all words
            _, first, numbers = np.unique(np.stack((low, high, few)), axis=1, return_index=True, return_inverse=True)
            numbers = numbers.ravel()
            break
    return numbers, [data[a:b].decode("latin-1") for a, b in zip(starts[first].tolist(), ends[first].tolist())]


def _packed(tokenizer, texts: list[str], dtype: str) -> list[bytes]:
    return [np.array(e.ids, dtype).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    """Ids of texts by pieces: those met lately are looked up, the library encodes the others."""

    def __init__(self, tokenizer, kept: int, dtype: str):
        self.tokenizer, self.dtype, self.half, self.young, self.old = tokenizer, dtype, max(kept // 2, 1), {}, {}
        suffix = tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the tokenizer marks no word ends")
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(suffix)

    def _new(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Many pieces are encoded as one text and cut at the word ends."""
        for i in range(0, len(pieces), _AT_ONCE):
            part = pieces[i:i + _AT_ONCE]
            raw = _packed(self.tokenizer, [" ".join(part)], self.dtype)[0]
            cuts = np.flatnonzero(self.ends[np.frombuffer(raw, self.dtype)]) + 1
            if len(cuts) != len(part):
                raise ValueError("the tokenizer does not split texts into these pieces")
            at = 0
            for piece, cut in zip(part, (cuts * np.dtype(self.dtype).itemsize).tolist()):
                yield piece, raw[at:cut]
                at = cut

    def _known(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young
        missing = [p for p in pieces if p not in self.young]
        new = []
        for p in missing:
            got = self.old.get(p)
            if got is None:
                new.append(p)
            else:
                self.young[p] = got
        self.young.update(self._new(new))
        return [self.young[p] for p in pieces]

    def ids(self, texts: list[str]) -> list[bytes]:
        plain = [bool(_PLAIN.fullmatch(t)) for t in texts]
        odd = iter(_packed(self.tokenizer, [t for t, ok in zip(texts, plain) if not ok], self.dtype))
        raw = [t.lower().encode("latin-1") for t, ok in zip(texts, plain) if ok]
        data = b"\n".join(raw)
        starts, ends = split_pieces(data)
        numbers, distinct = number_pieces(data, starts, ends)
        known = self._known(distinct)
        # the ids of every piece, gathered from those of the distinct ones
        width = np.dtype(self.dtype).itemsize
        flat = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.array([len(x) // width for x in known], np.int64)
        offsets = np.cumsum(sizes) - sizes
        counts = sizes[numbers]
        upto = np.concatenate(([0], np.cumsum(counts)))
        ids = flat[np.repeat(offsets[numbers] - upto[:-1], counts) + np.arange(upto[-1])]
        text_ends = np.cumsum([len(x) + 1 for x in raw])
        cuts = upto[np.searchsorted(starts, text_ends)].tolist()
        done = iter([ids[a:b].tobytes() for a, b in zip([0, *cuts], cuts)])
        return [next(done) if ok else next(odd) for ok in plain]


def _encoder(definition: str, vocabulary: Vocabulary):
    """(function from texts to packed ids, bytes of an id), kept from task to task: Python workers
    are reused, and what hangs on an imported module lives as long as they do."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_kept_encoders", {})
    key = (zlib.crc32(definition.encode()), vocabulary)
    if key not in kept:
        kept.clear()
        tokenizer = tokenizers.Tokenizer.from_str(definition)
        width = 2 if max(tokenizer.get_vocab_size(), vocabulary.end_id + 1) <= 1 << 16 else 4
        if vocabulary.by_piece:
            kept[key] = _Pieces(tokenizer, vocabulary.kept_pieces, f"<u{width}").ids, width
        else:
            kept[key] = lambda texts: _packed(tokenizer, texts, f"<u{width}"), width
    return kept[key]


def _portions(batches) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts, as many at a time as make ``_PORTION`` characters."""
    names, texts, held = [], [], 0
    for batch in batches:
        names += batch.column(0).to_pylist()
        texts += batch.column(1).to_pylist()
        held += batch.column(1).nbytes
        if held >= _PORTION:
            yield names, texts
            names, texts, held = [], [], 0
    if names:
        yield names, texts


def _vocabulary_file(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def write_token_files(docs: DataFrame, path: str, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text",
                      block_ids: int = 1 << 20, max_blocks: int = 16) -> None:
    """The ids of all texts of ``docs`` in key order, as files of blocks below ``path``.

    * a NULL text is empty: its document holds the end id only. NULL keys come first.
    * rows of equal key are ordered by text hash, then by text; integer keys stay integers,
      any other type is stored as strings.
    * a document longer than ``block_ids`` has a block of its own; texts are never cut.
    * an empty table makes no block. Other columns of ``docs`` are ignored.

    The tokenizer's file is read on the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(_vocabulary_file(vocabulary.path))
    whole = dict(docs.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    k, body = F.col(f"`{key}`").cast("bigint" if whole else "string"), F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def to_blocks(batches):
        from pyspark import TaskContext

        encode, width = _encoder(definition.value, vocabulary)
        end = vocabulary.end_id.to_bytes(width, "little")
        part, number, keys, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([encode_block(part, number, keys, ids, width)], pa.binary())], names=["block"])

        for names, texts in _portions(batches):
            for name, found in zip(names, encode(texts)):
                count = len(found) // width + 1
                if keys and held + count > block_ids:
                    yield block()
                    number, keys, ids, held = number + 1, [], [], 0
                keys.append(name)
                ids.append(found + end)
                held += count
        if keys:
            yield block()

    rows = docs.select(k.alias("key"), body.alias("body"), F.xxhash64(body).alias("tie"))
    placed = (rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "body").select("key", "body"))
    with small_batches(spark):
        made = placed.mapInArrow(to_blocks, "block binary")
        (made.select(F.col("block").cast("string").alias("value")).write
         .option("compression", "none").option("maxRecordsPerFile", max_blocks).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _key_type(spark: SparkSession, path: str) -> str:
    """Type of the stored keys, from the first block."""

    def kinds(batches):
        for batch in batches:
            for content in batch.column(0):
                for b in blocks(content.as_buffer()):
                    if len(b.keys) and b.keys[-1] is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([isinstance(b.keys[-1], str)])], names=["text"])
                        return

    with small_batches(spark, 1):
        first = _files(spark, path).mapInArrow(kinds, "text boolean").first()
    return "string" if first is not None and first["text"] else "bigint"


def token_rows(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files below ``path``: ``key``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit
    integers) and, on request, ``ids``."""
    dtype = _key_type(spark, path)
    fields = f"part int, number int, key {dtype}, at long, n_tokens long, ids_crc32 long"
    columns = fields + (", ids array<long>" if with_ids else "")
    kind = pa.string() if dtype == "string" else pa.int64()

    def documents(batches):
        for batch in batches:
            for content in batch.column(0):
                for b in blocks(content.as_buffer()):
                    ends = b.ends.all().astype(np.int64)
                    starts = np.concatenate(([0], ends[:-1]))
                    wide = np.ascontiguousarray(b.ids, "<u4")
                    sums = [zlib.crc32(wide[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                    n = b.n_docs
                    out = [pa.array(np.full(n, b.part, np.int32)), pa.array(np.full(n, b.number, np.int32)),
                           pa.array(b.keys, kind), pa.array(starts), pa.array(ends - starts),
                           pa.array(sums, pa.int64())]
                    if with_ids:
                        offsets = pa.array(np.concatenate((starts, ends[-1:])).astype(np.int32))
                        out.append(pa.ListArray.from_arrays(offsets, pa.array(wide.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in columns.split(", ")])

    with small_batches(spark, 1):
        rows = _files(spark, path).mapInArrow(documents, columns)
        rows = rows if with_ids else stage(rows)
        held = stage(rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("held")))
    # Where a block starts: the ids of all earlier partitions, and of its partition's earlier blocks.
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = held.groupBy("part").agg(F.sum("held").alias("held"))
    zero = F.lit(0).cast("long")
    parts = parts.select("part", F.coalesce(F.sum("held").over(before.orderBy("part")), zero).alias("base"))
    inside = held.select("part", "number", F.coalesce(
        F.sum("held").over(before.partitionBy("part").orderBy("number")), zero).alias("own"))
    base = stage(inside.join(parts, "part").select("part", "number", (F.col("base") + F.col("own")).alias("base")))
    base = F.broadcast(base) if base.count() <= MAX_BROADCAST_BLOCKS else base
    out = rows.join(base, ["part", "number"])
    return out.select(F.col("key").alias(key), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      *(["ids"] if with_ids else []))
