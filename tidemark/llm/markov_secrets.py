"""Secret scan: base patterns plus character Markov models.

Two first-order Markov models over ASCII characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a candidate string is a secret if
its log-likelihood ratio is high enough, in total and per character.

The labelled samples come from the corpus itself unless a table is given: what the base
patterns match is random, candidate strings apart from any base match are ordinary. All of
them are counted, none is sampled. Such samples know only the alphabets that the base
patterns happen to match; ``labelled_samples`` gives random strings of all usual alphabets,
and the corpus' words and identifiers (strings of their shape, not all candidates). A model is at most one row per pair of characters, so
counts are combined map-side and the two models (a table of fixed size, one number per pair
of characters) are the only thing that passes the driver.

DataFrame functions only. Patterns give strings but no positions, so a match's start is
rebuilt from the lengths of the pieces between matches (``split`` by the same pattern).
Positions are code points, ends are exclusive. Each text is scanned once; only matches and
candidates are staged.
"""

from __future__ import annotations

import math
import random
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage

# The base patterns of the query contract, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_MIN = 18
HEX = r"[0-9a-f]+"
HEX_MIN = 16
KINDS = ("assign", "access", "hex", "markov")

#: Candidates of the models. Matches of the base patterns for hex are runs of 16 or more.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
_CODES = 128
_SCALE = 1000  # log ratios are kept as integers of 1/1000 nat, so sums do not depend on order

#: Alphabets of random strings: base64 and its URL form, base62, base58, base36 and base32 and hex in both cases.
ALPHABETS = {
    "base64": string.ascii_letters + string.digits + "+/", "base64url": string.ascii_letters + string.digits + "-_",
    "base62": string.ascii_letters + string.digits,
    "base58": "".join(sorted(set(string.ascii_letters + string.digits) - set("0OIl"))),
    "upper36": string.ascii_uppercase + string.digits, "lower36": string.ascii_lowercase + string.digits,
    "base32": string.ascii_uppercase + "234567", "hex": string.digits + "abcdef", "HEX": string.digits + "ABCDEF",
}
_RANDOM_STRINGS, _RANDOM_LENGTH = 20, 500  # per alphabet

# Words and identifiers that the ordinary model learns from: whole strings of at most 64
# characters whose parts between separators are words (camel case has two or more small letters
# after a capital, capitals come in runs of 15 or fewer) with up to four digits, or numbers.
_MARKS = "+/_=-"
_TOKEN = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{2,64}+(?![\p{L}\p{N}+/_=-])"
_PART = r"(?:(?:[A-Za-z]?[a-z]*(?:[A-Z][a-z]{2,})*|[A-Z]{1,15})[0-9]{0,4}|[0-9]+)"
IDENTIFIER = rf"^{_PART}(?:[{_MARKS}]+{_PART})*$"

_COMMON_NAMES = 2000  # identifiers made of these words
_COMMON = ("access account action address array base buffer cache call char check class client code column config "
           "connection content context count create current data date default delete device document element "
           "error event export false field file filter find first format frame function group handle header height image "
           "import index input instance item join json key language last length level library line link list load local "
           "manager map message method model module name network next node null number object offset option order "
           "output package page parameter parent parse path position previous process project property query "
           "queue quick read record region remove request response result return schema score search section select "
           "server service session size source start state status stream string subject system table target task "
           "text thread time title total true type update upload user utils value variable version view virtual "
           "wait width window word wrap write xml year zero zone").split()


@dataclass(frozen=True)
class Scan:
    """A candidate is a secret above both bounds, in 1/1000 nat."""

    min_total: int = 8000
    min_per_pair: int = 300


def _matches(text: str, pattern: str, kind: int) -> Column:
    """Non-overlapping matches as structs (start, kind, end, match), from pieces and matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.char_length(x["piece"])
        end = start + F.char_length(x["match"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

    pairs = F.transform(found, lambda m, i: F.struct(F.get(pieces, i).alias("piece"), m.alias("match")))
    return F.aggregate(pairs, empty, step, lambda s: s["out"])


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """Staged (doc_id, base, candidates): matches of the base patterns, in order of start and
    kind, and candidate strings that overlap none of them."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select("doc_id", body.alias("body"))
    df = df.select(
        "doc_id",
        F.when(F.col("body").rlike(ASSIGN), _matches("body", ASSIGN, 0)).alias("assign"),
        F.when(F.col("body").rlike(ACCESS), _matches("body", ACCESS, 1)).alias("access"),
        # A run of hex digits is as long as it gets, so short runs may be left out at once.
        F.when(F.col("body").rlike(rf"[0-9a-f]{{{HEX_MIN}}}"),
               _matches("body", rf"[0-9a-f]{{{HEX_MIN},}}", 2)).alias("hex"),
        F.when(F.col("body").rlike(CANDIDATE), _matches("body", CANDIDATE, 3)).alias("maybe"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    value = F.filter("assign", lambda x: F.char_length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_MIN)
    access = F.filter("access", lambda x: F.char_length(x["match"]) >= ACCESS_MIN)
    df = df.select("doc_id", F.coalesce("maybe", none).alias("maybe"), F.array_sort(F.concat(
        F.coalesce(value, none), F.coalesce(access, none), F.coalesce("hex", none))).alias("base"))
    apart = F.filter("maybe", lambda c: ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return stage(df.select("doc_id", "base", apart.alias("candidates")))


def corpus_samples(rows: DataFrame) -> DataFrame:
    """(sample, random): labelled strings of the scanned corpus."""
    secret = F.transform("base", lambda b: F.struct(
        F.when(b["kind"] == 0, F.regexp_extract(b["match"], ASSIGN, 2)).otherwise(b["match"]).alias("sample"),
        F.lit(True).alias("random")))
    plain = F.transform("candidates", lambda c: F.struct(c["match"].alias("sample"), F.lit(False).alias("random")))
    return rows.select(F.explode(F.concat(secret, plain)).alias("s")).select("s.*")


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(sample, random, weight): random strings of every alphabet, and the words and identifiers of the corpus.

    Each distinct word or identifier counts once, and a word once more in one of the writings
    of identifiers (camel case, or small or capital letters with separators and numbers),
    which a hash of the word chooses. Identifiers of common words weigh at least a tenth of
    that, so that a pair of characters is not odd only because the corpus lacks it.

    Nothing is staged: the distinct strings are shuffled once and their shuffle is read twice, to
    count and to give them. Many small files would be written else, one per shuffle partition.
    """
    pick = random.Random(11)
    noise = ["".join(pick.choices(a, k=_RANDOM_LENGTH)) for a in ALPHABETS.values() for _ in range(_RANDOM_STRINGS)]
    common = []
    for i in range(_COMMON_NAMES):
        parts = pick.choices(_COMMON, k=3) + [str(pick.randrange(10_000))] * (i % 2)
        if i % 3 == 0:
            common.append((str.upper if i % 4 else str.capitalize)(parts[0]) + "".join(map(str.capitalize, parts[1:])))
        else:
            mark, other = pick.choices(_MARKS, k=2)
            name = mark.join(parts) + (mark * 3 + other + mark) * (i % 4 == 0)
            common.append(name.upper() if i % 3 == 1 else name)

    def listed(values: list[str]) -> Column:
        return F.explode(F.split(F.lit(" ".join(values)), " ")).alias("sample")

    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(_TOKEN), F.lit(0))
    tokens = (docs.select(F.explode(F.array_distinct(found)).alias("sample"))
              .filter(F.col("sample").rlike(IDENTIFIER)).distinct())
    word, small = F.col("sample"), F.lower("sample")

    def chosen(name: str, n: int) -> Column:
        return F.pmod(F.crc32(F.concat(F.lit(name), word).cast("binary")), F.lit(n)).cast("int")

    number = F.lpad(chosen("number", 10_000).cast("string"), 4, "0")
    one, two = (F.substring(F.lit(_MARKS), chosen(name, len(_MARKS)) + 1, F.lit(1)) for name in ("one", "two"))
    writings = [F.concat(F.initcap(small), F.initcap(small), number)]
    writings += [F.concat(w, one, w, one, one, two, one, number, one, w, number) for w in (small, F.upper(word))]
    names = F.when(word.rlike("^[A-Za-z][a-z]+$"), F.array(word, F.get(F.array(*writings), chosen("writing", len(writings)))))
    one_each = F.lit(1).cast("long").alias("weight")
    ordinary = tokens.select(F.explode(F.coalesce(names, F.array(word))).alias("sample"), one_each)
    times = F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(10 * _COMMON_NAMES))).cast("long")
    usual = tokens.agg(times.alias("weight")).select(listed(common), "weight")
    return (docs.sparkSession.range(1).select(listed(noise), one_each).withColumn("random", F.lit(True))
            .unionByName(ordinary.unionByName(usual).withColumn("random", F.lit(False))))


def _codes(text: Column) -> Column:
    """ASCII codes of a string's characters; any other character counts as code 0."""
    return F.transform(F.split(text, ""), lambda c: F.when(F.ascii(c) < _CODES, F.ascii(c)).otherwise(F.lit(0)))


def _pairs(text: Column) -> Column:
    """Cell number of each pair of neighbouring characters."""
    codes = _codes(text)
    return F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                      lambda a, b: a * _CODES + b)


def log_ratios(samples: DataFrame) -> list[int]:
    """Scaled log of P(next | character, random) / P(next | character, ordinary) per cell.

    Both models are smoothed by one half per cell. A sample counts ``weight`` times if there is
    such a column. Without samples of either kind every ratio is 0, so nothing is found.
    """
    weight = F.col("weight") if "weight" in samples.columns else F.lit(1)
    cells = (samples.filter(F.char_length("sample") > 1)
             .select("random", weight.alias("weight"), F.explode(_pairs(F.col("sample"))).alias("cell")))
    counts = cells.groupBy("random", "cell").agg(F.sum("weight").alias("n")).collect()  # at most 2 * 128 * 128
    n = {True: {}, False: {}}
    for r in counts:
        n[r["random"]][r["cell"]] = r["n"]
    if not n[True] or not n[False]:
        return [0] * (_CODES * _CODES)
    out = []
    for a in range(_CODES):
        row = range(a * _CODES, (a + 1) * _CODES)
        total = {k: math.log(sum(v.get(c, 0) for c in row) + _CODES / 2) for k, v in n.items()}
        out += [round(_SCALE * ((math.log(n[True].get(c, 0) + 0.5) - total[True])
                                - (math.log(n[False].get(c, 0) + 0.5) - total[False]))) for c in row]
    return out


def score(text: Column, ratios: list[int]) -> Column:
    """Sum of the scaled log ratios over a string's pairs of characters."""
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    return F.aggregate(_pairs(text), F.lit(0), lambda s, c: s + F.get(model, c))


def secret_rows(docs: DataFrame, how: Scan = Scan(), samples: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``samples`` (sample string, random boolean) replaces the corpus' own labelled strings.
    NULL and empty texts have no spans. Repeated rows are scanned alike; other columns of
    ``docs`` are ignored.
    """
    with small_batches(docs.sparkSession):
        rows = scanned(docs)
        ratios = log_ratios(corpus_samples(rows) if samples is None else samples)
    scored = F.transform("candidates", lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["match"].alias("match"),
        score(c["match"], ratios).alias("score")))
    rows = rows.withColumn("scored", scored)
    found = F.transform(
        F.filter("scored", lambda c: (c["score"] >= how.min_total)
                 & (c["score"] >= (c["end"] - c["start"] - 1) * how.min_per_pair)),
        lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                           c["match"].alias("match")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", found))).alias("spans"))
