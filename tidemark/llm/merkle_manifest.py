"""Merkle manifest of a dataset: content-addressed records, and proofs by descent.

Every row is a leaf: the digest of its fields. The leaves of one group (a language), in key
order, are the first level; each run of ``ARITY`` nodes becomes one node, the digest of its
children's digests, until one is left. The groups' subroots, in group order, form a tree of
the same kind, whose root names the whole dataset.

What is kept are content-addressed records, digest -> digests of the children. A leaf's proof
is found by descent: from the root, its rank's digits (base ``ARITY``) say which child comes
next; the children not chosen are collected, and the path is reversed at the end, so that it
leads from the leaf to the root. Leaves that share a prefix of digits share the steps of that
prefix: a step is one join of the nodes reached so far with the records, and the nodes
reached grow by ``ARITY`` per step, up to the lowest level. Neither the root's record nor a
hot group's is a hot join key.

Scale: texts are read once, only digests move. Ranks come from one range-partitioned sort of
narrow rows (staged) and the row counts per partition, so a group with a third of all rows is
spread like any other. Levels shrink by ``ARITY``; each is staged, so a lost executor costs
one level. Paths travel with the lowest inner nodes, not with the leaves: they are joined to
runs of leaves and unfolded where the proofs are folded.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import group_key, stage

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
MAX_BROADCAST_RUNS = 200_000  # a run's row is under 200 bytes
_LOW33 = (1 << 33) - 1


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:`` and the value as a string."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _few(runs: DataFrame) -> DataFrame:
    return F.broadcast(runs) if runs.count() <= MAX_BROADCAST_RUNS else runs


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (narrow) plus ``rank`` (0, 1, ... per group by ``order``) and the group's size ``n``.

    Rows equal in ``order`` are ranked in an unspecified order.
    """
    by = [group, *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = stage(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie"))
    at = placed.withColumn("at", F.monotonically_increasing_id())
    at = at.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(_LOW33)))
    runs = at.groupBy(group, "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select(
        group, "part", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(Window.partitionBy(group)).alias("n")))
    return (at.join(_few(runs), [group, "part"])
            .withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift"))


def _up(rank: Column | str) -> Column:
    return F.call_function("div", F.col(rank) if isinstance(rank, str) else rank, F.lit(ARITY).cast("long"))


def _runs(n: str) -> Column:
    """How many runs ``n`` nodes make."""
    return F.call_function("div", F.col(n) + (ARITY - 1), F.lit(ARITY).cast("long"))


def _climb(nodes: DataFrame, most: int) -> tuple[DataFrame | None, DataFrame]:
    """Records and tops of the trees over ``nodes`` (g, idx, digest, n: nodes of the group).

    Records: digest, children. Tops: g, digest, height (levels above ``nodes``); ``most`` is
    the largest ``n``.
    """
    records, tops, height, current = [], [], 0, nodes
    while True:
        tops.append(current.filter("n = 1").select("g", "digest", F.lit(height).alias("height")))
        if most <= 1:
            break
        children = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda c: c["digest"])
        level = (current.filter("n > 1").groupBy("g", _up("idx").alias("idx"), _runs("n").alias("n"))
                 .agg(children.alias("children")))
        current = stage(level.withColumn("digest", digest(F.array_join("children", ""))))
        records.append(current.select("digest", "children"))
        height, most = height + 1, -(-most // ARITY)
    # equal digests have equal children: one record each
    store = reduce(DataFrame.union, records).dropDuplicates(["digest"]) if records else None
    return store, reduce(DataFrame.union, tops)


def _split(children: Column, at: Column) -> Column:
    """The children not chosen: left and right of position ``at``."""
    n = F.size(children)
    return F.struct(F.array_join(F.slice(children, F.lit(1), at), "").alias("left"),
                    F.array_join(F.slice(children, at + 2, F.greatest(n - at - 1, F.lit(0))), "").alias("right"))


def _descend(entries: DataFrame, records: DataFrame | None, height: int, carry: list[str],
             wanted: DataFrame | None = None) -> DataFrame:
    """Nodes at height 0 below ``entries`` (g, digest, height, path, ``carry``): g, idx, path, ``carry``.

    ``path`` lists the children not chosen, from the root on. ``wanted`` (g, idx at height 0)
    keeps only the prefixes that lead to requested nodes.
    """
    cols = ["g", "idx", "digest", "path", *carry]
    reached = None
    for h in range(height, -1, -1):
        here = entries.filter(F.col("height") == h).withColumn("idx", F.lit(0).cast("long")).select(*cols)
        if reached is not None:
            step = (reached.join(records.withColumnRenamed("digest", "node"), F.col("digest") == F.col("node"))
                    .select("g", "idx", "path", *carry, "children", F.posexplode("children").alias("pos", "child")))
            here = here.unionByName(step.select(
                "g", (F.col("idx") * ARITY + F.col("pos")).alias("idx"), F.col("child").alias("digest"),
                F.concat(F.col("path"), F.array(_split(F.col("children"), F.col("pos")))).alias("path"), *carry))
        if wanted is not None:
            prefix = F.col("idx")
            for _ in range(h):
                prefix = _up(prefix)
            here = here.join(wanted.select("g", prefix.alias("idx")).distinct(), ["g", "idx"], "left_semi")
        reached = here
    return reached.select("g", "idx", "path", *carry)


@dataclass(frozen=True)
class Manifest:
    """``runs``: g, idx, n, digest, members (the leaves of each lowest run, with ``extra``);
    ``records``: digest, children above the runs; ``tops``: g, digest, height above the runs;
    ``groups``: g, idx, digest (subroot), ``group_records`` and ``root`` (g, digest, height)."""

    runs: DataFrame
    records: DataFrame | None
    tops: DataFrame
    groups: DataFrame
    group_records: DataFrame | None
    root: DataFrame
    height: int
    group_height: int


def _height(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def build(leaves: DataFrame, key: str, extra: list[str] = []) -> Manifest | None:
    """The manifest of ``leaves`` (g, ``key``, leaf, ``extra``: small columns); None if there are none."""
    rows = ranked(leaves, "g", [key, "leaf"])
    member = F.struct("rank", "leaf", F.col(key).alias("key"), *extra)
    runs = (rows.groupBy("g", _up("rank").alias("idx"), F.col("n").alias("leaves"))
            .agg(F.sort_array(F.collect_list(member)).alias("members")))
    # a lone leaf stands for itself
    whole = F.when(F.col("leaves") == 1, F.col("members")[0]["leaf"]).otherwise(
        digest(F.array_join(F.transform("members", lambda m: m["leaf"]), "")))
    runs = stage(runs.select("g", "idx", "leaves", _runs("leaves").alias("n"), "members", whole.alias("digest")))
    most = runs.agg(F.max("n").alias("n")).first()["n"]
    if most is None:
        return None
    records, tops = _climb(runs.select("g", "idx", "n", "digest"), most)
    tops = stage(tops)
    groups = stage(ranked(tops.select(F.lit("").alias("all"), "g", "digest"), "all", ["g"])
                   .select(F.col("all").alias("g"), F.col("rank").alias("idx"), "n", "digest",
                           F.col("g").alias("member")))
    count = groups.count()
    group_records, root = _climb(groups.select("g", "idx", "n", "digest"), count)
    return Manifest(runs, records, tops, groups.select("idx", "digest", F.col("member").alias("g")),
                    group_records, stage(root), _height(most), _height(count))


def paths(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Path of each lowest run: g, idx, path (from the root on), subroot, root.

    ``requests`` (g, idx) limits the descent to these runs; by default all are requested.
    """
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = m.root.select("g", "digest", "height", none.alias("path"), F.col("digest").alias("root"))
    reached = _descend(top, m.group_records, m.group_height, ["root"])
    entries = (reached.select("idx", "path", "root").join(m.groups, "idx")
               .select("g", "path", "root", F.col("digest").alias("subroot"))
               .join(m.tops, "g"))
    return _descend(entries, m.records, m.height, ["subroot", "root"], requests)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings (from the leaf on) lead to."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["left"], d, s["right"]))


def leaf_digests(docs: DataFrame, fields: tuple[str, ...], changed: dict[str, Column]) -> tuple[Column, Column]:
    """Digest of the fields of a row, and of the fields with ``changed`` in place of its own."""
    own = [field(F.col(f"`{f}`")) for f in fields]
    other = [field(changed[f]) if f in changed else c for f, c in zip(fields, own)]
    return digest(*own), digest(*other)


def tampered(key: Column, text: Column) -> Column:
    """The test tampering: A-Z lower-cased where 3 divides the CRC-32 of the decimal key."""
    hit = F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 0
    return F.when(hit, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)


def manifest_rows(docs: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text",
                  fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    * NULL fields have a digest form of their own; NULL keys come first in their group, the
      NULL group comes first among the groups. A NULL key is never tampered with.
    * rows of equal key are ordered by leaf digest; equal rows have equal leaves and get a
      proof each, by their rank.
    * a lone leaf is its group's subroot, and a lone subroot is the root: such a proof has no
      siblings, its digest is that of nothing.
    * texts are digested whole. An empty table gives an empty result; other columns of
      ``docs``, whatever their names, are ignored.
    """
    leaf, other = leaf_digests(docs, fields, {text: tampered(F.col(f"`{key}`"), F.col(f"`{text}`"))})
    leaves = docs.select(group_key(F.col(f"`{group}`")).alias("g"), F.col(f"`{key}`").alias("doc_id"),
                         leaf.alias("leaf"), other.alias("other"))
    m = build(leaves, "doc_id", ["other"])
    if m is None:
        return leaves.filter("1 = 0").select(
            "doc_id", "leaf", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
            F.lit(False).alias("verified"))
    found = m.runs.select("g", "idx", "leaves", "members").join(paths(m), ["g", "idx"])
    each = found.select("leaves", F.transform("members", lambda x: x["leaf"]).alias("run"),
                        F.reverse("path").alias("path"), "subroot", "root", F.posexplode("members").alias("pos", "m"))
    own = F.when(F.col("leaves") > 1, F.array(_split(F.col("run"), F.col("pos")))).otherwise(
        F.array().cast("array<struct<left:string,right:string>>"))
    each = each.select(F.col("m.key").alias("doc_id"), F.col("m.leaf").alias("leaf"), F.col("m.other").alias("other"),
                       "subroot", "root", F.concat(own, F.col("path")).alias("path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return (each.select("doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"),
                        fold(F.col("other"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
