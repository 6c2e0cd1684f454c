"""Merkle manifest of a dataset, with an inclusion proof for every row.

Method
------
A row's leaf is the SHA-256 of its columns.  The leaves of a group, in order of
their ids, are folded ``FANOUT`` at a time until one digest is left, the
group's subroot; the subroots, in order of the groups, are folded likewise into
the root.  ``store`` keeps the result as a content-addressed graph: a record
for each digest with the digests of its children.

Proofs are read off the graph.  Requests descend from the root: at each node
the next digit (base ``FANOUT``) of the request's rank selects a child, and the
children not selected are a segment of the path.  Requests that share their
first digits descend as one row, so the root is looked up once, not once for
every leaf, and a level of the descent has as many rows as the tree has nodes
there.  At the leaf the segments are reversed (nearest first): their digests
are the proof, and folding a leaf with them gives a root to compare.

Scale: the leaves (digests, no texts) are sorted once by range; a rank is the
place in the sorted partition plus the rows of the group in the partitions
before it, so no group is ever sorted or counted in one task.  Folding
shuffles by (group, rank / FANOUT), at most ``FANOUT`` rows a key, each level
a sixteenth of the one below.  The descent joins node tables by digest or by
(group, place), each place once.  Nothing but the greatest group size and the
number of groups comes to the driver.  Ranks and leaf groups are cut in the
shared folder.

Defined results
---------------
* a null column value is hashed as ``-``, any other as its UTF-8 byte count,
  ``:`` and the value, so ``-``, empty text and null differ; very long texts
  are hashed whole, where they are read;
* a null group (first) is a group like any other; a null id sorts first;
* rows with the same id are ordered by their leaf digests; equal rows have
  equal leaves, each with a place, and so a proof, of its own;
* a group of one row has that row's leaf as subroot, a table of one group that
  subroot as root; a proof without siblings is the hash of nothing;
* an empty table gives no rows; other columns, whatever their names, are
  ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import cut

#: Children of a node.
FANOUT = 16
_WIDTH = 64                              # characters of a digest


def digest_of(columns: list[Column]) -> Column:
    """The leaf of a row with these columns."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _folded(members: Column) -> Column:
    return F.sha2(F.array_join(members, ""), 256)


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where the keys are equal or both null; ``right`` adds its
    other columns."""
    named = right.select(*[F.col(c).alias(f"right_{c}" if c in keys else c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys]
    return left.join(named, on).drop(*[f"right_{k}" for k in keys])


def ranked(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``rank`` (from 0 within the group) and, apart, a row for
    each group with its size ``n``.  The order must be total up to rows that
    are alike."""
    tie = F.monotonically_increasing_id()      # parts rows alike between tasks
    at = cut(rows.withColumn("tie", tie))
    keys = [group, *order, "tie"]
    at = cut(at.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie"))
    at = at.withColumn("place", F.monotonically_increasing_id()) \
        .withColumn("part", F.shiftright("place", 33))
    runs = at.groupBy(group, "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part")
    runs = runs.withColumn("ahead", F.sum("n").over(before) - F.col("n"))
    out = _meet(at, runs.drop("n"), [group, "part"]).select(
        *rows.columns, F.expr("place - first + ahead").alias("rank"))
    return out, runs.groupBy(group).agg(F.sum("n").alias("n"))


def _height(n: Column, most: int) -> Column:
    """Levels above the leaves of a group of n."""
    levels, room = F.lit(0), 1
    while room < most:
        levels = levels + (n > room).cast("int")
        room *= FANOUT
    return levels


def _fold_up(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``nodes`` (group, rank, digest, n: the group's nodes):
    each a table group, rank, digest, n, children of the groups that still had
    several."""
    out = []
    while most > 1:
        step = nodes.where("n > 1").groupBy("grp", F.expr(f"rank div {FANOUT}").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"].alias("children"),
            F.first("n").alias("n"))
        nodes = cut(step.select("grp", F.col("up").alias("rank"), _folded(F.col("children")).alias("digest"),
                                F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), "children"))
        out.append(nodes)
        most = -(-most // FANOUT)
    return out


class Manifest:
    """The graph of one table: ``leaves`` (grp, rank, digest and the rows'
    own columns), ``levels`` by group and ``top`` over the groups."""

    def __init__(self, rows: DataFrame, order: list[str]):
        """rows: grp, digest and columns to carry along, ordered by ``order``."""
        leaves, sizes = ranked(rows, "grp", order)
        self.carried = [c for c in rows.columns if c not in ("grp", "digest")]
        self.spark = rows.sparkSession
        sizes = cut(sizes)
        self.most = sizes.agg(F.max("n")).first()[0] or 0
        # the lowest level keeps what its leaves carry
        own = F.struct("rank", "digest", *self.carried)
        grouped = leaves.groupBy("grp", F.expr(f"rank div {FANOUT}").alias("up")) \
            .agg(F.sort_array(F.collect_list(own)).alias("leaves"))
        self.leaves = cut(grouped.select("grp", F.col("up").alias("rank"), "leaves"))
        low = _meet(self.leaves, sizes, ["grp"]).select(
            "grp", "rank", "n", F.col("leaves.digest").alias("children"))
        ones = low.where("n = 1").select("grp", F.col("children")[0].alias("digest"), "n")
        many = cut(low.where("n > 1").select(
            "grp", "rank", _folded(F.col("children")).alias("digest"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), "children"))
        self.levels = [many, *_fold_up(many, -(-self.most // FANOUT))] if self.most > 1 else []
        subroots = functools.reduce(DataFrame.unionByName, [
            ones.select("grp", "digest"),
            *[lv.where("n = 1").select("grp", "digest") for lv in self.levels]])
        subroots = _meet(subroots, sizes, ["grp"]).select(
            F.col("grp").alias("name"), "digest", _height(F.col("n"), self.most).alias("height"))
        ordered, count = ranked(subroots.withColumn("grp", F.lit(0)), "grp", ["name"])
        self.groups = int(count.agg(F.sum("n")).first()[0] or 0)
        self.subroots = cut(ordered.withColumn("n", F.lit(self.groups).cast("bigint")))
        self.top = _fold_up(self.subroots.select("grp", "rank", "digest", "n"), self.groups)

    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        last = self.top[-1] if self.top else self.subroots
        return last.select("digest")

    def store(self) -> DataFrame:
        """(digest, children): the graph, each node once."""
        parts = [lv.select("digest", "children") for lv in [*self.levels, *self.top]]
        return functools.reduce(DataFrame.unionByName, parts).dropDuplicates(["digest"]) \
            if parts else self.subroots.select("digest", F.array().cast("array<string>").alias("children")).where("false")

    @staticmethod
    def _descend(frontier: DataFrame, store: DataFrame) -> DataFrame:
        """One step down: each request meets the record of its node's digest;
        the child of each digit goes on with the others as one more segment."""
        store = store.select(F.col("digest").alias("node"), "children")
        met = frontier.join(store, frontier["digest"] == store["node"])
        step = F.transform("children", lambda child, i: F.struct(
            child.alias("digest"), (F.col("rank") * FANOUT + i).alias("rank"),
            F.struct(i.alias("digit"), F.array_join(F.concat(
                F.slice("children", F.lit(1), i),
                F.slice("children", i + 2, F.lit(FANOUT))), "").alias("others")).alias("segment")))
        return met.select(*[c for c in frontier.columns if c not in ("digest", "rank", "path")],
                          "path", F.explode(step).alias("s")) \
            .select(*[c for c in frontier.columns if c not in ("digest", "rank", "path")],
                    "s.digest", "s.rank", F.concat("path", F.array("s.segment")).alias("path"))

    def proofs(self) -> DataFrame:
        """The carried columns of every leaf with grp, ``digest``, ``subroot``,
        ``root`` and ``path``: the segments (digit, others), nearest first."""
        none = "array<struct<digit:int,others:string>>"
        frontier = self.root().select("digest", F.lit(0).cast("bigint").alias("rank"),
                                      F.array().cast(none).alias("path"), F.col("digest").alias("root"))
        for lv in reversed(self.top):
            frontier = self._descend(frontier, lv.dropDuplicates(["digest"]))
        entry = frontier.join(self.subroots.select("rank", "name", "height"), "rank").select(
            F.col("name").alias("grp"), "height", F.col("digest").alias("subroot"), "root",
            "digest", F.lit(0).cast("bigint").alias("rank"), "path")
        entry = cut(entry)
        frontier = entry.where("false")
        for height in range(len(self.levels), 1, -1):
            frontier = frontier.unionByName(entry.where(F.col("height") == height))
            frontier = self._descend(frontier, self.levels[height - 1].dropDuplicates(["digest"]))
        # the lowest step: a group's leaves and the path to their node
        frontier = frontier.unionByName(entry.where("height <= 1"))
        met = _meet(self.leaves, frontier.drop("digest"), ["grp", "rank"]) \
            .withColumn("children", F.col("leaves.digest"))
        leaf = met.select("grp", "subroot", "root", "path", "children", "height",
                          F.posexplode("leaves").alias("digit", "leaf"))
        others = F.array_join(F.concat(F.slice("children", F.lit(1), F.col("digit")),
                                       F.slice("children", F.col("digit") + 2, F.lit(FANOUT))), "")
        last = F.when(F.col("height") > 0, F.array(F.struct("digit", others.alias("others")))) \
            .otherwise(F.array().cast(none))
        return leaf.select(*[f"leaf.{c}" for c in self.carried], "grp", "leaf.digest", "subroot", "root",
                           F.reverse(F.concat("path", last)).alias("path"))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings, nearest level first."""
    return F.sha2(F.array_join(path["others"], ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(digest: Column, segment: Column) -> Column:
        at = segment["digit"] * _WIDTH
        return F.sha2(F.concat(F.substr(segment["others"], F.lit(1), at), digest,
                               F.substr(segment["others"], at + 1, F.lit(FANOUT * _WIDTH))), 256)
    return F.aggregate(path, leaf, up)


def verify(docs: DataFrame, group: str, id_col: str, columns: list[str],
           altered: dict[str, Column], where: Column) -> DataFrame:
    """A row for each document: id_col, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` (from the columns as ``altered`` where
    ``where`` holds) and ``verified``."""
    rows = docs.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{id_col}`").alias("id"),
        digest_of([F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.when(where, digest_of([altered.get(c, F.col(f"`{c}`")) for c in columns])).alias("found"))
    got = Manifest(rows, ["id", "digest"]).proofs()
    got = got.withColumn("folded_root", fold(F.coalesce("found", "digest"), F.col("path")))
    return got.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
                      proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
