"""Connected groups of similar rows, found inside nodes of rows that share a key.

Both near-duplicate operators put each row under several 64-bit paths such that similar
rows share one. This module links rows under a path without ever listing all pairs of a
large node:

- a node of at most `leaf` rows is compared exhaustively, by an equi-join on the path
  whose cheap condition `near` lets only likely pairs out;
- a larger node is compared with a few of its rows, the pivots, which are then done with
  and leave it. If its remaining rows already belong to one group, it has nothing more to
  say and is dropped: no new connection can come from it. Otherwise `finish`, if there is
  one, may link all rows of nodes that no split makes smaller; `branch` splits the others.

Rows that belong to one group are never compared again. Likely pairs are confirmed by
`verify`; each row's first pair is confirmed before the others, which mostly spares them.
Every pair names a `block`: some `leaf` rows of one node, and its pivots, whose pairs can be
confirmed together. Pairs of rows that `heavy` marks have a block of their own each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, label) of every id in `edges` (a, b) but the smallest of its component, the label.

    Alternating large and small stars: every id is tied to the smallest id next to it
    until each component is one star. Minima come from aggregates and are joined back, so
    that no neighbour list is ever collected and a hot id can be split by the join.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("id"), F.least("a", "b").alias("label")
    ).where("id <> label")
    now = None
    while True:
        # Large stars: larger neighbours go to the smallest neighbour of their centre.
        both = pairs.unionByName(pairs.select(F.col("label").alias("id"), F.col("id").alias("label")))
        least = both.groupBy("id").agg(F.min("label").alias("m"))
        least = least.select("id", F.least("id", "m").alias("m"))
        large = (
            both.join(least, "id")
            .where(F.col("label") > F.col("id"))
            .select(F.col("label").alias("id"), F.col("m").alias("label"))
            .distinct()
        )
        # Small stars: smaller neighbours and the centre go to the smallest of them.
        low = large.groupBy("id").agg(F.min("label").alias("m"))
        joined = large.join(low, "id")
        small = (
            joined.select(F.col("label").alias("id"), F.col("m").alias("label"))
            .where("id <> label")
            .unionByName(low.select("id", F.col("m").alias("label")))
            .distinct()
        )
        before, now = now, scratch.keep(small, "stars")
        if before is not None:
            scratch.drop(before)
        # Stars: every id has one label, and no label has one itself.
        ends = now.select(F.col("id").alias("x"), F.lit(1).alias("own"), F.lit(0).alias("is_label"))
        tops = now.select(F.col("label").alias("x"), F.lit(0).alias("own"), F.lit(1).alias("is_label"))
        seen = ends.unionByName(tops).groupBy("x").agg(F.sum("own").alias("own"), F.max("is_label").alias("is_label"))
        if seen.where("own > 1 or (own = 1 and is_label = 1)").isEmpty():
            return now
        pairs = now


def with_component(rows: DataFrame, stars: DataFrame | None) -> DataFrame:
    """`rows` with `comp`, the group's label, and `linked`, whether the group has others."""
    if stars is None:
        return rows.withColumns({"comp": F.col("id"), "linked": F.lit(False)})
    return (
        rows.join(stars, "id", "left")
        .withColumns({"comp": F.coalesce("label", "id"), "linked": F.col("label").isNotNull()})
        .drop("label")
    )


def _apart(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one group yet."""
    left = stars.select(F.col("id").alias("a"), F.col("label").alias("la"))
    right = stars.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    return (
        pairs.join(left, "a", "left")
        .join(right, "b", "left")
        .where(F.coalesce("la", "a") != F.coalesce("lb", "b"))
        .select("a", "b", "block")
    )


class Linker:
    """Links rows with columns `path` (BIGINT), `id` and whatever `near` and `branch` need.

    A path has an id once. `hopeless` are aggregates of a node's rows and a condition on them
    and `in_node` under which no pair of the node is near: its rows are left out unjoined.
    """

    def __init__(
        self,
        near: Callable[[str, str], F.Column],
        verify: Callable[[DataFrame], DataFrame],
        branch: Callable[[DataFrame, int], DataFrame],
        scratch: Scratch,
        leaf: int = 64,
        pivots: int = 16,
        finish: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
        heavy: Callable[[str], F.Column] = lambda side: F.lit(False),
        hopeless: tuple[list[F.Column], F.Column] | None = None,
    ):
        self.near, self.verify, self.branch = near, verify, branch
        self.scratch, self.leaf, self.pivots, self.finish = scratch, leaf, pivots, finish
        self.heavy, self.hopeless = heavy, hopeless
        self.stars: DataFrame | None = None

    def nodes(self, rows: DataFrame) -> DataFrame:
        """Rows of nodes that hold two groups or more, with the node's size."""
        known = with_component(rows, self.stars)
        two = [F.min(F.xxhash64("comp")).alias("c0"), F.max(F.xxhash64("comp")).alias("c1")]
        if self.stars is None:
            two = []  # every row is a group of its own
        aggregates, condition = self.hopeless or ([], F.lit(False))
        about = known.groupBy("path").agg(F.count("*").alias("in_node"), *two, *aggregates)
        about = about.where("c0 <> c1" if two else "in_node > 1").where(~condition).select("path", "in_node")
        return known.join(about, "path")

    def pairs(self, nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Likely pairs (a < b, block) of rows in different groups, and the pivots of large nodes."""
        def out(joined: DataFrame, block: F.Column) -> DataFrame:
            ends = [F.col("l.id"), F.col("r.id")]
            alone = F.when(self.heavy("l") | self.heavy("r"), F.xxhash64(F.least(*ends), F.greatest(*ends)))
            return joined.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"), F.coalesce(alone, block).alias("block"))

        def once(pairs: DataFrame) -> DataFrame:
            return pairs.groupBy("a", "b").agg(F.min("block").alias("block"))

        small = nodes.where(F.col("in_node") <= self.leaf)
        apart = (F.col("l.path") == F.col("r.path")) & (F.col("l.comp") != F.col("r.comp"))
        on = apart & (F.col("l.id") < F.col("r.id")) & self.near("l", "r")
        found = out(small.alias("l").join(small.alias("r"), on), F.col("l.path"))
        # A row not linked to any other yet comes first; ties in an order of the path's own.
        rank = F.struct("linked", F.xxhash64("path", "id"))
        whole = F.struct(*[c for c in nodes.columns if c not in ("linked", "in_node")])
        pivots = (
            nodes.where(F.col("in_node") > self.leaf)
            .groupBy("path", F.pmod(F.xxhash64("id"), F.lit(self.pivots)).alias("slot"))
            .agg(F.min_by(whole, rank).alias("p"))
            .select("p.*")
        )
        pivots = self.scratch.keep(pivots, "pivots")
        if pivots.isEmpty():
            return once(found), None
        large = nodes.where(F.col("in_node") > self.leaf)
        met = large.alias("l").join(pivots.alias("r"), apart & self.near("l", "r"))
        slot = F.pmod(F.xxhash64("l.id"), F.ceil(F.col("l.in_node") / self.leaf))
        return once(found.unionByName(out(met, F.xxhash64("l.path", slot)))), pivots

    def link(self, pairs: DataFrame) -> None:
        """Confirm pairs and merge their groups."""
        self.tie(self.scratch.keep(self.verify(pairs), "edges"))

    def tie(self, edges: DataFrame) -> None:
        """Merge the groups of confirmed pairs."""
        if edges.isEmpty():
            return
        if self.stars is not None:
            edges = edges.unionByName(self.stars.select(F.col("id").alias("a"), F.col("label").alias("b")))
        self.stars = components(edges, self.scratch)

    def merge(self, pairs: DataFrame, level: int) -> None:
        """Confirm pairs; at first each row's first one, then those that still join two groups."""
        if pairs.isEmpty():
            return
        if level == 0:
            self.link(pairs.groupBy("b").agg(F.min(F.struct("a", "block")).alias("p")).select("p.a", "b", "p.block"))
            if self.stars is not None:
                pairs = self.scratch.keep(_apart(pairs, self.stars), "apart")
                if pairs.isEmpty():
                    return
        self.link(pairs)

    def run(self, rows: DataFrame, prepare: Callable[[DataFrame, DataFrame], None] | None = None) -> DataFrame | None:
        """(id, label) stars of all groups of two and more, or None if there are none.

        `prepare` gets the first likely pairs and the first large nodes, before any
        pair is confirmed: no other row will be asked for later.
        """
        level = 0
        while True:
            nodes = self.scratch.keep(self.nodes(rows), "nodes")
            found, pivots = self.pairs(nodes)
            found = self.scratch.keep(found, "pairs")
            large = nodes.where(F.col("in_node") > self.leaf)
            if prepare is not None and level == 0:
                prepare(found, large)
            self.merge(found, level)
            if pivots is None:
                return self.stars
            left = large.drop("comp", "linked", "in_node").join(
                pivots.select("path", "id"), ["path", "id"], "left_anti"
            )
            # Only nodes that still hold two groups are split.
            open_rows = self.scratch.keep(self.nodes(left), "open")
            if self.finish is not None and not open_rows.isEmpty():
                open_rows, edges = self.finish(open_rows)
                self.tie(edges)
            if open_rows.isEmpty():
                return self.stars
            level += 1
            rows = self.branch(open_rows.drop("comp", "linked", "in_node"), level)
