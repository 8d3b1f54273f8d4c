"""Merkle manifest of a table: checkpointed levels, proofs by recomputing the others.

A document is a leaf. Each source has a tree of its leaves by doc_id, and the sources'
roots are the leaves of a top tree. Every node covers up to 16 of the level below.

Only every other level is stored (``every``), as blocks: a block is an aligned subtree,
the up to 256 stored nodes below one node of the next stored level. To extract proofs
each block makes its missing interior nodes again, adds their siblings to the proof of
each of its nodes and drops them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.ordering import meet, numbered
from shoplake.storage import materialize

FAN = 16

#: Levels from one stored level to the next.
EVERY = 2

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(text: Column) -> Column:
    """SHA-256 of all fields, each with its length, ``text`` in place of the column of that name."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _at_level(n: Column, steps: int) -> Column:
    """How many of ``n`` nodes remain some levels up."""
    return F.ceil(n / F.lit(FAN**steps))


def _parents(digests: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda k: F.sha2(F.array_join(F.slice(digests, k * FAN + 1, FAN), ""), 256))


def _regenerated(blocks: DataFrame, every: int) -> DataFrame:
    """``blocks`` with the digests of each level inside, ``_d0`` (stored) up to the block's root."""
    out = blocks.withColumn("_d0", F.col("nodes.digest"))
    for j in range(every):
        below = F.col(f"_d{j}")
        out = out.withColumn(f"_d{j + 1}", F.when(_at_level(F.col("n"), j) > 1, _parents(below)).otherwise(below))
    return out


@dataclass(frozen=True)
class Tree:
    """Trees of one kind, told apart by ``keys``: stored levels as blocks, and their roots.

    A block holds ``n`` (nodes of its tree at this level), ``block`` (its number) and
    ``nodes`` (digest and payload ``what`` of each, in order).
    """

    keys: list[str]
    every: int
    levels: list[DataFrame]
    roots: DataFrame

    @staticmethod
    def build(nodes: DataFrame, keys: list[str], every: int) -> Tree:
        """``nodes``: keys, ``at`` (from 0 in each tree), ``n``, ``digest``, ``what``."""
        levels, roots, width = [], [], FAN**every
        while True:
            node = F.struct("at", "digest", *(["what"] if not levels else []))
            grouped = nodes.groupBy(*keys, "n", F.floor(F.col("at") / width).alias("block"))
            blocks = materialize(grouped.agg(F.sort_array(F.collect_list(node)).alias("nodes")), "tree-blocks")
            levels.append(blocks)
            above = _regenerated(blocks, every).select(
                *keys,
                _at_level(F.col("n"), every).alias("n"),
                F.col("block").alias("at"),
                F.col(f"_d{every}")[0].alias("digest"),
            )
            above = materialize(above, "tree-nodes")
            roots.append(above.where("n = 1").select(*keys, "digest"))
            nodes = above.where("n > 1")
            if nodes.isEmpty():
                break
        found = roots[0]
        for more in roots[1:]:
            found = found.unionByName(more)
        return Tree(keys, every, levels, found)

    def paths(self, tops: DataFrame) -> DataFrame:
        """The way up from each leaf: keys, ``what``, ``digest``, ``path``, and further columns of ``tops``.

        ``tops`` has the keys and the ``path`` from each tree's root on. A path is a list of runs
        from the leaf up: ``run`` has the digests of a whole run, ``at`` the node's place in it.
        """
        carried = [c for c in tops.columns if c not in self.keys]
        width, upper = FAN**self.every, None
        for blocks in reversed(self.levels):
            # Trees that end with this block go on at the top, the others at the level above.
            last, inner = blocks.where(F.col("n") <= width), blocks.where(F.col("n") > width)
            placed = meet(last, tops, self.keys)
            if upper is not None:
                placed = placed.unionByName(meet(inner, upper.withColumnRenamed("at", "block"), [*self.keys, "block"]))
            spread = _regenerated(placed, self.every).select(
                "*", F.posexplode("nodes").alias("_pos", "_node")
            )
            steps = []
            for j in range(self.every):
                start = F.floor(F.col("_pos") / FAN ** (j + 1)).cast("int") * FAN + 1
                step = F.struct(
                    (F.floor(F.col("_pos") / FAN**j) % FAN).cast("int").alias("at"),
                    F.slice(f"_d{j}", start, FAN).alias("run"),
                )
                steps.append(F.when(_at_level(F.col("n"), j) > 1, step))
            path = F.concat(F.array_compact(F.array(*steps)), "path").alias("path")
            carry = [path if c == "path" else F.col(c) for c in carried]
            if blocks is self.levels[0]:
                return spread.select(*self.keys, "_node.what", "_node.digest", *carry)
            upper = materialize(spread.select(*self.keys, "_node.at", *carry), "tree-paths")
        raise AssertionError("a tree has a level")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its path."""

    def up(node: Column, step: Column) -> Column:
        run = F.transform(step["run"], lambda x, i: F.when(i == step["at"], node).otherwise(x))
        return F.sha2(F.array_join(run, ""), 256)

    return F.aggregate(path, leaf, up)


def siblings(path: Column) -> Column:
    """The proof: all digests beside the way up, from the leaf's run to the root's."""
    return F.flatten(F.transform(path, lambda s: F.filter(s["run"], lambda _, i: i != s["at"])))


@dataclass(frozen=True)
class Manifest:
    """Trees of all sources and the tree of their roots; ``what`` of a leaf holds its row."""

    sources: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row with the ``digest`` of the whole table; none if the table is empty."""
        return self.top.roots

    def proofs(self) -> DataFrame:
        """One row per document: ``what``, ``digest`` (leaf), ``path``, ``subroot``, ``root``."""
        end = F.array().cast("array<struct<at:int,run:array<string>>>").alias("path")
        root = materialize(self.top.roots.select("tree", end, F.col("digest").alias("root")), "tree-tops")
        tops = self.top.paths(root).select("what.source", F.col("digest").alias("subroot"), "path", "root")
        return self.sources.paths(materialize(tops, "tree-tops"))


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, every: int = EVERY) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text; other columns are not read).

    A null field counts as ``-``, any other as its UTF-8 length, ``:`` and value, so null and
    empty differ. Leaves ascend by doc_id within a source, null first; rows that repeat a
    doc_id follow their digests, and equal rows are leaves of their own. Sources ascend by
    their bytes, null first. An empty table has no nodes. ``extra`` adds columns to ``what``.

    Texts are read once; only digests are sorted and grouped, 16 ** ``every`` to a block, by
    their place in the source, so a source of any size is spread over tasks.
    """
    kept = {"doc_id": F.col("doc_id"), **(extra or {})}
    leaves = docs.select(
        F.col("source").cast("string").alias("source"),
        F.struct(*[c.alias(k) for k, c in kept.items()]).alias("what"),
        leaf_digest(F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").alias("by"),
    )
    placed = numbered(materialize(leaves, "leaves"), ["source"], ["by", "digest", "row"], "at", "n")
    sources = Tree.build(placed.select("source", "at", "n", "digest", "what"), ["source"], every)
    of_source = F.struct("source").alias("what")
    roots = sources.roots.select(F.lit(0).alias("tree"), of_source, "digest", F.col("source").alias("by"))
    placed = numbered(materialize(roots, "subroots"), ["tree"], ["by"], "at", "n")
    return Manifest(sources, Tree.build(placed.drop("by"), ["tree"], every))
