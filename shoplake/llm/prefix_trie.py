"""Trie of conversation prefixes, kept as a compacted z-fast trie.

A prefix is known by its depth and a digest: the exclusive or, over its turns, of 120
bits of the MD5 of position, role and text. So digests of all prefixes of a conversation
are running totals, and equal prefixes have equal digests wherever they stand.

The compacted trie has a node for each prefix that branches or ends a conversation.
Columns of its table: ``lo`` and ``hi`` (depths of the parent and of the node), ``a`` and
``b`` (digest at hi), ``pa`` and ``pb`` (at lo), ``ca`` and ``cb`` (at lo + 1, which tells
a node from its siblings), ``hd``, ``ha`` and ``hb`` (the handle: depth and digest at the
two-fattest number in (lo, hi]) and ``rep``, a conversation that begins with the prefix.

Conversations go in by batches. Fat binary search over the handles finds each one's exit
node in as many lookups as its length has binary digits; only the turns beyond are
grouped, together with the edges they leave, to find the new nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.ordering import numbered
from shoplake.storage import materialize

#: Turns, or ids, that are handled at once within a conversation, edge or group.
CHUNK = 4096

#: Parts of 16 of the conversations that are in the trie after each batch.
BATCHES = (1, 4, 16)

NODE = ["depth", "a", "b"]


def _lane(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """A row per conversation and depth: digest, digest one turn up (``pa``, ``pb``), words and words up to here.

    ``turns`` has conv_id, pos (from 1, gapless), role and text. Totals run within
    chunks of a conversation; only one row per full chunk is added up in sequence.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sized = F.concat_ws(":", F.col("pos").cast("string"), F.length(role).cast("string"), role, text)
    digest = F.md5(sized.cast("binary"))
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        F.col("pos").cast("long").alias("depth"),
        _lane(digest, 1).alias("za"),
        _lane(digest, 17).alias("zb"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"),
    )
    sofar = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = materialize(
        rows.select(
            "*",
            F.bit_xor("za").over(sofar).alias("a"),
            F.bit_xor("zb").over(sofar).alias("b"),
            F.sum("words").over(sofar).alias("upto"),
        ),
        "chunk-prefixes",
    )
    chunks = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    before = rows.where(F.col("depth") % CHUNK == 0).select(
        "conv",
        (F.col("chunk") + 1).alias("chunk"),
        F.bit_xor("a").over(chunks).alias("xa"),
        F.bit_xor("b").over(chunks).alias("xb"),
        F.sum("upto").over(chunks).alias("xw"),
    )
    zero = F.lit(0).cast("long")
    met = rows.join(before, ["conv", "chunk"], "left").withColumns(
        {
            "a": F.col("a").bitwiseXOR(F.coalesce("xa", zero)),
            "b": F.col("b").bitwiseXOR(F.coalesce("xb", zero)),
            "upto": F.col("upto") + F.coalesce("xw", zero),
        }
    )
    return met.select(
        "conv",
        "depth",
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("za")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("zb")).alias("pb"),
        "words",
        "upto",
    )


def _fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with the most trailing zero bits."""
    bits = (F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _spread(edges: DataFrame) -> DataFrame:
    """``edges`` with a row for each ``depth`` from lo + 1 to hi."""
    starts = edges.withColumn("_from", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"), F.lit(CHUNK).cast("long"))))
    return starts.withColumn(
        "depth", F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK - 1, F.col("hi"))))
    ).drop("_from")


def _at(paths: DataFrame, **columns: str) -> DataFrame:
    """Chosen columns of the path rows under other names, keyed by ``rep`` and ``depth``."""
    return paths.select(F.col("conv").alias("rep"), "depth", *[F.col(c).alias(k) for k, c in columns.items()])


def exits(trie: DataFrame, paths: DataFrame, ends: DataFrame) -> DataFrame:
    """Fat binary search: the depth ``l`` of the deepest node above each conversation of ``ends`` (conv, n).

    A handle that is found moves the lower end to its node's depth, one that is missing
    moves the upper end below the handle. The node found last is compared in full: where the
    conversation leaves it before its end, its parent is the answer. Conversations that
    have finished look up a handle of depth -1, which none has.
    """
    handles = trie.select("hd", "ha", "hb", "lo", "hi", F.col("a").alias("ea"), F.col("b").alias("eb"))
    zero = F.lit(0).cast("long")
    state = ends.select("conv", zero.alias("l"), F.col("n").alias("r"), *[zero.alias(c) for c in ("clo", "chi", "ca", "cb")])
    most = ends.agg(F.max("n")).first()[0] or 0
    digests = paths.select("conv", F.col("depth").alias("f"), F.col("a").alias("fa"), F.col("b").alias("fb"))
    for _ in range(int(most).bit_length()):
        fat = F.when(F.col("l") < F.col("r"), _fattest(F.col("l"), F.col("r"))).otherwise(F.lit(-1).cast("long"))
        asked = state.withColumn("f", fat).join(digests, ["conv", "f"], "left")
        asked = asked.withColumns({c: F.coalesce(c, "conv") for c in ("fa", "fb")})
        on = (F.col("f") == F.col("hd")) & (F.col("fa") == F.col("ha")) & (F.col("fb") == F.col("hb"))
        met, hit = asked.join(handles, on, "left"), F.col("hd").isNotNull()
        state = met.select(
            "conv",
            F.when(hit, F.col("hi")).otherwise(F.col("l")).alias("l"),
            F.when(hit | (F.col("f") < 0), F.col("r")).otherwise(F.col("f") - 1).alias("r"),
            *[F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old) for old, new in (("clo", "lo"), ("chi", "hi"), ("ca", "ea"), ("cb", "eb"))],
        )
    last = state.join(digests.withColumnRenamed("f", "chi"), ["conv", "chi"], "left")
    whole = (F.col("fa") == F.col("ca")) & (F.col("fb") == F.col("cb"))
    return last.select("conv", F.when((F.col("chi") == 0) | whole, F.col("chi")).otherwise(F.col("clo")).alias("l"))


def inserted(trie: DataFrame | None, paths: DataFrame, batch: Column) -> DataFrame:
    """The compacted trie after the conversations of ``batch``."""
    rows = paths.where(batch)
    columns = ["conv", "l", *NODE, "pa", "pb", "stop"]
    if trie is None:
        zero = F.lit(0).cast("long")
        new = rows.select("*", zero.alias("l"), (F.col("depth") == F.col("n")).alias("stop")).select(*columns)
    else:
        ends = rows.where("depth = n").select("conv", "n")
        left = materialize(exits(trie, paths, ends), "trie-exits")
        beyond = rows.join(left, "conv").where("depth > l")
        beyond = materialize(beyond.select("*", (F.col("depth") == F.col("n")).alias("stop")).select(*columns), "trie-beyond")
        # Where a conversation goes on into an edge, the edge's own turns take part.
        into = beyond.where("depth = l + 1").select(F.col("l").alias("lo"), F.col("a").alias("ca"), F.col("b").alias("cb"))
        edges = materialize(trie.join(into.distinct(), ["lo", "ca", "cb"]), "trie-edges")
        of_edge = _spread(edges.select("lo", "hi", "rep")).join(_at(paths, a="a", b="b", pa="pa", pb="pb"), ["rep", "depth"])
        old = of_edge.select(
            F.col("rep").alias("conv"), F.col("lo").alias("l"), *NODE, "pa", "pb", (F.col("depth") == F.col("hi")).alias("stop")
        )
        new = materialize(beyond.unionByName(old), "trie-rows")
    nodes = new.groupBy(*NODE).agg(
        F.min("conv").alias("rep"), F.bool_or("stop").alias("stop"), F.first("pa").alias("pa"), F.first("pb").alias("pb")
    )
    nodes = materialize(nodes, "trie-new")
    above = nodes.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    kids = above.groupBy(*NODE).agg(F.count("*").alias("kids"))
    marked = nodes.join(kids, NODE, "left").where("stop or kids > 1").select(*NODE, "rep")
    marked = materialize(marked, "trie-marked")
    along = Window.partitionBy("conv", "l").orderBy("depth")
    made = (
        new.join(marked, NODE)
        .withColumn("lo", F.coalesce(F.lag("depth").over(along), "l"))
        .where("conv = rep")
        .select("lo", F.col("depth").alias("hi"), "a", "b", "rep")
        .withColumn("hd", _fattest(F.col("lo"), F.col("hi")))
        .join(_at(paths, ha="a", hb="b").withColumnRenamed("depth", "hd"), ["rep", "hd"])
        .withColumn("depth", F.col("lo") + 1)
        .join(_at(paths, ca="a", cb="b", pa="pa", pb="pb"), ["rep", "depth"])
        .drop("depth")
    )
    if trie is not None:
        gone = edges.select("hi", "a", "b")
        made = made.unionByName(trie.join(gone, ["hi", "a", "b"], "left_anti"))
    return materialize(made, "trie")


def id_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of each class's conversation ids: ``members`` (rep, conv) to rep, ends_sha256.

    Ids ascend by number and are joined by commas, in chunks of many tasks. A digest needs
    its bytes in sequence, so the chunks of a class pass one task, one after the other, and
    none but the current one is held.
    """
    placed = numbered(members, ["rep"], ["conv"], "at", "size")
    texts = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = placed.groupBy("rep", F.floor(F.col("at") / CHUNK).alias("chunk")).agg(texts.alias("ids"))
    ordered = chunks.repartition("rep").sortWithinPartitions("rep", "chunk")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, None
        for batch in batches:
            done = []
            for rep, ids in zip(batch.column("rep").to_pylist(), batch.column("ids")):
                if rep == current:
                    running.update(b",")
                else:
                    if running:
                        done.append((current, running.hexdigest()))
                    current, running = rep, hashlib.sha256()
                running.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], ["rep", "ends_sha256"])
        if running:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([running.hexdigest()])], ["rep", "ends_sha256"])

    return ordered.mapInArrow(digest, "rep long, ends_sha256 string")


def compacted(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Compacted trie, path rows of the distinct conversations, these (``rep`` the least id), and all members' ``rep``."""
    zero = F.lit(0).cast("long")
    every = materialize(prefixes(turns), "prefixes")
    ends = every.groupBy("conv").agg(F.max(F.struct("depth", "a", "b", "upto")).alias("e")).select("conv", "e.*")
    whole = members.select(F.col("conv_id").alias("conv")).join(ends, "conv", "left")
    whole = materialize(whole.select("conv", *[F.coalesce(c, zero).alias(c) for c in (*NODE, "upto")]), "conversations")
    classes = whole.groupBy(*NODE).agg(F.min("conv").alias("rep"), F.count("*").alias("weight"), F.first("upto").alias("total"))
    classes = materialize(classes.withColumnRenamed("depth", "n"), "classes")
    of_rep = classes.select(F.col("rep").alias("conv"), "n", "weight", "total")
    paths = materialize(every.join(of_rep, "conv"), "paths")
    trie, lower = None, 0
    slot = F.pmod(F.xxhash64("conv"), F.lit(BATCHES[-1]))
    for upper in BATCHES:
        trie = inserted(trie, paths, (slot >= lower) & (slot < upper))
        lower = upper
    held = whole.join(classes.select(F.col("n").alias("depth"), "a", "b", "rep"), NODE).select("rep", "conv")
    return trie, paths, classes, held


def trie_nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of a conversation, the textless root included.

    ``turns``: conv_id (long), pos (from 1, gapless), role, text; a null role or text
    equals an empty one. ``members``: conv_id of every conversation, once each, also
    without turns. No members, no rows. Copies of a conversation are one path with a
    weight. Other columns are not read.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (ids of the members that end here).

    A node's members share its edge, so sums over them are taken once per compacted node
    and carried along the edge by running words: of the words below a depth every member
    counts its own, less the words that it is first, by id, to bring into the trie.
    """
    trie, paths, classes, held = compacted(turns, members)
    zero = F.lit(0).cast("long")
    bottoms = trie.select(F.col("hi").alias("depth"), "a", "b")
    visits = paths.select("conv", *NODE, "n", "weight", "total", "upto").join(bottoms, NODE)
    visits = materialize(visits, "visits")
    least = materialize(visits.groupBy(*NODE).agg(F.min("conv").alias("least")), "least-visitors")
    # Words of the part of a path that a conversation of smaller id has too.
    common = F.max(F.when(F.col("least") < F.col("conv"), F.col("upto")))
    shared = visits.join(least, NODE).groupBy("conv").agg(F.coalesce(common, zero).alias("shared"))
    below = trie.groupBy(F.col("lo").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("kids"))
    ended = classes.withColumnRenamed("n", "depth").join(below, NODE, "left")
    own = ended.select(F.col("rep").alias("conv"), F.col("kids").isNull().cast("long").alias("leaf"), "weight", "total")
    own = materialize(own.join(shared, "conv", "left").withColumn("shared", F.coalesce("shared", zero)), "own")
    seen = visits.select("conv", *NODE).unionByName(own.select("conv", *[zero.alias(c) for c in NODE]))
    stats = (
        seen.join(own, "conv")
        .groupBy(*NODE)
        .agg(
            F.min(F.struct("conv", "shared")).alias("first"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.col("weight") * F.col("total") - F.col("total") + F.col("shared")).alias("words"),
        )
        .select(*NODE, F.col("first.conv").alias("conv_id"), "n_convs", "n_leaves", (F.col("words") - F.col("first.shared")).alias("base"))
    )
    stats = materialize(stats, "trie-stats")
    ids = id_digests(held)
    ending = classes.select(F.col("n").alias("depth"), "a", "b", "rep").join(ids, "rep").drop("rep")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    full = stats.join(below, NODE, "left").join(ending, NODE, "left")
    full = full.withColumns({"kids": F.coalesce("kids", zero), "ends_sha256": F.coalesce("ends_sha256", nothing)})
    full = materialize(full, "trie-bottoms")
    root = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    parents = full.select(F.col("depth").alias("lo"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("above"))
    edges = trie.select("lo", "hi", "a", "b", "pa", "pb", "rep").join(full.withColumnRenamed("depth", "hi"), ["hi", "a", "b"])
    spread = _spread(edges.join(parents, ["lo", "pa", "pb"])).join(_at(paths, upto="upto", last="words"), ["rep", "depth"])
    bottom = F.col("depth") == F.col("hi")
    inner = spread.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("lo") + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(bottom, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("base") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("last"))).alias("saved_tokens"),
        F.when(bottom, F.col("ends_sha256")).otherwise(nothing).alias("ends_sha256"),
    )
    top = root.withColumnsRenamed({"kids": "n_children", "base": "saved_tokens"})
    return inner.unionByName(top.select(*inner.columns))
