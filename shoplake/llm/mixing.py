"""Mixing sources to target weights: fixed-length blocks, drawn by output shard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import fresh, release, running
from shoplake.storage import materialize

#: A word: a run of characters other than U+0020 and U+0009-U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: No source is taken more often than this.
MOST = 3

#: Sources are planned on the driver; more are refused.
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    """One source's plan; ``slots`` blocks are taken, the last of them cut to ``last`` words."""

    name: str | None
    size: int
    target: float
    blocks: int
    slots: int
    last: int


def targets(sizes: list[int], weights: list[float], most: int = MOST) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its size.

    What a share exceeds its limit by goes to the others by weight, until none does.
    """
    total, open_, result = sum(sizes), [i for i, s in enumerate(sizes) if s], [0.0] * len(sizes)
    left = float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in over or open_:
            result[i] = float(most * sizes[i]) if over else weights[i] * unit
        if not over:
            break
        left -= sum(result[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return result


def permuted(position: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a keyed four-round network, walked until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in range(4):
            key = np.uint64((seed * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
            f = (right ^ key) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(31)) & mask)
        return (left << shift) | right

    x = once(np.asarray(position, dtype=np.uint64))
    while (outside := x >= n).any():
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def _seed(seed: int, source: int, epoch: int) -> int:
    return (int(seed) * 1_000_003 + int(source)) * 1_009 + int(epoch)


def plan(name: str | None, size: int, target: float, block: int) -> Source:
    """Whole passes over the source's blocks first, then blocks of one more pass up to the target."""
    words = min(round(target), MOST * size)
    blocks = -(-size // block)
    passes, rest = divmod(words, size) if size else (0, 0)
    more = -(-rest // block)
    return Source(name, size, target, blocks, passes * blocks + more, rest - (more - 1) * block if more else block)


def sources(rows: DataFrame, block: int) -> list[Source]:
    """The plan of each source (columns source, size of ``rows``), by code point, null last."""
    grouped = rows.groupBy("source").agg(F.sum("size").alias("size"))
    found = [(r["source"], int(r["size"] or 0)) for r in grouped.limit(MAX_SOURCES + 1).collect()]
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda f: (f[0] is None, f[0] or ""))
    sizes = [size for _, size in found]
    aims = targets(sizes, [1.0 + i % 3 for i in range(len(found))])
    return [plan(name, size, aim, block) for (name, size), aim in zip(found, aims)]


def _draw(docs: DataFrame, plans: list[Source], per_shard: int, seed: int) -> DataFrame:
    """Slots: shard, source number, ordinal of the draw within its source.

    Each output shard draws its source counts from a multinomial over the planned
    slots, seeded by its own number. Their sums miss the plan a little; a source's
    draws beyond its plan are handed, in order, to the sources that got too few.
    """
    spark = docs.sparkSession
    quota = np.array([p.slots for p in plans], dtype=np.int64)
    total = int(quota.sum())
    shares = quota / max(total, 1)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                drawn = np.random.default_rng([seed, int(shard)]).multinomial(min(per_shard, total - int(shard) * per_shard), shares)
                has = np.flatnonzero(drawn)
                yield pd.DataFrame({"shard": shard, "number": has, "drawn": drawn[has]})
        release()

    shards = -(-total // per_shard)
    drawn = spark.range(0, shards, 1, max(1, min(shards, 200))).mapInPandas(counts, "shard long, number int, drawn long")
    drawn = materialize(drawn, "draws")
    got = np.zeros(len(plans), dtype=np.int64)
    for r in drawn.groupBy("number").agg(F.sum("drawn").alias("n")).collect():
        got[r["number"]] = r["n"]
    over = np.maximum(got - quota, 0)
    under = np.maximum(quota - got, 0)
    over_base, under_ends = np.cumsum(over) - over, np.cumsum(under)
    under_base = under_ends - under

    def ordinals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, number, first, n in batch[["shard", "number", "first", "drawn"]].itertuples(index=False):
                for start in range(int(first), int(first + n), 1 << 16):
                    ordinal = np.arange(start, min(start + (1 << 16), int(first + n)))
                    to = np.full(len(ordinal), number)
                    extra = ordinal >= quota[number]
                    k = over_base[number] + ordinal[extra] - quota[number]
                    to[extra] = np.searchsorted(under_ends, k, side="right")
                    ordinal[extra] = got[to[extra]] + k - under_base[to[extra]]
                    yield pd.DataFrame({"shard": shard, "number": to, "ordinal": ordinal})
        release()

    placed = running(drawn, ["number"], ["shard"], F.col("drawn"), "first")
    return placed.mapInPandas(ordinals, "shard long, number int, ordinal long")


def mix(
    docs: DataFrame, size: Column, block: int = 512, per_shard: int = 1 << 16, seed: int = 7, row: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, source, ``size`` words) to the sources' target weights.

    Returns the documents (row, doc_id, source, size, source_size, target) and the
    mixture: one row per slot and document in it (shard, number of the source,
    ordinal, row, first_word, words, copy). Sources by code point, null last, weigh
    1, 2, 3, repeating. A source's texts, in hash order, are one run of words cut
    into blocks of ``block``. Slot ``ordinal`` of a source is block
    ``permutation(ordinal mod blocks)`` of pass ``ordinal div blocks`` (``copy``); a
    shorter tail block ends each pass, and the last slot is cut so that a source
    yields its rounded target exactly. No text is taken more than three times.

    Empty and null texts and empty sources take no part but keep their row; equal
    ids are separate rows; an empty table gives empty results. The same rows give
    the same mixture. ``row`` names numbers that the rows have already, each its
    own. Only the sources' sums (at most 100,000) reach the driver.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )
    rows = materialize(rows, "sizes")
    plans = sources(rows, block)
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(i, p.name, p.size, p.target) for i, p in enumerate(plans)],
        "number int, name string, source_size long, target double",
    )
    numbered = rows.join(F.broadcast(known), rows.source.eqNullSafe(known.name), "left").drop("name")
    numbered = materialize(numbered, "numbered")
    # Cut every document at the block borders it crosses.
    at = running(numbered.where("size > 0"), ["number"], ["doc_id", "row"], F.col("size"), "start")
    cut = at.select(
        "row", "number", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"),
    )
    low, high = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    pieces = cut.select(
        "row", "number", "block", (low - F.col("start")).alias("first_word"), (high - low).alias("words"),
        (low - F.col("block") * block).alias("offset"),
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (number, copy), part in batch.assign(
                copy=batch["ordinal"] // np.array([max(p.blocks, 1) for p in plans])[batch["number"]]
            ).groupby(["number", "copy"]):
                p = plans[number]
                ordinal = part["ordinal"].to_numpy()
                position, whole = ordinal - copy * p.blocks, p.size // block
                found = position.copy()
                if (inner := position < whole).any():
                    found[inner] = permuted(position[inner], whole, _seed(seed, number, copy))
                room = np.where(ordinal == p.slots - 1, p.last, block)
                yield pd.DataFrame({"shard": part["shard"], "number": number, "ordinal": ordinal, "copy": copy, "block": found, "room": room})
        release()

    slots = _draw(docs, plans, per_shard, seed).mapInPandas(
        place, "shard long, number int, ordinal long, copy int, block long, room long"
    )
    fits = F.least(F.col("words"), F.col("room") - F.col("offset"))
    mixture = slots.join(pieces, ["number", "block"]).withColumn("words", fits).where("words > 0")
    return numbered, mixture.drop("room", "offset", "block")


def taken(docs: DataFrame, **options) -> DataFrame:
    """Words that the mixture takes of each row: doc_id, size, source_size, target, taken."""
    numbered, mixture = mix(docs, F.regexp_count("text", F.lit(WORD)), **options)
    words = mixture.groupBy("row").agg(F.sum("words").alias("taken"))
    return numbered.join(words, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: a row of ``docs`` for each pass that takes words of it.

    ``text`` holds the words that the pass takes, with the white space between
    them; a text that is taken whole is unchanged. ``n_chars`` follows the text.
    Rows without words are not part of a mixture. Rows that share an id, null
    included, are mixed each by itself: the texts are stored once with row numbers.
    """
    row, mixed, spans = (fresh(docs, n) for n in ("row", "mixed", "spans"))
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mixed-texts")
    numbered, mixture = mix(stored, F.regexp_count("text", F.lit(WORD)), row=F.col(row), **options)
    passes = mixture.join(numbered.select("row", "size"), "row").groupBy(F.col("row").alias(mixed), "copy").agg(
        F.struct(
            F.sum("words").alias("took"),
            F.max("size").alias("of"),
            F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("parts"),
        ).alias(spans)
    )
    cut = F.pandas_udf(_cut, "string")
    met = stored.join(passes.drop("copy"), F.col(row) == F.col(mixed))
    text = F.when(F.col(spans)["took"] == F.col(spans)["of"], F.col("text")).otherwise(cut("text", F.col(spans)["parts"]))
    met = met.withColumn("text", text).select(*docs.columns)
    return met.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else met


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    result = []
    for whole, parts in zip(text, spans):
        at = [m.span() for m in re.finditer(WORD, whole or "")]
        kept: list[str] = []
        start, end = 0, None
        for part in parts:
            first, last = at[part["first_word"]][0], at[part["first_word"] + part["words"] - 1][1]
            # Neighbouring blocks keep the white space that stood between them.
            if kept and end == part["first_word"]:
                kept[-1] = whole[start:last]
            else:
                start = first
                kept.append(whole[first:last])
            end = part["first_word"] + part["words"]
        result.append("\n".join(kept))
    return pd.Series(result, dtype=object)
