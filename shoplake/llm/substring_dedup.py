"""Substring deduplication: lines, sentences or paragraphs that occur again are taken out."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import attach, screened, slices
from shoplake.storage import materialize

#: What ends a unit. Sentences are units inside lines, which are units too.
UNIT_ENDS = {"line": re.compile(r"\n"), "sentence": re.compile(r"\n"), "paragraph": re.compile(r"\n[^\S\n]*\n\s*")}

#: What ends a sentence inside a line.
SENTENCE_ENDS = re.compile(r"(?<=[.!?\u2026])[^\S\n]+|(?<=[\u3002\uff01\uff1f])[^\S\n]*")

#: Neighbouring repeated sentences are taken out from so many characters on.
LEAST = 50

_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def normalised(unit: str) -> str:
    """A-Z lower-cased, runs of white space as one space, none at the ends."""
    return _SPACE.sub(" ", unit.encode(errors="surrogatepass").lower().decode(errors="surrogatepass")).strip(" ")


def spans(text: str, ends: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and end of every unit in the text, without what ends it."""
    start = 0
    for m in ends.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def units(docs: DataFrame, unit: str) -> DataFrame:
    """Units with content: doc_id, body (digest of the whole text), start, stop, nth, digest.

    ``nth`` counts the sentences of a text, with a gap between lines; it is -1 for
    other units. A line that is one sentence is a line only.
    """
    ends = UNIT_ENDS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                body = _body(text)
                for start, stop, nth in _places(text, ends, unit == "sentence"):
                    if norm := normalised(text[start:stop]):
                        row = doc_id, body, start, stop, nth, hashlib.blake2b(norm.encode(), digest_size=16).digest()
                        for column, value in zip(found, row):
                            column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(found, kinds)], ["doc_id", "body", "start", "stop", "nth", "digest"]
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, body long, start int, stop int, nth int, digest binary")


def _places(text: str, ends: re.Pattern, sentences: bool) -> Iterator[tuple[int, int, int]]:
    """Start, stop and nth of every unit; a line's sentences follow it."""
    nth = 0
    for start, stop in spans(text, ends):
        yield start, stop, -1
        if sentences:
            inner = [(start + a, start + b) for a, b in spans(text[start:stop], SENTENCE_ENDS)]
            inner = [(a, b) for a, b in inner if text[a:b].strip()]
            for a, b in inner if len(inner) > 1 else ():
                yield a, b, nth
                nth += 1
            nth += 1


def _chosen(start: list[int], stop: list[int], nth: list[int], least: int) -> list[int]:
    """Which repeated units of a text (in order, a line before its sentences) are taken out.

    Lines are; sentences outside of these when with the repeated ones next to them
    they have ``least`` characters, and so is a line (nth -2) that only a sentence repeats.
    """
    chosen: list[int] = []
    run: list[int] = []
    upto = size = 0
    for i, (a, b, n) in enumerate(zip(start, stop, nth)):
        if n < 0:
            if n == -1 or b - a >= least:
                chosen.append(i)
                upto = b
        elif a >= upto:
            if run and n != nth[run[-1]] + 1:
                chosen.extend(run if size >= least else ())
                run, size = [], 0
            run.append(i)
            size += b - a
    chosen.extend(run if size >= least else ())
    return sorted(chosen)


def _choice(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The texts of a batch with those of their repeated units that are taken out, if any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = batch.column("removed")
            values, offsets = removed.values, removed.offsets.to_pylist()
            start, stop, nth = (values.field(f).to_pylist() for f in ("start", "stop", "nth"))
            found = [[a + i for i in _chosen(start[a:b], stop[a:b], nth[a:b], least)] for a, b in zip(offsets, offsets[1:])]
            taken = values.take(pa.array([i for f in found for i in f], pa.int64()))
            names = ["start", "stop", "kept_id", "kept_start"]
            units = pa.StructArray.from_arrays([taken.field(n) for n in names], names)
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            kept = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), pa.ListArray.from_arrays(ends, units)], ["doc_id", "body", "removed"]
            )
            yield kept.filter(pa.array([bool(f) for f in found], pa.bool_()))

    return run


def _body(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def substring_dedup(docs: DataFrame, unit: str = "line", least: int = LEAST) -> DataFrame:
    """Take out repeated lines (or paragraphs, or lines and sentences): doc_id, text, removed, n_removed.

    Units are equal when they are so after `normalised`; units without content are
    left alone. Of equal units in the whole table the earliest stays, by doc_id (null
    first), then by place; the others are removed with the line end after them.
    ``removed`` lists their places in the original text in order: start, stop, and
    the document that keeps the unit, kept_id, with its kept_start. Offsets count
    characters.

    With the unit ``sentence``, lines are units and so are the sentences of longer
    lines, so that a passage inside lines is found by its whole sentences. Repeated
    sentences next to each other in a line are taken out, with the white space after
    them, if they have ``least`` characters together: short ones alone are common
    prose.

    A null text stays null and an empty one empty. Rows of equal id and text are the
    same document: each gets the same result. Every unit is hashed; digests are
    grouped with partial sums, and a digest of very many units is met by broadcast,
    so no task gathers its places. Other columns are not read.
    """
    found = materialize(units(docs, unit), "units")
    place = F.struct("doc_id", "start", "body")
    groups = found.groupBy("digest").agg(
        F.min(place).alias("first"),
        F.min(F.when(F.col("nth") < 0, place)).alias("line"),  # which only a sentence can precede
        F.count(F.lit(1)).alias("n"),
    ).where("n > 1")
    groups = materialize(groups, "repeated")
    keyed = found.withColumn("_key", F.xxhash64("digest"))
    maybe, _ = screened(keyed, "_key", groups.select(F.xxhash64("digest").alias("_wanted")))
    maybe = materialize(maybe.drop("_key"), "maybe-repeated")
    again = attach(maybe, groups, "digest", "n", "inner").where(place != F.col("first"))
    nth = F.when((F.col("nth") < 0) & (place == F.col("line")), -2).otherwise(F.col("nth")).alias("nth")
    # By place, and a line before its first sentence.
    fields = F.struct("start", nth, "stop", F.col("first.doc_id").alias("kept_id"), F.col("first.start").alias("kept_start"))
    lists = again.groupBy("doc_id", "body").agg(F.sort_array(F.collect_set(fields)).alias("removed"))
    lists = lists.mapInArrow(_choice(least), "doc_id long, body long, removed array<struct<start: int, stop: int, kept_id: long, kept_start: int>>")
    ends = UNIT_ENDS[unit]

    none = F.array().cast(lists.schema["removed"].dataType)
    body = F.pandas_udf(lambda text: pd.Series([_body(t or "") for t in text], dtype="int64"), "long")
    cut = F.pandas_udf(lambda text, removed: pd.Series([_without(t, r, ends, unit == "sentence") for t, r in zip(text, removed)], dtype=object), "string")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_id = lists.groupBy(F.col("doc_id").alias("_id")).agg(F.map_from_entries(F.collect_list(F.struct("body", "removed"))).alias("by_body"))
    met = whole.join(by_id, whole.doc_id.eqNullSafe(by_id["_id"]), "left")
    met = met.withColumn("removed", F.coalesce(F.col("by_body")[body("text")], none))
    return met.select("doc_id", cut("text", "removed").alias("text"), "removed", F.size("removed").alias("n_removed"))


def _without(text: str | None, removed: list, ends: re.Pattern, sentences: bool = False) -> str | None:
    if not len(removed):
        return text
    kept, at = [], 0
    for r in removed:
        kept.append(text[at : r["start"]])
        end = ends.match(text, r["stop"])
        if sentences and (not end or (r["start"] > 0 and text[r["start"] - 1] != "\n")):  # not a line: its end stays
            end = re.compile(r"[^\S\n]+").match(text, r["stop"])
        at = end.end() if end else r["stop"]
    kept.append(text[at:])
    return "".join(kept)
