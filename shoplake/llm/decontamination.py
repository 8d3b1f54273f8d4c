"""Benchmark decontamination: an FM-index of each training shard, searched for all benchmark windows.

A word is a run of ASCII digits, ASCII letters and characters from U+0080 on, A-Z
lower-cased. A window is ``width`` consecutive words of an item; an item of fewer
words is one window. A shard is a batch of whole texts of some MB in one task. Its words are
coded by the benchmark's vocabulary; words outside it end a run, since no window can cross
them, and runs shorter than the shortest window are left out of the index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import running, slices
from shoplake.llm.fm_index import FmIndex
from shoplake.storage import materialize

WIDTH = 10

#: Benchmark text that is sent to the tasks at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 4 << 20

#: Words in a piece of an item.
PIECE_WORDS = 20_000

#: Occurrences that are turned into documents and items at once.
STEP = 1 << 20

# Word bytes as they are or lower-cased, all others as a space.
_FOLDED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))

SPAN = "struct<first:long,stop:long,start:long,end:long>"
FOUND = f"n_words long, n_hit long, removed array<{SPAN}>, items array<string>"


@dataclass(frozen=True)
class Words:
    """Words of some texts: values, first and last byte (in their text), and each text's first word."""

    values: pa.Array
    start: np.ndarray
    end: np.ndarray
    upto: np.ndarray


def split(text: pa.Array) -> Words:
    """The words of each text; null has none."""
    text = pc.fill_null(text.cast(pa.string()), "")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    raw = bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data else b""
    folded = np.frombuffer(raw.translate(_FOLDED), dtype=np.uint8)
    offsets = offsets - offsets[0]
    inside = np.zeros(len(folded) + 1, dtype=bool)
    inside[:-1] = folded != 0x20
    edge = np.zeros(len(folded) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    lengths = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    values = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(lengths), pa.py_buffer(folded[inside[:-1]].tobytes()))
    upto = np.searchsorted(start, offsets)
    base = np.repeat(offsets[:-1], np.diff(upto))
    return Words(values, start - base, end - base, upto)


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block of the benchmark: words by number, and the items of each window."""

    vocabulary: pa.Array
    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    items: list[str]
    item_upto: np.ndarray
    item_of: np.ndarray

    @staticmethod
    def of(pieces: list[tuple[str | None, str]], width: int) -> Windows:
        """``pieces``: item and text; an item without a name has windows, but is never reported."""
        words = split(pa.array([text for _, text in pieces], pa.string()))
        coded = words.values.dictionary_encode()
        vocabulary = coded.dictionary
        flat = np.concatenate((coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, np.zeros(width, dtype=np.int64)))
        sizes = np.diff(words.upto)
        many = np.where(sizes == 0, 0, np.maximum(1, sizes - width + 1))
        owner = np.repeat(np.arange(len(pieces)), many)
        starts = words.upto[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        lengths = np.minimum(width, sizes[owner])
        grid = np.zeros((len(starts), width), dtype=np.int64)
        for k in range(width):
            grid[:, k] = np.where(k < lengths, flat[starts + k], 0)
        _, one, same = np.unique(grid, axis=0, return_index=True, return_inverse=True)
        names, item = np.unique([name for name, _ in pieces if name is not None], return_inverse=True)
        item_of_piece = np.full(len(pieces), -1)
        item_of_piece[[i for i, (name, _) in enumerate(pieces) if name is not None]] = item
        pairs = np.unique(np.stack((same.reshape(-1), item_of_piece[owner]), axis=1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0] if len(pairs) else np.zeros((0, 2), dtype=np.int64)
        upto = np.searchsorted(pairs[:, 0], np.arange(len(one) + 1))
        return Windows(vocabulary, flat, starts[one], lengths[one], [str(n) for n in names], upto, pairs[:, 1])


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and which range each is of."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


def search(words: Words, windows: Windows) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words are hit, and the items of each text, by an index of these texts."""
    n, texts = len(words.start), len(words.upto) - 1
    none = [np.zeros(0, dtype=np.int64)] * texts
    if not len(windows.starts) or not n:
        return np.zeros(n, dtype=bool), none
    coded = pc.fill_null(pc.index_in(words.values, value_set=windows.vocabulary.cast(words.values.type)), -1)
    coded = coded.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    first = np.zeros(n, dtype=bool)
    first[words.upto[:-1][words.upto[:-1] < n]] = True
    begins = np.flatnonzero((coded > 0) & (first | (np.concatenate(([0], coded[:-1])) == 0)))
    ends = np.flatnonzero((coded > 0) & np.append(first[1:] | (coded[1:] == 0), True)) + 1
    long_enough = ends - begins >= windows.lengths.min()
    begins, ends = begins[long_enough], ends[long_enough]
    if not len(begins):
        return np.zeros(n, dtype=bool), none
    word, run = _spread(begins, ends)
    place = np.arange(len(word)) + run
    symbols = np.zeros(len(word) + len(begins), dtype=np.int64)
    symbols[place] = coded[word]
    origin = np.zeros(len(symbols), dtype=np.int64)
    origin[place] = word
    index = FmIndex(symbols, len(windows.vocabulary))
    low, high = index.search(windows.flat, windows.starts, windows.lengths)
    met = np.flatnonzero(low < high)
    # Each row is located once, however many windows begin its suffix.
    cover = np.zeros(index.size + 1, dtype=np.int64)
    np.add.at(cover, low[met], 1)
    np.add.at(cover, high[met], -1)
    rows = np.flatnonzero(np.cumsum(cover)[:-1])
    where = np.zeros(index.size, dtype=np.int64)
    where[rows] = origin[index.locate(rows)]
    open_ = np.zeros(n + 1, dtype=np.int64)
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    cuts = np.searchsorted(np.cumsum(high[met] - low[met]), np.arange(STEP, int((high - low).sum()) + STEP, STEP))
    for some in np.split(met, np.unique(cuts)):
        row, of = _spread(low[some], high[some])
        at, window = where[row], some[of]
        np.add.at(open_, at, 1)
        np.add.at(open_, at + windows.lengths[window], -1)
        text = np.searchsorted(words.upto, at, side="right") - 1
        seen = np.unique(text * len(windows.starts) + window)
        text, window = seen // len(windows.starts), seen % len(windows.starts)
        item, of = _spread(windows.item_upto[window], windows.item_upto[window + 1])
        pairs.append(np.unique(np.stack((text[of], windows.item_of[item]), axis=1), axis=0))
    found = np.unique(np.concatenate(pairs), axis=0)
    return np.cumsum(open_)[:n] > 0, np.split(found[:, 1], np.searchsorted(found[:, 0], np.arange(1, texts)))


def _results(batch: pa.RecordBatch, windows: Windows, sparse: bool) -> pa.RecordBatch:
    """Columns of FOUND beside the given ones but the text; ``sparse``: only for texts with a hit."""
    words = split(batch.column("text"))
    hit, items = search(words, windows)
    upto, names = words.upto, np.array([*windows.items, ""], dtype=object)
    total = np.concatenate(([0], np.cumsum(hit)))
    first = np.zeros(len(hit), dtype=bool)
    first[upto[:-1][upto[:-1] < len(hit)]] = True
    begins = np.flatnonzero(hit & (first | ~np.concatenate(([False], hit[:-1]))))
    ends = np.flatnonzero(hit & np.append(first[1:] | ~hit[1:], True)) if len(hit) else begins
    text = np.searchsorted(upto, begins, side="right") - 1
    base = upto[text]
    spans = pa.StructArray.from_arrays(
        [pa.array(x) for x in (begins - base, ends + 1 - base, words.start[begins], words.end[ends])],
        ["first", "stop", "start", "end"],
    )
    span_upto = np.searchsorted(text, np.arange(len(upto)))
    item_upto = np.concatenate(([0], np.cumsum([len(i) for i in items])))
    flat = names[np.concatenate(items)] if len(items) else names[:0]
    columns = {
        **{name: batch.column(name) for name in batch.schema.names if name != "text"},
        "n_words": pa.array(np.diff(upto).astype(np.int64)),
        "n_hit": pa.array((total[upto[1:]] - total[upto[:-1]]).astype(np.int64)),
        "removed": pa.ListArray.from_arrays(pa.array(span_upto, pa.int32()), spans),
        "items": pa.ListArray.from_arrays(pa.array(item_upto, pa.int32()), pa.array(list(flat), pa.string())),
    }
    out = pa.RecordBatch.from_pydict(columns)
    return out.filter(pc.greater(out.column("n_hit"), 0)) if sparse else out


def _scan(rows: DataFrame, windows: Windows, sparse: bool) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _results(batch, sent.value, sparse)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(scan, f"{kept}, {FOUND}")


def _pieces(width: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of an item overlap by a window less one word, so each window is in one."""
        for batch in slices(batches, "text"):
            words = split(batch.column("text"))
            names, pieces = [], []
            for i, name in enumerate(batch.column("item").to_pylist()):
                own = words.values[words.upto[i] : words.upto[i + 1]].to_pylist()
                for start in range(0, max(len(own) - width + 1, min(len(own), 1)), longest - width + 1):
                    names.append(name)
                    pieces.append(" ".join(own[start : start + longest]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.string())], ["item", "text"])

    return cut


def _merged(rows: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Results of ``rows`` in the blocks together: overlapping and touching spans joined, items once."""
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    together = found.groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list("removed"))).alias("_spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"),
    )

    def join(done, span):
        last = F.get(done, F.size(done) - 1)
        later = F.struct(
            last["first"].alias("first"), F.greatest(last["stop"], span["stop"]).alias("stop"),
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"),
        )
        touches = (F.size(done) > 0) & (last["stop"] >= span["first"])
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(later))).otherwise(
            F.concat(done, F.array(span))
        )

    empty = F.array().cast(f"array<{SPAN}>")
    kept = [c for c in rows.columns if c not in ("row", "text")]
    joined = rows.join(together, "row", "left").withColumn("removed", F.aggregate(F.coalesce("_spans", empty), empty, join))
    hits = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.select(*kept, "n_words", hits.alias("n_hit"), "removed", items.alias("items"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, piece_words: int = PIECE_WORDS
) -> DataFrame:
    """What of each document repeats a benchmark window: doc_id, n_words, n_hit, removed, items.

    ``docs``: doc_id, text; ``benchmark``: item_id, text; other columns are not read.
    ``removed`` are the spans to remove, overlapping and touching ones merged: words
    [first, stop) and bytes [start, end) of the UTF-8 text. ``items`` are the ids, as text,
    of the items with an occurring window, each once, in no order. Every row gives a row,
    repeated ones and those with a null doc_id too; a null text has no words. Windows of
    items with a null id count as hits and are not named. Without windows nothing is hit.

    A task indexes its own texts and searches them for all windows; nothing is shuffled while the
    benchmark has up to ``block_bytes`` of words. A larger one is cut into blocks,
    one of which is on the driver and in the tasks at a time; every block is searched in all
    texts (which are stored once with row numbers) and the findings are merged by row.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    pieces = items.mapInArrow(_pieces(width, max(piece_words, width)), "item string, text string")
    pieces = materialize(pieces.withColumn("piece", F.monotonically_increasing_id()), "benchmark-pieces")
    rows = docs.select("doc_id", "text")
    if (pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= block_bytes:
        sent = [(r.item, r.text) for r in pieces.select("item", "text").collect()]
        return _scan(rows, Windows.of(sent, width), sparse=False)
    size = F.octet_length("text").cast("long")
    placed = running(pieces, [], ["piece"], size, "before").withColumn("block", F.floor(F.col("before") / block_bytes))
    placed = materialize(placed, "benchmark-blocks")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    base, parts = None, []
    for block in range(placed.agg(F.max("block")).first()[0] + 1):
        sent = [(r.item, r.text) for r in placed.where(F.col("block") == block).select("item", "text").collect()]
        windows = Windows.of(sent, width)
        if base is None:
            base = materialize(_scan(rows, windows, sparse=False), "block-hits")
            parts.append(base.where("n_hit > 0").select("row", "removed", "items"))
        else:
            hits = _scan(rows.select("row", "text"), windows, sparse=True)
            parts.append(materialize(hits.select("row", "removed", "items"), "block-hits"))
    return _merged(base.select("doc_id", "row", "n_words"), parts)
