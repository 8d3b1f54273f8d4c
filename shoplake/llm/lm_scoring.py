"""Language-model scoring: the marginal probability of a text over a subword lattice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import slices, split_words
from shoplake.llm.subword_encoding import Encoder, utf8_bytes
from shoplake.llm.vocabulary import PIECES, SPACE, Vocabulary, load
from shoplake.storage import materialize

#: Languages with a model of their own; all others share one more.
CLASSES = 7

#: Words with a millionth of all tokens (a million at most) are scored where they are read.
FREQUENT = 1_000_000

#: Share of the base measure that the end of a text has.
END_SHARE = 1e-3

#: Probability that a word ends after a piece, before anything is learned.
WORD_END = 0.25

#: Share of the pieces' probability that single bytes have together.
BYTE_SHARE = 1e-3

#: What is learned about pieces counts against so many uses by the file's scores.
PRIOR_USES = 1000.0

#: Words that one lattice joins.
LATTICE_BYTES = 1 << 19

#: Text that one count of words takes in.
COUNT_BYTES = 24 << 20


class Speller:
    """Log-probability of a word under the pieces: all its segmentations, summed.

    ``pieces`` are log-weights by piece, ``byte`` that of a single byte, ``end`` that
    of a word's end; together they sum to 1.
    """

    def __init__(self, encoder: Encoder, pieces: np.ndarray, byte: float, end: float) -> None:
        self.encoder, self.pieces, self.byte, self.end = encoder, pieces, byte, end

    @classmethod
    def given(cls, encoder: Encoder) -> Speller:
        """By the vocabulary file alone: its scores are ranks (0, -1, -2, ...), and a piece weighs 1 / (10 + rank)."""
        weights = _file_weights(encoder) * (1 - WORD_END) * (1 - BYTE_SHARE)
        return cls(encoder, np.log(weights), float(np.log((1 - WORD_END) * BYTE_SHARE / 256)), float(np.log(WORD_END)))

    @classmethod
    def learned(cls, encoder: Encoder, expected: np.ndarray, words: float) -> Speller:
        """By expected uses of each piece (then of bytes) in so many words, with the file's weights as prior."""
        uses = expected[:-1] + PRIOR_USES * (1 - BYTE_SHARE) * _file_weights(encoder)
        single = expected[-1] + PRIOR_USES * BYTE_SHARE
        ends = words + PRIOR_USES * WORD_END
        total = uses.sum() + single + ends
        return cls(encoder, np.log(uses / total), float(np.log(single / total / 256)), float(np.log(ends / total)))

    def _weights(self, lattice: tuple) -> np.ndarray:
        text, _, _, begin, _, piece = lattice
        return np.where(piece >= 0, self.pieces[piece], self.byte * utf8_bytes(text[begin]))

    def log_probability(self, lattice: tuple) -> np.ndarray:
        """Natural logarithms, one for each word of the lattice."""
        text, starts, ends, begin, length, _ = lattice
        return forward(len(text), starts, begin, length, self._weights(lattice))[ends] + self.end

    def uses(self, lattice: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each edge: the number of its word, its piece (-1: bytes), its expected uses."""
        text, starts, ends, begin, length, piece = lattice
        weight = self._weights(lattice)
        before = forward(len(text), starts, begin, length, weight)
        after = backward(len(text), starts, ends, begin, length, weight)
        word = np.searchsorted(starts, begin, side="right") - 1
        return word, piece, np.exp(before[begin] + weight + after[begin + length] - before[ends][word])


def _file_weights(encoder: Encoder) -> np.ndarray:
    weights = 1.0 / (10.0 - np.minimum(encoder.scores, 0.0))
    return weights / weights.sum()


def _heads(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)


def forward(size: int, starts: np.ndarray, begin: np.ndarray, length: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all paths from a word's start to each position.

    All words advance together, by distance from their start.
    """
    owner = np.repeat(starts, np.diff(np.append(starts, size)))
    end = begin + length
    distance = end - owner[begin]
    order = np.argsort(distance.astype(np.int64) * (size + 1) + end)
    begin, weight, end, distance = begin[order], weight[order], end[order], distance[order]
    total = np.full(size + 1, -np.inf)
    total[starts] = 0.0
    cuts = _heads(distance)
    for a, b in zip(cuts, [*cuts[1:], len(distance)]):
        heads = _heads(end[a:b])
        total[end[a:b][heads]] = np.logaddexp.reduceat(total[begin[a:b]] + weight[a:b], heads)
    return total


def backward(size: int, starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, length: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all paths from each position to its word's end: `forward`, read from behind."""
    return forward(size, size - 1 - ends[::-1], size - 1 - begin - length, length, weight)[:size][::-1]


def _count(docs: DataFrame, classes: int) -> DataFrame:
    """word, kind, n: training occurrences by slice of a task; words seen only elsewhere have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", COUNT_BYTES):
            offsets, words = split_words(batch.column("text"))
            coded = words.dictionary_encode()
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            kind = batch.column("kind").to_numpy()[owner]
            learn = batch.column("learn").to_numpy(zero_copy_only=False)[owner]
            cell = coded.indices.to_numpy().astype(np.int64) * classes + kind
            n = np.bincount(cell, weights=learn, minlength=1)
            seen = np.flatnonzero(np.bincount(cell, minlength=1))
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(seen // classes)), pa.array(seen % classes, pa.int32()), pa.array(n[seen].astype(np.int64))],
                ["word", "kind", "n"],
            )

    return docs.select("text", "kind", "learn").mapInArrow(run, "word string, kind int, n long")


def _uses(table: DataFrame, each: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Expected uses of every piece (and of bytes, last) in each class's tokens, and their number."""
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller.given(Encoder(vocabulary))
        size = len(speller.pieces) + 1
        total = np.zeros((len(each), size + 1))
        for batch in slices(batches, "word", LATTICE_BYTES):
            word, piece, uses = speller.uses(speller.encoder.edges([SPACE + w for w in batch.column("word").to_pylist()]))
            for z, c in enumerate(each):
                times = batch.column(c).to_numpy()
                total[z, :size] += np.bincount(piece % size, weights=uses * times[word], minlength=size)
                total[z, size] += times.sum()
        kind, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(place), pa.array(total[kind, place])], ["kind", "place", "uses"])

    found = table.select("word", *each).mapInArrow(run, "kind long, place long, uses double")
    summed = found.groupBy("kind", "place").agg(F.sum("uses").alias("uses")).toArrow()
    size = len(vocabulary.pieces) + 1
    total = np.zeros((len(each), size + 1))
    total[summed.column("kind").to_numpy(), summed.column("place").to_numpy()] = summed.column("uses").to_numpy()
    return total[:, :size], total[:, size]


def _spelled(table: DataFrame, expected: np.ndarray, words: np.ndarray, path: str) -> DataFrame:
    """``table`` and s0, s1, ...: log10 of the word's probability in each class's spelling."""
    vocabulary, names = load(path), [f"s{z}" for z in range(len(words))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        spellers = [Speller.learned(encoder, e, n) for e, n in zip(expected, words)]
        for batch in slices(batches, "word", LATTICE_BYTES):
            lattice = encoder.edges([SPACE + w for w in batch.column("word").to_pylist()])
            found = [pa.array((s.log_probability(lattice) + np.log1p(-END_SHARE)) / np.log(10.0)) for s in spellers]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    schema = ", ".join([*(f"{n} {t}" for n, t in table.dtypes), *(f"{n} double" for n in names)])
    return table.mapInArrow(run, schema)


def _places(docs: DataFrame, frequent: pa.Table, values: list[str]) -> DataFrame:
    """row, word, times, rest: a row for each rare word of a text, and one for the rest of it.

    ``rest`` has the text's doc_id, learn and ``sums``, which adds up ``values`` over
    its frequent words and then holds the number of words. The ``word`` of such a row
    has a space, so it equals no word and spreads.
    """
    names = frequent.column("word").combine_chunks()
    weights = np.stack([frequent.column(v).to_numpy() for v in values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["row", "word", "times", "rest"]
        kind = pa.struct([("doc_id", pa.int64()), ("learn", pa.bool_()), ("sums", pa.list_(pa.float64()))])
        for batch in slices(batches, "text"):
            row = batch.column("row").to_numpy()
            offsets, words = split_words(batch.column("text"))
            coded = words.dictionary_encode()
            code = coded.indices.to_numpy()
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            place = pc.fill_null(pc.index_in(coded.dictionary, names), -1).to_numpy()
            at = place[code]
            often = at >= 0
            sums = np.stack([np.bincount(owner[often], w[at[often]], len(batch)) for w in weights] + [np.diff(offsets)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel().astype(float)))
            rest = pa.StructArray.from_arrays([batch.column("doc_id"), batch.column("learn"), lists], fields=list(kind))
            alone = pa.array([f" {r}" for r in row.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(row), alone, pa.array(np.ones(len(row), dtype=np.int32)), rest], fields)
            names_here = max(len(coded.dictionary), 1)
            cell, times = np.unique(owner[~often] * names_here + code[~often], return_counts=True)
            word = coded.dictionary.take(pa.array(cell % names_here))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[cell // names_here]), word, pa.array(times.astype(np.int32)), pa.nulls(len(cell), kind)], fields
            )

    schema = "row long, word string, times int, rest struct<doc_id: long, learn: boolean, sums: array<double>>"
    return docs.select("row", "text", "doc_id", "learn").mapInArrow(run, schema)


def lm_score(docs: DataFrame, held_out: Column, path: str = PIECES, counts: bool = True) -> DataFrame:
    """Log10 probability of every text under a model learned from the others.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    Texts with ``held_out`` false train. Tokens are words (A-Z lower-cased, runs of
    other than white space) and one end a text. ``base_score`` is an add-one unigram
    model: the sum of log10((c+1)/(N+V+1)).

    The model is a mixture over languages (``lang``: the seven most frequent of the
    training texts, and the rest with null), which a text need not name: its
    probability is the sum over languages of share times product over tokens. Every
    word, seen or new, goes through its subword lattice: all paths, summed by a
    forward recursion in log space. The vocabulary file's scores weigh the paths of
    the training texts' words, whose expected pieces by token (one forward-backward
    pass) then weigh the language's lattice, with the file's scores as prior. With
    ``counts`` a seen word has two more edges over its whole length, its discounted
    count in the language and in all training texts, and the lattice's sum weighs
    what the discounts leave. Without them the lattice alone scores. The
    probabilities of all words and the end sum to at most 1.

    Null and empty texts are one end. Repeated rows are scored (and learned) each; an
    empty table gives an empty result; a null doc_id trains. Without training texts
    the spelling decides. Words are counted over all texts with partial sums; only a
    text's rare words are shuffled, to the table of all words.
    """
    spark = docs.sparkSession
    out = F.coalesce(held_out, F.lit(False))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang"), (~out).alias("learn")
    )
    langs = rows.where("learn and lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES)
    names = sorted(r["lang"] for r in langs.collect())
    classes = len(names) + 1
    kind = F.coalesce(*[F.when(F.col("lang") == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))
    rows = rows.withColumn("kind", kind.cast("int")).withColumn("row", F.monotonically_increasing_id())
    counted = _count(rows, classes).groupBy("word").agg(
        *[F.sum(F.when(F.col("kind") == z, F.col("n")).otherwise(0)).alias(f"c{z}") for z in range(classes)]
    )
    table = materialize(counted, "words")
    each = [f"c{z}" for z in range(classes)]
    all_ = sum((F.col(c) for c in each[1:]), F.col("c0"))
    stats = table.agg(
        F.count(F.when(all_ > 0, 1)).alias("v"),
        F.count(F.when(all_ == 1, 1)).alias("once"),
        F.count(F.when(all_ == 2, 1)).alias("twice"),
        *[F.sum(c).alias(c) for c in each],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"v{z}") for z, c in enumerate(each)],
    ).first()
    texts = {r["kind"]: r["n"] for r in rows.where("learn").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends = [texts.get(z, 0) for z in range(classes)]
    in_class = [(stats[c] or 0) + e for c, e in zip(each, ends)]
    tokens, kinds = sum(in_class), stats["v"] + (1 if sum(ends) else 0)
    # What seen words leave to others: an absolute discount, by class and in general.
    discount = (stats["once"] + 1) / (stats["once"] + 2 * stats["twice"] + 2)
    left = discount * kinds / tokens if tokens else 1.0
    lefts = [discount * (stats[f"v{z}"] + (1 if e else 0)) / n if n else 1.0 for z, (n, e) in enumerate(zip(in_class, ends))]

    def seen(most, count, by_class):
        general = most(count - discount, 0.0) / float(max(tokens, 1))
        return [most(c - discount, 0.0) / float(max(n, 1)) + general * g for c, n, g in zip(by_class, in_class, lefts)]

    def base(count):
        return (count + 1) / float(tokens + kinds + 1)

    def column_most(a, b):
        return F.greatest(a, F.lit(b))

    values = ["base", "known", *[f"p{z}" for z in range(classes)]]
    expected, words = _uses(table.where(all_ > 0), each, path)
    # A word's probability is that of its lattice, and that of its counts on top.
    spelled = [F.col(f"s{z}") + float(np.log10(g * left) if counts else 0.0) for z, g in enumerate(lefts)]
    both = [
        F.when(all_ > 0, F.log10(p + F.pow(F.lit(10.0), q))).otherwise(q) if counts else q
        for p, q in zip(seen(column_most, all_, [F.col(c) for c in each]), spelled)
    ]
    scored = _spelled(table, expected, words, path).select(
        "word",
        all_.alias("c"),
        F.log10(base(all_)).alias("base"),
        F.when(all_ > 0, 1.0).otherwise(0.0).alias("known"),
        *[p.alias(f"p{z}") for z, p in enumerate(both)],
    )
    scored = materialize(scored, "scored")
    frequent = scored.where((F.col("c") > 0) & (F.col("c") * FREQUENT >= tokens)).toArrow()
    places = _places(rows, frequent, values)
    rare = scored.select(F.col("word").alias("_word"), *values)
    met = places.join(rare, F.col("word") == F.col("_word"), "left")
    part = [F.coalesce(F.col("rest.sums")[i], F.col("times") * F.col(v)) for i, v in enumerate(values)]
    summed = met.groupBy("row").agg(
        *[F.sum(p).alias(v) for p, v in zip(part, values)],
        F.max("rest.doc_id").alias("doc_id"),
        F.max("rest.learn").alias("learn"),
        F.max(F.col("rest.sums")[len(values)]).alias("words"),
    )
    end_p = [p + END_SHARE * left * g for p, g in zip(seen(max, sum(ends), ends), lefts)] if counts else [END_SHARE] * classes
    share = [(t + 1) / (sum(ends) + classes) for t in ends]
    in_log = [F.col(f"p{z}") + float(np.log10(end_p[z] * share[z])) for z in range(classes)]
    top = F.greatest(*in_log) if classes > 1 else in_log[0]
    score = top + F.log10(sum((F.pow(F.lit(10.0), p - top) for p in in_log[1:]), F.pow(F.lit(10.0), in_log[0] - top)))
    return summed.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        (F.col("words") + 1).cast("long").alias("n_tokens"),
        (F.col("known") + (1 if sum(ends) else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(base(sum(ends))))).alias("base_score"),
        score.alias("score"),
    )
