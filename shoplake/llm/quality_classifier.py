"""Quality classifier: co-training of a text view and a metadata view."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import release, slices, split_words
from shoplake.storage import materialize

#: Bounds of what is fitted: labelled rows, unlabelled rows, telling words for each target.
LABELLED, POOL, WORDS = 6_000, 4_000, 300

#: Rounds of co-training, pseudo-labels that a view hands over a round and class, and their least confidence.
ROUNDS, HANDED, CONFIDENT = 3, 200, 0.95

#: Languages and sources that the metadata view tells apart, the others being one.
NAMES = 50

#: Text and rows of one step of learning or scoring.
STEP_BYTES, STEP_ROWS = 4 << 20, 2_000

#: Parts of the labelled rows, by which they calibrate what was learned without them.
CALIBRATE = 4

_SHAPES = 6


def shapes(text: pa.Array, offsets: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Numbers about each text that don't depend on its words: shares of kinds of bytes, lengths."""
    text = pc.fill_null(text, "")
    size = pc.binary_length(text).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer(b"".join(text.cast(pa.binary()).to_pylist()), dtype=np.uint8)
    n = np.maximum(size, 1)
    columns = [np.log1p(size)]
    upper = (raw >= 65) & (raw <= 90)
    lower = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    for kind in (upper, (raw >= 33) & ~upper & ~lower & ~((raw >= 48) & (raw <= 57)), (raw >= 48) & (raw <= 57)):
        total = np.zeros(len(size))
        if len(raw):
            total[size > 0] = np.add.reduceat(kind, ends[:-1][size > 0], dtype=np.int64)
        columns.append(total / n)
    words = np.diff(offsets)
    columns.append(np.log1p(size / np.maximum(words, 1)))
    columns.append(np.log1p(words) - np.log1p(distinct))
    return np.stack(columns, axis=1)


def text_features(text: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes of each text; then pairs of text and vocabulary word that it holds."""
    offsets, words = split_words(text)
    coded = words.dictionary_encode()
    owner = np.repeat(np.arange(len(text)), np.diff(offsets))
    names = max(len(coded.dictionary), 1)
    cells = np.unique(owner * names + coded.indices.to_numpy())
    doc, code = cells // names, cells % names
    place = pc.fill_null(pc.index_in(coded.dictionary, vocabulary), -1).to_numpy()[code] if len(cells) else np.zeros(0, dtype=np.int64)
    distinct = np.bincount(doc, minlength=len(text))
    held = place >= 0
    return shapes(text, offsets, distinct), doc[held], place[held]


@dataclass
class View:
    """A logistic regression on standardised columns, and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return self.slope * (z @ self.weights[:-1] + self.weights[-1]) + self.offset

    @staticmethod
    def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> View:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.clip((x - mean) / scale, -6, 6)
        return View(mean, scale, _logistic(np.hstack([z, np.ones((len(z), 1))]), y, ridge))

    def calibrated(self, margin: np.ndarray, y: np.ndarray) -> View:
        """Two numbers that turn the margin into log-odds, from margins of rows that were not learned from.

        The slope is drawn to 1, so few rows change little. A view whose margin runs
        against the labels says nothing: its log-odds are those of the labels.
        """
        if len(set(y.tolist())) < 2:
            return self
        soft = (y * len(y) + 0.5) / (len(y) + 1)
        slope, offset = _logistic(np.stack([margin, np.ones(len(y))], axis=1), soft, 1.0, margin) + (1.0, 0.0)
        if slope <= 0:
            slope, offset = 0.0, np.log(soft.mean() / (1 - soft.mean()))
        return View(self.mean, self.scale, self.weights, float(slope), float(offset))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, base: np.ndarray | float = 0.0) -> np.ndarray:
    """Newton's method, on top of given margins; the last column, the constant, is not held back."""
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], ridge)
    hold[-1] = 1e-6
    for _ in range(12):
        p = _odds(base + x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(hold), x.T @ (p - y) + hold * w)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _odds(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def co_train(views: list[np.ndarray], y: np.ndarray, known: np.ndarray) -> tuple[list[View], np.ndarray]:
    """Two calibrated views of one target; how their log-odds add up, and a constant.

    ``y`` counts where ``known``; the other rows are the pool. In each round both
    views are fitted, and each hands the pool rows that it is surest of, with its
    labels, to the other one's training rows. In the rounds some labelled rows are
    kept back to calibrate; in the end each labelled row calibrates by a fit without
    it, and is learned from.
    """
    labelled = np.flatnonzero(known)
    fold = np.arange(len(labelled)) % CALIBRATE
    given: list[dict[int, float]] = [{} for _ in views]

    def fit(x: np.ndarray, pseudo: dict[int, float], rows: np.ndarray) -> View:
        return View.fitted(np.vstack([x[rows], x[list(pseudo)]]) if pseudo else x[rows], np.concatenate([y[rows], list(pseudo.values())]))

    for _ in range(ROUNDS):
        held, base = labelled[fold == 0], labelled[fold > 0]
        fitted = [fit(x, g, base) for x, g in zip(views, given)]
        fitted = [f.calibrated(f.margin(x[held]), y[held]) for f, x in zip(fitted, views)]
        for teacher, pupil in ((0, 1), (1, 0)):
            pool = np.array([i for i in np.flatnonzero(~known) if i not in given[pupil]], dtype=np.int64)
            if not len(pool):
                continue
            p = _odds(fitted[teacher].margin(views[teacher][pool]))
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                best = np.argsort(-sure, kind="stable")[:HANDED]
                given[pupil].update({int(pool[i]): label for i in best if sure[i] >= CONFIDENT})
    final, seen = [], []
    for x, g in zip(views, given):
        margin = np.zeros(len(labelled))
        for k in range(CALIBRATE):
            margin[fold == k] = fit(x, g, labelled[fold != k]).margin(x[labelled[fold == k]])
        view = fit(x, g, labelled).calibrated(margin, y[labelled])
        final.append(view)
        seen.append(view.slope * margin + view.offset)
    # Independent views would just add up, less what is known before any view; how far
    # they are from that shows on the labelled rows.
    rate = float(np.clip(y[labelled].mean(), 1e-3, 1 - 1e-3))
    sum_ = np.array([1.0, 1.0, -np.log(rate / (1 - rate))])
    x = np.stack([*seen, np.ones(len(labelled))], axis=1)
    return final, sum_ + _logistic(x, (y[labelled] * len(labelled) + 0.5) / (len(labelled) + 1), 1.0, x @ sum_)


def _meta(docs: DataFrame) -> list[Column]:
    """Metadata columns of a document; what it lacks is null."""
    has = set(docs.columns)
    return [
        *[(F.col(c).cast("string") if c in has else F.lit(None).cast("string")).alias(c) for c in ("lang", "source")],
        (F.col("n_chars").cast("double") if "n_chars" in has else F.lit(None).cast("double")).alias("n_chars"),
    ]


def _meta_features(batch: pa.RecordBatch, langs: list[str], sources: list[str]) -> np.ndarray:
    n = batch.column("n_chars").to_numpy(zero_copy_only=False)
    n = np.where(np.isfinite(n) & (n > 0), n, 0.0)
    columns = [np.log1p(n)]
    for name, known in (("lang", langs), ("source", sources)):
        column = batch.column(name)
        columns.extend(pc.fill_null(pc.equal(column, k), False).to_numpy(zero_copy_only=False).astype(float) for k in known)
        columns.append(pc.is_null(column).to_numpy(zero_copy_only=False).astype(float))
    return np.stack(columns, axis=1)


def _first(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows by hash of ``id``. Of very many only those of the least hashes are sorted at all."""
    order = F.xxhash64(F.col("id"))
    share = 2 * n / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(order < F.lit(int(-(2**63) + share * 2**64)))
    return rows.orderBy(order, "id").limit(n)


def _sample(docs: DataFrame, labels: DataFrame, targets: list[str]) -> DataFrame:
    """The bounded rows to learn from, in hash order of their id: labelled ones, then the pool. One row an id."""
    named = labels.select(F.col("doc_id").cast("long").alias("id"), *[F.col(t).cast("double").alias(f"y_{t}") for t in targets])
    named = named.where("id is not null").dropna(subset=[f"y_{t}" for t in targets]).groupBy("id").agg(
        *[F.max(f"y_{t}").alias(f"y_{t}") for t in targets]
    )
    some = _first(named, LABELLED)
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct()
    pool = _first(ids.join(named, "id", "left_anti"), POOL)
    wanted = some.unionByName(pool, allowMissingColumns=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_meta(docs))
    met = rows.join(F.broadcast(wanted), F.col("doc_id") == F.col("id")).drop("id")
    # Of an id's rows the one with the least digest; few ids have more than one.
    met = met.withColumn("digest", F.xxhash64("text", "lang", "source", "n_chars"))
    beside = ["text", "lang", "source", "n_chars"]
    one = met.groupBy("doc_id", *[f"y_{t}" for t in targets]).agg(F.min_by(F.struct(*beside), "digest").alias("row"))
    return one.select("doc_id", *[f"y_{t}" for t in targets], "row.*")


def _telling_words(sample: DataFrame, target: str) -> list[str]:
    """Words whose presence tells most about a target, by the likelihood ratio, in at least five texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP_BYTES, STEP_ROWS):
            offsets, words = split_words(batch.column("text"))
            coded = words.dictionary_encode()
            names = max(len(coded.dictionary), 1)
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            cells = np.unique(owner * names + coded.indices.to_numpy())
            y = batch.column(f"y_{target}").to_numpy()
            yes = np.bincount(cells % names, weights=y[cells // names], minlength=len(coded.dictionary))
            n = np.bincount(cells % names, minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n), pa.array(yes)], ["word", "n", "yes"])

    known = sample.where(F.col(f"y_{target}").isNotNull()).select("text", f"y_{target}")
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum(f"y_{target}").alias("yes")).first()
    if not total["n"]:
        return []
    counts = known.mapInArrow(run, "word string, n long, yes double").groupBy("word").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes"))
    n, yes, rate = F.col("n"), F.col("yes"), float(np.clip(total["yes"] / total["n"], 1e-3, 1 - 1e-3))
    gain = F.when(yes > 0, yes * F.log(yes / (n * rate))).otherwise(0.0) + F.when(n > yes, (n - yes) * F.log((n - yes) / (n * (1 - rate)))).otherwise(0.0)
    best = counts.where("n >= 5").withColumn("gain", gain).where("gain >= 8").orderBy(F.desc("gain"), "word").limit(WORDS)
    return [r["word"] for r in best.collect()]


class Classifier:
    """Co-trained classifiers of some 0/1 targets, ready to score batches of documents."""

    def __init__(self, docs: DataFrame, labels: DataFrame, targets: list[str]) -> None:
        sample = materialize(_sample(docs, labels, targets), "classifier-sample")
        words = {t: _telling_words(sample, t) for t in targets}
        self.targets, self.vocabulary = targets, sorted(set().union(*words.values()))
        self.langs, self.sources = (
            [r[c] for r in sample.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(NAMES).collect()]
            for c in ("lang", "source")
        )
        self.columns = {
            t: np.concatenate([np.arange(_SHAPES), [_SHAPES + self.vocabulary.index(w) for w in words[t]]]).astype(np.int64)
            for t in targets
        }
        ys = [f"y_{t}" for t in targets]
        plain = self._features()
        schema = f"doc_id long, {', '.join(f'{y} double' for y in ys)}, text array<float>, meta array<float>"

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", STEP_BYTES, STEP_ROWS):
                row = [pa.array(list(x.astype(np.float32))) for x in plain(batch)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[batch.column(y) for y in ys], *row], ["doc_id", *ys, "text", "meta"]
                )

        columns = self.columns

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(batches, pa_schema).sort_by("doc_id")
            if not len(rows):
                return
            x = [np.stack(rows.column(c).to_numpy()) for c in ("text", "meta")]
            models: dict[str, tuple[list[View], np.ndarray] | None] = {}
            for t in targets:
                y = rows.column(f"y_{t}").to_numpy().astype(float)
                known = np.isfinite(y)
                both = len(set(y[known].tolist())) > 1 and known.sum() >= 2 * CALIBRATE
                models[t] = co_train([x[0][:, columns[t]], x[1]], np.nan_to_num(y), known) if both else None
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(models)], pa.binary())], ["models"])
            del rows, x
            release()

        # The bounded sample is fitted in one task; only weights come to the driver.
        pa_schema = pa.schema(
            [("doc_id", pa.int64()), *[(y, pa.float64()) for y in ys], ("text", pa.list_(pa.float32())), ("meta", pa.list_(pa.float32()))]
        )
        found = sample.mapInArrow(features, schema).repartition(1).mapInArrow(fit, "models binary").collect()
        self.models: dict[str, tuple[list[View], np.ndarray] | None] = dict.fromkeys(targets)
        for row in found:
            self.models |= pickle.loads(row.models)

    def _features(self):
        vocabulary, langs, sources = self.vocabulary, self.langs, self.sources

        def plain(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            shape, doc, place = text_features(batch.column("text"), pa.array(vocabulary, pa.string()))
            held = np.zeros((len(shape), len(vocabulary)))
            held[doc, place] = 1.0
            return np.hstack([shape, held]), _meta_features(batch, langs, sources)

        return plain

    def scorer(self):
        """A function from a batch (text, lang, source, n_chars) to p, text and meta of each target."""
        plain, targets, models, columns = self._features(), self.targets, self.models, self.columns

        def run(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            text, meta = plain(batch)
            result = {}
            for t in targets:
                if models[t] is None:
                    a = b = both = np.zeros(len(batch))
                else:
                    (content, page), (of_text, of_meta, constant) = models[t]
                    a, b = content.margin(text[:, columns[t]]), page.margin(meta)
                    both = of_text * a + of_meta * b + constant
                result |= {f"p_{t}": _odds(both), f"text_{t}": _odds(a), f"meta_{t}": _odds(b)}
            return result

        return run


def score(docs: DataFrame, labels: DataFrame, targets: list[str]) -> DataFrame:
    """Probability of each target for every row: doc_id, p_<target>, and by view, text_<target>, meta_<target>.

    ``labels`` has doc_id and 0/1 columns ``targets``. For each target one classifier
    sees the text (telling words and the text's shape), another the metadata (lang,
    source, n_chars). They are co-trained on at most 6,000 labelled and 4,000 other
    rows, in hash order of their id, and calibrated by fits without a quarter each.
    The views' log-odds add up, by weights that start from those of independent
    evidence.

    Every row is scored by its whole text. Null and empty texts have no words;
    missing metadata is a value of its own. Repeated ids are scored each; of repeated
    labels the greatest counts, rows of ``labels`` with nulls don't. Without labels
    of both kinds all probabilities are 0.5. Empty tables give an empty result. One
    task gets the features of the sample, at most 10,000 rows of some hundred numbers, and
    the driver the weights; documents are not shuffled.
    """
    run = Classifier(docs, labels, targets).scorer()
    outputs = [f"{kind}_{t}" for t in targets for kind in ("p", "text", "meta")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP_BYTES, STEP_ROWS):
            found = run(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(found[c]) for c in outputs]], ["doc_id", *outputs])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_meta(docs))
    return rows.mapInArrow(scored, "doc_id long, " + ", ".join(f"{c} double" for c in outputs))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that are probably of good quality and not toxic.

    A row goes when p_quality is below 0.5 or p_toxic is not. See `score` for nulls,
    ties and bounds; without usable labels all rows stay.
    """
    run = Classifier(docs, labels, ["quality", "toxic"]).scorer()
    names, extra = docs.columns, ["lang", "source", "n_chars"]
    text = [n.lower() for n in names].index("text")
    beside = docs.select("*", F.struct(*_meta(docs)).alias("_meta"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (b.rename_columns([f"{i}" for i in range(len(names) + 1)]) for b in batches)
        for batch in slices(texts, f"{text}", STEP_BYTES, STEP_ROWS):
            meta = batch.column(len(names)).flatten()
            found = run(pa.RecordBatch.from_arrays([batch.column(text), *meta], ["text", *extra]))
            good = (found["p_quality"] >= 0.5) & ((found["p_toxic"] < 0.5) | (found["p_toxic"] == 0.5) & (found["text_toxic"] == 0.5))
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names).filter(pa.array(good))

    return beside.mapInArrow(kept, docs.schema)


def keeps() -> Column:
    """Whether a scored row stays: of good quality, and not toxic (0.5 throughout: nothing was learned)."""
    return (F.col("p_quality") >= 0.5) & ((F.col("p_toxic") < 0.5) | (F.col("p_toxic") == 0.5) & (F.col("text_toxic") == 0.5))
