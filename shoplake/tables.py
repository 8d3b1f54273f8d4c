"""Versioned tables: Parquet files in buckets of the key, changed by whole commits.

    rows/<commit>/bucket=<n>/      rows of one commit, never changed afterwards
    filters/<commit>/              bitmaps of the keys of large segments
    sources/<commit>/              names of the raw files a commit was made from
    staged/<name>/bucket=<n>/      rows of a commit that is being made
    versions/version=<n>/          one file: which of these make up version n

A version appears when its single file does, so a reader sees all of a commit or none
of it, and a reader of an older version is not disturbed. The same file holds the number
of the last batch of every stream that writes the table: rows, the raw files they come
from and the progress of the stream are committed at once. One writer at a time: a
commit fails if its version has been taken meanwhile.

A bucket's rows of one commit are a segment. The driver holds one line for each
segment, with the range of its keys; ``compact`` keeps their number down.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, MapType, StringType, StructField, StructType, VariantType

from shoplake.operators.changes import ACTION, DELETE, INSERT, IS_UPDATE, insert_absent, updated
from shoplake.operators.lookup import BROADCAST_BYTES, all_set, byte_size, fits_broadcast
from shoplake.storage import COMPRESSION, free_shuffles, remove

#: Buckets of a new table. A bucket that is updated is written anew as a whole, so a large
#: table wants so many that each holds some GB.
BUCKETS = 8

#: Up to so many buckets, each task writes its rows of every bucket without a shuffle.
WRITERS = 16

#: Parts, by bucket, in which rows are shuffled to meet the keys held.
SHUFFLES = 8

#: Rows of a bucket that one task joins when segments are compacted.
ROWS_PER_TASK = 1 << 20

#: Rows of a part of a table that is read in parts.
ROWS_PER_PART = 1 << 24

#: A bucket with more segments is compacted after a batch.
MAX_SEGMENTS = 32

#: Bits of a key filter for each key, and bits that a key sets: one in 500 keys seems held that is not.
FILTER_BITS, FILTER_HASHES = 16, 4

#: A filter is asked for at most so many keys: with more, some would seem held for certain.
ASKED = 100_000

SOURCE = "_raw_file"
_BUCKET = "bucket"
_SOURCES = StructType([StructField(SOURCE, StringType())])
_MANIFEST = (
    "kind string, commit string, bucket int, n long, slots long, loader string, batch long, "
    "least array<string>, most array<string>"
)
_TEXTS = pa.list_(pa.string())
_MANIFEST_TABLE = pa.schema(
    {
        "kind": pa.string(), "commit": pa.string(), "bucket": pa.int32(), "n": pa.int64(), "slots": pa.int64(),
        "loader": pa.string(), "batch": pa.int64(), "least": _TEXTS, "most": _TEXTS,
    }
)
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_VERSION = re.compile(r"/version=(\d+)/[^/]+$")


@dataclass(frozen=True)
class Segment:
    """A bucket's rows of one commit; ``slots`` are the bits of its key filter, if it has one."""

    commit: str
    bucket: int
    n: int
    slots: int = 0
    least: tuple | None = None
    most: tuple | None = None


@dataclass(frozen=True)
class Version:
    """What a version of a table holds."""

    number: int
    buckets: int
    segments: tuple[Segment, ...] = ()
    sources: tuple[tuple[str, str], ...] = ()
    offsets: dict[str, int] = field(default_factory=dict)

    def most_segments(self) -> int:
        """Segments of the bucket that has most."""
        return max(Counter(s.bucket for s in self.segments).values(), default=0)


@contextmanager
def _writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Let a task keep ``n`` files open, so that it need not sort its rows by bucket."""
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, max(n, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def _bit_is_set(bits: str, slot: str) -> str:
    at = f"bitmap_bit_position({slot})"
    byte = f"cast(conv(hex(substring({bits}, cast({at} div 8 + 1 as int), 1)), 16, 10) as int)"
    return f"(shiftright({byte}, cast({at} % 8 as int)) & 1) = 1"


@dataclass(frozen=True)
class VersionedTable:
    """A table below ``path``. Without ``keys`` it has a single bucket and is only replaced or added to."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: Sequence[str] = ()
    buckets: int = BUCKETS
    partition_by: str | None = None
    broadcast_limit: int = BROADCAST_BYTES

    # --- versions -----------------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, oldest first; a listing, no job."""
        try:
            files = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/versions").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({int(found[1]) for found in map(_VERSION.search, files) if found})

    def version(self, number: int | None = None) -> Version:
        """The version of that number, by default the newest; number 0 is the empty table."""
        known = self.versions()
        number = (known[-1] if known else 0) if number is None else number
        if not number:
            return Version(0, self.buckets if self.keys else 1)
        if number not in known:
            raise ValueError(f"{self.path} has no version {number}")
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/versions/version={number}").collect()
        return Version(
            number,
            next(r.bucket for r in rows if r.kind == "table"),
            tuple(
                Segment(r.commit, r.bucket, r.n, r.slots, self._typed(r.least), self._typed(r.most))
                for r in rows
                if r.kind == "rows"
            ),
            tuple((r.commit, r.loader) for r in rows if r.kind == "sources"),
            {r.loader: r.batch for r in rows if r.kind == "offset"},
        )

    def _commit(self, version: Version) -> Version:
        """Make ``version`` the newest, under the next number."""
        version = replace(version, number=version.number + 1)

        lines = [{"kind": "table", "bucket": version.buckets}]
        for s in version.segments:
            least, most = ([None if v is None else str(v) for v in side] if side else None for side in (s.least, s.most))
            lines.append(
                {"kind": "rows", "commit": s.commit, "bucket": s.bucket, "n": s.n, "slots": s.slots, "least": least, "most": most}
            )
        lines += [{"kind": "sources", "commit": commit, "loader": loader} for commit, loader in version.sources]
        lines += [{"kind": "offset", "loader": loader, "batch": batch} for loader, batch in version.offsets.items()]
        target = f"{self.path}/versions/version={version.number}"
        one_file = self.spark.createDataFrame(pa.Table.from_pylist(lines, _MANIFEST_TABLE)).coalesce(1)
        try:
            one_file.write.mode("errorifexists").parquet(target)
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS" or version.number in self.versions():
                raise
            # What a writer left that died before its file was complete.
            remove(self.spark, target)
            one_file.write.mode("errorifexists").parquet(target)
        return version

    # --- segments -----------------------------------------------------------------

    def _typed(self, values: list[str] | None) -> tuple | None:
        if values is None:
            return None
        kinds = [self.schema[k].dataType for k in self.keys]
        return tuple(v if v is None or isinstance(k, StringType) else int(v) for v, k in zip(values, kinds))

    def _ranged(self) -> list[str]:
        return [k for k in self.keys if isinstance(self.schema[k].dataType, StringType | IntegralType)]

    def bucket(self, rows: DataFrame, buckets: int) -> Column:
        """Bucket of a row. Rows without a key match nothing, so their content spreads them."""
        if not self.keys:
            return F.lit(0)
        content = [f.name for f in rows.schema if not isinstance(f.dataType, VariantType | MapType)]
        keyed = F.when(all_set(self.keys), F.xxhash64(*self.keys)).otherwise(F.xxhash64(*content))
        return F.pmod(keyed, F.lit(buckets)).cast("int")

    def _folder(self, segment: Segment) -> str:
        return f"{self.path}/rows/{segment.commit}/{_BUCKET}={segment.bucket}"

    def _read(self, segments: Sequence[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        if self.partition_by:
            # Partitions lie within the bucket's folder, and their column comes from there.
            parts = [self.spark.read.schema(self.schema).parquet(self._folder(s)) for s in segments]
            return reduce(DataFrame.unionByName, parts).select(*self.schema.names)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(s) for s in segments])

    def _gathered(self, segments: Sequence[Segment], buckets: int) -> DataFrame:
        """Rows of ``segments``; where ``_write`` makes no shuffle, a task has rows of one bucket."""
        if self.partition_by or buckets > WRITERS:
            return self._read(segments)
        by_bucket: dict[int, list[Segment]] = {}
        for s in segments:
            by_bucket.setdefault(s.bucket, []).append(s)
        # Spark makes one task of a union whose parts have a single partition each.
        parts = [self._read(held).coalesce(max(2, sum(s.n for s in held) // ROWS_PER_TASK)) for held in by_bucket.values()]
        return reduce(DataFrame.unionByName, parts)

    def _write(self, rows: DataFrame | Iterable[DataFrame], buckets: int) -> tuple[str, list[Segment]]:
        """Write ``rows``, or the parts of them one by one, under a new commit, which no version knows yet."""
        commit = uuid.uuid4().hex
        folder = f"{self.path}/rows/{commit}"
        for part in [rows] if isinstance(rows, DataFrame) else rows:
            self._deal(part, buckets, folder)
        kinds = [*[self.schema[k] for k in self._ranged()], StructField(_BUCKET, IntegerType())]
        stored = self.spark.read.schema(StructType(kinds)).parquet(folder)
        ends = [F.min(k).alias(f"least_{k}") for k in self._ranged()] + [F.max(k).alias(f"most_{k}") for k in self._ranged()]
        found = stored.groupBy(_BUCKET).agg(F.count("*").alias("n"), *ends).collect()

        def side(row, name):
            values = {k: row[f"{name}_{k}"] for k in self._ranged()}
            return tuple(values.get(k) for k in self.keys) if self.keys else None

        return commit, [Segment(commit, r[_BUCKET], r.n, 0, side(r, "least"), side(r, "most")) for r in found]

    def _deal(self, rows: DataFrame, buckets: int, folder: str) -> None:
        """Add ``rows`` to the files of their buckets below ``folder``; shuffle files of steps that have ended go."""
        dealt = rows.select(*self.schema.names).withColumn(_BUCKET, self.bucket(rows, buckets))
        by = [_BUCKET, *([self.partition_by] if self.partition_by else [])]
        if self.partition_by or buckets > WRITERS:
            # Rebalancing makes few files of a small bucket and many of a large one.
            dealt = dealt.hint("rebalance", *[F.col(c) for c in by])
            dealt.write.mode("append").partitionBy(*by).parquet(folder, compression=COMPRESSION)
        else:
            with _writers(rows.sparkSession, buckets):
                dealt.write.mode("append").partitionBy(*by).parquet(folder, compression=COMPRESSION)
        free_shuffles(rows.sparkSession)

    def _write_sources(self, sources: DataFrame | None, commit: str, loader: str) -> list[tuple[str, str]]:
        if sources is None:
            return []
        sources.select(SOURCE).write.parquet(f"{self.path}/sources/{commit}")
        return [(commit, loader)]

    # --- key filters ----------------------------------------------------------------

    def _filtered(self, commit: str, segments: list[Segment]) -> list[Segment]:
        """Write the key filters of a commit's segments; the segments that have them."""
        if not self.keys or not segments:
            return segments
        sized = [replace(s, slots=FILTER_BITS << max(s.n - 1, 1).bit_length()) for s in segments]
        slots = self.spark.createDataFrame([(s.bucket, s.slots) for s in sized], f"{_BUCKET} int, slots long")
        kinds = StructType([*[self.schema[k] for k in self.keys], StructField(_BUCKET, IntegerType())])
        held = self.spark.read.schema(kinds).parquet(f"{self.path}/rows/{commit}").where(all_set(self.keys))
        # A task meets all pieces of its buckets, so single bits are shuffled, once a key, and not its bitmaps.
        bits = held.distinct().join(F.broadcast(slots), _BUCKET).select(_BUCKET, F.explode(self._slots()).alias("slot"))
        placed = bits.withColumn("piece", F.expr("bitmap_bucket_number(slot)")).repartition(_BUCKET, "piece")
        made = placed.groupBy(_BUCKET, "piece").agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
        made.write.parquet(f"{self.path}/filters/{commit}")
        return sized

    def _slots(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(*self.keys, F.lit(i)), F.col("slots")) for i in range(FILTER_HASHES)])

    def _may_hold(self, segments: list[Segment], wanted: DataFrame) -> list[Segment]:
        """Segments whose filter lets at least one key of ``wanted`` (bucket, keys) pass."""
        if not segments:
            return []
        listed = [(s.commit, s.bucket, s.slots) for s in segments]
        asked = self.spark.createDataFrame(listed, f"commit string, {_BUCKET} int, slots long")
        commits = sorted({s.commit for s in segments})
        filters = reduce(
            DataFrame.unionByName,
            [
                self.spark.read.schema(f"{_BUCKET} int, piece long, bits binary")
                .parquet(f"{self.path}/filters/{c}")
                .withColumn("commit", F.lit(c))
                for c in commits
            ],
        )
        key = F.struct(*self.keys).alias("key")
        slots = wanted.join(F.broadcast(asked), _BUCKET).select("commit", _BUCKET, key, F.explode(self._slots()).alias("slot"))
        placed = slots.withColumn("piece", F.expr("bitmap_bucket_number(slot)"))
        set_ = placed.join(filters, ["commit", _BUCKET, "piece"]).where(_bit_is_set("bits", "slot"))
        passed = set_.groupBy("commit", _BUCKET, "key").agg(F.count_distinct("slot").alias("hits"))
        # A key whose slots coincide sets fewer bits.
        distinct = slots.groupBy("commit", _BUCKET, "key").agg(F.count_distinct("slot").alias("wanted"))
        met = passed.join(distinct, ["commit", _BUCKET, "key"]).where("hits = wanted").select("commit", _BUCKET).distinct()
        found = {(r.commit, r[_BUCKET]) for r in met.collect()}
        return [s for s in segments if (s.commit, s.bucket) in found]

    def candidates(self, version: Version, changes: DataFrame) -> tuple[list[Segment], bool]:
        """Segments that can hold a key of ``changes``, by bucket, key range and key filter; whether the keys can be broadcast.

        One line per bucket comes to the driver.
        """
        if not version.segments:
            return [], True
        wanted = changes.where(all_set(self.keys)).select(*self.keys)
        wanted = wanted.withColumn(_BUCKET, self.bucket(wanted, version.buckets))
        ranged = self._ranged()
        ends = [f(k).alias(f"{f.__name__}_{k}") for k in ranged for f in (F.min, F.max)]
        found = wanted.groupBy(_BUCKET).agg(byte_size(wanted).alias("bytes"), F.approx_count_distinct(F.xxhash64(*self.keys)).alias("asked"), *ends).collect()
        asked, fits = {r[_BUCKET]: r for r in found}, sum(r.bytes for r in found) <= self.broadcast_limit
        if not fits:
            # Repeated keys count once in what is broadcast.
            fits = fits_broadcast(wanted.select(*self.keys).distinct(), self.broadcast_limit)

        def overlaps(s: Segment) -> bool:
            row = asked.get(s.bucket)
            if row is None:
                return False
            for k, low, high in zip(self.keys, s.least or (), s.most or ()):
                # Ranges leave out NULLs; a segment without any value holds no key.
                if k in ranged and (low is None or row[f"min_{k}"] > high or row[f"max_{k}"] < low):
                    return False
            return True

        near = [s for s in version.segments if overlaps(s)]
        # So many keys would pass a filter by chance.
        sure = [s for s in near if not s.slots or asked[s.bucket].asked > ASKED]
        return sure + self._may_hold([s for s in near if s not in sure], wanted.distinct()), fits

    # --- reading and changing ---------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest. Later commits don't change what is read."""
        return self._read(self.version(number).segments)

    def read_parts(self, number: int | None = None, rows: int = ROWS_PER_PART) -> list[DataFrame]:
        """The rows of a version in parts of whole buckets with some ``rows`` rows, as far as there are buckets."""
        by_bucket: dict[int, list[Segment]] = {}
        for s in self.version(number).segments:
            by_bucket.setdefault(s.bucket, []).append(s)
        parts: list[list[Segment]] = [[]]
        for held in by_bucket.values():
            if parts[-1] and sum(s.n for s in [*parts[-1], *held]) > rows:
                parts.append([])
            parts[-1] += held
        return [self._read(part) for part in parts]

    def replace(
        self,
        rows: DataFrame | Iterable[DataFrame],
        sources: DataFrame | None = None,
        loader: str = "bulk",
        offsets: dict[str, int] | None = None,
    ) -> Version:
        """Full refresh: the next version holds ``rows`` only, which may come in parts. Older versions stay readable.

        ``offsets`` says how far each loader's data is in it.
        """
        last = self.version()
        base = Version(last.number, self.buckets if self.keys else 1, offsets=offsets or {})
        commit, segments = self._write(rows, base.buckets)
        segments = self._filtered(commit, segments)
        taken = self._write_sources(sources, commit, loader)
        return self._commit(replace(base, segments=tuple(segments), sources=tuple(taken)))

    def append(self, rows: DataFrame, sources: DataFrame | None = None, loader: str = "bulk") -> Version:
        """Add all ``rows``."""
        return self._add(self.version(), rows, (), sources, loader, None)

    def appended(self, since: int) -> tuple[DataFrame, int]:
        """Rows that commits after version ``since`` added, and the newest version's number.

        For a table that is only added to: rows of a replacement count as added.
        """
        last = self.version()
        before = {(s.commit, s.bucket) for s in self.version(since).segments} if since else set()
        return self._read([s for s in last.segments if (s.commit, s.bucket) not in before]), last.number

    def unknown_sources(self, version: Version, files: DataFrame, loader: str | None) -> DataFrame:
        """Names in ``files`` that no other loader than ``loader`` has taken in."""
        others = [f"{self.path}/sources/{commit}" for commit, name in version.sources if name != loader]
        if not others:
            return files
        taken = self.spark.read.schema(_SOURCES).parquet(*others)
        known = taken.join(F.broadcast(files), SOURCE, "left_semi")
        return files.join(known, SOURCE, "left_anti")

    def insert_absent(
        self,
        changes: DataFrame,
        sources: DataFrame | None = None,
        loader: str = "bulk",
        batch: int | None = None,
        since: Version | None = None,
    ) -> Version:
        """Add the rows of ``changes`` whose key is not held; rows of one key stay together, NULL keys are always added.

        With ``batch`` the commit also notes that the loader got so far; a batch that was
        committed before changes nothing.
        """
        last = since or self.version()
        if batch is not None and last.offsets.get(loader, -1) >= batch:
            return last
        held, fits = self.candidates(last, changes)
        if not held or fits or last.buckets == 1 or self.partition_by:
            absent = insert_absent(self._read(held), changes, self.keys, fits=fits) if held else changes
            return self._add(last, absent, (), sources, loader, batch)
        # Rows and held keys that are too large to broadcast meet in a shuffle, for some buckets at a time.
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._deal(changes, last.buckets, staged)
        done = self._add(last, self._absent_parts(last, held, staged), (), sources, loader, batch)
        remove(self.spark, staged)
        return done

    def _absent_parts(self, last: Version, held: list[Segment], staged: str) -> Iterator[DataFrame]:
        """Rows below ``staged`` whose key is not held, by groups of buckets; what is written before the next is asked for is deleted."""
        step, kinds = -(-last.buckets // SHUFFLES), StructType([*self.schema, StructField(_BUCKET, IntegerType())])
        for first in range(0, last.buckets, step):
            group = range(first, min(first + step, last.buckets))
            rows = self.spark.read.schema(kinds).parquet(staged).where(F.col(_BUCKET).isin(*group)).drop(_BUCKET)
            near = [s for s in held if s.bucket in group]
            yield insert_absent(self._read(near), rows, self.keys, fits=False) if near else rows
            for bucket in group:
                remove(self.spark, f"{staged}/{_BUCKET}={bucket}")

    def _absent(self, last: Version, changes: DataFrame) -> DataFrame:
        held, fits = self.candidates(last, changes)
        return insert_absent(self._read(held), changes, self.keys, fits=fits) if held else changes

    def _add(self, last, rows, gone, sources, loader, batch) -> Version:
        commit, segments = self._write(rows, last.buckets)
        offsets = last.offsets if batch is None else {**last.offsets, loader: batch}
        kept = [s for s in last.segments if s.bucket not in gone]
        taken = self._write_sources(sources, commit, loader)
        return self._commit(
            replace(last, segments=(*kept, *segments), sources=(*last.sources, *taken), offsets=offsets)
        )

    def merge(
        self, changes: DataFrame, sources: DataFrame | None = None, loader: str = "bulk", batch: int | None = None
    ) -> Version:
        """Apply updates, deletes and inserts (see ``shoplake.operators.merge``) and commit the result.

        Only buckets that can hold an updated or deleted key are written anew; inserted
        rows are added. ``changes`` is read several times: store it first.
        """
        last = self.version()
        if batch is not None and last.offsets.get(loader, -1) >= batch:
            return last
        is_insert, is_delete = F.col(ACTION) == INSERT, F.col(ACTION) == DELETE
        firing = changes.where((is_insert & F.col(IS_UPDATE)) | (is_delete & ~F.col(IS_UPDATE)))
        touched = {s.bucket for s in self.candidates(last, firing)[0]}
        old = self._read([s for s in last.segments if s.bucket in touched])
        fresh = changes.where(is_insert & ~F.col(IS_UPDATE)).select(*self.schema.names)
        absent = self._absent(last, fresh)
        rows = updated(old, firing, self.keys, self.broadcast_limit).unionByName(absent) if touched else absent
        return self._add(last, rows, touched, sources, loader, batch)

    # --- upkeep -----------------------------------------------------------------------

    def compact(self, max_segments: int = 1) -> Version:
        """Join small segments of buckets with more than ``max_segments``, in tiers of size.

        Of a bucket the smallest segments are joined, as long as the next one is at most
        twice as large as those before it together: a row is written anew some log2 times.
        Names of raw files are joined for each loader. No row changes.
        """
        last = self.version()
        by_bucket: dict[int, list[Segment]] = {}
        for s in sorted(last.segments, key=lambda s: s.n):
            by_bucket.setdefault(s.bucket, []).append(s)
        chosen: list[Segment] = []
        for held in by_bucket.values():
            if len(held) > max_segments:
                tier, total = held[:2], held[0].n + held[min(1, len(held) - 1)].n
                for s in held[2:]:
                    if s.n > 2 * total and len(held) - len(tier) < max_segments:
                        break
                    tier, total = [*tier, s], total + s.n
                chosen += tier if len(tier) > 1 else []
        sources = list(last.sources)
        loaders = [name for name, n in Counter(name for _, name in sources).items() if n > max_segments]
        if not chosen and not loaders:
            return last
        commit, made = uuid.uuid4().hex, []
        if chosen:
            commit, made = self._write(self._gathered(chosen, last.buckets), last.buckets)
            made = self._filtered(commit, made)
        for i, name in enumerate(sorted(loaders)):
            folders = [f"{self.path}/sources/{c}" for c, n in sources if n == name]
            joined = self._write_sources(self.spark.read.schema(_SOURCES).parquet(*folders).coalesce(1), f"{commit}-{i}", name)
            sources = [s for s in sources if s[1] != name] + joined
        gone = set(chosen)
        kept = [s for s in last.segments if s not in gone]
        return self._commit(replace(last, segments=(*kept, *made), sources=tuple(sources)))

    def expire(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions, and the files that only they use.

        Files of commits that never became a version go too, so nobody may be writing.
        """
        known = self.versions()
        stays = [self.version(n) for n in known[-keep:]]
        commits = {s.commit for v in stays for s in v.segments} | {c for v in stays for c, _ in v.sources}
        for n in known[:-keep]:
            remove(self.spark, f"{self.path}/versions/version={n}")
        for kind in ("rows", "filters", "sources", "staged"):
            for name in self._commits(kind) - commits:
                remove(self.spark, f"{self.path}/{kind}/{name}")

    def _commits(self, kind: str) -> set[str]:
        try:
            files = self.spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(f"{self.path}/{kind}").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()
        return {found[1] for found in (re.search(rf"/{kind}/([^/]+)/", f) for f in files) if found}


def replace_table(df: DataFrame | Sequence[DataFrame], path: str, partition_by: str | None = None) -> DataFrame:
    """Full refresh that readers of the old table survive, of a table or its parts; returns the stored table."""
    first = df if isinstance(df, DataFrame) else df[0]
    table = VersionedTable(first.sparkSession, path, first.schema, partition_by=partition_by)
    table.replace(df)
    return table.read()


__all__ = ["BUCKETS", "MAX_SEGMENTS", "SOURCE", "Segment", "Version", "VersionedTable", "replace_table"]
