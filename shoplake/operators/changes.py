"""Change feeds and keyed merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, MapType, StringType, StructType, VariantType

from shoplake.operators.lookup import BROADCAST_BYTES, all_set, byte_size, lookup
from shoplake.storage import materialize

# Change metadata: INSERT or DELETE, and whether the row is half of an update.
ACTION = "_action"
IS_UPDATE = "_is_update"
INSERT = "INSERT"
DELETE = "DELETE"

# Rows that are counted in sequence, or copies that are made of a row, at once.
_CHUNK_ROWS = 4_000


def append_feed(df: DataFrame) -> DataFrame:
    """Rows added to an append-only table, as changes."""
    return df.withColumns({ACTION: F.lit(INSERT), IS_UPDATE: F.lit(False)})


def _complex(kind: DataType) -> bool:
    """Whether values of the type hold a variant or a map, which can be neither grouped nor compared."""
    if isinstance(kind, StructType):
        return any(_complex(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _complex(kind.elementType)
    return isinstance(kind, VariantType | MapType)


def canonical(value: Column, kind: DataType) -> Column:
    """A form of the value that can be grouped and is equal for equal values.

    A variant becomes the digest of its text, whose fields are in order of their names; a
    map becomes its entries in order of their keys. NULL stays NULL.
    """
    if not _complex(kind):
        return value
    if isinstance(kind, VariantType):
        return F.sha2(F.to_json(value), 256)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, MapType):
        entry = lambda e: F.struct(canonical(e["key"], kind.keyType).alias("k"), canonical(e["value"], kind.valueType).alias("v"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    fields = [canonical(value[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(kind)]
    return F.when(value.isNotNull(), F.struct(*fields))


def _earlier(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, name: str, chunks: int
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` over the group's rows before this one.

    The order is by chunk, a hash of ``order``, then by ``order``. Only one sum per
    group and chunk is added up in sequence, so a large group covers many tasks.
    """
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sums = dealt.groupBy(*group, "_chunk").agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*group, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(amount).over(within), F.lit(0))
    return dealt.join(bases, [*group, "_chunk"]).withColumn(name, F.col("_base") + here).drop("_base", "_chunk")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that turn ``old`` into ``new``, both multisets of rows of any column types.

    Rows that both sides hold equally often cancel out, also where a key is NULL or has
    several rows. Of what is left of a key with n old and m new rows, min(n, m) pairs are
    updates: DELETE of an old row and INSERT of a new one, both marked as parts of an
    update. The others are plain DELETEs or INSERTs, as are all rows whose key is NULL.

    Equal rows are counted before they are shuffled and no row meets another, so neither
    copies nor a key with many rows pile up. Only changed rows are stored and paired.
    """
    keys, schema = list(keys), old.schema
    names = [f"_c{i}" for i in range(len(schema))]
    plain = [canonical(F.col(f.name), f.dataType).alias(n) for f, n in zip(schema, names)]
    kept = {f"_v{i}": f.name for i, f in enumerate(schema) if _complex(f.dataType)}
    held = [F.col(c).alias(v) for v, c in kept.items()]
    both = old.select(*plain, *held, F.lit(-1).alias("_side")).union(new.select(*old.columns).select(*plain, *held, F.lit(1).alias("_side")))
    net = both.groupBy(*names).agg(F.sum("_side").alias("_net"), *[F.first(v, ignorenulls=True).alias(v) for v in kept])
    changed = materialize(net.where("_net <> 0").withColumn("_n", F.abs("_net")), "changed-rows")

    ids = [names[schema.names.index(k)] for k in keys]
    gone = F.sum(F.when(F.col("_net") < 0, F.col("_n")).otherwise(0))
    came = F.sum(F.when(F.col("_net") > 0, F.col("_n")).otherwise(0))
    per_key = changed.where(all_set(ids)).groupBy(*ids).agg(gone.alias("_gone"), came.alias("_came"), F.count("*").alias("_rows"))
    per_key = per_key.withColumn("_pairs", F.least("_gone", "_came"))
    # Of most keys all rows that are left are in pairs, or none is. The others' pairs are counted out.
    partly = (F.col("_pairs") > 0) & (F.col("_gone") != F.col("_came"))
    met = changed.join(per_key, ids, "left")
    updates = F.when(F.col("_pairs") > 0, F.col("_n")).otherwise(F.lit(0).cast("long"))
    columns = [*names, *kept, "_net", "_n", "_updates"]
    decided = met.where(F.coalesce(~partly, F.lit(True))).withColumn("_updates", updates).select(*columns)
    ambiguous = per_key.agg(F.sum(F.when(partly, F.col("_rows")))).first()[0]
    if ambiguous:
        rest = met.where(partly).withColumn("_is_new", F.col("_net") > 0)
        placed = _earlier(rest, [*ids, "_is_new"], names, "_n", "_before", -(-ambiguous // _CHUNK_ROWS))
        some = F.greatest(F.lit(0).cast("long"), F.least("_n", F.col("_pairs") - F.col("_before")))
        decided = decided.unionByName(placed.withColumn("_updates", some).select(*columns))
    # Each row as often as it changed, in runs of bounded length.
    runs = F.array(
        F.struct(F.lit(True).alias("update"), F.col("_updates").alias("n")),
        F.struct(F.lit(False).alias("update"), (F.col("_n") - F.col("_updates")).alias("n")),
    )
    one = decided.withColumn("_run", F.explode(F.filter(runs, lambda r: r["n"] > 0)))
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_run.n") - 1, F.lit(_CHUNK_ROWS).cast("long")))
    part = one.withColumn("_from", step).withColumn("_many", F.least(F.lit(_CHUNK_ROWS), F.col("_run.n") - F.col("_from")))
    copies = part.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_many").cast("int"))))
    values = [F.col(n).alias(f.name) for f, n in zip(schema, names)]
    for v, c in kept.items():
        values[schema.names.index(c)] = F.col(v).alias(c)
    action = F.when(F.col("_net") < 0, DELETE).otherwise(INSERT)
    return copies.select(*values, action.alias(ACTION), F.col("_run.update").alias(IS_UPDATE))


def insert_absent(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_BYTES,
    fits: bool | None = None,
) -> DataFrame:
    """Rows of ``changes`` whose key ``target`` does not hold.

    Rows of one key within ``changes`` stay together, and NULL keys are always
    absent. Only the key columns of ``target`` are read, and only row groups that
    can hold keys between the least and the greatest wanted one. While the wanted
    keys are small they are broadcast and ``target`` is not shuffled. ``fits`` skips
    measuring them, and their range, when the caller has done it.
    """
    keys = list(keys)
    wanted = changes.where(all_set(keys)).select(*keys).distinct()
    held = target.where(all_set(keys)).select(*keys)
    if fits is None:
        ranged = [f.name for f in wanted.schema if isinstance(f.dataType, StringType | IntegralType)]
        seen = wanted.agg(
            byte_size(wanted).alias("_bytes"),
            *[F.min(k).alias(f"_least_{k}") for k in ranged],
            *[F.max(k).alias(f"_most_{k}") for k in ranged],
        ).first()
        for k in ranged:
            held = held.where(F.col(k).between(F.lit(seen[f"_least_{k}"]), F.lit(seen[f"_most_{k}"])))
        fits = seen["_bytes"] <= broadcast_limit
    if fits:
        present = held.join(F.broadcast(wanted), keys, "left_semi").distinct()
    else:
        present = held.distinct().join(wanted, keys, "left_semi")
    marked = present.withColumn("_held", F.lit(True))
    return lookup(changes, marked, keys, fits=fits).where("_held is null").drop("_held")


def updated(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``target`` with the updates and deletes of ``changes`` applied.

    Matched INSERT halves of updates replace all non-key columns, matched plain DELETEs
    remove. Several DELETEs of a key delete as one does; two updates of a target row, or an
    update and a DELETE, are an error.
    """
    keys = list(keys)
    columns = target.columns
    payload = [c for c in columns if c not in keys]
    is_insert = F.col(ACTION) == INSERT
    is_delete = F.col(ACTION) == DELETE

    firing = changes.where(
        all_set(keys) & ((is_insert & F.col(IS_UPDATE)) | (is_delete & ~F.col(IS_UPDATE)))
    )
    per_key = (
        firing.groupBy(*keys)
        .agg(
            F.count_if(~is_delete).alias("_updates"),
            F.count_if(is_delete).alias("_deletes"),
            F.first(F.struct(is_delete.alias("gone"), *payload)).alias("_to"),
        )
        .select(
            *keys,
            ((F.col("_updates") > 1) | ((F.col("_updates") > 0) & (F.col("_deletes") > 0))).alias("_clash"),
            F.col("_to.gone").alias("_gone"),
            *[F.col(f"_to.{c}").alias(f"_to_{c}") for c in payload],
        )
    )
    clash = F.raise_error(F.lit("several changes update or delete one target row"))
    stays = F.when(F.col("_clash"), clash.cast("boolean")).otherwise(
        F.coalesce(~F.col("_gone"), F.lit(True))
    )
    return (
        lookup(target, per_key, keys, broadcast_limit=broadcast_limit)
        .where(stays)
        .select(
            *[
                F.when(F.col("_gone").isNull(), F.col(c)).otherwise(F.col(f"_to_{c}")).alias(c)
                if c in payload
                else F.col(c)
                for c in columns
            ]
        )
    )


def merge(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Apply ``changes`` to ``target``: ``updated``, and unmatched plain INSERTs are added.

    Every other combination does nothing.
    """
    kept = updated(target, changes, keys, broadcast_limit)
    fresh = changes.where((F.col(ACTION) == INSERT) & ~F.col(IS_UPDATE)).select(*target.columns)
    return kept.unionByName(insert_absent(target, fresh, keys, broadcast_limit))
