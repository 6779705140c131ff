"""Upsert, anti-join and latest-row operators on merge keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.clean import cast_in_range
from zonemill.functions.columns import col, find, require
from zonemill.functions.keys import MergeKeys
from zonemill.layout import INSERTED_COLUMN, UPDATED_COLUMN
from zonemill.session import fits_broadcast, size_in_bytes

# Rows of one key that a task can take. Every key with more is spread over tasks.
HEAVY_ROWS = 100_000
# Bits of the digest of source keys, the most keys it is made for, and the least bytes of a key in a size estimate.
DIGEST_BITS, DIGEST_KEYS, KEY_BYTES = 1 << 28, 1 << 25, 8
AUDIT_MODES = ("null", "preserve", "none")


class Upsert:
    """Target after an upsert of ``source``, as a whole or as changed and unchanged rows.

    A matched row takes every source column and keeps the columns only the target has.
    An unmatched source row is inserted, with NULL in those columns. Target rows without
    a match stay.

    ``columns`` limits the source to its keys and these columns. ``audit`` says what
    happens to the two audit columns: ``"null"`` clears the insert date on update and
    the update date on insert, ``"preserve"`` keeps the target's insert date instead,
    ``"none"`` treats them like any column. Several source rows matching one target
    row raise when the result is computed; ``on_duplicate="latest"`` keeps the first
    row by ``order_by`` of every key. A source column that the target lacks raises
    unless ``evolve`` is set.

    The target is never shuffled when Spark can broadcast the source. Otherwise the rows of
    target and source go through one exchange by key, together, and meet one row per key of
    what both sides hold (see :meth:`_met`): three exchanges in all. The facts of a key are
    aggregated in the tasks that read it, and the join is one of plain exchanges, so adaptive
    execution can split a heavy key of either side. With ``on_duplicate="latest"`` the source
    is ranked first, its one row per key joined to the target's rows for the updates, and to
    the target's distinct keys for the inserts. Nothing runs until the result is computed.
    """

    def __init__(
        self,
        target: DataFrame,
        source: DataFrame,
        keys: Sequence[str],
        *,
        columns: Sequence[str] | None = None,
        audit: str = "null",
        on_duplicate: str = "error",
        order_by: Sequence[str | Column] = (),
        evolve: bool = False,
    ):
        if audit not in AUDIT_MODES:
            raise ValueError(f"audit must be one of {AUDIT_MODES}, not {audit!r}")
        if on_duplicate not in ("error", "latest"):
            raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
        self._target, self._audit = target, audit
        self._on = on = MergeKeys(target, list(keys), "the target")
        if on_duplicate == "latest":
            source = latest_per_key(keys_as(target, source, on), on.names, order_by)
        self._batch = batch = _aligned(target, source, on, columns, evolve)
        self._added = [f for f in batch.schema if f.name not in target.columns]
        # Whether Spark will broadcast the source keys, and whether all of the source.
        self.small_keys = fits_broadcast(on.project(batch))
        self._small_source = self.small_keys and fits_broadcast(batch)
        self._changes = None
        if on_duplicate == "latest":
            self._changes, self._inserts = _unique(target, batch, on, self.small_keys)
        elif self.small_keys:
            self._changes, self._inserts = _checked(target, batch, on, self._small_source)

    def result(self) -> DataFrame:
        """All rows, from one pass over the full target rows."""
        if self._changes is None:
            return self._met(F.lit(True))
        return self._updates("left").union(self._inserted())

    def changed(self) -> DataFrame:
        """Updated and inserted rows; with small keys only matched target rows are shuffled."""
        if self._changes is None:
            return self._met(F.col("_n") > 0)
        return self._updates("inner").union(self._inserted())

    def _met(self, wanted: Column) -> DataFrame:
        """Target rows that are ``wanted`` and new source rows, by one exchange of all rows.

        One side holds the rows of both tables, source rows as they would be inserted. The other
        holds one row per key: the number of its source rows, whether the target has it, and the
        values of a single source row. So each row knows by its key alone whether it is updated,
        kept, inserted, dropped, or an error. Columns carry numbers in place of names, which may
        clash between the sides; those that a query does not use reach neither exchange.
        """
        on, target, batch = self._on, self._target, self._batch
        fields, given = [*target.schema, *self._added], batch.columns
        held = on.project(
            target,
            F.lit(False).alias("_new"),
            *[(col(f.name) if f.name in target.columns else F.lit(None).cast(f.dataType)).alias(f"_c{i}") for i, f in enumerate(fields)],
        )
        new = on.project(
            batch.alias("s"),
            F.lit(True).alias("_new"),
            *[_inserted(f, f.name in given, self._audit).alias(f"_c{i}") for i, f in enumerate(fields)],
        )
        told = on.project(batch, F.lit(1).alias("_n"), F.lit(False).alias("_held"), *[col(c).alias(f"_s{i}") for i, c in enumerate(given)])
        known = on.project(
            target.select(*map(col, on.names)),
            F.lit(0).alias("_n"),
            F.lit(True).alias("_held"),
            *[F.lit(None).cast(batch.schema[c].dataType).alias(f"_s{i}") for i, c in enumerate(given)],
        )
        # By key and part: the join then takes a plain exchange, which can be split.
        part = F.pmod(F.xxhash64(*on.labels), F.lit(2)).alias("_part")
        facts = told.union(known).groupBy(*on.labels, part).agg(
            F.sum("_n").alias("_n"),
            F.max("_held").alias("_held"),
            *[F.first(f"_s{i}", ignorenulls=True).alias(f"_s{i}") for i in range(len(given))],
        ).drop("_part")
        several = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
        kept = F.when(F.col("_new"), ~F.col("_held")).when(F.col("_n") > 1, several).otherwise(wanted)
        met = held.union(new).join(facts, on.labels).filter(kept)
        hit = ~F.col("_new") & (F.col("_n") == 1)
        columns = []
        for i, field in enumerate(fields):
            value = F.col(f"_c{i}")
            if field.name in given and not (self._audit == "preserve" and field.name == INSERTED_COLUMN):
                cleared = self._audit == "null" and field.name == INSERTED_COLUMN
                value = F.when(hit, F.lit(None) if cleared else F.col(f"_s{given.index(field.name)}")).otherwise(value)
            columns.append(value.alias(field.name))
        return met.select(columns)

    def unchanged(self) -> DataFrame:
        """Target rows without a match; with small keys they stay in the tasks that read them."""
        kept = self._by_keys("left_anti")
        return kept.select("t.*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in self._added])

    def _by_keys(self, how: str) -> DataFrame:
        given = self._on.project(self._batch)
        return self._target.alias("t").join(given.alias("k"), self._on.match_projected("t", "k"), how)

    def _updates(self, how: str) -> DataFrame:
        held = self._target.alias("t")
        if how == "inner" and self.small_keys and not self._small_source:
            held = self._by_keys("left_semi").select("t.*").alias("t")
        hit = self._changes.withColumn("_hit", F.lit(True))
        joined = held.join(hit.alias("s"), self._on.match("t", "s"), how)
        given = self._batch.columns
        return joined.select(
            *[_updated(c, c in given, self._audit).alias(c) for c in self._target.columns], *self._extra()
        )

    def _inserted(self) -> DataFrame:
        given = self._batch.columns
        return self._inserts.select(
            *[_inserted(f, f.name in given, self._audit).alias(f.name) for f in self._target.schema], *self._extra()
        )

    def _extra(self) -> list[Column]:
        return [col(f.name, "s").alias(f.name) for f in self._added]


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], **options: object) -> DataFrame:
    """Target after an upsert of ``source``; rules and options are those of :class:`Upsert`."""
    return Upsert(target, source, keys, **options).result()


def _unique(target: DataFrame, batch: DataFrame, on: MergeKeys, small_keys: bool) -> tuple[DataFrame, DataFrame]:
    """Source rows for the update join and source rows to insert, for a source without repeated keys."""
    seen, wanted = on.project(target), on.project(batch)
    if small_keys:
        seen = seen.join(wanted, on.labels, "left_semi")
    inserts = batch.alias("s").join(seen.distinct().alias("m"), on.match_projected("s", "m"), "left_anti")
    return batch, inserts


def _checked(target: DataFrame, batch: DataFrame, on: MergeKeys, small_source: bool) -> tuple[DataFrame, DataFrame]:
    """Source rows for the update join and source rows to insert, where the source keys can be broadcast.

    A repeated source key raises where it matches. Elsewhere all its rows are inserted,
    however many there are: they are salted over many tasks, and as they cannot match,
    the matched keys need no copies per salt.
    """
    counts = on.project(batch).groupBy(on.labels).agg(F.count(F.lit(1)).alias("_n"))
    seen = on.project(target)
    if not fits_broadcast(counts):
        seen = seen.distinct()
    batch = batch.withColumn("_salt", F.lit(0)) if small_source else _salted_repeats(batch, counts, on, small=True)
    # The aggregate keeps the check off unmatched keys: Spark moves no test through it.
    matched = seen.join(counts, on.labels).groupBy(on.labels).agg(F.max("_n").alias("_n"))
    several = F.raise_error(F.lit("several source rows match one target row"))
    matched = matched.select(
        *on.labels, F.when(F.col("_n") > 1, several).otherwise(F.lit(0)).cast("int").alias("_salt")
    )
    inserts = batch.alias("s").join(
        matched.alias("m"),
        on.match_projected("s", "m") & (F.col("s._salt") == F.col("m._salt")),
        "left_anti",
    )
    return batch.filter("_salt = 0").drop("_salt"), inserts


def _updated(name: str, given: bool, audit: str) -> Column:
    kept = col(name, "t")
    if not given or (audit == "preserve" and name == INSERTED_COLUMN):
        return kept
    value = F.lit(None) if audit == "null" and name == INSERTED_COLUMN else col(name, "s")
    return F.when(col("_hit", "s"), value).otherwise(kept)


def _inserted(field: T.StructField, given: bool, audit: str) -> Column:
    if not given or (audit != "none" and field.name == UPDATED_COLUMN):
        return F.lit(None).cast(field.dataType)
    return col(field.name, "s")


def keys_as(target: DataFrame, source: DataFrame, on: MergeKeys) -> DataFrame:
    """Source with its key columns named and typed as in the target."""
    found = dict(zip(require(source, on.names, "the source"), on.names))
    return source.select(
        [
            col(c).cast(target.schema[found[c]].dataType).alias(found[c]) if c in found else col(c)
            for c in source.columns
        ]
    )


def _aligned(
    target: DataFrame, source: DataFrame, on: MergeKeys, columns: Sequence[str] | None, evolve: bool
) -> DataFrame:
    """The wanted source columns, named and typed as in the target."""
    key_columns = require(source, on.names, "the source")
    types = {f.name: f.dataType for f in target.schema}
    given_types = {f.name: f.dataType for f in source.schema}
    wanted = source.columns
    if columns is not None:
        named = require(source, columns, "the source")
        wanted = [c for c in source.columns if c in key_columns or c in named]
    picked = []
    for name in wanted:
        match = find(target, name)
        if match is not None:
            value = cast_in_range(name, col(name), given_types[name], types[match])
            picked.append(value.alias(match))
        elif evolve:
            picked.append(col(name))
        else:
            raise ValueError(f"the target has no column {name!r}; set evolve to add it")
    return source.select(picked)


def _salted_repeats(batch: DataFrame, counts: DataFrame, on: MergeKeys, small: bool = False) -> DataFrame:
    """Spread the rows of every source key with more than ``HEAVY_ROWS`` rows over many tasks.

    The salt is the input partition, which a retried task keeps. Rows of all other keys
    have salt 0. ``small`` says that all keys together are within Spark's broadcast limit in
    bytes, so the heavy ones are too.
    """
    heavy = counts.filter(F.col("_n") > HEAVY_ROWS)
    if small:
        heavy = F.broadcast(heavy)
    # Taken before the join, which may bring all rows of a key to one partition.
    given = batch.withColumn("_from", 1 + F.spark_partition_id())
    return (
        given.alias("s")
        .join(heavy.alias("h"), on.match_projected("s", "h"), "left")
        .withColumn("_salt", F.when(F.col("h._n").isNotNull(), F.col("_from")).otherwise(F.lit(0)).cast("int"))
        .select("s.*", "_salt")
        .drop("_from")
    )


def missing_from_source(
    target: DataFrame, source: DataFrame, keys: Sequence[str], prefilter: bool = False
) -> DataFrame:
    """Target rows whose key the source does not hold.

    A source too large to broadcast meets the target by key. Its distinct keys are found by
    key and part, so that both sides of the join are plain exchanges and adaptive execution
    can split a heavy target key over tasks, however many such keys there are.

    With ``prefilter``, which pays where most target rows have no match, such a source is
    first digested to a bit set of its hashed keys, of ``DIGEST_BITS`` at most, which is
    broadcast. A target row whose bit is not set has no match: the task that reads it hands
    it on. Only the others are shuffled. Beyond ``DIGEST_KEYS`` source keys, by Spark's size
    estimate, the digest would tell too little, and all rows are shuffled.
    """
    on = MergeKeys(target, list(keys), "the target")
    given = on.project(keys_as(target, source, on))
    part = F.pmod(F.xxhash64(*on.labels), F.lit(2)).alias("_part")
    present = given.groupBy(*on.labels, part).agg(F.lit(1).alias("_one")).select(*on.labels)
    met, by_key = target.alias("t"), on.match_projected("t", "p")
    if not prefilter or fits_broadcast(given) or size_in_bytes(given) > DIGEST_KEYS * KEY_BYTES:
        return met.join(present.alias("p"), by_key, "left_anti")
    possible = _may_be_held(target, given, on)
    absent = possible.filter(~F.col("_may")).select("t.*")
    doubtful = possible.filter(F.col("_may")).select("t.*").alias("t")
    return absent.union(doubtful.join(present.alias("p"), by_key, "left_anti"))


def _may_be_held(target: DataFrame, given: DataFrame, on: MergeKeys) -> DataFrame:
    """Target rows ``t`` with ``_may``: whether the digest of the ``given`` keys has their bit.

    The digest is a bit set in rows of 4 KB, fewer than ``DIGEST_BITS / 32768`` of them.
    """
    place = F.xxhash64(*on.labels).bitwiseAND(F.lit(DIGEST_BITS - 1))
    digest = given.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
    digest = digest.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    place = F.xxhash64(*on.columns("t")).bitwiseAND(F.lit(DIGEST_BITS - 1))
    found = target.alias("t").join(F.broadcast(digest.alias("d")), F.bitmap_bucket_number(place) == F.col("d._bucket"), "left")
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("d._bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))
    return found.withColumn("_may", F.coalesce(byte.bitwiseAND(mask) > 0, F.lit(False)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order_by``.

    Names in ``order_by`` sort the greatest value first and NULL last; sort expressions
    are taken as they are. The order should be total, or ties pick any row. Spark keeps
    one row per key in every task before it shuffles.
    """
    if not order_by:
        raise ValueError("latest_per_key needs an order")
    order = [col(*require(df, [o], "the table")).desc_nulls_last() if isinstance(o, str) else o for o in order_by]
    ranked = Window.partitionBy(*MergeKeys(df, list(keys)).columns()).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
