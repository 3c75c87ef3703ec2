"""Column and DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MONEY = "decimal(21,6)"
TOTAL = "decimal(38,6)"
REPEAT_STEP = 10_000
LEDGER_DAY = "ledger_day"  # a clustered ledger's column, by which it is laid out


def lot_key(column: Column) -> Column:
    """Join key under which a missing lot equals an empty one."""
    return F.coalesce(column, F.lit(""))


def expiry_key(column: Column) -> Column:
    """Join key under which a missing expiry equals 1900-01-01."""
    return F.coalesce(column.cast("date"), F.lit("1900-01-01").cast("date"))


def day_of(ledger: DataFrame) -> Column:
    """The calendar day of a ledger row: stored in a clustered ledger, else worked out."""
    return F.col(LEDGER_DAY) if LEDGER_DAY in ledger.columns else F.to_date("ref_date")


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(Decimal(0)))


def number_text(column: Column) -> Column:
    """Plain decimal text at scale 6, in ANSI and non-ANSI sessions alike."""
    value = column.cast(TOTAL)
    return F.when(value == 0, F.lit("0.000000")).otherwise(value.cast("string"))


def stable_id(*parts: Column) -> Column:
    """36-character id that a recomputed stage gives again."""
    digest = F.sha2(F.concat_ws("|", *[blank(part) for part in parts]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def blank(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def finding_key(check: str, *ids: Column) -> Column:
    """Digest of the check name and its ids; a null id is left out."""
    return F.sha2(F.concat_ws("|", F.lit(check), *[part.cast("string") for part in ids]), 256)


class MissingColumns(ValueError):
    """Input tables lack columns that a job reads."""


def require(frames: Mapping[str, DataFrame], needed: Mapping[str, Iterable[str]]) -> None:
    """Raise unless every table has the columns needed of it; all that lack are named."""
    lacking = {
        name: sorted(set(columns) - set(frames[name].columns)) for name, columns in needed.items()
    }
    told = [f"{name}: {', '.join(columns)}" for name, columns in lacking.items() if columns]
    if told:
        raise MissingColumns("; ".join(told))


def conform(frame: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The schema's columns in its order; a column the frame lacks is a typed null."""
    have = set(frame.columns)
    return frame.select(
        *[
            (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in schema.items()
        ]
    )


def add_missing(frame: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The frame's own columns plus typed nulls for the schema's others."""
    have = set(frame.columns)
    return frame.select(
        "*", *[null_of(kind).alias(name) for name, kind in schema.items() if name not in have]
    )


def keys_of(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct keys: equal rows collapse on the map side, before any shuffle,
    so a key with very many rows reaches its join as one row per map task."""
    return frame.select(*columns).distinct()


HASH_SETTING = "spark.sql.legacy.collationAwareHashFunctions"


def _collated(frame: DataFrame, on: Iterable[str]) -> bool:
    """Whether a key column compares by anything but its bytes."""
    kinds = [frame.schema[name].dataType for name in on]
    return any(isinstance(kind, StringType) and kind.collation != "UTF8_BINARY" for kind in kinds)


def hashes_alike(frame: DataFrame, on: Iterable[str]) -> bool:
    """Whether equal keys have equal hashes: see HASH_SETTING."""
    return frame.sparkSession.conf.get(HASH_SETTING, "false") == "true" or not _collated(frame, on)


def join_spread(
    left: DataFrame, right: DataFrame, on: list[str], how: str, apart: str | None = None
) -> DataFrame:
    """A join that stays splittable when one key holds very many rows of `left`.

    Adaptive execution splits a hot partition only where both sides come straight
    from a shuffle made for the join. A side that is already laid out by the same
    keys, as after a grouping, would hide that; the hash as a further key gives
    both sides a shuffle of their own. A side small enough is still broadcast.

    `apart` names a column of `left` that is set only where a key is null: it spreads
    rows that have no partner. Keys under a collation are equal where their hashes are
    only if the session hashes by collation (HASH_SETTING, which `tune` sets); without
    that such keys take the plain join."""
    if not (hashes_alike(left, on) and hashes_alike(right, on)):
        return left.join(right, on, how)
    keys = [F.col(name) for name in on]
    # a null adds nothing to the hash, so keys without one hash alike on both sides
    return (
        left.withColumn("_spread", F.xxhash64(*keys, *([F.col(apart)] if apart else [])))
        .join(right.withColumn("_spread", F.xxhash64(*keys)), ["_spread", *on], how)
        .drop("_spread")
    )


def without(
    left: DataFrame, right: DataFrame, on: list[str], hot: bool = False
) -> DataFrame:
    """Rows of `left` that have no partner in `right`. `hot`: a key may hold very many
    rows of `left`, as for a foreign key; a row's own id needs no such care."""
    join = join_spread if hot else DataFrame.join
    return join(left, keys_of(right, on), on, "left_anti")


def within(
    left: DataFrame, right: DataFrame, on: list[str], hot: bool = False
) -> DataFrame:
    """Rows of `left` that have a partner in `right`; `hot` as above."""
    join = join_spread if hot else DataFrame.join
    return join(left, keys_of(right, on), on, "left_semi")


def repeat_rows(frame: DataFrame, copies: Column) -> DataFrame:
    """Each row `copies` times, through two short lists rather than one long one."""
    last = F.col("_copies") - 1
    step = F.lit(REPEAT_STEP)
    return (
        frame.withColumn("_copies", copies.cast("bigint"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor(last / step).cast("bigint"))))
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(
                    F.lit(0).cast("bigint"),
                    F.least(step - 1, last - F.col("_block") * step).cast("bigint"),
                )
            ),
        )
        .drop("_copies", "_block", "_copy")
    )
