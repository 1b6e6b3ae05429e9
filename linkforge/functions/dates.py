"""Dates with a precision. A parsed date is the array of its known parts: [year], [year, month], up to the second."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkforge.functions.text import let
from linkforge.schema import DAY, HOUR, MINUTE, MONTH, YEAR

def parse(value: Column, precision: Column) -> Column:
    """The parts of a timestamp text (1984-11-16T00:00:00Z) that its precision vouches for; null if they are no date."""
    n = F.when(precision <= YEAR, 4).when(precision == MONTH, 7).when(precision == DAY, 10).when(precision == HOUR, 13).when(precision == MINUTE, 16).otherwise(F.length(value))
    pieces = F.filter(F.split(F.substring(value, F.lit(1), n), "[-T:Z]"), lambda x: x != "")

    def checked(p: Column) -> Column:
        at = lambda i, default: F.coalesce(F.get(p, F.lit(i)), F.lit(default))
        date = F.try_to_date(F.concat_ws("-", at(0, ""), at(1, "01"), at(2, "01")), "yyyy-MM-dd")
        numbers = F.transform(F.slice(p, 1, 6), lambda x: x.try_cast("int"))
        time = F.forall(F.arrays_zip(F.slice(p, 4, 3).alias("x"), F.array(F.lit(23), F.lit(59), F.lit(59)).alias("m")), lambda z: z.x.isNull() | F.coalesce(z.x.try_cast("int") <= z.m, F.lit(False)))
        return F.when(date.isNotNull() & (F.length(at(0, "")) == 4) & time, numbers)

    return let(pieces, checked)


def of_date(date: Column, precision: Column) -> Column:
    """The parts of a DATE; a null precision counts as a year's."""
    p = F.coalesce(precision, F.lit(YEAR))
    return F.when(date.isNotNull(), F.slice(F.array(F.year(date), F.month(date), F.day(date)), 1, F.when(p <= YEAR, 1).when(p == MONTH, 2).otherwise(3)))


def parse_list(pairs: Column) -> Column:
    """array<array<string>> of [value, precision] to the parsed dates; null if none can be parsed."""
    out = F.array_distinct(F.filter(F.transform(pairs, lambda p: parse(F.get(p, F.lit(0)), F.get(p, F.lit(1)).try_cast("int"))), lambda x: x.isNotNull()))
    return F.when(F.size(out) > 0, out)


def similarity(a: Column, b: Column) -> Column:
    """Share of the leading parts known on both sides that agree, from the year on."""
    n = F.least(F.size(a), F.size(b))
    return F.size(F.filter(F.sequence(F.lit(1), n), lambda k: F.slice(a, 1, k) == F.slice(b, 1, k))) / n


def same_to_shared_precision(a: Column, a_precision: Column, b: Column, b_precision: Column) -> Column:
    """Two timestamps or dates agree to the poorer precision; false below a year's."""
    p = F.least(a_precision, b_precision)
    same = (F.year(a) == F.year(b)) & ((p < MONTH) | (F.month(a) == F.month(b))) & ((p < DAY) | (F.day(a) == F.day(b)))
    return F.coalesce((p >= YEAR) & same, F.lit(False))


def birth_or_death_match(born: Column, died: Column, target: dict[str, Column]) -> Column:
    """born, died: array<struct<value:date, precision:int>>; target: born, born_precision, died, died_precision."""

    def some(dates: Column, key: str) -> Column:
        return F.coalesce(F.exists(dates, lambda d: same_to_shared_precision(d.value, d.precision, target[key], target[f"{key}_precision"])), F.lit(False))

    return some(born, "born") | some(died, "died")


def match_values(source: Column, target: Column) -> Column:
    """Bio values YYYY-MM-DD/precision: 'shared' if equal to the poorer precision, 'extra' if not; null for other precisions."""
    sp, tp = (F.substring_index(x, "/", -1).try_cast("int") for x in (source, target))
    p = F.least(sp, tp)
    n = F.when(p == YEAR, 4).when(p == MONTH, 7).when(p == DAY, 10)
    cut = lambda x: F.substring(x, F.lit(1), n)
    return F.when(n.isNotNull(), F.when(cut(source) == cut(target), F.lit("shared")).otherwise(F.lit("extra")))


def bio_value(date: Column, precision: Column) -> Column:
    return F.when(date.isNotNull(), F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("/"), F.coalesce(precision, F.lit(YEAR)).cast("string")))


def from_parts(year: Column, month: Column, day: Column) -> tuple[Column, Column]:
    """(date, precision) of numbers that may be null: precision by the first that is; missing ones are 1; no year or one
    before 1: null. An impossible date is null too."""
    y = F.when(year > 0, year)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(F.coalesce(month, F.lit(1)).cast("string"), 2, "0"), F.lpad(F.coalesce(day, F.lit(1)).cast("string"), 2, "0"))
    date = F.when(y.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))
    precision = F.when(date.isNotNull(), F.when(month.isNull(), YEAR).when(day.isNull(), MONTH).otherwise(DAY))
    return date, precision


def from_year(year: Column) -> tuple[Column, Column]:
    return from_parts(year.try_cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"))


def earliest(rows, keys: list[str], date: str, precision: str):
    """The earliest date of each key with its precision; the finer of equals."""
    best = F.min(F.struct(F.col(date), (-F.coalesce(F.col(precision), F.lit(0))).alias("p")))
    return rows.where(F.col(date).isNotNull()).groupBy(*keys).agg(best.alias("m")).select(*keys, F.col(f"m.{date}").alias(date), (-F.col("m.p")).alias(precision))
