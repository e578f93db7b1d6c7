"""Dates, hours and weekdays of a sale.

A sale's timestamp is the wall-clock time of the shop and carries no zone (TIMESTAMP_NTZ), so
day and hour do not move with the session's time zone. Zoned timestamps work as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.settings import Period

# Weekday names, 1 = Sunday.
WEEKDAYS = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]
UNKNOWN_WEEKDAY = "Desconhecido"


def day(moment: Column) -> Column:
    return moment.cast("date")


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def weekday_number(moment: Column) -> Column:
    return F.dayofweek(moment)


def weekday_name(number: Column) -> Column:
    """Name of weekday 1-7; anything else, NULL included, is the unknown weekday."""
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.when(number.between(1, 7), F.get(names, number - 1)).otherwise(F.lit(UNKNOWN_WEEKDAY))


def columns(moment: Column) -> dict[str, Column]:
    """All calendar columns of a sale by name."""
    return {
        "data": day(moment),
        "hora": hour_of_day(moment),
        "dia_semana_num": weekday_number(moment),
        "dia_semana": weekday_name(weekday_number(moment)),
    }


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; text that is no timestamp becomes NULL instead of failing the job."""
    return text.try_cast("timestamp_ntz")


def within(date: Column, period: Period | None) -> Column:
    """True inside the period, both ends included; always true without one."""
    if period is None:
        return F.lit(True)
    return date.between(F.lit(period.first), F.lit(period.last))
