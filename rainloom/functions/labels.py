"""Labels, levels and names of periods and maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rainloom import config


def period_label(kind: Column, start: Column, end: Column) -> Column:
    """The title of a period, with French prefixes and English month names."""
    span = F.concat(F.lit("("), F.date_format(start, "dd MMM"), F.lit(" - "), F.date_format(end, "dd MMM yyyy"), F.lit(")"))
    day = F.dayofmonth(start)
    number = F.when(day <= 10, "1").when(day <= 20, "2").otherwise("3")
    long = F.date_format(start, "MMMM yyyy")
    full = F.concat(F.date_format(start, "dd MMM yyyy"), F.lit(" - "), F.date_format(end, "dd MMM yyyy"))
    return (
        F.when(kind == "decade", F.concat(F.lit("Décade "), number, F.lit(" - "), long, F.lit("\n"), span))
        .when(kind == "month", F.concat(long, F.lit("\n"), span))
        .when(kind == "season", F.concat(F.lit("Saison "), F.date_format(start, "MMM"), F.lit("-"), F.date_format(end, "MMM yyyy"), F.lit("\n"), span))
        .when(kind == "custom", F.concat(F.lit("Période personnalisée\n("), full, F.lit(")")))
        .otherwise(full)
    )


def levels(kind: Column) -> Column:
    """The contour levels of a period type; those of months for an unknown one."""
    table = F.create_map(*[x for k, v in config.LEVELS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(table[kind], F.array(*map(F.lit, config.LEVELS["month"])))


def subfolder(kind: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in config.SUBFOLDERS.items() for x in kv])[kind], kind)


def safe_name(text: Column) -> Column:
    return F.translate(text, "/ ", "-_")


def model_title(model: Column) -> Column:
    """The display name of a model; its own name where it has none."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in config.MODEL_NAMES.items() for x in kv])[model], model)
