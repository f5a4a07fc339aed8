"""Which file to load: the file listing as a DataFrame, one best file per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.functions.dates import ANY_MONTH, MONTH_ALIASES, MONTHS, month_number, month_start
from gondola.operators.dedup import keep_first

# Accepted file names, written without their case.
CHAIN_YEAR_FIRST = rf"^(\d{{4}})-({ANY_MONTH})\.csv$"
CHAIN_MONTH_FIRST = rf"^({ANY_MONTH})-(\d{{4}})\.csv$"
PANEL_NAME = rf"^base([ _-]?)({ANY_MONTH})([ _-]?)(\d{{4}})\.csv$"


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """path, folder, name and modification time of all files below the roots.

    Reads no content: only the listing columns are selected.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(roots))
        .select("path", F.col("modificationTime").alias("modified"))
    )
    return with_names(files)


def with_names(files: DataFrame) -> DataFrame:
    parts = F.split("path", "/")
    return files.withColumns(
        {"name": F.element_at(parts, -1), "folder": F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))}
    )


def _first_of(year: Column, month: Column) -> Column:
    return F.try_make_timestamp(
        year.try_cast("int"), month_number(month).try_cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def _periods_contained(name: Column) -> Column:
    """Every (year, month) pair whose year and month name occur anywhere in the name."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(name) - 3, F.lit(1)))
    years = F.array_distinct(F.transform(starts, lambda i: F.substring(name, i, F.lit(4))))
    years = F.filter(years, lambda y: y.rlike(r"^(19|20)\d{2}$"))
    found = [
        F.when(_names_month(name, number), F.lit(number)) for number in range(1, len(MONTHS) + 1)
    ]
    months = F.array_compact(F.array(*found))
    return F.flatten(
        F.transform(years, lambda y: F.transform(months, lambda m: F.make_date(y.cast("int"), m, F.lit(1))))
    )


def _spellings(number: int) -> list[str]:
    return [MONTHS[number - 1]] + [a for a, n in MONTH_ALIASES.items() if n == number]


def _names_month(name: Column, number: int) -> Column:
    result = F.lit(False)
    for spelling in _spellings(number):
        result = result | name.contains(spelling.lower())
    return result


def chain_candidates(files: DataFrame, loose: bool = False) -> DataFrame:
    """Files that may be a chain feed, with ``category`` (their folder), ``period`` and
    ``quality``: 1 ``2025-Mayo.csv``, 2 ``Mayo-2025.csv``, 3 the same in any case or
    with the other spelling of September, 4 (``loose``) any csv naming year and month.
    """
    low = F.lower("name")
    year = F.coalesce(_group(low, CHAIN_YEAR_FIRST, 1), _group(low, CHAIN_MONTH_FIRST, 2))
    month = F.coalesce(_group(low, CHAIN_YEAR_FIRST, 2), _group(low, CHAIN_MONTH_FIRST, 1))
    proper = "|".join(MONTHS)
    exact = (
        F.when(F.col("name").rlike(rf"^\d{{4}}-({proper})\.csv$"), 1)
        .when(F.col("name").rlike(rf"^({proper})-\d{{4}}\.csv$"), 2)
        .otherwise(3)
    )
    named = _first_of(year, month)
    return _with_periods(files, "category", F.col("folder"), named, exact, low.endswith(".csv"), 4, loose)


def panel_candidates(files: DataFrame, loose: bool = False) -> DataFrame:
    """Files that may be a panel feed: ``base``, month and year, at most one of space,
    underscore and hyphen between them, in any folder. ``quality`` is 1; with ``loose``
    it follows the separator (none, hyphen, underscore, then the other spelling), other
    separators and names that only start with ``base_`` and name year and month coming last.
    """
    low = F.lower("name")
    year, month = _group(low, PANEL_NAME, 4), _group(low, PANEL_NAME, 2)
    named = _first_of(year, month)
    if not loose:
        return _with_periods(files, None, None, named, F.lit(1), F.lit(False), 0, False)
    before, between = _group(low, PANEL_NAME, 1), _group(low, PANEL_NAME, 3)
    rank = F.when(before == "_", F.when(between == "", 1).when(between == "-", 2).when(between == "_", 3))
    alias = F.when(month.isin(*[a.lower() for a in MONTH_ALIASES]), 3).otherwise(0)
    exact = F.when(rank.isNotNull(), rank + alias)
    named = F.when(exact.isNotNull(), named)
    return _with_periods(files, None, None, named, exact, low.startswith("base_"), 7, True)


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _with_periods(
    files: DataFrame,
    category_name: str | None,
    category: Column | None,
    named: Column,
    quality: Column,
    loosely: Column,
    loose_quality: int,
    loose: bool,
) -> DataFrame:
    if category_name:
        files = files.withColumn(category_name, category)
    # As long as a name has its period in the right place, no other is read into it.
    contained = F.when(loosely, _periods_contained(F.lower("name"))) if loose else F.lit(None)
    periods = F.when(named.isNotNull(), F.array(named))
    periods = F.coalesce(periods, contained) if loose else periods
    rank = F.when(named.isNotNull(), quality).otherwise(F.lit(loose_quality))
    return files.withColumn("quality", rank.cast("int")).withColumn("period", F.explode(periods))


def best_files(candidates: DataFrame, *by: str) -> DataFrame:
    """One file per ``by`` and period: best name, then newest, then by path."""
    order = [F.col("quality"), F.col("modified").desc(), F.col("path")]
    return keep_first(candidates, [*by, "period"], order)


def files_for_month(best: DataFrame, month: Column, categories: Sequence[str] | None = None) -> DataFrame:
    """The file that a run loads for each wanted category, or for the feed as a whole: ``period``,
    ``path`` and ``outcome``, ``found`` or ``missing``.

    ``best`` comes from ``best_files``; ``month`` is any day of the month wanted:
    ``dates.target_day`` of the run's day for the chain feed, ``dates.previous_month_start``
    for the panel feed.
    """
    spark = best.sparkSession
    wanted = spark.createDataFrame([(c,) for c in categories or [""]], "category string")
    wanted = wanted.withColumn("period", month_start(month))
    known = best if categories else best.withColumn("category", F.lit(""))
    known = known.select(F.col("category").alias("_c"), F.col("period").alias("_p"), "path")
    joined = wanted.join(known, (F.col("category") == F.col("_c")) & (F.col("period") == F.col("_p")), "left")
    outcome = F.when(F.col("path").isNull(), "missing").otherwise("found").alias("outcome")
    return joined.select(*(["category"] if categories else []), "period", "path", outcome)
