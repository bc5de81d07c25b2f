"""Turning columns into numbers: one-hot groups, as columns or as one sparse vector, cyclic dates and flags."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions import dates as D
from urbanflow.functions.names import col_q
from urbanflow.functions.text import boolean_to_int, boolean_to_int_strict
from urbanflow.operators.aggregates import level_values
from urbanflow.operators.checks import Watch, check_numeric
from urbanflow.operators.positions import row_numbers
from urbanflow.session import join_lookup, materialize


def one_hot(df: DataFrame, columns: list[str], levels: dict[str, list] | None = None) -> DataFrame:
    """Replace each column by 0/1 columns `column_value` of one byte, appended in the order of `columns`, values sorted.

    A missing value gives zeros; no level is dropped. Without `levels` one job finds them. The result is a single
    projection, however many columns it makes.
    """
    levels = levels if levels is not None else level_values(df, columns)
    kept = [col_q(c) for c in df.columns if c not in columns]
    zero = F.lit(0).cast("tinyint")
    flags = [F.coalesce((col_q(c) == F.lit(v)).cast("tinyint"), zero).alias(f"{c}_{v}") for c in columns for v in levels[c]]
    return df.select(*kept, *flags)


def cyclic_columns(date: Column, day: Column) -> list[Column]:
    """The four sine/cosine columns of a date and the number of its day in the week."""
    year_day = F.dayofyear(date)
    return [
        D.cycle_sin(day, D.WEEK_PERIOD).alias("day_of_week_sin"),
        D.cycle_cos(day, D.WEEK_PERIOD).alias("day_of_week_cos"),
        D.cycle_sin(year_day, D.YEAR_PERIOD).alias("day_of_year_sin"),
        D.cycle_cos(year_day, D.YEAR_PERIOD).alias("day_of_year_cos"),
    ]


def _valid_date(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit("date cannot be parsed: "), text)).cast("date")
    return F.coalesce(D.to_date_lenient(c), failure)


def encode_temporal(
    df: DataFrame, date: str = S.DATE, day_name: str = S.DAY_OF_WEEK, passthrough: tuple[str, ...] = (), strict: bool = True
) -> DataFrame:
    """Replace the date and day-name columns by their cyclic columns, appended at the end.

    A missing or unreadable date and an unknown day name are errors, or give NULLs when not `strict`. Columns named in
    `passthrough` stay.
    """
    kept = [col_q(c) for c in df.columns if c not in (date, day_name) or c in passthrough]
    if strict:
        return df.select(*kept, *cyclic_columns(_valid_date(col_q(date)), D.day_index_strict(col_q(day_name))))
    return df.select(*kept, *cyclic_columns(D.to_date_lenient(col_q(date)), D.day_index(col_q(day_name))))


def encode_booleans(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Flags as TINYINT in place; a value that is no flag is an error, or NULL when not `strict`."""
    flag = boolean_to_int_strict if strict else boolean_to_int
    return df.select([flag(col_q(c)).alias(c) if c in columns else col_q(c) for c in df.columns])


def encode_dataset(
    df: DataFrame,
    date: str = S.DATE,
    day_name: str = S.DAY_OF_WEEK,
    categoricals: list[str] = S.CATEGORICALS,
    flags: list[str] = S.FLAGS,
    levels: dict[str, list] | None = None,
    passthrough: tuple[str, ...] = (),
    drop: tuple[str, ...] = (),
    strict: bool = True,
) -> DataFrame:
    """All-numeric table: remaining inputs, then the cyclic columns, then one 0/1 group per categorical column.

    `drop` names input columns that are not encoded (the sunrise and sunset texts); `passthrough` names columns that
    ride along unencoded (date or key), so that later steps can split or join by them.
    """
    table = df.select([col_q(c) for c in df.columns if c not in drop])
    table = encode_temporal(table, date, day_name, passthrough, strict)
    table = one_hot(table, categoricals, levels)
    table = encode_booleans(table, flags, strict)
    check_numeric(table.select([col_q(c) for c in table.columns if c not in passthrough]))
    return table


def encode_watched(
    df: DataFrame, date: str = S.DATE, day_name: str = S.DAY_OF_WEEK, flags: list[str] = S.FLAGS, **options
) -> tuple[DataFrame, Watch]:
    """`encode_dataset` for a job that writes: every bad date, day name and flag is counted as the rows are read.

    After the job, `verify` of the watch raises one error that lists all distinct bad values of all columns.
    """
    mapped = {date: D.to_date_lenient(col_q(date)), day_name: D.day_index(col_q(day_name))}
    watch = Watch(df, mapped | {c: boolean_to_int(col_q(c)) for c in flags})
    return encode_dataset(watch.table, date, day_name, flags=flags, strict=False, **options), watch


def level_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, index, levels): the levels of each column numbered from 0 in ascending order, as a written table.

    Levels stay on the executors, however many there are; `levels` is their number in the column.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("at"), col_q(c).cast("string").alias("value")) for i, c in enumerate(columns)])).alias("p"))
    found = row_numbers(pairs.select("p.*").where("value IS NOT NULL").distinct(), ["at", "value"], "number")
    sizes = found.groupBy("at").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("levels"))
    numbered = found.join(F.broadcast(sizes), "at")
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("at") + 1)
    return materialize(numbered.select(name.alias("column"), "value", (F.col("number") - F.col("first")).cast("int").alias("index"), "levels"))


def one_hot_sparse(df: DataFrame, columns: list[str], index: DataFrame, out: str = "levels") -> DataFrame:
    """Replace the columns by one sparse vector with a 1 at the place of each row's levels, in the order of `one_hot`.

    Each column is looked up in the index, which is broadcast only if it is small. A missing value, and one that the
    index lacks, gives zeros. The result has one column however many levels there are.
    """
    sizes = {r["column"]: r["levels"] for r in index.groupBy("column").agg(F.max("levels").alias("levels")).collect()}
    table, hot = df, []
    for i, c in enumerate(columns):
        n = sizes.get(c, 0)
        own = index.where(F.col("column") == c).select(F.col("value").alias(f"__v{i}"), F.col("index").alias(f"__i{i}"))
        table = join_lookup(table.withColumn(f"__v{i}", col_q(c).cast("string")), own, [f"__v{i}"], "left")
        # The number after the last level stands for none of them; the encoder drops it.
        known = {"ml_attr": {"type": "nominal", "num_vals": n + 1}}
        table = table.withColumn(f"__n{i}", F.coalesce(f"__i{i}", F.lit(n)).cast("double").alias(f"__n{i}", metadata=known))
        hot.append(f"__n{i}")
    encoder = OneHotEncoder(inputCols=hot, outputCols=[f"__h{i}" for i in range(len(columns))], dropLast=True)
    encoded = encoder.fit(table).transform(table)
    joined = VectorAssembler(inputCols=encoder.getOutputCols(), outputCol=out).transform(encoded)
    return joined.select(*[col_q(c) for c in df.columns if c not in columns], col_q(out))
