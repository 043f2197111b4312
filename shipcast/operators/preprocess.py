"""Exact preprocessing for training (M2): fitted once, applied without a join.

Numbers: missing values (NULL and NaN) become the exact median, then the value
is divided by its standard deviation over the filled rows (population form; 1
where that is zero), after subtracting the mean if ``centre``. Texts: missing
values become the most frequent one (of equal counts the smallest), and each
value has its number among the sorted ones; a value that was not fitted has
the number -1 and an all-zero indicator vector. A column without any value is
filled with zero, or has no categories.

What is fitted is a few numbers for each column and at most ``max_categories``
texts, so it travels as literals of the expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.operators.quality import numeric_summary

MAX_CATEGORIES = 1000
TABLE = "column_name string, kind string, median double, mean double, scale double, most_frequent string, category string, code int"


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, float]]:
    """(median, mean, scale) of each numeric column after filling."""
    nan = F.lit(float("nan"))
    clean = df.select(*[F.nullif(F.col(f"`{c}`").cast("double"), nan).alias(c) for c in columns])
    rows = clean.count()
    found = {r["column_name"]: r for r in numeric_summary(clean, columns, (0.5,)).collect()} if columns and rows else {}
    out = {}
    for c in columns:
        if c not in found:
            out[c] = (0.0, 0.0, 1.0)
            continue
        n, mean, median = found[c]["count"], found[c]["mean"], found[c]["p50"]
        spread = (found[c]["std"] or 0.0) ** 2 * (n - 1) / n if n > 1 else 0.0
        whole = (n * mean + (rows - n) * median) / rows
        var = (n * (spread + (mean - whole) ** 2) + (rows - n) * (median - whole) ** 2) / rows
        out[c] = (median, whole, math.sqrt(var) if var > 0 else 1.0)
    return out


@dataclass(frozen=True)
class Preprocessing:
    """``numbers``: (median, mean, scale) by column; ``texts``: (most frequent
    value, sorted values) by column."""

    numbers: dict[str, tuple[float, float, float]]
    texts: dict[str, tuple[str | None, list[str]]]
    centre: bool = False

    def scaled(self, name: str) -> Column:
        median, mean, scale = self.numbers[name]
        value = F.coalesce(F.nullif(F.col(f"`{name}`").cast("double"), F.lit(float("nan"))), F.lit(median))
        return (value - F.lit(mean) if self.centre else value) / F.lit(scale)

    def code(self, name: str) -> Column:
        fill, values = self.texts[name]
        value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(fill))
        return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]).cast("array<string>"), value), F.lit(0)).cast("int") - 1

    def vector(self) -> Column:
        """All features as one array: scaled numbers, then indicators."""
        parts = [F.array(*[self.scaled(c) for c in self.numbers]).cast("array<double>")]
        for c, (_, values) in self.texts.items():
            code = self.code(c)
            parts.append(F.array(*[F.when(code == k, 1.0).otherwise(0.0) for k in range(len(values))]).cast("array<double>"))
        return F.concat(*parts)

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, ``<number>_scaled``, ``<text>_code`` and ``features``."""
        return df.select(*keep, *[self.scaled(c).alias(f"{c}_scaled") for c in self.numbers],
                         *[self.code(c).alias(f"{c}_code") for c in self.texts], self.vector().alias("features"))

    def table(self, spark: SparkSession) -> DataFrame:
        """The fitted values as rows, to be stored beside a model."""
        rows = [(c, "number", *own, None, None, None) for c, own in self.numbers.items()]
        for c, (fill, values) in self.texts.items():
            rows += [(c, "text", None, None, None, fill, v, k) for k, v in enumerate(values)] or [(c, "text", None, None, None, None, None, None)]
        return spark.createDataFrame(rows, TABLE)

    @staticmethod
    def from_table(table: DataFrame, centre: bool = False) -> Preprocessing:
        """What ``table`` wrote: as many rows as columns and categories."""
        numbers, texts = {}, {}
        for r in table.collect():
            if r["kind"] == "number":
                numbers[r["column_name"]] = (r["median"], r["mean"], r["scale"])
            else:
                own = texts.setdefault(r["column_name"], (r["most_frequent"], []))
                if r["category"] is not None:
                    own[1].append((r["code"], r["category"]))
        return Preprocessing(numbers, {c: (fill, [v for _, v in sorted(values)]) for c, (fill, values) in texts.items()}, centre)


def fit(df: DataFrame, numbers: list[str], texts: list[str], centre: bool = False, max_categories: int = MAX_CATEGORIES) -> Preprocessing:
    """Fit the preprocessing; a text column of more than ``max_categories``
    values is an error (the ML-ready rules drop such columns before)."""
    found: dict[str, tuple[str | None, list[str]]] = {c: (None, []) for c in texts}
    if texts:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in texts])).alias("s")
        counts = df.select(cells).select("s.*").where("v is not null").groupBy("c", "v").agg(F.count("*").alias("n")).persist()
        wide = [r["c"] for r in counts.groupBy("c").agg(F.count("*").alias("k")).where(F.col("k") > max_categories).collect()]
        if wide:
            counts.unpersist()
            raise ValueError(f"more than {max_categories} categories: {sorted(wide)}")
        most: dict[str, tuple[int, str]] = {}
        for r in counts.orderBy("c", "v").collect():
            found[r["c"]][1].append(r["v"])
            if r["c"] not in most or r["n"] > most[r["c"]][0]:
                most[r["c"]] = (r["n"], r["v"])
        counts.unpersist()
        found = {c: (most[c][1] if c in most else None, values) for c, (_, values) in found.items()}
    return Preprocessing(exact_medians(df, numbers), found, centre)
