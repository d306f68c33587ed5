"""Release metrics: distinct counts by group, weekly sheets, graded drops, the promotion gate, release differences."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.functions.expressions import blank


def distinct_metrics(df: DataFrame, keys: list[str], metrics: dict[str, tuple[str, Column | None]], null_counts: bool = False) -> DataFrame:
    """Wide distinct counts: name -> (column, condition). null_counts: null is one more value where the group has it."""
    out = []
    for name, (column, condition) in metrics.items():
        ok = condition if condition is not None else F.lit(True)
        n = F.countDistinct(F.when(ok, F.col(column)))
        if null_counts:
            n = n + F.coalesce(F.max(F.when(ok & F.col(column).isNull(), 1)), F.lit(0))
        out.append(n.cast("long").alias(name))
    return df.groupBy(*keys).agg(*out)


def long_with_total(wide: DataFrame, keys: list[str], total: str = "TOTAL") -> DataFrame:
    """(keys, metric, value) with TOTAL rows that sum the groups: shared members count once for each group."""
    names = [c for c in wide.columns if c not in keys]
    rows = wide.unpivot([F.col(k).cast("string").alias(k) for k in keys], names, "metric", "value")
    sums = rows.groupBy("metric").agg(F.sum("value").alias("value")).select(*[F.lit(total).alias(k) for k in keys], "metric", "value")
    return rows.unionByName(sums)


def upsert_week(sheet: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A long sheet (keys, week, value): the weeks of the new rows replace those they name as a whole."""
    return sheet.join(F.broadcast(new.select("week").distinct()), "week", "left_anti").unionByName(new.select(*sheet.columns))


def widen(sheet: DataFrame, keys: list[str], weeks: list[str]) -> DataFrame:
    return sheet.groupBy(*keys).pivot("week", weeks).agg(F.first("value"))


def sheet_order(df: DataFrame, key: str, metric_order: dict[str, int]) -> DataFrame:
    """TOTAL first, then by number, then by the order of metrics."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in metric_order.items() for x in kv]), F.col("metric")), F.lit(99))
    return df.orderBy(F.when(F.col(key) == "TOTAL", 0).otherwise(1), F.col(key).try_cast("long").asc_nulls_last(), key, rank, "metric")


@dataclass(frozen=True)
class Thresholds:
    """When a drop is critical or a warning, for a group and for the total."""

    hard_abs: int = 1000
    big: int = 1000
    crit_pct: float = 10.0
    warn_abs: int = 200
    mid: int = 100
    warn_pct: float = 25.0
    agg_abs: int = 1000
    agg_pct: float = 5.0

    @classmethod
    def from_env(cls, env=None, prefix: str = "ALERT_") -> Thresholds:
        env, own = os.environ if env is None else env, {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw:
                try:
                    own[f.name] = type(f.default)(raw)
                except ValueError:
                    continue  # what isn't a number leaves the default
        return cls(**own)


def severity(before: Column, now: Column, total: Column, t: Thresholds = Thresholds()) -> Column:
    """CRITICAL, WARNING, INFO, or null where nothing dropped; a missing value counts as 0."""
    a, b = F.coalesce(before, F.lit(0)), F.coalesce(now, F.lit(0))
    drop = a - b
    pct = F.when(a > 0, drop * 100.0 / F.when(a > 0, a)).otherwise(100.0)
    of_total = F.when((drop >= t.agg_abs) | (pct >= t.agg_pct), "CRITICAL").otherwise("INFO")
    of_group = (
        F.when((drop >= t.hard_abs) | ((a >= t.big) & (pct >= t.crit_pct)), "CRITICAL")
        .when((drop >= t.warn_abs) | ((a >= t.mid) & (pct >= t.warn_pct)), "WARNING").otherwise("INFO")
    )
    return F.when(drop > 0, F.when(total, of_total).otherwise(of_group))


def last_two_weeks(sheet: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """(keys, before, now) of the sheet's last two weeks; what a week lacks is 0."""
    weeks = F.broadcast(sheet.select("week").distinct().orderBy(F.col("week").desc()).limit(2).agg(F.min("week").alias("_a"), F.max("week").alias("_b")))
    rows = sheet.join(weeks, F.col("week") >= F.col("_a"))
    pick = lambda c: F.coalesce(F.max(F.when(F.col("week") == F.col(c), F.col(value))), F.lit(0)).cast("long")
    return rows.groupBy(*keys).agg(F.when(F.max("_a") < F.max("_b"), pick("_a")).otherwise(F.lit(0)).cast("long").alias("before"), pick("_b").alias("now"))


def verdict(graded: DataFrame, column: str = "severity") -> DataFrame:
    """(verdict): 20 with any CRITICAL, 10 with any WARNING, else 0; no rows give 0."""
    worst = lambda s: F.coalesce(F.bool_or(F.col(column) == s), F.lit(False))
    return graded.agg(F.when(worst("CRITICAL"), 20).when(worst("WARNING"), 10).otherwise(0).alias("verdict"))


def status_diff(previous: DataFrame, latest: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, before, now) for each column of a shared key that changed."""
    both = previous.select(key, *[F.col(c).cast("string").alias(f"_p{c}") for c in columns]).join(latest.select(key, *[F.col(c).cast("string").alias(f"_n{c}") for c in columns]), key)
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_p{c}").alias("before"), F.col(f"_n{c}").alias("now")) for c in columns])
    return both.select(key, F.explode(each).alias("x")).select(key, "x.*").where(~F.col("before").eqNullSafe(F.col("now")))


def new_rows(previous: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    return latest.join(previous.select(key), key, "left_anti")


def count_diff(previous: DataFrame, latest: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, before, now, change) of the non-null counts of a column, for all keys of either release, with a TOTAL row."""
    n = lambda df, name: df.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(F.count(column).alias(name))
    both = n(previous, "before").join(n(latest, "now"), keys, "full").na.fill(0, ["before", "now"])
    total = both.agg(F.coalesce(F.sum("before"), F.lit(0)).alias("before"), F.coalesce(F.sum("now"), F.lit(0)).alias("now")).select(*[F.lit("TOTAL").alias(k) for k in keys], "before", "now")
    return both.unionByName(total).withColumn("change", F.col("now") - F.col("before"))


def proteome_status(df: DataFrame) -> DataFrame:
    """Status and Reason from exists (the folder), bytes (of the sequence file), proteome_type, has_metadata and candidates."""
    filled = F.coalesce(F.col("bytes"), F.lit(0)) > 0
    orphans = F.coalesce(F.lower(F.trim("proteome_type")) == "orphans", F.lit(False))
    status = F.when(~F.col("exists"), "MISSING").when(~filled, "EMPTY").when(orphans, "ORPHANS").otherwise("SELECTED")
    reason = (
        F.when(F.col("status") == "MISSING", "no species dir").when((F.col("status") == "EMPTY") & (F.coalesce("candidates", F.lit(0)) == 0), "no-candidates")
        .when(F.col("status") == "EMPTY", "fetch-empty").when((F.col("status") == "SELECTED") & ~F.col("has_metadata"), "no-metadata").otherwise("ok")
    )
    return df.withColumn("status", status).withColumn("reason", reason)


def one_line(df: DataFrame, column: str) -> str:
    """'SELECTED 3, EMPTY 1': few distinct values, so the driver may hold their counts."""
    rows = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column).collect()
    return ", ".join(f"{r[0]} {r.n}" for r in rows)

