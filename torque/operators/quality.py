"""Data-quality operators: row rules, constraint / unique / foreign-key checks,
null profiles and defaults.  All set-based: one filter or one aggregate pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import once
from .broadcast import bounded_broadcast

Rules = Mapping[str, Column]

# Currency ids the ETL job accepts (fixed values of the source job).
DEFAULT_ALLOWED_CURRENCY_IDS = (1, 2, 3, 4)


def etl_rules(allowed_currency_ids: Sequence[int] = DEFAULT_ALLOWED_CURRENCY_IDS) -> dict[str, Column]:
    """The six conjunctive row rules of the ETL job.  A null makes
    a rule fail (NaN passes ``> 0``, as in the source engine)."""
    return {
        "sale_price_positive": F.col("sale_price") > 0,
        "brand_id_present": F.col("brand_id").isNotNull(),
        "car_id_present": F.col("car_id").isNotNull(),
        "currency_allowed": F.col("currency_id").isin(list(allowed_currency_ids)),
        "normalized_positive": F.col("sale_price_normalized") > 0,
        "label_present": F.col("sale_price_normalized_currency") != F.lit(""),
    }


def passed(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def all_pass(rules: Rules) -> Column:
    cond = F.lit(True)
    for r in rules.values():
        cond = cond & passed(r)
    return cond


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep only the rows passing every rule (Q1)."""
    return df.filter(all_pass(rules))


def split_rules(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); ``rejected`` carries the names of the failed rules."""
    failed = F.filter(F.array(*[F.when(~passed(r), F.lit(n)) for n, r in rules.items()]),
                      lambda x: x.isNotNull())
    valid = df.filter(all_pass(rules))
    rejected = df.filter(~all_pass(rules)).withColumn("failed_rules", failed)
    return valid, rejected


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """A3 / Q2: input, valid and rejected counts plus the failures of each rule,
    in one aggregate pass (partial aggregation per task, one row out)."""
    ok = all_pass(rules)
    aggs = [F.count(F.lit(1)).alias("input_rows"),
            F.count(F.when(ok, 1)).alias("valid_rows"),
            F.count(F.when(~ok, 1)).alias("rejected_rows")]
    aggs += [F.count(F.when(~passed(r), 1)).alias(f"fail_{n}") for n, r in rules.items()]
    return df.agg(*aggs)


def observed_rules(df: DataFrame, rules: Rules, name: str = "rules") -> tuple[DataFrame, Observation]:
    """Valid rows plus an ``Observation`` that collects the rule counts while
    the rows are written: no second pass over the data."""
    obs = Observation(name)
    ok = all_pass(rules)
    aggs = [F.count(F.lit(1)).alias("input_rows"), F.count(F.when(ok, 1)).alias("valid_rows")]
    aggs += [F.count(F.when(~passed(r), 1)).alias(f"fail_{n}") for n, r in rules.items()]
    return df.observe(obs, *aggs).filter(ok), obs


def violations(df: DataFrame, rules: Rules, id_cols: Sequence[str]) -> DataFrame:
    """Q3 / Q4: one row per (row id, violated constraint)."""
    failed = F.array(*[F.when(~passed(r), F.lit(n)) for n, r in rules.items()])
    return (df.select(*id_cols, F.explode(failed).alias("constraint_name"))
            .filter(F.col("constraint_name").isNotNull()))


def check(df: DataFrame, rules: Rules, id_cols: Sequence[str], mode: str = "fail") -> DataFrame:
    """Q3: enforce constraints before a snapshot is published.  ``fail`` raises
    on any violation (the old snapshot stays current); ``quarantine`` returns
    the passing rows only."""
    if mode == "fail":
        bad = violations(df, rules, id_cols)
        if not bad.isEmpty():
            raise ValueError("constraint violated: " + ", ".join(
                f"{r['constraint_name']}" for r in bad.select("constraint_name").distinct().limit(10).collect()))
        return df
    if mode == "quarantine":
        return apply_rules(df, rules)
    raise ValueError(f"unknown check mode {mode!r}")


def dataset_constraints() -> dict[str, Column]:
    """Q3: NOT NULL and CHECK constraints of ``car_sales_dataset``."""
    cols = ["sale_id", "brand_id", "brand_name", "car_id", "car_name", "sale_price",
            "currency_id", "currency_name", "sale_price_normalized",
            "sale_price_normalized_currency", "exchange_rate_date", "transaction_date"]
    rules = {f"{c}_not_null": F.col(c).isNotNull() for c in cols}
    rules["sale_price_positive"] = F.col("sale_price") > 0
    rules["sale_price_normalized_positive"] = F.col("sale_price_normalized") > 0
    return rules


def source_constraints() -> dict[str, dict[str, Column]]:
    """Q4: CHECK constraints of the source tables."""
    return {
        "cars": {"price_non_negative": F.col("price") >= 0, "stock_non_negative": F.col("stock") >= 0},
        "car_sales": {"price_non_negative": F.col("price") >= 0},
    }


def unique_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Q5: key values held by more than one row, with their row count.  An
    aggregate, combined map-side, so a hot key costs one row per task."""
    keys = list(keys)
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    key_text.alias("key_value"), F.col("n_rows")))


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                  child_table: str, parent_table: str) -> DataFrame:
    """Q6: foreign-key values with no parent row, with the number of child rows
    holding each.  A null foreign key is allowed.  Parent keys under the
    counted bound are broadcast, so the child is not shuffled for the anti
    join; the per-value count is combined map-side."""
    c = child.select(F.col(fk).alias("fk_value")).filter(F.col("fk_value").isNotNull())
    parent_keys = bounded_broadcast(once(parent.select(F.col(pk).alias("fk_value"))))
    missing = c.join(parent_keys, "fk_value", "left_anti")
    return (missing.groupBy("fk_value").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(child_table).alias("child_table"), F.lit(fk).alias("fk_column"),
                    F.lit(parent_table).alias("parent_table"),
                    F.col("fk_value").cast("bigint").alias("fk_value"), "n_rows"))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Q7: column defaults for missing values (``coalesce``)."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: rows and nulls per column in one aggregate pass."""
    columns = list(columns or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in columns])
