"""Ion charge balance per sample.

One grouped aggregate does all the work: eleven conditional averages that Spark
combines on the map side, so a sample that holds a large share of all rows
still reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round2
from ..model.lookups import MEQ_FACTORS, ions

CATIONS = ("ca", "mg", "na", "k", "na+k")
ANIONS = ("cl", "hco3", "co3", "so4", "no3", "no2")
IONS = tuple(MEQ_FACTORS)


def column_of(ion: str) -> str:
    return ion.replace("+", "_")


def ion_values(results: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """Rows that count towards a balance: (keys, ion, value).

    Rows with a detection condition, without a value or for another parameter
    drop out before anything is shuffled.
    """
    usable = results.where(
        F.coalesce(F.col("DetectCond") == "", F.lit(True)) & F.col("ResultValue").isNotNull()
    ).select(*keys, F.lower("Param").alias("param"), F.col("ResultValue").alias("value"))
    return usable.join(ions(results.sparkSession), "param").select(*keys, "ion", "value")


def mean_values(values: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """Mean of the values reported for one ion of a sample, in long form."""
    return values.groupBy(*keys, "ion").agg(F.avg("value").alias("value"), F.count("value").alias("n_values"))


def concentrations(values: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """One row per sample, one column per ion: the mean of its values, or NULL."""
    return values.groupBy(*keys).agg(
        *(F.avg(F.when(F.col("ion") == ion, F.col("value"))).alias(column_of(ion)) for ion in IONS)
    )


def merge_concentrations(*value_sets: DataFrame) -> DataFrame:
    """Join several sets of ion values into one before they are averaged."""
    merged = value_sets[0]
    for values in value_sets[1:]:
        merged = merged.unionByName(values)
    return merged


def derive_alkalis(df: DataFrame) -> DataFrame:
    """Sodium and potassium from their reported sum.

    Either one is the sum less the other when only the other is reported. The
    sum itself then no longer counts: it is 0 as soon as potassium is reported,
    or when sodium is reported beside the sum.
    """
    na, k, both = F.col("na"), F.col("k"), F.col("na_k")
    return df.withColumns(
        {
            "sodium": F.coalesce(na, both - k),
            "potassium": F.coalesce(k, both - na),
            "alkali_sum": F.when((both.isNotNull() & na.isNotNull()) | k.isNotNull(), F.lit(0.0)).otherwise(both),
        }
    )


def qualifying(df: DataFrame) -> DataFrame:
    """Samples with all five required ions and some sodium."""
    condition = F.col("sodium").isNotNull() | F.col("alkali_sum").isNotNull()
    for ion in ("ca", "mg", "cl", "hco3", "so4"):
        condition = condition & F.col(ion).isNotNull()
    return df.where(condition)


def totals(df: DataFrame) -> DataFrame:
    """Cation and anion totals in meq/l and the balance in percent, unrounded."""
    source = {"na": "sodium", "k": "potassium", "na+k": "alkali_sum"}

    def total(members):
        terms = [F.coalesce(F.col(source.get(ion, ion)), F.lit(0.0)) * MEQ_FACTORS[ion] for ion in members]
        out = terms[0]
        for term in terms[1:]:
            out = out + term
        return out

    df = df.withColumns({"cation_total": total(CATIONS), "anion_total": total(ANIONS)})
    cation, anion = F.col("cation_total"), F.col("anion_total")
    return df.withColumn("balance", F.coalesce(F.try_divide(cation - anion, cation + anion) * 100.0, F.lit(0.0)))


def sample_totals(results: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """Per qualifying sample: keys, balance, cation_total, anion_total."""
    wide = totals(qualifying(derive_alkalis(concentrations(ion_values(results, keys), keys))))
    return wide.select(*keys, "balance", "cation_total", "anion_total")


def balance_rows(sample: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """Three result rows per sample: Param, ResultValue at two decimals, Unit.

    Every other result field stays NULL.
    """
    rounded = sample.select(
        *keys, *(round2(F.col(c)).alias(c) for c in ("balance", "cation_total", "anion_total"))
    )

    # Names and units of the derived rows.
    rows = F.array(
        *(
            F.struct(F.lit(param).alias("Param"), F.col(c).alias("ResultValue"), F.lit(unit).alias("Unit"))
            for param, c, unit in (
                ("Charge Balance", "balance", "%"),
                ("Cation Total", "cation_total", "meq/l"),
                ("Anions Total", "anion_total", "meq/l"),
            )
        )
    )
    return rounded.select(*keys, F.inline(rows))


def charge_balance(results: DataFrame, keys: tuple[str, ...] = ("SampleId",)) -> DataFrame:
    """Balance rows of every qualifying sample in ``results``."""
    return balance_rows(sample_totals(results, keys), keys)
