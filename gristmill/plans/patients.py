"""Patient tables: labels, rankings, comparison with the own group, age bands.

``id`` is the tie-break wherever rows are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.measures import floor_to_ten, two_way_label
from gristmill.functions.ordering import smallest_first, sql_desc
from gristmill.operators.joins import attach_group_stats
from gristmill.operators.ordered import ranks
from gristmill.operators.windows import page, top_ranks, top_rows

def by_bmi() -> list[Column]:
    return [sql_desc("bmi"), smallest_first("id")]


def diagnosis_label(column: str = "diagnosis") -> Column:
    return two_way_label(F.col(column) == 1, "Cancer", "No Cancer")


def raw_view(patients: DataFrame, rows: int = 20) -> DataFrame:
    """First look at the table."""
    return patients.select("id", "age", "gender", "bmi", "smoking", "genetic_risk", "diagnosis").orderBy("id").limit(rows)


def labelled(patients: DataFrame) -> DataFrame:
    """Diagnosis as text beside the number."""
    return patients.select("id", "age", "bmi", "diagnosis", diagnosis_label().alias("diagnosis_label"))


def heaviest(patients: DataFrame, rows: int = 20) -> DataFrame:
    """Patients by BMI, highest first."""
    return patients.select("id", "age", "bmi", "diagnosis").orderBy(*by_bmi()).limit(rows)


def bmi_page(patients: DataFrame, offset: int = 2, rows: int = 7) -> DataFrame:
    """A slice of the sorted list, by position only."""
    return page(patients.select("id", "age", "bmi", "diagnosis"), by_bmi(), offset, rows)


def bmi_ranked(patients: DataFrame) -> DataFrame:
    """Every patient with the rank over all patients."""
    return ranks(patients.select("id", "age", "bmi", "diagnosis"), [], "bmi", rank="bmi_rank_all")


def bmi_rank_slice(patients: DataFrame, low: int = 3, high: int = 10) -> DataFrame:
    """Patients ranked ``low`` to ``high``."""
    return top_ranks(patients.select("id", "age", "bmi", "diagnosis"), [], "bmi", high, "bmi_rank_all", low=low).orderBy(
        "bmi_rank_all", "id"
    )


def bmi_ranked_in_group(patients: DataFrame) -> DataFrame:
    """Every patient with the rank inside the own diagnosis."""
    columns = patients.select("id", "diagnosis", "age", "bmi", "genetic_risk")
    return ranks(columns, ["diagnosis"], "bmi", rank="bmi_rank_in_group")


def bmi_ranks_up_to(patients: DataFrame, n: int = 3) -> DataFrame:
    """Patients with one of the first ``n`` ranks of their diagnosis, ties included."""
    return top_ranks(patients.select("id", "diagnosis", "bmi"), ["diagnosis"], "bmi", n, "bmi_rank")


def top_of_group(patients: DataFrame, n: int = 3) -> DataFrame:
    """``n`` patients per diagnosis with label and rank.

    The rank is counted among the ``n`` rows kept: whoever precedes a kept row
    is kept as well.
    """
    columns = patients.select("id", "diagnosis", "age", "bmi", "genetic_risk")
    top = top_rows(columns, ["diagnosis"], by_bmi(), n, "sample_row_num")
    first = top.groupBy("diagnosis", "bmi").agg(F.min("sample_row_num").cast("bigint").alias("bmi_rank_in_group"))
    same = top.alias("t").join(
        first.alias("f"),
        F.expr("t.diagnosis <=> f.diagnosis AND t.bmi <=> f.bmi"),
    )
    return same.select(
        "t.id", diagnosis_label("t.diagnosis").alias("diagnosis_label"), "t.age", "t.bmi", "t.genetic_risk",
        "f.bmi_rank_in_group", "t.sample_row_num",
    ).orderBy("diagnosis_label", "sample_row_num")


def group_average(patients: DataFrame) -> DataFrame:
    """Average BMI per diagnosis."""
    return patients.groupBy("diagnosis").agg(F.round(F.avg("bmi"), 2).alias("avg_bmi")).orderBy("diagnosis")


def beside_group(patients: DataFrame) -> DataFrame:
    """Every patient with size and average of the own diagnosis and the distance from that average."""
    columns = patients.select("id", "diagnosis", "age", "bmi")
    stats = {"group_patient_count": F.count("*"), "__avg": F.avg("bmi")}
    return (
        attach_group_stats(columns, ["diagnosis"], stats)
        .withColumns(
            {
                "group_avg_bmi": F.round("__avg", 2),
                "bmi_diff_from_group_avg": F.round(F.col("bmi") - F.col("__avg"), 2),
            }
        )
        .drop("__avg")
    )


def top_beside_group(patients: DataFrame, n: int = 3) -> DataFrame:
    """``n`` patients per diagnosis beside the statistics of the whole diagnosis."""
    top = top_rows(beside_group(patients), ["diagnosis"], by_bmi(), n, "sample_row_num")
    return top.withColumn("diagnosis_label", diagnosis_label()).orderBy("diagnosis_label", "sample_row_num")


def with_age_band(patients: DataFrame) -> DataFrame:
    return patients.select("id", "age", "bmi", "diagnosis", floor_to_ten(F.col("age")).alias("age_band"))


def ranked_in_age_band(patients: DataFrame) -> DataFrame:
    """Every patient with the rank inside the own age band."""
    return ranks(with_age_band(patients), ["age_band"], "bmi", rank="bmi_rank_in_age_band")


def top_of_age_band(patients: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest BMIs of every age band."""
    return top_rows(with_age_band(patients), ["age_band"], by_bmi(), n, "bmi_row_num_in_age_band")


def age_band_cancer_ratio(patients: DataFrame, n: int = 10) -> DataFrame:
    """Share of cancer among those top patients."""
    return (
        top_of_age_band(patients, n)
        .groupBy("age_band")
        .agg(
            F.count("*").alias("patient_count"),
            F.sum("diagnosis").alias("cancer_patient_count"),
            F.round(F.avg("diagnosis"), 3).alias("cancer_ratio"),
        )
        .orderBy("age_band")
    )
