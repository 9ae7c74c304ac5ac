"""Cleaning of a survey table, step by step in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.functions.scalar import cast_int, map_codes, regex_remove, upper, zfill_prefix
from windvane.functions.time import age_from_birthdate
from windvane.operators.bins import bin_quantile, bin_width
from windvane.operators.select import columns_matching, drop_sparse_columns, drop_sparse_rows, rename_columns

# Answer codes of the frequency question.
FREQUENCY = {
    1: "Manytimes",
    2: "Onetimebyday",
    3: "5/6timesforweek",
    4: "4timesforweek",
    5: "1/3timesforweek",
    6: "1timeformonth",
    7: "1/trimestre",
    8: "Less",
    9: "Never",
}


@dataclass(frozen=True)
class SurveySpec:
    """Column roles of the survey table; ``year`` is the current year for the age."""

    year: int
    dropped: str = "vote"
    title: str = "civility"
    birthdate: str = "birthdate"
    city: str = "city"
    postal_code: str = "postal_code"
    duration: str = "surveyduration"
    code: str = "q1"
    code_name: str = "Frequency"
    codes: dict = field(default_factory=lambda: dict(FREQUENCY))
    bins: int = 10


def clean_table(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Drop vote columns; clean title, city and postal code; derive the age; drop sparse columns, then
    sparse rows; bin duration and age (bin numbers); rename and decode the frequency answer."""
    out = df.drop(*columns_matching(df, spec.dropped))
    out = out.withColumns(
        {
            spec.title: regex_remove(spec.title),
            "Year_Month": F.to_date(spec.birthdate),
            "Age": age_from_birthdate(spec.birthdate, spec.year),
            spec.city: upper(spec.city),
            spec.postal_code: zfill_prefix(spec.postal_code),
        }
    )
    out = drop_sparse_rows(drop_sparse_columns(out))
    out = bin_quantile(out, spec.duration, spec.bins, "duration")
    out = bin_width(out, "Age", spec.bins, "Age")
    out = rename_columns(out, {spec.code: spec.code_name})
    return out.withColumn(spec.code_name, map_codes(cast_int(spec.code_name), spec.codes))
