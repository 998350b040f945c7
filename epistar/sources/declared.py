"""Source files read with declared fields instead of inferred ones.

Inference takes a pass of its own and types every file by itself: a field that is
text in one file and a number in the next comes out unlike. Here a record becomes a map of
its keys to the text of their values, so all spellings of a value (``12``, ``"12"``) read alike, and each
declared field is taken from it with its declared type. A transform asks which columns an
input has; that is observed while the rows are landed, not by a scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epistar.operators.columns import tolerant_number
from epistar.session import cut_lineage
from epistar.sources.records import split_records

TEXT, WHOLE, REAL = "string", "bigint", "double"

# The fields of the movement indicator files (current and archive layouts).
MOVEMENT_FIELDS = {
    "CountryISO2Code": TEXT, "Country": TEXT, "LocationCode": TEXT, "LocationName": TEXT, "Week": TEXT, "Colour": TEXT,
    "NotificationRate": REAL, "NotificationRateGeoLevel": TEXT, "VaccineUptake": REAL, "VaccineGeoLevel": TEXT,
    "TestingRate": REAL, "TestingGeoLevel": TEXT, "WeightedRate": REAL,
    "country": TEXT, "geo_id_final": TEXT, "region": TEXT, "week": TEXT, "colour": TEXT, "regional_testing_data": TEXT,
    "subnational_rate_14": REAL, "subnational_cases_7": WHOLE, "subnational_cases_14": WHOLE, "subnational_population": WHOLE,
    "national_rate_14": REAL, "national_cases_7": WHOLE, "national_cases_14": WHOLE, "national_population": WHOLE,
    "positivity_rate_combined": REAL, "testing_rate_combined": REAL,
}

# The fields of the cases and deaths files (weekly and daily layouts).
CASES_FIELDS = {
    "country": TEXT, "country_code": TEXT, "continent": TEXT, "population": WHOLE, "indicator": TEXT, "year_week": TEXT,
    "weekly_count": WHOLE, "cumulative_count": WHOLE, "rate_14_day": REAL, "source": TEXT,
    "day": WHOLE, "month": WHOLE, "year": WHOLE, "cases": WHOLE, "deaths": WHOLE, "countriesAndTerritories": TEXT,
    "geoId": TEXT, "countryterritoryCode": TEXT, "popData2020": WHOLE, "continentExp": TEXT,
}

# The fields of the vaccine tracker files; refusals may be text and stay so.
VACCINE_FIELDS = {
    "YearWeekISO": TEXT, "ReportingCountry": TEXT, "Region": TEXT, "TargetGroup": TEXT, "Vaccine": TEXT,
    "FirstDose": WHOLE, "FirstDoseRefused": TEXT, "SecondDose": WHOLE, "DoseAdditional1": WHOLE, "DoseAdditional2": WHOLE,
    "DoseAdditional3": WHOLE, "DoseAdditional4": WHOLE, "DoseAdditional5": WHOLE, "UnknownDose": WHOLE,
    "NumberDosesReceived": WHOLE, "NumberDosesExported": WHOLE, "Population": WHOLE, "Denominator": WHOLE,
}


def read_declared(
    spark: SparkSession, path: str, fields: Mapping[str, str], partitions: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """One records document or array, of any size, as rows of its declared fields with ``_file`` and ``_pos``.

    Returns the rows, with those declared fields that some record has as a key (null or not), in declared order, and
    ``{"rows": n, "undeclared": rows with other keys}``. Other keys are left out. A value that
    does not fit its type becomes null; a record that is no JSON object fails the read, as does a document
    that breaks off. Names that differ in case only are one column, under the first declared name, the first
    non-null value winning; of a key that a record repeats the first value counts. An empty array has no columns but the two of the order.
    """
    names = list(fields)
    record = F.from_json("text", "map<string,string>", {"mode": "FAILFAST"})
    text = split_records(spark, path).select("_file", "_pos", record.alias("rec"))
    if partitions:
        text = text.repartition(partitions)
    seen = Observation()
    declared = F.array(*[F.lit(n) for n in names])
    watched = text.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(F.array_except(F.map_keys("rec"), declared)) > 0).alias("undeclared"),
        *[F.count_if(F.map_contains_key("rec", n)).alias(f"has_{k}") for k, n in enumerate(names)],
    )
    # numbered columns: names that differ in case only would clash in a table
    landed = cut_lineage(watched.select("_file", "_pos", *[F.col("rec")[n].alias(f"f{k}") for k, n in enumerate(names)]))
    metrics = seen.get
    places: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        if metrics[f"has_{k}"]:
            places.setdefault(name.lower(), []).append(k)

    def value(k: int):
        kind = fields[names[k]]
        return F.col(f"f{k}") if kind == TEXT else tolerant_number(f"f{k}", kind)

    columns = [F.coalesce(*[value(k) for k in group]).alias(names[group[0]]) for group in places.values()]
    counts = {"rows": metrics["rows"], "undeclared": metrics["undeclared"]}
    return landed.select(*columns, "_file", "_pos"), counts
