"""Shared fixtures: one local Spark session and source files in the reference layouts."""

from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from epistar.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="epistar-test-ckpt-")
    session = build_session(
        "local[4]",
        app_name="epistar-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.sql.autoBroadcastJoinThreshold": "10485760"},
    )
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="epistar-test-")


def write_json(folder: str, name: str, payload) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf8") as fh:
        json.dump(payload, fh)
    return path


# Invented rows in the source layouts (see FIXTURES.md).
COUNTRY_LOOKUP_CSV = "Name,Code\nNamibia,NA\nCzechia,CZ\nGermany,DE\nFrance,FR\nVirgin Islands US,VI\nUnited States,US\nItaly,IT\n"

MOVEMENT_CURRENT = [
    {"CountryISO2Code": "DE", "Country": "Germany", "LocationCode": "DE1", "LocationName": "Bavaria",
     "NotificationRate": 120.5, "NotificationRateGeoLevel": "Regional", "VaccineUptake": 70.0,
     "VaccineGeoLevel": "National", "TestingRate": 900.0, "TestingGeoLevel": "Regional",
     "WeightedRate": 150.0, "Colour": "Dark Red", "Week": "2021-W10"},
    {"CountryISO2Code": "DE", "Country": "Germany", "LocationCode": "DE2", "LocationName": "Saxony",
     "NotificationRate": 30.0, "NotificationRateGeoLevel": "Regional", "VaccineUptake": None,
     "VaccineGeoLevel": "Regional", "TestingRate": 500.0, "TestingGeoLevel": "National",
     "WeightedRate": 20.0, "Colour": "Green", "Week": "2022-W10"},
    {"CountryISO2Code": "FR", "Country": "France", "LocationCode": "FR1", "LocationName": "Ile",
     "NotificationRate": 50.0, "NotificationRateGeoLevel": "National", "VaccineUptake": 60.0,
     "VaccineGeoLevel": "National", "TestingRate": 700.0, "TestingGeoLevel": "National",
     "WeightedRate": 55.0, "Colour": "Purple", "Week": "2021-W10"},
]

MOVEMENT_ARCHIVE = {"records": [
    {"country": "Czechia", "geo_id_final": "CZ1", "region": "Praha", "week": "2021-10", "colour": "Red",
     "subnational_rate_14": 200.0, "regional_testing_data": "TRUE", "positivity_rate_combined": 5.5,
     "testing_rate_combined": 800.0, "national_cases_7": 100, "national_population": 10000},
    {"country": "Czechia", "geo_id_final": "CZ1", "region": "Praha", "week": "2021-12", "colour": "Red",
     "subnational_rate_14": 210.0, "regional_testing_data": "FALSE", "positivity_rate_combined": 6.0,
     "testing_rate_combined": 810.0, "national_cases_7": 50, "national_population": 10000},
    {"country": "Czechia", "geo_id_final": "CZ1", "region": "Praha", "week": "2021-11", "colour": "Orange",
     "subnational_rate_14": 190.0, "regional_testing_data": "TRUE", "positivity_rate_combined": 4.0,
     "testing_rate_combined": 790.0, "national_cases_7": 70, "national_population": 10000},
]}

CASES_WEEKLY = {"records": [
    {"country": "Germany", "country_code": "DEU", "continent": "Europe", "population": 83000000,
     "indicator": "cases", "weekly_count": 1000, "cumulative_count": 5000, "rate_14_day": 2.5,
     "year_week": "2021-10", "source": "TESSy"},
    {"country": "Germany", "country_code": "DEU", "continent": "Europe", "population": 83000000,
     "indicator": "deaths", "weekly_count": 10, "cumulative_count": 50, "rate_14_day": 0.1,
     "year_week": "2021-10", "source": "TESSy"},
    {"country": "Namibia", "country_code": "NAM", "continent": "Africa", "population": 2500000,
     "indicator": "cases", "weekly_count": 40, "cumulative_count": 400, "rate_14_day": 3.0,
     "year_week": "2021-10", "source": "TESSy"},
    {"country": "Africa (total)", "country_code": None, "continent": "Africa", "population": 1,
     "indicator": "cases", "weekly_count": 5, "cumulative_count": 9, "rate_14_day": 1.0,
     "year_week": "2021-10", "source": "TESSy"},
]}

CASES_DAILY = [
    {"day": 8, "month": 3, "year": 2021, "cases": 100, "deaths": 1, "countriesAndTerritories": "Germany",
     "geoId": "DE", "countryterritoryCode": "DEU", "popData2020": 83000000, "continentExp": "Europe"},
    {"day": 9, "month": 3, "year": 2021, "cases": None, "deaths": 2, "countriesAndTerritories": "Germany",
     "geoId": "DE", "countryterritoryCode": "DEU", "popData2020": 83000000, "continentExp": "Europe"},
    {"day": 10, "month": 3, "year": 2021, "cases": 50, "deaths": 0, "countriesAndTerritories": "Germany",
     "geoId": "DE", "countryterritoryCode": "DEU", "popData2020": 83000000, "continentExp": "Europe"},
    {"day": 1, "month": 3, "year": 2021, "cases": 7, "deaths": 0, "countriesAndTerritories": "Germany",
     "geoId": "DE", "countryterritoryCode": "DEU", "popData2020": 83000000, "continentExp": "Europe"},
]

VACCINE_TRACKER = {"records": [
    {"YearWeekISO": "2021-W10", "ReportingCountry": "DE", "Region": "DE", "TargetGroup": "Age10_14",
     "Vaccine": "COM", "FirstDose": 10, "FirstDoseRefused": None, "SecondDose": 5, "DoseAdditional1": 1,
     "DoseAdditional2": 0, "DoseAdditional3": 0, "DoseAdditional4": 0, "DoseAdditional5": 0,
     "UnknownDose": 0, "NumberDosesReceived": "n/a", "NumberDosesExported": 3, "Population": 1000,
     "Denominator": 900},
    {"YearWeekISO": "2021-W10", "ReportingCountry": "DE", "Region": "DE1", "TargetGroup": "1_Age60+",
     "Vaccine": "MOD", "FirstDose": 4, "FirstDoseRefused": "2", "SecondDose": None, "DoseAdditional1": 0,
     "DoseAdditional2": 0, "DoseAdditional3": 0, "DoseAdditional4": 0, "DoseAdditional5": 0,
     "UnknownDose": 1, "NumberDosesReceived": 100, "NumberDosesExported": None, "Population": 500,
     "Denominator": "12.0"},
    {"YearWeekISO": "2020-W53", "ReportingCountry": "FR", "Region": "FR", "TargetGroup": "ALL",
     "Vaccine": "COM", "FirstDose": 7, "FirstDoseRefused": None, "SecondDose": 1, "DoseAdditional1": 0,
     "DoseAdditional2": 0, "DoseAdditional3": 0, "DoseAdditional4": 0, "DoseAdditional5": 0,
     "UnknownDose": 0, "NumberDosesReceived": 20, "NumberDosesExported": 0, "Population": 700,
     "Denominator": 650},
]}


@pytest.fixture()
def landed(scratch):
    """Source files in a raw folder, as an extract step would land them."""
    raw = os.path.join(scratch, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "data.csv"), "w", encoding="utf8") as fh:
        fh.write(COUNTRY_LOOKUP_CSV)
    write_json(raw, "movementindicators.json", MOVEMENT_CURRENT)
    write_json(raw, "movementindicatorsarchive.json", MOVEMENT_ARCHIVE)
    write_json(raw, "nationalcasedeath.json", CASES_WEEKLY)
    write_json(raw, "nationalcasedeath_eueea_daily_ei.json", CASES_DAILY)
    write_json(raw, "vaccine-tracker.json", VACCINE_TRACKER)
    return raw
