"""Traffic-sign codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Code, title, description.
SIGN_TYPES = [
    ("E1", "Parkeerverbod", "Parkeerverbod"),
    ("E2", "Verbod stil te staan", "Verbod stil te staan"),
    ("E3", "Verbod (brom)fietsen te plaatsen", "Verbod fietsen en bromfietsen te plaatsen"),
    ("E4", "Parkeergelegenheid", "Parkeergelegenheid"),
    ("E5", "Taxistandplaats", "Taxistandplaats"),
    ("E6", "Gehandicaptenparkeerplaats", "Gehandicaptenparkeerplaats"),
    ("E6a", "Gehandicaptenparkeerplaats algemeen", "Gehandicaptenparkeerplaats algemeen"),
    ("E6b", "Gehandicaptenparkeerplaats op kenteken", "Gehandicaptenparkeerplaats op kenteken"),
    ("E7", "Laden en lossen", "Gelegenheid bestemd voor het onmiddellijk laden en lossen van goederen"),
    ("E8", "Specifieke voertuigcategorie", "Parkeergelegenheid alleen bestemd voor de voertuigcategorie of groep voertuigen die op het bord is aangegeven"),
    ("E9", "Vergunninghouders", "Parkeergelegenheid alleen bestemd voor vergunninghouders"),
    ("E10", "Blauwe zone", "Parkeerschijf-zone met verplicht gebruik van parkeerschijf, tevens parkeerverbod indien er langer wordt geparkeerd dan de parkeerduur die op het bord is aangegeven"),
    ("E11", "Einde blauwe zone", "Einde parkeerschijf-zone met verplicht gebruik van parkeerschijf"),
    ("E12", "Park & Ride", "Parkeergelegenheid ten behoeve van overstappers op het openbaar vervoer"),
    ("E13", "Carpool", "Parkeergelegenheid ten behoeve van carpoolers"),
]


def e_types(spark: SparkSession) -> DataFrame:
    """The code list; a fixed handful of rows, so it may always be broadcast."""
    rows = [
        F.struct(F.lit(code).alias("code"), F.lit(title).alias("title"), F.lit(text).alias("description"))
        for code, title, text in SIGN_TYPES
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
