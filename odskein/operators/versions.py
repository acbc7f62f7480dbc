"""The latest version of each member of a versioned dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.functions.nulls import blank_to_null
from odskein.operators.lookups import with_totals

# Country names the source dimension gets wrong, by ICAO prefix or by full code.
PREFIX_COUNTRY_NAMES = {"WI": "INDONESIA", "WR": "INDONESIA"}
CODE_COUNTRY_NAMES = {"XSPR": "CUBA"}


def latest_version(dimension: DataFrame, key: str, version: str) -> DataFrame:
    """Rows that carry their key's highest version, all of them when several tie.

    Rows without a key or without a version drop out. The maximum is an aggregate that is
    combined before the shuffle, and the semi join spreads one key's rows over its versions and
    can be split where a version has many; a window would sort all rows of a key in one task.
    """
    keyed = dimension.where(F.col(key).isNotNull())
    newest = keyed.groupBy(key).agg(F.max(version).alias(version))
    return with_totals(keyed, newest, [key, version], "left_semi")


def current_airports(airports: DataFrame, prefix_repair: bool = False) -> DataFrame:
    """Distinct attributes of each airport's latest version, country names repaired.

    The prefix rule compares the code *from its second character on* with a two-letter prefix, so
    it only meets three-letter codes. ``prefix_repair`` compares the first two characters.
    """
    code = F.col("cfmu_ap_code")
    part = F.substring(code, 1, 2) if prefix_repair else F.substr(code, F.lit(2))
    name = F.col("iso_ct_name")
    rules = [(part == prefix, country) for prefix, country in PREFIX_COUNTRY_NAMES.items()]
    rules += [(code == whole, country) for whole, country in CODE_COUNTRY_NAMES.items()]
    repaired = name
    for test, country in reversed(rules):
        repaired = F.when(test, country).otherwise(repaired)
    # Identical copies of a version are dropped before the versions are compared.
    versions = (
        airports.withColumn("cfmu_ap_code", blank_to_null(code))
        .select(
            "cfmu_ap_code",
            F.substring(code, 1, 2).alias("icao_ctry_code"),
            "cfmu_ap_name",
            repaired.alias("iso_ct_name"),
            "iso_ct_code",
            "latitude",
            "longitude",
            "valid_to",
        )
        .distinct()
    )
    return latest_version(versions, "cfmu_ap_code", "valid_to").drop("valid_to")
