"""Small inline inputs."""

from datetime import datetime

from odskein import schemas
from odskein.sources.literals import inline_rows


def at(text):
    return datetime.fromisoformat(text)


def flights(spark, rows):
    return inline_rows(
        spark,
        schemas.FLIGHTS,
        [(u, lobt and at(lobt), dep, des, kind, use) for u, lobt, dep, des, kind, use in rows],
    )


def aircraft(spark, rows=(("A1", "L2J"), ("H1", "H2T"))):
    return inline_rows(spark, schemas.AIRCRAFT_TYPES, list(rows))


AIRPORT_DEFAULTS = {
    "icao_ap_name": None,
    "iata_ap_code": None,
    "iata_ap_name": None,
    "ec_iso_ct_code": None,
    "iso_ct_code": None,
    "iso_ct_name": None,
    "longitude": None,
    "latitude": None,
    "valid_from": None,
    "valid_to": None,
    "cfmu_ap_code": None,
    "cfmu_ap_name": None,
}


def airports(spark, rows):
    full = []
    for number, row in enumerate(rows):
        record = {"sk_ap_id": number, "icao_ap_code": f"AP{number}", **AIRPORT_DEFAULTS, **row}
        for stamp in ("valid_from", "valid_to"):
            if isinstance(record[stamp], str):
                record[stamp] = at(record[stamp])
        full.append(tuple(record[name] for name in schemas.AIRPORTS.names))
    return inline_rows(spark, schemas.AIRPORTS, full)


def operational(spark, rows):
    return inline_rows(
        spark,
        schemas.OPERATIONAL_FLIGHTS,
        [(u, at(lobt), at(entry), dep, des, state) for u, lobt, entry, dep, des, state in rows],
    )


def country_rows(spark, rows):
    return inline_rows(spark, schemas.COUNTRY_FLOWS, rows)


def prepared(spark, rows):
    """Rows of (year, flights, origin iso and region, destination iso and region)."""
    return inline_rows(
        spark,
        schemas.PREPARED_FLOWS,
        [
            (y, n, o, o and f"Land {o}", r, d, d and f"Land {d}", s)
            for y, n, o, r, d, s in rows
        ],
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
