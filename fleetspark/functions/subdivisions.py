"""Holiday subdivision codes in the form of the federal-state tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whole codes and their replacement; None means the subdivision is not used.
WHOLE_CODES = {
    # Austria
    "AT-BL": "AT-1", "AT-KÄ": "AT-2", "AT-NÖ": "AT-3", "AT-OÖ": "AT-4", "AT-SB": "AT-5", "AT-SM": "AT-6",
    "AT-TI": "AT-7", "AT-VA": "AT-8", "AT-WI": "AT-9",
    # Spain
    "ES-CN-LP-LA": "ES-CN", "ES-CN-SC-TE": "ES-CN", "ES-CN-SC-LG": "ES-CN", "ES-CN-SC-EH": "ES-CN",
    "ES-CN-LP-GC": "ES-CN", "ES-CN-LP-FV": "ES-CN", "ES-AN-SE": "ES-AN", "ES-AN-CO": "ES-AN", "ES-AN-JA": "ES-AN",
    "ES-AN-HL": "ES-AN", "ES-AN-MA": "ES-AN", "ES-AN-GR": "ES-AN", "ES-AR-HU": "ES-AR", "ES-AR-ZG": "ES-AR",
    "ES-AR-TE": "ES-AR",
    # Germany
    "DE-BY-AU": "DE-BY",
    # Poland
    "PL-DS": "PL-02", "PL-KP": "PL-04", "PL-LU": "PL-06", "PL-LB": "PL-08", "PL-LD": "PL-10", "PL-MA": "PL-12",
    "PL-MZ": "PL-14", "PL-OP": "PL-16", "PL-PK": "PL-18", "PL-PD": "PL-20", "PL-PM": "PL-22", "PL-SL": "PL-24",
    "PL-SK": "PL-26", "PL-WN": "PL-28", "PL-WP": "PL-30", "PL-ZP": "PL-32",
    # France
    "FR-AR": "FR-ARA", "FR-BF": "FR-BFC", "FR-BT": "FR-BRE", "FR-CV": "FR-CVL", "FR-GE": "FR-GES",
    "FR-GE-BR": "FR-GES", "FR-GE-HR": "FR-GES", "FR-GE-MO": "FR-GES", "FR-HF": "FR-HDF", "FR-IF": "FR-IDF",
    "FR-NO": "FR-NOR", "FR-NA": "FR-NAQ", "FR-OC": "FR-OCC", "FR-PL": "FR-PDL", "FR-SP": "FR-PAC",
    "FR-BL": None, "FR-CO": None, "FR-GP": None, "FR-GY": None, "FR-MF": None, "FR-MQ": None, "FR-PC": None,
    "FR-RU": None, "FR-YT": None, "FR-ZA": None, "FR-ZB": None, "FR-ZC": None,
    # Slovenia
    "SI-VR": None, "SI-ZR": None,
}

# The first two parts of a code decide, whatever follows.
REGION_CODES = {
    # Czechia
    "CZ-PR": "CZ-10", "CZ-ST": "CZ-20", "CZ-JC": "CZ-31", "CZ-PL": "CZ-32", "CZ-KA": "CZ-41", "CZ-US": "CZ-42",
    "CZ-LI": "CZ-51", "CZ-KR": "CZ-52", "CZ-PA": "CZ-53", "CZ-VY": "CZ-63", "CZ-JM": "CZ-64", "CZ-OL": "CZ-71",
    "CZ-ZL": "CZ-72", "CZ-MO": "CZ-80",
    # Italy
    "IT-AB": "IT-65", "IT-VA": "IT-23", "IT-PU": "IT-75", "IT-BA": "IT-77", "IT-ER": "IT-45", "IT-FV": "IT-36",
    "IT-CL": "IT-78", "IT-CM": "IT-72", "IT-LA": "IT-62", "IT-LI": "IT-42", "IT-LO": "IT-25", "IT-MA": "IT-57",
    "IT-MO": "IT-67", "IT-PI": "IT-21", "IT-SA": "IT-88", "IT-SI": "IT-82", "IT-TO": "IT-52", "IT-TR": "IT-32",
    "IT-UM": "IT-55", "IT-VE": "IT-34",
    # Portugal
    "PT-AV": "PT-01", "PT-BE": "PT-02", "PT-BR": "PT-03", "PT-BA": "PT-04", "PT-CB": "PT-05", "PT-CO": "PT-06",
    "PT-EV": "PT-07", "PT-FA": "PT-08", "PT-GU": "PT-09", "PT-LE": "PT-10", "PT-LI": "PT-11", "PT-PA": "PT-12",
    "PT-PO": "PT-13", "PT-SA": "PT-14", "PT-SE": "PT-15", "PT-VC": "PT-16", "PT-VR": "PT-17", "PT-VI": "PT-18",
    "PT-AC": "PT-20", "PT-MA": "PT-30",
}

# Swiss cantons; longer codes are cut to the canton.
CANTONS = [
    "CH-AG", "CH-AR", "CH-AI", "CH-BL", "CH-BS", "CH-BE", "CH-FR", "CH-GE", "CH-GL", "CH-GR", "CH-JU", "CH-LU", "CH-NE",
    "CH-NW", "CH-OW", "CH-SH", "CH-SZ", "CH-SO", "CH-SG", "CH-TI", "CH-TG", "CH-UR", "CH-VD", "CH-VS", "CH-ZG", "CH-ZH",
]


def _literal_map(entries: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def normalize_subdivision(code: Column) -> Column:
    """The code used for federal states; unknown codes stay as they are, unused ones become null."""
    whole = _literal_map({k: v for k, v in WHOLE_CODES.items() if v})
    unused = [k for k, v in WHOLE_CODES.items() if v is None]
    region = F.substring_index(code, "-", 2)
    by_region = _literal_map({**REGION_CODES, **{c: c for c in CANTONS}})
    return F.when(~code.isin(unused), F.coalesce(F.try_element_at(whole, code), F.try_element_at(by_region, region), code))
