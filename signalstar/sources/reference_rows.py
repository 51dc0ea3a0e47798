"""Authored rows that no raw source carries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalstar.sources.schemas import ENTITIES, PLACES, REGION_KEYS, SOURCES
from signalstar.sources.tables import local_table

# Entities in id order with their authored description. A price range
# is not known for any of them.
ENTITY_INFO = [
    ("BPC-157", "gastric/tissue injury repair, studied mainly in animal models", False),
    ("TB-500", "tissue repair and wound healing, studied mainly in animal models", False),
    ("Retatrutide", "triple hormone-receptor agonist studied for obesity and type 2 diabetes weight loss", False),
    ("Semaglutide", "GLP-1 receptor agonist for type 2 diabetes and chronic weight management", True),
    ("Ipamorelin", "growth hormone secretagogue studied for GH release and body composition", False),
    ("GHK-Cu", "copper-binding peptide studied for skin repair, collagen production and wound healing", False),
    ("Epitalon", "synthetic tetrapeptide studied for telomerase activation and cellular ageing", False),
    ("Tesamorelin", "GHRH analogue studied for reducing visceral fat; approved in the US (Egrifta) for HIV-associated lipodystrophy but not MHRA-approved in the UK", False),
    ("CJC-1295", "GHRH analogue studied for sustained growth hormone/IGF-1 elevation", False),
]

# Regions in id order with their geography codes.
REGION_CODES = [
    ("England", "E92000001"),
    ("Scotland", "S92000003"),
    ("Wales", "W92000004"),
    ("Northern Ireland", "N92000002"),
]

# Sources in id order with their authored reliability, 1 to 10.
SOURCE_RELIABILITY = [
    ("Google Trends", 7),
    ("PubMed", 9),
    ("GDELT", 5),
    ("Wikipedia", 6),
    ("ONS", 10),
]

# Which source fills which kind of row, and the event categories.
TREND_SOURCE = "Google Trends"
PAGEVIEW_SOURCE = "Wikipedia"
NEWS_CATEGORY = "News/Media"
PUBLICATION_CATEGORY = "Clinical research"

# Place codes of the nation-level and the region-level extract.
NATION_PLACES = [
    ("K02000001", "United Kingdom"),
    ("E92000001", "England"),
    ("S92000003", "Scotland"),
    ("W92000004", "Wales"),
    ("N92000002", "Northern Ireland"),
]
REGION_PLACES = [
    ("E12000001", "North East"),
    ("E12000002", "North West"),
    ("E12000003", "Yorkshire and The Humber"),
    ("E12000004", "East Midlands"),
    ("E12000005", "West Midlands"),
    ("E12000006", "East"),
    ("E12000007", "London"),
    ("E12000008", "South East"),
    ("E12000009", "South West"),
    ("W92000004", "Wales"),
    ("S92000003", "Scotland"),
    ("N92000002", "Northern Ireland"),
]


def entity_rows(spark: SparkSession, info=None) -> DataFrame:
    """The entity dimension, numbered from one in listing order."""
    info = ENTITY_INFO if info is None else info
    rows = [(i, name, usage, None, ok) for i, (name, usage, ok) in enumerate(info, 1)]
    return local_table(spark, rows, ENTITIES)


def source_rows(spark: SparkSession, reliability=None) -> DataFrame:
    reliability = SOURCE_RELIABILITY if reliability is None else reliability
    rows = [(i, name, score) for i, (name, score) in enumerate(reliability, 1)]
    return local_table(spark, rows, SOURCES)


def region_keys(spark: SparkSession, names=None) -> DataFrame:
    names = [name for name, _ in REGION_CODES] if names is None else names
    rows = [(i, name) for i, name in enumerate(names, 1)]
    return local_table(spark, rows, REGION_KEYS)


def place_codes(spark: SparkSession, places=None) -> DataFrame:
    return local_table(spark, NATION_PLACES if places is None else places, PLACES)
