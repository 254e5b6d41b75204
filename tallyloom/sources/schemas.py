"""Declared schemas of every input and table. Nothing is inferred at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT, INT, LONG, DATE, FLAG = StringType(), IntegerType(), LongType(), DateType(), BooleanType()


def texts(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, TEXT) for name in names])


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _table(*columns: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(name, kind, not required) for name, kind, required in columns])


# ---- landed JSON pages ----

AFFILIATION_PAGE = StructType(
    [
        StructField(
            "search-results",
            StructType(
                [
                    StructField("opensearch:totalResults", TEXT),
                    StructField(
                        "entry",
                        ArrayType(texts(["dc:identifier", "eid", "prism:url", "affiliation-name", "document-count"])),
                    ),
                ]
            ),
        )
    ]
)

AUTHOR_ENTRY = texts(["authid", "given-name", "surname", "authname"])

# Fixed mapping: page field -> publication column, in table order.
PUBLICATION_FIELDS = {
    "DOCUMENT_DESC": "dc:description",
    "DOCUMENT_TITLE_LBL": "dc:title",
    "ELECTRONIC_ID": "eid",
    "ARTICLE_NBR": "article-number",
    "SUB_TYPE_ID": "subtype",
    "SUB_TYPE_LBL": "subtypeDescription",
    "PRISM_ISSN_LBL": "prism:issn",
    "PRISM_COVER_DT": "prism:coverDate",
    "FA_LBL": "@_fa",
    "PRISM_DIGITAL_OBJECT_ID": "prism:doi",
    "PRISM_COVER_DISPLAY_DT": "prism:coverDisplayDate",
    "AUTHOR_KEYWORDS_DESC": "authkeywords",
    "DOCUMENT_CREATOR_NM": "dc:creator",
    "PRISM_PAGE_RANGE_LBL": "prism:pageRange",
    "PRISM_URL": "prism:url",
    "SOURCE_ID": "source-id",
    "PRISM_PUBLICATION_NM": "prism:publicationName",
    "CITED_BY_CNT": "citedby-count",
    "PUBLIC_ITEM_ID": "pii",
    "OPEN_ACCESS_IND": "openaccessFlag",
    "OPEN_ACCESS_IND_LBL": "openaccessFlag",
    "FUND_NBR": "fund-no",
    "PRISM_VOLUME_NBR": "prism:volume",
    "PRIMS_AGGREGATION_TYPE_LBL": "prism:aggregationType",
}
# An entry has the mapped fields, its identifier, and its authors.
PUBLICATION_ENTRY = StructType(
    [
        StructField("dc:identifier", TEXT),
        *[StructField(f, FLAG if f == "openaccessFlag" else TEXT) for f in dict.fromkeys(PUBLICATION_FIELDS.values())],
        StructField("author", ArrayType(AUTHOR_ENTRY)),
    ]
)

PUBLICATION_PAGE = StructType(
    [
        StructField(
            "search-results",
            StructType(
                [
                    StructField("opensearch:Query", texts(["@searchTerms"])),
                    StructField("entry", ArrayType(PUBLICATION_ENTRY)),
                ]
            ),
        )
    ]
)

CITATION_OVERVIEW = StructType(
    [
        StructField(
            "abstract-citations-response",
            StructType(
                [
                    StructField("identifier-legend", record(identifier=ArrayType(texts(["scopus_id"])))),
                    StructField(
                        "citeColumnTotalXML",
                        record(
                            citeCountHeader=record(
                                columnHeading=ArrayType(texts(["$"])), columnTotal=ArrayType(texts(["$"]))
                            )
                        ),
                    ),
                ]
            ),
        )
    ]
)

METRIC_DOCUMENT = record(
    id_value=TEXT,
    count_categories=ArrayType(
        record(
            name=TEXT,
            count_types=ArrayType(record(name=TEXT, total=LONG, sources=ArrayType(record(name=TEXT, total=LONG)))),
        )
    ),
)

# ---- bibliometric tables (fixed names) ----

AFFILIATION = _table(
    ("AFFILIATION_ID", INT, True),
    ("ELECTRONIC_ID", TEXT, True),
    ("PRISM_URL", TEXT, False),
    ("AFFILIATION_NM", TEXT, False),
    ("DOCUMENT_CNT", INT, False),
)

_PUBLICATION_TYPES = {"PRISM_COVER_DT": DATE, "PRISM_COVER_DISPLAY_DT": DATE, "OPEN_ACCESS_IND": INT}

PUBLICATION = _table(
    ("DOCUMENT_ID", TEXT, True), *[(c, _PUBLICATION_TYPES.get(c, TEXT), False) for c in PUBLICATION_FIELDS]
)
AFFILIATION_PUBLICATION = _table(("DOCUMENT_ID", TEXT, True), ("AFFILIATION_ID", TEXT, True))
AUTHOR = _table(
    ("AUTHOR_ID", TEXT, True), ("FIRST_NM", TEXT, False), ("LAST_NM", TEXT, False), ("FULLNAME", TEXT, False)
)
AUTHOR_PUBLICATION = _table(("AUTHOR_ID", TEXT, True), ("DOCUMENT_ID", TEXT, True))
CITATION_COUNT_BY_YEAR = _table(("DOCUMENT_ID", TEXT, True), ("YEAR_LBL", TEXT, True), ("CITATION_CNT", INT, False))
IMPACT_FLAT = _table(
    ("DOCUMENT_ID", TEXT, False),
    ("CATEGORY_LBL", TEXT, False),
    ("SUB_CATEGORY_LBL", TEXT, False),
    ("METRIC_CNT", LONG, False),
    ("CITATION_SOURCE_LBL", TEXT, False),
    ("CITATION_SOURCE_CNT", LONG, False),
)
IMPACT_METRIC = _table(
    ("DOCUMENT_ID", TEXT, True),
    ("CATEGORY_LBL", TEXT, True),
    ("SUB_CATEGORY_LBL", TEXT, True),
    ("METRIC_CNT", LONG, False),
)
IMPACT_CITATION_SOURCE = _table(
    ("DOCUMENT_ID", TEXT, True),
    ("CATEGORY_LBL", TEXT, True),
    ("SUB_CATEGORY_LBL", TEXT, True),
    ("CITATION_SOURCE_LBL", TEXT, True),
    ("METRIC_CNT", LONG, False),
)
AFFILIATION_SECTOR = _table(("AFFILIATION_ID", INT, False), ("SECTOR_ID", INT, False))
SECTOR = _table(("SECTOR_ID", INT, False), ("SECTOR_LBL", TEXT, False), ("SECTOR_DESC", TEXT, False))
AFFILIATION_INDICATOR = _table(("AFFILIATION_ID", INT, False), ("INDICATOR_CD", TEXT, False))
ACKNOWLEDGEMENTS_BY_YEAR = texts(["YEAR_LBL", "ACKNOWLEDGEMENTS"])

# ---- project tracker sheet: fixed column names by position ----

TRACKER_DESCRIPTIVE = [
    "LAST_UPDATED_DT",
    "EAD_FILE_NBR",
    "PROJECT_NM",
    "PROPONENT_LBL",
    "PROJECT_TYPE_LBL",
    "PROVINCE_LBL",
    "EAD_OFFICER_LBL",
    "PROCESS_LBL",
    "CURRENT STATUS_LBL",
    "PHASE_LBL",
    "NEXT_DEADLINE_LBL",
    "NEXT_ACTIVITY_DESC",
    "Expert_Input_Required_For_Next_Deadline_LBL",
    "EA_IA_DOCUMENTATION_ISSUED_LBL",
    "INPUT_CAPTURED_IN_EA_IA_DOCUMENTATION_LBL",
    "ASKED_FOR_HRF_INPUT_LBL",
    "HRF_INPUT_PROVIDED_LBL",
]
TRACKER_INDICATORS = [
    "HYDROGEO_IND",
    "SEISMICITY_IND",
    "TERRAIN_HAZARDS_IND",
    "GEOLOGY_IND",
    "PERMAFROST_IND",
    "COASTAL_GEOSCIENCE_IND",
    "MARINE_GEOHAZARDS_IND",
    "EXPLOSIVES_IND",
    "GEOCHEM_ARD_ML_IND",
    "PIPELINE_INT_IND",
    "LMS_ECONOMIC_IND",
    "FORESTS_FORESTRY_SCIENCE_IND",
    "HEAVY_OIL_BITUMEN_TAILINGS_IND",
    "EMISSIONS_STORAGE_FLARING_HYDROCARBONS_IND",
    "ENERGY_ECONOMIC_IND",
    "ENERGY_POLICY_IND",
]

# ---- lab samples ----

SAMPLE_DIMENSION = [
    "Sample ID",
    "Project Name",
    "Sample Type",
    "Material Type",
    "Lithology",
    "Zone",
    "Borehole",
]
SAMPLE_RESULT = texts(
    [
        "SAMPLE_ID",
        "Project_NM",
        "Sample_Type_LBL",
        "Material_Type_LBL",
        "Lithology_LBL",
        "Zone_LBL",
        "Borehole_LBL",
        "Test_NM",
        "Value_SRT",
    ]
)

# ---- labour force and audit ----

LABOUR_FORCE = texts(["GEO", "Date", "VALUE", "Labour_force_characteristics", "NAICS"])

# Sheet letter -> name of the audit columns.
AUDIT_CELLS = {
    "A": "cardholder",
    "B": "merchant",
    "C": "description",
    "D": "date",
    "E": "total",
    "N": "merchant_category",
    "AE": "gl_code",
}
