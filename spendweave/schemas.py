"""Table schemas (Spark DDL), as far as the jobs need them."""

from .columns import CREATED, LEVELS, UPDATED


def _each(pattern: str, kind: str) -> str:
    return ", ".join(f"{pattern.format(level)} {kind}" for level in LEVELS)


_AUDIT = f"{CREATED} timestamp, {UPDATED} timestamp"

PO = ("ID bigint, GENERIC_DOCUMENT bigint, IS_BLANKET int, SHIP_TO_COUNTRY string, IS_ADHOC int, "
      f"SERVICE_TYPE string, {_AUDIT}")
CXML_DOCUMENT = ("ID bigint, FROM_ORG bigint, TO_ORG bigint, DASHBOARD_STATUS string, "
                 f"DOCUMENT_DATE timestamp, CREATED timestamp, {_AUDIT}")
PO_ITEM = ("ID bigint, PO bigint, DESCRIPTION string, MANUFACTURER_PART string, "
           "MANUFACTURER_NAME string, ITEM_TYPE string, ITEM_CATEGORY string, "
           "UNIT_OF_MEASURE string, SUPPLIER_PART string, SUPPLIER_PART_KID string, "
           f"SUPPLIER_PART_EXTENSION string, {_AUDIT}")
PO_ITEM_COMMODITY = f"ID bigint, PO_ITEM bigint, DOMAIN string, CODE string, {_AUDIT}"
ORG = f"ID bigint, ANID string, NAME string, {_AUDIT}"

ITEM = ", ".join((
    "ID string, PO_ITEM_ID decimal(28,0), PO_ID bigint, PO_ITEM_COMMODITY_ID bigint",
    "GENERIC_DOCUMENT_ID bigint, CXML_DOCUMENT_ID bigint",
    "DESCRIPTION string, PROCESSED_DESCRIPTION string, MANUFACTURER_PART string",
    "MANUFACTURER_NAME string, ITEM_TYPE string, ITEM_CATEGORY string, UNIT_OF_MEASURE string",
    "SUPPLIER_PART string, SUPPLIER_PART_NUMBER string, SUPPLIER_PART_EXTENSION string",
    "DOMAIN string, IS_BLANKET int, IS_ADHOC int, SHIP_TO_COUNTRY string, SERVICE_TYPE string",
    "BUYER_ORG bigint, SUPPLIER_ORG bigint, BUYER_NAME string, BUYER_ANID string",
    "SUPPLIER_NAME string, SUPPLIER_ANID string, DASHBOARD_STATUS string",
    "DOCUMENT_DATE timestamp, CREATED_DATE timestamp",
    _each("AN_UNSPSC_{}", "string"),
    "AN_DATA_QUALITY_LEVEL string, AN_DATA_QUALITY_LEVEL_MANUAL_REVIEWED string",
    _each("AN_CLASSIFICATION_QUALITY_{}", "string"),
    "AN_CLASSIFICATION_QUALITY_LEVEL_MANUAL_REVIEWED string",
    "AN_CLASSIFICATION_QUALITY_LEVEL_MANUAL_REVIEWED_AT timestamp",
    _each("SBN_PREDICATED_UNSPSC_{}", "string"),
    _each("SBN_PREDICTION_CONFIDENCE_{}", "decimal(6,5)"),
    "SBN_PREDICTION_LASTUPDATED_AT timestamp",
    _each("EXTERNAL_PREDICATED_UNSPSC_{}", "string"),
    _each("EXTERNAL_PREDICATION_CONFIDENCE_{}", "decimal(6,5)"),
    "EXTERNAL_PREDICATION_LASTUPDATED_AT timestamp",
    _each("FINAL_REPORT_UNSPSC_{}", "string"),
    _each("FINAL_REPORT_CONFIDENCE_{}", "decimal(6,5)"),
    "FINAL_REPORT_UNSPSC_MANUAL_LABELED string, FINAL_REPORT_LASTUPDATED_AT timestamp",
    "FINAL_REPORT_SOURCE string, BANNED_FROM_TRAINING int, BANNED_FROM_ENRICHMENT int",
    "MODEL_UUID string", _AUDIT))

VENDOR_FEED = ("DESCRIPTION string, PROCESSED_DESCRIPTION string, "
               f"{_each('PREDICATED_UNSPSC_{}', 'string')}, "
               f"{_each('PREDICATION_CONFIDENCE_{}', 'decimal(6,5)')}, "
               f"PREDICATION_LASTUPDATED_AT timestamp, {_AUDIT}")
VENDOR_REPORT = ("DESCRIPTION string, PROCESSED_DESCRIPTION string, "
                 f"{_each('UNSPSC_{}', 'string')}, {_each('CONFIDENCE_{}', 'decimal(6,5)')}, "
                 f"REPORT_LASTUPDATED_AT timestamp, {_AUDIT}")
MODEL_REPORT = (f"CONCAT_FEATURE string, {_each('UNSPSC_{}', 'string')}, "
                f"{_each('CONFIDENCE_{}', 'decimal(6,5)')}, REPORT_LASTUPDATED_AT timestamp, "
                f"MODEL_UUID string, {_AUDIT}")
MODEL_INFO = f"UUID string, NAME string, VERSION int, STAGE string, {_AUDIT}"
DIMENSION = ("ID string, PO_ITEM_ID decimal(28,0), DESCRIPTION string, DASHBOARD_STATUS string, "
             f"{_each('UNSPSC_{}', 'string')}, {_each('UNSPSC_CONFIDENCE_{}', 'decimal(6,5)')}, "
             f"REPORT_LASTUPDATED_AT timestamp, REPORT_SOURCE string, {_AUDIT}")
FACT = ("SUPPLIER_ANID string, PO bigint, ID bigint, BUYER_ORG bigint, SUPPLIER_ORG bigint, "
        "REQUESTED_DELIVERY_DATE timestamp, DOCUMENT_DATE timestamp, SHIP_TO_COUNTRY string, "
        "UNIT_OF_MEASURE string, QUANTITY bigint, UNIT_PRICE_USD bigint, PRODUCT_ID string, "
        f"IS_BLANKET int, {_AUDIT}")
NETWORK = ("SUPPLIER_ANID string, BUYER_ORG bigint, SUPPLIER_ORG bigint, "
           "REQUESTED_DELIVERY_DATE timestamp, DOCUMENT_DATE timestamp, SHIP_TO_COUNTRY string, "
           f"UNIT_OF_MEASURE string, {_each('UNSPSC_{}', 'string')}, ORDER_AMOUNT bigint, "
           "ORDER_UNITS bigint, AVERAGE_UNIT_PRICE_USD double, PO_COUNT bigint, "
           f"PO_ITEM_COUNT bigint, {_AUDIT}")
JOB_OFFSET = f"JOB string, OFFSET_AT timestamp, RESET_FLAG int, {_AUDIT}"
