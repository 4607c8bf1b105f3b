"""Column names and codes shared by the tables.

Everything in this module is data that has to agree with the tables other
jobs read and write; there is no logic here.
"""

CREATED = "_DELTA_CREATED_ON"
UPDATED = "_DELTA_UPDATED_ON"
AUDIT = (CREATED, UPDATED)

LEVELS = ("SEGMENT", "FAMILY", "CLASS", "COMMODITY")

#: Codes of a purchase line without a usable classification, by level.
UNKNOWN_CODE = {"SEGMENT": "99", "FAMILY": "9999", "CLASS": "999999", "COMMODITY": "99999999"}

#: Spelling used by the vendor export and the one used by the star load.
STATUS_OBSOLETED = "PO_OBSOLETED"
STATUS_OBSOLETE = "PO_OBSOLETE"

#: Spellings of "not available" found in the raw text columns.
NA_SPELLINGS = ("N/A", "?", "null", "NULL", "Null", "NA", "Not Available",
                "not available", "NAN", "nan", "Nan")
NA = "N/A"

# -- raw tables, as projected by the extract ---------------------------------

PO_ITEM = ("ID as PO_ITEM_ID", "PO as PO_ID", "DESCRIPTION", "MANUFACTURER_PART",
           "MANUFACTURER_NAME", "ITEM_TYPE", "ITEM_CATEGORY", "UNIT_OF_MEASURE",
           "SUPPLIER_PART", "SUPPLIER_PART_KID as SUPPLIER_PART_NUMBER",
           "SUPPLIER_PART_EXTENSION")
PO_ITEM_COMMODITY = ("ID as PO_ITEM_COMMODITY_ID", "PO_ITEM", "DOMAIN", "CODE")
PO = ("ID", "GENERIC_DOCUMENT as GENERIC_DOCUMENT_ID", "IS_BLANKET", "SHIP_TO_COUNTRY",
      "IS_ADHOC", "SERVICE_TYPE")
DOCUMENT = ("ID as CXML_DOCUMENT_ID", "FROM_ORG as BUYER_ORG", "TO_ORG as SUPPLIER_ORG",
            "DASHBOARD_STATUS", "DOCUMENT_DATE", "CREATED as CREATED_DATE")
ORG = ("ID as ORG_ID", "ANID", "NAME")

# -- vendor exchange ----------------------------------------------------------

EXPORT = ("PO_ITEM_ID", "DESCRIPTION", "PROCESSED_DESCRIPTION", "MANUFACTURER_PART",
          "MANUFACTURER_NAME", "AN_UNSPSC_COMMODITY")
VENDOR_FEED = ("DESCRIPTION", "PROCESSED_DESCRIPTION",
               *(f"PREDICATED_UNSPSC_{level}" for level in LEVELS),
               "PREDICATION_LASTUPDATED_AT")
VENDOR_ITEM = ("ID", "PO_ITEM_ID", "PROCESSED_DESCRIPTION",
               *(f"EXTERNAL_PREDICATED_UNSPSC_{level}" for level in LEVELS),
               "EXTERNAL_PREDICATION_LASTUPDATED_AT")

#: Vendor feed column -> report column.
FEED_TO_REPORT = {**{f"PREDICATED_UNSPSC_{level}": f"UNSPSC_{level}" for level in LEVELS},
                  "PREDICATION_LASTUPDATED_AT": "REPORT_LASTUPDATED_AT"}

#: Report column -> item column, for vendor predictions.
REPORT_TO_ITEM = {**{f"UNSPSC_{level}": f"EXTERNAL_PREDICATED_UNSPSC_{level}" for level in LEVELS},
                  "REPORT_LASTUPDATED_AT": "EXTERNAL_PREDICATION_LASTUPDATED_AT"}

#: Report column -> item column, for predictions of our own model.
REPORT_TO_OWN = {**{f"UNSPSC_{level}": f"SBN_PREDICATED_UNSPSC_{level}" for level in LEVELS},
                 **{f"CONFIDENCE_{level}": f"SBN_PREDICTION_CONFIDENCE_{level}" for level in LEVELS},
                 "REPORT_LASTUPDATED_AT": "SBN_PREDICTION_LASTUPDATED_AT"}

#: Item columns the scoring job writes.
OWN_PREDICTION = ("ID", *(f"SBN_PREDICATED_UNSPSC_{level}" for level in LEVELS),
                  *(f"SBN_PREDICTION_CONFIDENCE_{level}" for level in LEVELS),
                  "MODEL_UUID", "SBN_PREDICTION_LASTUPDATED_AT")

# -- star schema ---------------------------------------------------------------

DIMENSION = ("ID", "PO_ITEM_ID", "DESCRIPTION", "DASHBOARD_STATUS",
             *(f"FINAL_REPORT_UNSPSC_{level} as UNSPSC_{level}" for level in LEVELS),
             *(f"FINAL_REPORT_CONFIDENCE_{level} as UNSPSC_CONFIDENCE_{level}" for level in LEVELS),
             "FINAL_REPORT_LASTUPDATED_AT as REPORT_LASTUPDATED_AT",
             "FINAL_REPORT_SOURCE as REPORT_SOURCE")
NETWORK_GROUP = ("SUPPLIER_ANID", "BUYER_ORG", "SUPPLIER_ORG", "REQUESTED_DELIVERY_DATE",
                 "DOCUMENT_DATE", "SHIP_TO_COUNTRY", "UNIT_OF_MEASURE",
                 *(f"UNSPSC_{level}" for level in LEVELS))
NETWORK_KEY = ("SUPPLIER_ANID", "BUYER_ORG", "SUPPLIER_ORG", "REQUESTED_DELIVERY_DATE",
               "DOCUMENT_DATE", "SHIP_TO_COUNTRY", "UNIT_OF_MEASURE", "UNSPSC_COMMODITY")

# -- model features ------------------------------------------------------------

FEATURE = "CONCAT_FEATURE"
FEATURE_PARTS = ("SUPPLIER_ORG", "BUYER_ORG", "DESCRIPTION", "MANUFACTURER_NAME",
                 "ITEM_TYPE", "IS_ADHOC")
TEXT_COLUMNS = ("SUPPLIER_ORG", "BUYER_ORG", "PO_ITEM_ID", "DESCRIPTION", "SUPPLIER_PART",
                "MANUFACTURER_PART", "MANUFACTURER_NAME", "ITEM_TYPE", "IS_ADHOC")
