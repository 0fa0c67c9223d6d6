"""Values of the data contract."""

# Codes written into every matrix record.
GROUP_CODE = "7777"
TAX_AUTH_ID = ""
CUSTOMER_BUSINESS = "0B"
CUSTOMER_PERSONAL = "99"
PROVIDER_CODE = "99"
TRANSACTION_CODE = "01"
PER_TAXABLE_TYPE = "01"
DEFAULT_TAX_TYPE = "01"
DEFAULT_TAX_CAT = "00"
BLANK_ITEM_CODE = "000"

# Taxable status texts (upper case).
NOT_TAXABLE_TEXTS = ["NOT TAXABLE", "NONTAXABLE", "EXEMPT"]
TAXABLE_TEXTS = ["TAXABLE"]
UNCERTAIN_TEXTS = ["DRILL DOWN", "TO RESEARCH"]

# Exact-case status codes of the older status look-up.
LEGACY_STATUS = {
    "Not Taxable": 0,
    "Nontaxable": 0,
    "Exempt": 0,
    "Taxable": 1,
    "Drill Down": -1,
}
LEGACY_STATUS_DEFAULT = 1

# Naming convention of research files and geocodes.
FILE_NAME_SUFFIX = "SALES TAX RESEARCH"
STATE_SUFFIX = "00000000"

# US state names and codes.
US_STATES = {
    "ALABAMA": "AL",
    "ALASKA": "AK",
    "ARIZONA": "AZ",
    "ARKANSAS": "AR",
    "CALIFORNIA": "CA",
    "COLORADO": "CO",
    "CONNECTICUT": "CT",
    "DELAWARE": "DE",
    "DISTRICT OF COLUMBIA": "DC",
    "FLORIDA": "FL",
    "GEORGIA": "GA",
    "HAWAII": "HI",
    "IDAHO": "ID",
    "ILLINOIS": "IL",
    "INDIANA": "IN",
    "IOWA": "IA",
    "KANSAS": "KS",
    "KENTUCKY": "KY",
    "LOUISIANA": "LA",
    "MAINE": "ME",
    "MARYLAND": "MD",
    "MASSACHUSETTS": "MA",
    "MICHIGAN": "MI",
    "MINNESOTA": "MN",
    "MISSISSIPPI": "MS",
    "MISSOURI": "MO",
    "MONTANA": "MT",
    "NEBRASKA": "NE",
    "NEVADA": "NV",
    "NEW HAMPSHIRE": "NH",
    "NEW JERSEY": "NJ",
    "NEW MEXICO": "NM",
    "NEW YORK": "NY",
    "NORTH CAROLINA": "NC",
    "NORTH DAKOTA": "ND",
    "OHIO": "OH",
    "OKLAHOMA": "OK",
    "OREGON": "OR",
    "PENNSYLVANIA": "PA",
    "RHODE ISLAND": "RI",
    "SOUTH CAROLINA": "SC",
    "SOUTH DAKOTA": "SD",
    "TENNESSEE": "TN",
    "TEXAS": "TX",
    "UTAH": "UT",
    "VERMONT": "VT",
    "VIRGINIA": "VA",
    "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV",
    "WISCONSIN": "WI",
    "WYOMING": "WY",
}

# Output columns in file order.
MATRIX_COLUMNS = [
    "geocode", "tax_auth_id", "group", "item", "customer", "provider", "transaction",
    "taxable", "tax_type", "tax_cat", "effective", "per_taxable_type", "percent_taxable",
]
ITEM_COLUMNS = ["group", "item", "description"]

# The static product-group table.
PRODUCT_GROUPS = [(GROUP_CODE, "Custom product group")]
PRODUCT_GROUP_COLUMNS = ["group", "description"]

# Error types.
ERR_FILE = "FileProcessingError"
ERR_UNKNOWN_STATUS = "UnknownTaxableValueError"
ERR_NO_TAX_TYPE = "MissingTaxTypeError"
ERR_REPLICATION = "CityTreatmentReplicationError"
ERR_UNMAPPED = "ExcludedUnmappedResearchIds"
UNMAPPED_IMPACT = (
    "These records do not appear in matrix_update.csv or product_item_update.csv"
)

# Sample sizes quoted in error messages.
MISSING_TYPE_SAMPLE = 5
REPLICATION_SAMPLE = 10

# Texts of error messages.
MSG_FILE = "Could not determine geocode(s) for filename: {file}"
MSG_HEADER = "No headers found in the sheet at row {row}"
MSG_UNKNOWN_STATUS = (
    "Unknown taxable value '{text}' (normalized: '{upper}'). "
    "Known values: {known}. Uncertain values (skipped): {uncertain}"
)
MSG_NO_TAX_TYPE = (
    "No tax types found for geocode='{geocode}', tax_cat='{tax_cat}' - excluded {n} records "
    "from output. Affected items: {items}"
)
MSG_REPLICATION = (
    "City geocode '{geocode}' has {n} records but no matching state-level tax treatments found "
    "for parent geocode '{parent}'. Affected records: groups={groups}, items=[{items}], "
    "customers={customers}"
)
MSG_UNMAPPED = (
    "{n} research_ids could not be mapped to product codes and were excluded from output files"
)
