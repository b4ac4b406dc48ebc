"""Column names and the open-row date shared by every layer."""

# Part of the stored-table contract.
RECORD_ID = "RecordID"
FROM_DATE = "from_date"
TO_DATE = "to_date"
OPEN_END = "2099-12-31"
HISTORY_COLUMNS = (FROM_DATE, TO_DATE, RECORD_ID)
LAYERS = (
    "landingzone_layer",
    "raw_layer",
    "datamodel_layer",
    "enriched_layer",
    "monitoring_layer",
)

LINEAGE = "_lineage"
LINEAGE_TYPE = "array<struct<source_table_name:string,source_RecordID:string>>"
