import pytest

from layerloom import TableCatalog, TableDef
from layerloom.catalog import struct_of


@pytest.mark.parametrize(
    ("layer", "name"),
    [
        ("monitoring_layer", "monitoring_values"),
        ("landingzone_layer", "flights_landingzone"),
        ("raw_layer", "flights_raw"),
        ("datamodel_layer", "airports_datamodel"),
        ("enriched_layer", "flight_airport_departures_enriched"),
    ],
)
def test_definition_per_layer(layer, name):
    assert TableCatalog.default().definition(layer, name).name == name


def test_unknown_layer_and_table_raise():
    catalog = TableCatalog.default()
    with pytest.raises(ValueError):
        catalog.definition("invalid_layer", "airports_datamodel")
    with pytest.raises(ValueError):
        catalog.definition("raw_layer", "nothing_raw")
    with pytest.raises(ValueError):
        catalog.register(TableDef("x", "invalid_layer", "x", "x", "csv", struct_of("long a")))


def test_monitoring_tables_are_found_by_name_alone():
    catalog = TableCatalog.default()
    assert catalog.find("record_tracing").partition_column == "target_table_name"
    assert catalog.find("monitoring_values").layer == "monitoring_layer"


def test_layer_listing():
    names = set(TableCatalog.default().layer("datamodel_layer"))
    assert names == {"flights_datamodel", "airports_datamodel", "airlines_datamodel"}


def test_raw_tables_extend_landing_tables_by_history():
    catalog = TableCatalog.default()
    raw = catalog.find("timezone_raw").columns.names
    assert raw == ["Airport", "TimeZone", "TimeZoneOffset", "from_date", "to_date", "RecordID"]
    assert len(catalog.find("flights_landingzone").columns) == 31


def test_own_tables_can_be_registered():
    own = TableDef("sales_raw", "raw_layer", "raw", "sales", "parquet", struct_of("long a"))
    catalog = TableCatalog.default().register(own)
    assert catalog.find("sales_raw") is own
    assert own.source_name == "sales_raw"


def test_rules_reach_the_definitions():
    catalog = TableCatalog.default()
    assert len(catalog.find("airports_datamodel").signalling_checks) == 5
    assert catalog.find("airports_raw").signalling_checks == ()
    assert [c["check"] for c in catalog.find("flights_raw").quality_checks] == [
        "values in range",
        "values have format",
    ]
