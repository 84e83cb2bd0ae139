from sparkmon.constants import SENSORS
from sparkmon.schema import EVENT_SCHEMA, WIRE_SCHEMA


def test_wire_schema_has_all_fields_in_order():
    assert WIRE_SCHEMA.names == EVENT_SCHEMA.names
    assert set(SENSORS) < set(WIRE_SCHEMA.names)


def test_time_is_text_on_the_wire_and_typed_inside():
    assert WIRE_SCHEMA["event_time"].dataType.typeName() == "string"
    assert EVENT_SCHEMA["event_time"].dataType.typeName() == "timestamp"
