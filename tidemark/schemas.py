"""Schemas of the stored tables, as DDL strings. JSON documents stay text, so
that what was received is kept byte for byte."""

MESSAGES = (
    "message_id string, source_id string, run_id string, received_at timestamp, message_type int, "
    "payload_format string, payload_json string, payload_sha256 string, collector_version string, ingested_at timestamp"
)
STRUCTURES = (
    "structure_id string, source_id string, captured_at timestamp, last_modified string, payload_json string, "
    "payload_sha256 string, collector_version string, ingested_at timestamp"
)
STATE_UUID_MAP = (
    "structure_id string, structure_captured_at timestamp, structure_last_modified string, state_uuid string, "
    "state_name string, control_uuid string, control_name string, control_type string, room_uuid string, "
    "room_name string, category_uuid string, category_name string, mapping_source string, mapping_priority int, "
    "control_path string, loaded_at timestamp"
)
STRUCTURE_VERSIONS = (
    "structure_id string, source_id string, structure_captured_at timestamp, structure_last_modified_raw string, "
    "structure_last_modified timestamp_ntz, payload_sha256 string, collector_version string, ingested_at timestamp, "
    "payload_bytes long, control_count long, control_object_count long, state_mapping_count long, room_count long, "
    "category_count long"
)
STATE_EVENTS = (
    "received_at timestamp, received_at_berlin timestamp_ntz, source_id string, message_id string, message_type int, "
    "state_uuid string, state_name string, control_uuid string, control_name string, control_type string, "
    "room_uuid string, room_name string, category_uuid string, category_name string, value_numeric double, "
    "value_text string, value_json string, structure_id string, structure_captured_at timestamp, "
    "structure_last_modified string, structure_resolution string, mapping_source string, mapping_priority int, "
    "competing_best_mappings int, resolution_status string, bronze_ingested_at timestamp, loaded_at timestamp"
)
PROCESSED = "source_id string, message_id string, structure_id string"
LOAD_RUNS = (
    "load_run_id string, started_at timestamp, finished_at timestamp, status string, source_max_ingested_at timestamp, "
    "structures_loaded long, mappings_loaded long, messages_processed long, events_inserted long, error_message string"
)
CURRENT_STATE = (
    "source_id", "state_uuid", "state_name", "control_uuid", "control_name", "control_type", "room_uuid", "room_name",
    "category_uuid", "category_name", "last_received_at", "last_received_at_berlin", "value_numeric", "value_text",
    "value_json", "structure_id", "resolution_status",
)
