"""Rows for Bronze tables, built per test."""

import json
from datetime import UTC, datetime

from tidemark import schemas

STATE = "12345678-1234-1234-1234567890abcdef"
ACTION = "87654321-1234-1234-1234567890abcdef"
ROOM = "11111111-1234-1234-1234567890abcdef"


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def document(name="Meter", conflict=False, **more):
    controls = {
        ACTION: {
            "name": name, "type": "Meter", "uuidAction": ACTION, "room": ROOM, "states": {"actual": STATE},
            "subControls": {"named-child": {"name": "Child", "type": "Switch", "states": {"active": ACTION}}},
        }
    }
    if conflict:
        controls["other"] = {"name": "Other", "type": "Meter", "states": {"actual": STATE}}
    return json.dumps({"controls": controls, "rooms": {ROOM: {"name": "Plant"}}, "cats": {}, "padding": "x" * 1100} | more)


def message(i, received, parsed, source="home", kind=2, ingested=None):
    payload = parsed if isinstance(parsed, str) else json.dumps({"parsed": parsed})
    return (i, source, "run", at(received), kind, "json", payload, "sha", "1", at(ingested or received))


def structure(i, captured, payload, source="home", modified=None):
    return (i, source, at(captured), modified, payload, "sha", "1", at(captured))


def messages(spark, rows):
    return spark.createDataFrame(rows, schemas.MESSAGES)


def structures(spark, rows):
    return spark.createDataFrame(rows, schemas.STRUCTURES)
