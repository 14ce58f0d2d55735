"""Envelopes of captured messages; the socket client itself is outside."""

from __future__ import annotations

import base64
import hashlib
import json
from datetime import UTC, datetime
from typing import Any

#: Fixed: message types whose payload is parsed, stored raw only, and made by the
#: collector itself.
PARSED_TYPES, RAW_TYPES, META_TYPE = (0, 2, 3), (1, 4, 5, 7), 90
LEAST_DOCUMENT = 1000


def json_safe(x: Any) -> Any:
    """The nearest JSON value: bytes as text or base64, tuples as lists, odd keys
    as JSON text, anything else by its repr."""
    if x is None or isinstance(x, (str, int, float, bool)):
        return x
    if isinstance(x, (bytes, bytearray)):
        try:
            return bytes(x).decode()
        except UnicodeDecodeError:
            return {"__bytes_b64": base64.b64encode(bytes(x)).decode()}
    if isinstance(x, dict):
        return {k if isinstance(k, str) else compact_json(k): json_safe(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [json_safe(v) for v in x]
    return repr(x)


def compact_json(x: Any) -> str:
    return json.dumps(json_safe(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def envelope(raw: bytes | str, message_type: int, parsed: Any = None, now: datetime | None = None) -> str:
    """Text of a message: when, what came over the wire, and for parsed types its
    content."""
    if isinstance(raw, str):
        wire = {"encoding": "utf8", "data": raw}
    else:
        wire = {"encoding": "base64", "data": base64.b64encode(raw).decode()}
    body = {"captured_at": (now or datetime.now(UTC)).isoformat(timespec="microseconds"), "transport": wire}
    if message_type in PARSED_TYPES:
        body["parsed"] = parsed
    return compact_json(body)


def meta_event(event: str, now: datetime | None = None, **details: Any) -> str:
    return compact_json({"captured_at": (now or datetime.now(UTC)).isoformat(timespec="microseconds"), "event": event, **details})


def structure_row(source_id: str, text: str, status: int = 200, version: str = "1", now: datetime | None = None) -> dict:
    """A configuration snapshot known by its content; raises on one that is not
    worth keeping."""
    if status != 200:
        raise ValueError(f"status {status}")
    if len(text) < LEAST_DOCUMENT:
        raise ValueError("the document is too short")
    doc = json.loads(text)
    if not isinstance(doc, dict) or not doc.get("controls"):
        raise ValueError("the document has no controls")
    sha = hashlib.sha256(text.encode()).hexdigest()
    at = now or datetime.now(UTC)
    return {
        "structure_id": f"{source_id}:{sha}", "source_id": source_id, "captured_at": at, "last_modified": doc.get("lastModified"),
        "payload_json": text, "payload_sha256": sha, "collector_version": version, "ingested_at": at,
    }
