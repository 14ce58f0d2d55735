"""Command line: python -m tidemark.cli COMMAND. Paths and limits come from
arguments, or from environment variables named like them (TIDEMARK_STORE, ...)."""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
from datetime import UTC, datetime

from pyspark.sql import functions as F

from .operators.reports import health, spool_status, upload_report
from .plans.publish import Outbox, Target, publish
from .plans.refresh import Limits, Refresh
from .plans.upload import Uploader, UploadLimits
from .session import session
from .sources import archive_spool, archived_messages, archived_structures, note_failed, note_uploaded, read_spool, tables

SPOOL = "message_id string, source_id string, run_id string, received_at timestamp, message_type int, payload_format string, payload_json string, payload_sha256 string, collector_version string, uploaded_at timestamp"
STRUCTURES = "structure_id string, source_id string, captured_at timestamp, last_modified string, payload_json string, payload_sha256 string, collector_version string"
KEYS = {"ws_messages": "message_id", "structures": "structure_id"}


def identifier(name: str) -> str:
    """A plain SQL identifier, or an error."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **more):
        c = sub.add_parser(name)
        for k, v in more.items():
            env = os.environ.get(f"TIDEMARK_{k.upper()}")
            kind = str if v is None else type(v)
            c.add_argument(f"--{k.replace('_', '-')}", type=kind, default=kind(env) if env else v, required=v is None and env is None)
        return c

    command("refresh", store=None, archive=None, batch_size=5000, max_batches=12, max_seconds=600.0).add_argument("--check", action="store_true")
    command("upload", store=None, spool=None, batch_size=5000, max_batches=12, max_seconds=240.0)
    command("archive", archive=None, spool=None, max_rows=1000, max_bytes=32 << 20, max_batches=4)
    command("publish", outbox=None, target=None, max_batches=10, max_seconds=120.0)
    command("report", spool=None, window_minutes=10.0, ingress_per_day=0.0)
    command("health", spool=None).add_argument("--no-backlog", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark, code = session(), 0
    if a.command == "refresh":
        r = Refresh(spark, a.store, lambda: archived_messages(spark, a.archive), lambda: archived_structures(spark, a.archive), Limits(a.batch_size, a.max_batches, max_seconds=a.max_seconds))
        out = r.preflight() or {"status": "ok"} if a.check else r.run()
    elif a.command == "upload":
        # rows that are noted as uploaded are not read again
        schemas = {"ws_messages": SPOOL, "structures": f"{STRUCTURES}, uploaded_at timestamp"}
        spools = {t: lambda t=t: read_spool(spark, a.spool, t, schemas[t]).where("uploaded_at IS NULL") for t in tables(a.spool) if t in schemas}

        def outcome(table, keys, error):
            return note_uploaded(a.spool, table, KEYS[table], keys) if error is None else note_failed(a.spool, table, KEYS[table], keys, error)

        out = Uploader(spark, a.store, spools, UploadLimits(a.batch_size, a.max_batches, a.max_seconds), outcome=outcome).run()
    elif a.command == "archive":
        out = {}
        for table, schema, at in (("ws_messages", SPOOL, "received_at"), ("structures", STRUCTURES, "captured_at")):
            if table not in tables(a.spool):
                continue
            ingested = lambda after, table=table, schema=schema: read_spool(spark, a.spool, table, f"row_id long, {schema}", after).drop("uploaded_at").withColumn("ingested_at", F.current_timestamp())
            out[table] = archive_spool(ingested, a.archive, table, at, a.max_rows, a.max_bytes, a.max_batches)
    elif a.command == "publish":
        out = publish(Outbox(spark, a.outbox), Target(spark, a.target), a.max_batches, a.max_seconds)
    else:
        spool, now = read_spool(spark, a.spool, "ws_messages", SPOOL), datetime.now(UTC)
        if a.command == "report":
            out = upload_report(spool, now, a.window_minutes, a.ingress_per_day)
        else:
            try:
                status = spool_status(spool).first().asDict()
            except Exception as e:  # the spool cannot be read
                print(json.dumps({"error": type(e).__name__}))
                return 2
            aware = {k: v.replace(tzinfo=UTC) if isinstance(v, datetime) else v for k, v in status.items()}
            problems = health(aware, now, check_backlog=not a.no_backlog)
            out, code = status | {"problems": problems}, int(bool(problems))
    print(json.dumps(out, default=str, sort_keys=True))
    return code


if __name__ == "__main__":
    sys.exit(main())
