"""The log of job runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from eventlode.functions.inline import inline_rows
from eventlode.schemas import JOB_RUNS
from eventlode.sources.tables import ParquetStore


def logged_run(store: ParquetStore, job_name: str, job_type: str, job: Callable[[], int]) -> int:
    """Run a job that returns its number of records and append one row on how it went.

    A job that fails is logged as failed and its error raised again.
    """
    started = datetime.now(timezone.utc)

    def log(status: str, records: int, error: str | None) -> None:
        ended = datetime.now(timezone.utc)
        row = (uuid.uuid4().hex, job_name, job_type, status, started, ended, records, error, None, ended)
        store.append("job_runs", inline_rows(store.spark, [row], JOB_RUNS))

    try:
        records = job()
    except Exception as error:
        log("failed", 0, str(error)[:2000])
        raise
    log("success", records, None)
    return records
