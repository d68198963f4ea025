"""A manifest for each run of a stage: running, then completed or failed with the reason."""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from pathlib import Path

from evigrain.sources.files import write_json


@contextmanager
def stage_run(stage: str, folder: str | Path, inputs: list[str] = (), outputs: list[str] = ()) -> Iterator[dict]:
    """The manifest as a dictionary; what the body puts in counts is kept."""
    own = {"schema_version": "0.1", "run_id": uuid.uuid4().hex, "stage": stage, "status": "running", "started_at": datetime.now(UTC).isoformat(), "inputs": list(inputs), "outputs": list(outputs), "counts": {}, "errors": []}
    path = Path(folder) / f"{stage}-{own['run_id']}.json"
    write_json(path, own)
    try:
        yield own
        own["status"] = "completed"
    except BaseException as e:
        own["status"] = "failed"
        own["errors"].append({"type": type(e).__name__, "message": str(e), "trace": traceback.format_exc()})
        raise
    finally:
        own["finished_at"] = datetime.now(UTC).isoformat()
        write_json(path, own)
