"""Loading batches as their descriptions arrive: a file stream over a folder of JSON descriptions.

A description that cannot be read, or whose batch fails, goes to a folder of dead letters with its error and does not
hold up the others; `redrive` tries dead letters again.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.batches import Batch, run
from ..sources.store import Store

DEAD = "control/dead"


def described(text: str) -> Batch:
    """The batch that a description names; ValueError if it does not."""
    d = json.loads(text)
    missing = [k for k in ("batch_id", "load_type", "dt", "files") if not isinstance(d, dict) or not d.get(k)]
    if missing:
        raise ValueError(f"a description lacks {', '.join(missing)}")
    return Batch(d["batch_id"], d["load_type"], d["dt"], dict(d["files"]), datetime.fromisoformat(d["cutoff"]) if d.get("cutoff") else None)


def attempt(spark: SparkSession, root: str, text: str) -> str:
    """Load one described batch: LOADED, SKIPPED, or DEAD with a dead letter."""
    try:
        return run(spark, root, described(text))
    except Exception as e:  # whatever it is, the letter tells it and the batch's own log too
        Store(spark, root).create(f"{DEAD}/{uuid.uuid4().hex}.json", {"description": text, "error": f"{type(e).__name__}: {str(e)[:500]}"})
        return "DEAD"


def redrive(spark: SparkSession, root: str) -> dict[str, str]:
    """Try every dead letter once more; a letter goes when it is tried, and comes back as a new one if it fails again."""
    store = Store(spark, root)
    out = {}
    for name in store.names(DEAD):
        if not name.endswith(".json"):
            continue
        letter = store.read_json(f"{DEAD}/{name}")
        out[name] = attempt(spark, root, letter["description"])
        store.delete(f"{DEAD}/{name}")
    return out


def watch(spark: SparkSession, folder: str, root: str, checkpoint: str) -> StreamingQuery:
    """Load every description in the folder that no earlier call has seen, oldest batch id first, one at a time.

    The checkpoint remembers which files were seen, and the batch's log lets a repeated one pass without effect.
    """

    def load(rows, _: int) -> None:
        batch_id = F.coalesce(F.get_json_object("value", "$.batch_id"), F.lit(""))
        for r in rows.orderBy(batch_id, "value").collect():  # descriptions of batches, a few lines each
            attempt(spark, root, r.value)

    stream = spark.readStream.format("text").option("wholetext", True).load(folder)
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
