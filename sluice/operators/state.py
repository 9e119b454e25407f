"""The resume state that is safe to publish.

With every stream committed to the end of the log, the last STATE is adopted
whole. With streams committed to different points, each stream's bookmark is
the last one sent at or before its own point, and a stream without a commit
keeps the bookmark that was published before.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_rows(control: DataFrame) -> DataFrame:
    return control.filter(F.col("type") == "STATE").select("ord", "state_json")


def bookmark_entries(states: DataFrame) -> DataFrame:
    """(ord, stream, bookmark JSON) for every bookmark of every STATE."""
    bm = F.try_variant_get(F.parse_json("state_json"), "$.bookmarks", "map<string,variant>")
    return states.select("ord", F.explode(bm).alias("stream", "_bm")).select(
        "ord", "stream", F.to_json("_bm").alias("bookmark"))


def fold_bookmarks(states: DataFrame, committed: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Per stream, the last bookmark whose STATE is not ahead of what the
    stream has committed. `committed` is DataFrame[stream, committed]; a stream
    that is not in it has committed nothing and keeps its bookmark of
    `previous` (DataFrame[stream, bookmark]) if it has one."""
    # One row per stream goes to the tasks, never the STATE rows: left to itself the planner
    # broadcasts those if it has no size for `committed`, and the driver holds the whole log.
    safe = (bookmark_entries(states).join(F.broadcast(committed.select("stream", "committed")), "stream")
            .filter(F.col("ord") <= F.col("committed")).groupBy("stream").agg(F.max_by("bookmark", "ord").alias("bookmark")))
    if previous is None:
        return safe
    kept = previous.select("stream", "bookmark").join(safe.select("stream"), "stream", "left_anti")
    return safe.unionByName(kept)


def bookmark_frame(spark, document: dict | None) -> DataFrame:
    """DataFrame[stream, bookmark] of a published state."""
    marks = (document or {}).get("bookmarks") or {}
    return spark.createDataFrame([(s, json.dumps(b, sort_keys=True)) for s, b in marks.items()], "stream string, bookmark string")


def latest_state_document(states: DataFrame):
    """The last STATE whole (H4 advance_all: every stream of the log is committed to its end)."""
    latest = states.agg(F.max_by("state_json", "ord").alias("s")).collect()[0]["s"]
    return None if latest is None else json.loads(latest)


def held_back_state(states: DataFrame, committed: DataFrame, previous: dict | None = None):
    """H4: the last STATE, with the bookmark of every stream held back to what it committed."""
    document = latest_state_document(states)
    if not isinstance(document, dict) or not document.get("bookmarks"):
        return document
    held = fold_bookmarks(states, committed, bookmark_frame(states.sparkSession, previous))
    document["bookmarks"] = {r["stream"]: json.loads(r["bookmark"]) for r in held.collect()}  # one row per stream
    return document


def held_back_to(states: DataFrame, unsafe: dict, ord_type, previous: dict | None = None):
    """H4 for a load in which streams failed: `unsafe` has, per failed stream, the position
    of its first uncommitted message, or None if nothing of it was committed. All other
    bookmarks of the log are safe to its end."""
    document = latest_state_document(states)
    if not isinstance(document, dict) or not document.get("bookmarks"):
        return document
    from sluice.operators.epochs import ord_literal

    entries = bookmark_entries(states)
    safe = F.lit(True)
    for stream, start in unsafe.items():
        before = F.lit(False) if start is None else F.col("ord") < ord_literal(start, ord_type)
        safe &= (F.col("stream") != stream) | before
    held = entries.filter(safe).groupBy("stream").agg(F.max_by("bookmark", "ord").alias("bookmark"))
    kept = (previous or {}).get("bookmarks") or {}
    marks = {s: kept[s] for s in unsafe if s in kept}
    marks |= {r["stream"]: json.loads(r["bookmark"]) for r in held.collect()}  # one row per stream
    document["bookmarks"] = marks
    return document
