"""Refresh driven by landed reports, as a Structured Streaming query.

The warehouse is kept current by re-pulling the last N days and replacing that window
(late corrections overwrite earlier values). Here each finished landing posts a small
manifest line — which table, where the report is, which window — into a manifest folder.
A file-source stream over that folder runs the matching refresh for every manifest in a
micro-batch (``foreachBatch``):

* the stream's checkpoint records which manifests were processed, so a restarted job
  resumes where it stopped;
* every refresh is a window replace (idempotent), so a manifest re-run after a failure
  between the table write and the checkpoint commit gives the same table;
* ``Trigger.AvailableNow`` processes what has landed and stops (scheduled runs); a
  processing-time trigger keeps it running.

Manifests are control data (one line per landing); the reports themselves are read and
written by the distributed refresh jobs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import ingest as I

MANIFEST_SCHEMA = "kind string, table_name string, report_path string, start string, end string, landed_at string"


def post_manifest(spark: SparkSession, manifest_dir: str, kind: str, table_name: str, report_path: str,
                  start, end, landed_at: _dt.datetime | None = None) -> None:
    """Announce a finished landing (one JSON line, written as its own file) and when it landed."""
    landed_at = landed_at or _dt.datetime.now(_dt.timezone.utc)
    row = {"kind": kind, "table_name": table_name, "report_path": report_path,
           "start": str(start), "end": str(end), "landed_at": landed_at.isoformat(timespec="microseconds")}
    spark.createDataFrame([tuple(row.values())], MANIFEST_SCHEMA).coalesce(1) \
        .write.mode("append").json(manifest_dir)


def apply_manifest(spark: SparkSession, warehouse_root: str, m: dict) -> bool:
    """Run the refresh one manifest asks for."""
    table_path = f"{warehouse_root.rstrip('/')}/{m['table_name']}"
    if m["kind"] == "report":
        spec = I.REPORTS[m["table_name"]]
        return I.refresh_report(spark, m["report_path"], table_path, spec, m["start"], m["end"], warehouse_root)
    if m["kind"] == "yt_channel":
        return I.refresh_yt_channel(spark, m["report_path"], table_path, m["start"], m["end"])
    if m["kind"] == "yt_videos":
        return I.refresh_yt_videos(spark, m["report_path"], table_path, start=m["start"], end=m["end"])
    if m["kind"] == "rd_campaigns":  # the landing's records, and beside them their metrics
        return I.refresh_email_campaigns(spark, f"{m['report_path']}/campaigns", f"{m['report_path']}/metrics", table_path,
                                         m["start"], m["end"])
    if m["kind"] == "rd_leads":
        return I.refresh_lead_stage(spark, m["report_path"], table_path, m["start"], m["end"])
    raise ValueError(f"unknown manifest kind: {m['kind']}")


def start_refresh_stream(spark: SparkSession, manifest_dir: str, warehouse_root: str,
                         checkpoint: str, available_now: bool = True,
                         max_manifests_per_batch: int = 100, refresh_marts: bool = False) -> StreamingQuery:
    """Start the manifest-driven refresh. Manifests of one micro-batch are applied in
    the order they landed in, so a newer pull of the same window wins. ``checkpoint`` is the
    stream's own folder: a restart with the same one goes on where the last run stopped.

    With ``refresh_marts`` the day-local marts are then refreshed for the span of the
    batch's windows (``plans.build.refresh_marts_window``)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        # At most ``max_manifests_per_batch`` small control rows reach the driver.
        manifests = [r.asDict() for r in batch.orderBy("landed_at", "end", "report_path").collect()]
        for m in manifests:
            apply_manifest(spark, warehouse_root, m)
        if refresh_marts and manifests:
            from tidemark.plans.build import refresh_marts_window
            refresh_marts_window(spark, warehouse_root, min(m["start"] for m in manifests),
                                 max(m["end"] for m in manifests))

    stream = (spark.readStream.schema(MANIFEST_SCHEMA)
                   .option("maxFilesPerTrigger", max_manifests_per_batch)
                   .json(manifest_dir))
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
