"""Reports as a stream (optional, §2.19): depth and date of each well are the only state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHAINED = "well_name string, report_id string, dtim_start string, md_m double, md_in_start_m double, progress_m double, late boolean"


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    depth, day = state.get if state.exists else (None, "")
    rows = pd.concat(list(batches)).sort_values(["dtim_start", "report_id"])
    out = []
    for r in rows.itertuples():
        md = r.md_m if r.md_m == r.md_m and r.md_m else None
        late = r.dtim_start < day
        start = depth if md is not None and depth is not None and md >= depth and not late else None
        out.append((key[0], r.report_id, r.dtim_start, md, start, round(md - start, 2) if start is not None else None, late))
        if not late:
            depth, day = md if md is not None else depth, r.dtim_start
    state.update((depth, day))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in CHAINED.split(", ")])


def chained(reports: DataFrame) -> DataFrame:
    """WIN2 over a stream of (well_name, report_id, dtim_start, md_m); a report older than the well's last one is marked late and changes no state."""
    rows = reports.select("well_name", "report_id", "dtim_start", F.col("md_m").cast("double").alias("md_m"))
    return rows.groupBy("well_name").applyInPandasWithState(_step, CHAINED, "depth double, day string", "append", GroupStateTimeout.NoTimeout)


def windowed_hours(log: DataFrame, ts: str = "ts", late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Hours by category in windows of event time; rows later than the watermark are left out."""
    return log.withWatermark(ts, late).groupBy(F.window(ts, width), "category").agg(F.sum("hours").alias("hours"), F.count(F.lit(1)).alias("entries"))
