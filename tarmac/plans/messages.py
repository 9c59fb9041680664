"""A message stream to windowed text files and to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.sinks.windowed_text import write_windows
from tarmac.streaming.messages import stamp, stamp_lines
from tarmac.streaming.runs import append_files


def stream_to_text_and_table(messages: DataFrame, out: str, state: str, drain: bool = True, width: str = "1 minute") -> list:
    """`messages` has (ts, message).  Two queries read the same stream: stamped lines go to
    one text file per window, stamped rows to a table."""
    return [
        write_windows(stamp_lines(messages, "ts").withColumnRenamed("value", "line"), f"{out}/text", f"{state}/text", width=width, drain=drain),
        append_files(stamp(messages), f"{out}/table", f"{state}/table", drain=drain),
    ]
