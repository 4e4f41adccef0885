from .files import read_csv_inferred, read_history_csv, read_mart, write_csv
from .jdbc import read_jdbc, write_jdbc_replace
from .messages import parse_events, publish_slice, read_event_stream, to_messages, write_messages

__all__ = ["read_csv_inferred", "read_history_csv", "read_mart", "write_csv", "read_jdbc",
           "write_jdbc_replace", "parse_events", "publish_slice", "read_event_stream", "to_messages",
           "write_messages"]
