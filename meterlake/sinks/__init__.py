from meterlake.sinks.database import export_table
from meterlake.sinks.files import write_csv, write_data, write_parquet, write_silver
from meterlake.sinks.load_record import append_load_record, read_load_records
from meterlake.sinks.small import to_pandas

__all__ = [
    "append_load_record",
    "export_table",
    "read_load_records",
    "to_pandas",
    "write_csv",
    "write_data",
    "write_parquet",
    "write_silver",
]
