from meterlake.sources.configured import read_data
from meterlake.sources.files import (
    file_inventory,
    read_bronze,
    read_header_csv,
    read_measurement_file,
)
from meterlake.sources.object_store import s3a_settings
from meterlake.sources.tables import read_gold, read_silver

__all__ = [
    "file_inventory",
    "read_bronze",
    "read_data",
    "read_gold",
    "read_header_csv",
    "read_measurement_file",
    "read_silver",
    "s3a_settings",
]
