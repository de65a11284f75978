from meterlake.streaming.landing import read_landing, start_silver_stream

__all__ = ["read_landing", "start_silver_stream"]
