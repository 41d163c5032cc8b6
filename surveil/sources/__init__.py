from surveil.sources.bars import read_bars, ticks_to_bars
from surveil.sources.tables import read_cases, read_metadata, parse_listing, read_listing, read_candidates
from surveil.sources.sinks import write_table, load_or_build

__all__ = [
    "read_bars", "ticks_to_bars", "read_cases", "read_metadata", "parse_listing",
    "read_listing", "read_candidates", "write_table", "load_or_build",
]
