"""Training-data operators: deduplication, filtering, decontamination, mixing, sharding, formatting.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; the contract queries over the driver tables are in
``surveil.llm.queries``.
"""
