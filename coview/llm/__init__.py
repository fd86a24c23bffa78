"""Training-data operators: joins, packing, de-duplication, labelling, scoring.

Each module holds one operator with its general interface; ``queries`` holds
the thin ``opN_<name>`` queries the driver runs and their DuckDB SQL.
"""
