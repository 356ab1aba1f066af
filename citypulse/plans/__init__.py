"""Query catalog: named plans over the fixture tables, with DuckDB oracles."""
