"""Plans: the table layout, the election spec, the medallion stages, the
driver-table fixture, and the registered queries with their SQL oracles."""
