"""zonemill: move tables through data-lake zones with Spark."""
