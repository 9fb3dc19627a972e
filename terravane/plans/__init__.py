"""Plans over the driver tables: adapters and registered queries with their SQL."""
