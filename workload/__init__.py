"""The library on the driver's tables: adapters, registered queries and their SQL oracles."""
