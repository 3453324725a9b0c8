"""Physical layout helpers and the catalog of registered queries."""
