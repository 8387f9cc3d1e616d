"""Reports over the tables and the registered queries."""
