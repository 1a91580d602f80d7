"""The registered queries on the given tables, and the SQL that checks them."""
