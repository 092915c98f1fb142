"""The registered queries over the shared tables, and the SQL that checks them."""
