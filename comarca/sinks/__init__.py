"""Writers for tables, files, documents and JDBC warehouses."""
