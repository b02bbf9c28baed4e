"""DuckDB SQL used as an independent oracle for the Spark operators (see ``__spark_entry__.oracle_sql``)."""
