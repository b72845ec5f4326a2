"""Jobs that chain the operators: raw files to tables, tables to the star schema."""
