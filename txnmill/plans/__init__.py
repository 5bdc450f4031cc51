"""Jobs: whole runs from tables to tables, with gates between the stages."""
