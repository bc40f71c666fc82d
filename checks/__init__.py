"""One query per operator on the given tables, each beside the SQL that must give the same rows."""
