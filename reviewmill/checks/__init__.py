"""The registered queries, each next to the SQL that an independent engine checks it with."""
