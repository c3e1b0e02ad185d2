"""Named queries over the event tables and the SQL they are checked against."""
