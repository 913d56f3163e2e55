"""Reading posts, tables and streams; writing results."""
