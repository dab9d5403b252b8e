"""noticeloom: Spark jobs that turn landed housing notices into a queryable, quality-gated table."""
