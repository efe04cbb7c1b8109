from postlake.sources.tables import (  # noqa: F401
    TABLES, read_table, posts, event_topics, ref_vectors, query_vectors, user_requests,
)
