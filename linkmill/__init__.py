"""linkmill: link submissions and fetched pages to a clean text corpus, as Spark jobs."""
