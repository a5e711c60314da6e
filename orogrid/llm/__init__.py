"""Training-data operators: quality, URL filtering, deduplication, personal data, chat, mixing, WARC."""
