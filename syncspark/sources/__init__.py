"""Sources: response payloads, sitemaps, web pages and tables."""
