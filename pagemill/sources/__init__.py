"""Page, sitemap and table readers and writers."""
