"""Readers and writers: JSON, CSV, Markdown, HTML, front matter, manifests and file trees."""
