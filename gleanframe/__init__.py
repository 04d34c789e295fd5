"""Listing-crawl analytics as Spark jobs over tables of fetched pages."""
