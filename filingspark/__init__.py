"""Spark operators for public-company data: filings, news, candles and text."""
