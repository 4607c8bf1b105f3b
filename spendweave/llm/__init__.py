"""Operators for training-data pipelines: deduplication, personal data, packing, chat
formatting, tokenizing, URL and quality filters. Nothing else in the library imports this
package."""
