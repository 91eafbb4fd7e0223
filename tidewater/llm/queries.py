"""Registers the queries of every operator module."""

from tidewater.llm import conversations, language_id, mixing, neighbours, packing, piece_codec, quality, secrets, similarity_join, substring_dedup, token_counts, url_filter, vector_codes  # noqa: F401
from tidewater.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
