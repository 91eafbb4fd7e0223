"""Operators of a training-data pipeline: quality, packing, URL rules, deduplication,
mixing, nearest neighbours, secrets, token counts, similarity joins, language ID,
conversation repair, vector codes, piece encoding.

Nothing else in the library imports this subpackage; its queries are in
``tidewater.llm.queries``.
"""
