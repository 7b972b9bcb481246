"""Training-data operators: token counts, dedup, scoring, packing, search.

Nothing outside this subpackage imports it; its queries reach the engine
through ``quarry.llm.queries`` only.
"""
