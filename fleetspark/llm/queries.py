"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import importlib

# name -> (module, function, SQL or None)
_REGISTERED = {
    "op1_quality_rules": ("quality", "OP1_SQL"),
    "op2_embedding_near_dedup": ("graph", None),
    "op3_chat_formatting": ("chat", "OP3_SQL"),
    "op4_piece_encoding": ("pieces", None),
    "op5_warc_derivatives": ("warc", None),
    "op6_suffix_array_dedup": ("suffixes", None),
    "op7_mix_sources": ("mixing", None),
    "op8_simhash_near_dedup": ("simhash", None),
    "op9_virtual_slots": ("sharding", None),
    "op10_lattice_scoring": ("lattice", None),
    "op11_structure_repair": ("repair", "OP11_SQL"),
    "op12_hard_negatives": ("negatives", "OP12_SQL"),
    "op13_personal_data": ("pii", "OP13_SQL"),
}


def _module(name: str):
    return importlib.import_module(f"fleetspark.llm.{name}")


def queries() -> dict:
    return {name: getattr(_module(m), name) for name, (m, _) in _REGISTERED.items()}


def oracle_sql() -> dict:
    return {name: getattr(_module(m), sql) for name, (m, sql) in _REGISTERED.items() if sql}
