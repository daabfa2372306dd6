"""The standardisation rules as SQL expression text (for spark.sql reports).

Generated from the config constants, so the SQL and DataFrame paths share
one definition of the categories.
"""

from __future__ import annotations

from .. import config as C


def sql_lit(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_in_list(values) -> str:
    return "(" + ", ".join(sql_lit(v) for v in values) + ")"


def phase_case(col: str = "phase") -> str:
    arms = " ".join(f"WHEN {col} IN {sql_in_list(sp)} THEN {sql_lit(label)}"
                    for label, sp in C.PHASE_SPELLINGS.items())
    return f"CASE {arms} ELSE {sql_lit(C.UNKNOWN_PHASE)} END"


def status_expr(col: str = "overall_status") -> str:
    return f"coalesce({col}, {sql_lit(C.UNKNOWN_STATUS)})"
