"""Deterministic per-row pseudo-random integers from plain integer arithmetic.

A row's values depend only on its id and a per-column salt, never on the
partitioning, so the same id range gives the same rows on 8 threads or 1000
executors. The mixer is the public 32-bit xor-shift-multiply integer hash
(multiplier 0x45d9f3b); only shifts, xor, masks and products below 2^59 are
used, so Spark and the SQL oracle compute identical values.

The hash is emitted as SQL select items that reference earlier items by
alias (lateral column aliases, supported by Spark and DuckDB), which keeps
every step a single small expression instead of a tree that repeats its
input at each xor-shift.
"""

from __future__ import annotations

MASK32 = 0xFFFFFFFF
MIX_MULTIPLIER = 0x45D9F3B


def _xor(a: str, b: str, dialect: str) -> str:
    return f"({a} ^ {b})" if dialect == "spark" else f"xor({a}, {b})"


def _shr16(a: str, dialect: str) -> str:
    return f"shiftright({a}, 16)" if dialect == "spark" else f"({a} >> 16)"


def hash_select_items(id_expr: str, salts: dict[str, int], dialect: str = "spark") -> list[str]:
    """Select items computing ``name = hash32(id, salt)`` for every salt;
    helper columns are prefixed ``_h_``."""
    items = [
        f"(CAST({id_expr} AS BIGINT) & {MASK32}) AS _h_lo",
        f"({_shr16(_shr16(f'CAST({id_expr} AS BIGINT)', dialect), dialect)} & {MASK32}) AS _h_hi",
    ]

    def mix(src: str, tag: str) -> str:
        for step in range(2):
            dst = f"_h_{tag}{step}"
            items.append(f"(({_xor(_shr16(src, dialect), src, dialect)} * {MIX_MULTIPLIER}) & {MASK32}) AS {dst}")
            src = dst
        dst = f"_h_{tag}x"
        items.append(f"{_xor(_shr16(src, dialect), src, dialect)} AS {dst}")
        return dst

    for name, salt in salts.items():
        items.append(f"{_xor('_h_lo', str(salt & MASK32), dialect)} AS _h_{name}_in")
        inner = mix(f"_h_{name}_in", f"{name}_a")
        items.append(f"{_xor(inner, '_h_hi', dialect)} AS _h_{name}_mid")
        outer = mix(f"_h_{name}_mid", f"{name}_b")
        items.append(f"{outer} AS {name}")
    return items
