"""SQL for the merge queries, written as the union of its three cases.

Matched rows come from an inner join, new rows and absent rows from NOT EXISTS.  That is a
different route to the result than the single outer join of the merge operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from workload.registry import RUN_TS_SQL


def merge_sql(
    target: str,
    source: str,
    keys: Sequence[str],
    writes: dict[str, str],
    changed: str,
    columns: Sequence[str],
    absent: str = "keep",
    insert: bool = True,
    insert_only: Sequence[str] = (),
    flag: str | None = None,
    deleted_at: str | None = None,
    updated_at: str | None = None,
) -> str:
    """``writes`` maps a column to the source expression written (alias ``s``); ``changed`` is
    the condition under which a matched row (aliases ``s``, ``t``) is updated; ``columns`` are
    the target's columns in order."""
    match = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    audit = {c for c in (flag, deleted_at, updated_at) if c}

    def matched(c: str) -> str:
        if c in keys or c in insert_only:
            return f't."{c}"'
        if c in writes:
            return f'CASE WHEN {changed} THEN {writes[c]} ELSE t."{c}" END'
        if c == flag:
            return f'CASE WHEN {changed} THEN 0 ELSE t."{c}" END'
        if c == deleted_at:
            return f'CASE WHEN {changed} THEN NULL ELSE t."{c}" END'
        if c == updated_at:
            return f'CASE WHEN {changed} THEN {RUN_TS_SQL} ELSE t."{c}" END'
        return f't."{c}"'

    def inserted(c: str) -> str:
        if c in keys or c in insert_only:
            return f's."{c}"'
        if c in writes:
            return writes[c]
        return "0" if c == flag else "NULL"

    live = f't."{flag}" = 0' if flag else f't."{deleted_at}" IS NULL'

    def gone(c: str) -> str:
        if absent != "soft" or c not in audit:
            return f't."{c}"'
        new = "1" if c == flag else RUN_TS_SQL
        return f'CASE WHEN {live} THEN {new} ELSE t."{c}" END'

    gone_action = f"CASE WHEN {live} THEN 'delete' ELSE 'keep' END" if absent == "soft" else "'keep'"

    def row(make, action: str) -> str:
        return ", ".join(f'{make(c)} AS "{c}"' for c in columns) + f", {action} AS merge_action"

    parts = [
        f"SELECT {row(matched, f'''CASE WHEN {changed} THEN 'update' ELSE 'keep' END''')} "
        f"FROM tgt t JOIN src s ON {match}"
    ]
    if insert:
        parts.append(
            f"SELECT {row(inserted, chr(39) + 'insert' + chr(39))} FROM src s "
            f"WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE {match})"
        )
    if absent != "hard":
        parts.append(
            f"SELECT {row(gone, gone_action)} FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE {match})"
        )
    return f"WITH tgt AS ({target}), src AS ({source}) " + " UNION ALL ".join(parts)


def any_differs(pairs: Sequence[tuple[str, str]]) -> str:
    """True when one pair is known to differ; a comparison with NULL counts as equal."""
    return "(" + " OR ".join(f"COALESCE({a} <> {b}, FALSE)" for a, b in pairs) + ")"
