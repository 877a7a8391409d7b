"""The merge family: one operator, configured by a ``MergeSpec``.

A merge takes the current target and a full source extract and yields the next snapshot of
the target.  Built-in file tables have no row-level UPDATE, so every flavour is a join that
shuffles each side at most once, on the key:

* absent rows soft-deleted or kept, new rows inserted, the plain upsert by key: one full outer join;
* absent rows deleted for good: ``source left join target``;
* update of existing rows only: ``target left join source``.

Keys must be unique and not NULL on both sides.  The check rides on the shuffle and sort the join
needs anyway.  It looks at two rows per key only, so a key repeated any number of times is cut
down before the shuffle and fails the run instead of filling one task.

A target whose keys may repeat or be NULL says so (``unique_target=False``).  A full outer join
cannot split a key that holds much of it, so the join is then taken apart: the target left joins
the source, which adaptive execution can split, and the source rows without a target are those
that an anti join with the target's distinct keys leaves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE, KEEP, REMOVE = "insert", "update", "delete", "keep", "remove"
ACTION = "merge_action"


@dataclass(frozen=True)
class Rule:
    """How one column is compared and written.

    ``fill`` replaces a NULL of the source before it is compared and written.
    ``null_as`` replaces a NULL on both sides, for the comparison only.
    A comparison that meets a NULL left on either side counts as "not changed".
    """

    fill: Any = None
    null_as: Any = None


def raw() -> Rule:
    """NULLs on either side hide a change."""
    return Rule()


def filled(value: Any) -> Rule:
    """Source NULLs become ``value``; a NULL in the target hides a change."""
    return Rule(fill=value)


def null_equal(value: Any) -> Rule:
    """NULL and ``value`` are the same; the source value is written as it is."""
    return Rule(null_as=value)


def filled_null_equal(value: Any) -> Rule:
    """Source NULLs become ``value``, and a NULL in the target compares as ``value``."""
    return Rule(fill=value, null_as=value)


@dataclass(frozen=True)
class MergeSpec:
    """What a merge compares, writes and does with rows missing on one side.

    ``absent``  what happens to target rows without a source row: soft, hard or keep.
    ``insert``  whether source rows without a target row are added.
    ``always``  overwrite matched rows without comparing.
    ``insert_only``  source columns written on insert but never updated.
    ``on_insert``  constants for target columns the source does not carry.
    ``unique_target``  fail on a repeated or NULL target key; if false, every such row is a row of
    its own.
    """

    keys: Sequence[str]
    columns: Mapping[str, Rule]
    absent: str = "keep"
    insert: bool = True
    always: bool = False
    insert_only: Sequence[str] = ()
    deleted_flag: str | None = None
    deleted_at: str | None = None
    updated_at: str | None = None
    on_insert: Mapping[str, Any] = field(default_factory=dict)
    unique_target: bool = True

    def __post_init__(self) -> None:
        if self.absent not in ("soft", "hard", "keep"):
            raise ValueError(f"absent must be soft, hard or keep, not {self.absent!r}")
        if self.absent == "soft" and not self.deleted_at:
            raise ValueError("a soft delete needs a deleted_at column")
        if not self.insert and self.absent != "keep":
            raise ValueError("an update-only merge keeps absent rows")


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the run fails when a key is NULL or occurs twice.

    The rank limit reaches below the shuffle, so at most two rows per key leave a map task.
    Rows are lost to it only in a run that fails.
    """
    names = [_quote(k) for k in keys]
    shown = "concat_ws(', ', " + ", ".join(f"coalesce(string({n}), 'NULL')" for n in names) + ")"
    no_key = " OR ".join(f"{n} IS NULL" for n in names)
    order = ", ".join(names)
    return (
        df.selectExpr("*", f"row_number() OVER (PARTITION BY {order} ORDER BY {order}) AS __rank")
        .filter("__rank <= 2")
        .filter(
            f"CASE WHEN {no_key} THEN boolean(raise_error(concat('NULL merge key: ', {shown}))) "
            f"WHEN __rank > 1 THEN boolean(raise_error(concat('duplicate merge key: ', {shown}))) "
            "ELSE TRUE END"
        )
        .drop("__rank")
    )


def _sides(target: DataFrame, source: DataFrame, spec: MergeSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides with prefixed columns, the source filled and in the target's types, with its keys
    checked and without."""
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}

    def written(name: str) -> str:
        value = f"CAST({_quote(name)} AS {types[name]})"
        rule = spec.columns.get(name)
        if rule is not None and rule.fill is not None:
            value = f"coalesce({value}, CAST({_literal(rule.fill)} AS {types[name]}))"
        return f"{value} AS {_quote(name)}"

    def prefixed(names: Sequence[str], side: str) -> list[str]:
        return [*[f"{_quote(c)} AS {_quote(f'{side}_{c}')}" for c in names], f"TRUE AS {side}_here"]

    wanted = [*spec.keys, *spec.columns, *spec.insert_only]
    plain = source.selectExpr(*[written(c) for c in wanted])
    t = require_unique(target, spec.keys) if spec.unique_target else target
    s = [side.selectExpr(*prefixed(wanted, "s")) for side in (require_unique(plain, spec.keys), plain)]
    return t.selectExpr(*prefixed(target.columns, "t")), *s


def _changed(spec: MergeSpec) -> str:
    """Condition under which a matched row is updated; NULL on either side is no difference
    unless the rule names a stand-in for it."""
    if spec.always:
        return "TRUE"
    tests = []
    if spec.deleted_flag:
        tests.append(f"coalesce({_quote('t_' + spec.deleted_flag)} = 1, FALSE)")
    if spec.deleted_at:
        tests.append(f"{_quote('t_' + spec.deleted_at)} IS NOT NULL")
    for name, rule in spec.columns.items():
        new, old = _quote(f"s_{name}"), _quote(f"t_{name}")
        if rule.null_as is not None:
            value = _literal(rule.null_as)
            new, old = f"coalesce({new}, {value})", f"coalesce({old}, {value})"
        tests.append(f"coalesce({new} <> {old}, FALSE)")
    return "(" + " OR ".join(tests) + ")"


def _action(spec: MergeSpec) -> str:
    cases = [f"WHEN t_here IS NULL THEN '{INSERT}'"]
    if spec.absent == "hard":
        cases.append(f"WHEN s_here IS NULL THEN '{REMOVE}'")
    if spec.absent == "soft":
        live = (
            f"{_quote('t_' + spec.deleted_flag)} = 0"
            if spec.deleted_flag
            else f"{_quote('t_' + spec.deleted_at)} IS NULL"
        )
        cases.append(f"WHEN s_here IS NULL AND {live} THEN '{DELETE}'")
    cases += [f"WHEN s_here IS NULL THEN '{KEEP}'", f"WHEN {_changed(spec)} THEN '{UPDATE}'"]
    return "CASE " + " ".join(cases) + f" ELSE '{KEEP}' END"


def _next_value(name: str, kind: str, spec: MergeSpec, run_ts: datetime) -> str:
    """The column's value in the next snapshot, by the action taken on the row."""
    old, new = _quote(f"t_{name}"), _quote(f"s_{name}")
    fresh = _literal(spec.on_insert.get(name))
    if name in spec.keys:
        return f"coalesce({old}, {new})"
    if name in spec.columns:
        cases = {(INSERT, UPDATE): new}
    elif name in spec.insert_only:
        cases = {(INSERT,): new}
    elif name == spec.deleted_flag:
        cases = {(INSERT, UPDATE): "0", (DELETE,): "1"}
    elif name == spec.deleted_at:
        cases = {(INSERT, UPDATE): "NULL", (DELETE,): _literal(run_ts)}
    elif name == spec.updated_at:
        cases = {(UPDATE, DELETE): _literal(run_ts), (INSERT,): fresh}
    else:
        cases = {(INSERT,): fresh}
    whens = " ".join(
        f"WHEN {ACTION} IN ({', '.join(map(_literal, actions))}) THEN CAST({value} AS {kind})"
        for actions, value in cases.items()
    )
    return f"CASE {whens} ELSE {old} END"


def merge_with_actions(
    target: DataFrame, source: DataFrame, spec: MergeSpec, run_ts: datetime, removed: bool = False
) -> DataFrame:
    """The next snapshot plus ``merge_action`` telling what happened to each row.

    With ``removed``, target rows that are deleted for good stay, with the action ``remove``.
    """
    joined = _joined(*_sides(target, source, spec), spec, removed)
    next_row = [
        f"{_next_value(f.name, f.dataType.simpleString(), spec, run_ts)} AS {_quote(f.name)}"
        for f in target.schema.fields
    ]
    return joined.selectExpr("*", f"{_action(spec)} AS {ACTION}").selectExpr(*next_row, ACTION)


def _joined(t: DataFrame, s: DataFrame, plain: DataFrame, spec: MergeSpec, removed: bool) -> DataFrame:
    on = F.expr(" AND ".join(f"{_quote('t_' + k)} = {_quote('s_' + k)}" for k in spec.keys))
    gone = spec.absent == "hard" and not removed
    if not spec.insert:
        return t.join(s, on, "left")
    if spec.unique_target:
        return s.join(t, on, "left") if gone else t.join(s, on, "full")
    # A join is split only if nothing stands between it and its shuffles, so the source is checked on
    # the other branch, which all its rows pass.  Keys are reduced before they are shuffled.
    known = t.select(*[_quote(f"t_{k}") for k in spec.keys]).distinct()
    matched = t.join(plain, on, "inner" if gone else "left")
    return matched.unionByName(s.join(known, on, "left_anti"), allowMissingColumns=True)


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec, run_ts: datetime) -> DataFrame:
    """The next snapshot of the target, in the target's schema."""
    return merge_with_actions(target, source, spec, run_ts).drop(ACTION)


def soft_delete_absent(
    target: DataFrame,
    source_keys: DataFrame,
    keys: Sequence[str],
    run_ts: datetime,
    deleted_at: str = "deleted_at",
    updated_at: str = "updated_at",
) -> DataFrame:
    """Mark live target rows whose key the source lacks; a repeated source key is harmless here.

    The source's keys are reduced to distinct ones before they are shuffled.
    """
    seen = source_keys.selectExpr(*[f"{_quote(k)} AS {_quote('s_' + k)}" for k in keys]).distinct()
    on = F.expr(" AND ".join(f"{_quote(k)} = {_quote('s_' + k)}" for k in keys))
    gone = f"(s_here IS NULL AND {_quote(deleted_at)} IS NULL)"
    stamped = {
        c: f"CASE WHEN __gone THEN {_literal(run_ts)} ELSE {_quote(c)} END AS {_quote(c)}"
        for c in (deleted_at, updated_at)
    }
    return (
        target.join(seen.selectExpr("*", "TRUE AS s_here"), on, "left")
        .selectExpr("*", f"{gone} AS __gone")
        .selectExpr(*[stamped.get(c, _quote(c)) for c in target.columns])
    )


def keyed_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key or are added; nothing is compared.

    Keys are unique on both sides, or the run fails.
    """
    return merge(target, source, upsert_spec(target.columns, keys), datetime.min)


def upsert_spec(columns: Sequence[str], keys: Sequence[str]) -> MergeSpec:
    return MergeSpec(keys=tuple(keys), columns={c: raw() for c in columns if c not in keys}, always=True)
