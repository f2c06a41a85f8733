"""Declarative mapping rules, folded into one projection."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import text
from tidelog.functions.hooks import COMMON_HOOKS, Hook, HookResult

Names = Sequence[str]
MAP = T.MapType(T.StringType(), T.StringType())


@dataclass(frozen=True)
class MapRule:
    """Fill ``outs`` from the fields ``ins`` with a hook, by name or directly.

    An output is a column, or ``column=part`` for one of the hook's named parts.
    """

    ins: tuple[str, ...]
    outs: tuple[str, ...]
    hook: str | Hook = "copy"

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(out.partition("=")[0] for out in self.outs)


def apply_rules(
    df: DataFrame,
    rules: Sequence[MapRule],
    hooks: Mapping[str, Hook] | None = None,
    keep: Names = (),
    leftovers: str = "event_loginfo",
    fields: str = "fields",
    decode: text.Sql | None = None,
) -> DataFrame:
    """``keep``, then the outputs in rule order, then the unclaimed fields.

    A rule that applies takes its inputs away from later rules; one that refuses
    a row (``HookResult.ok``) leaves both fields and outputs alone.

    Three projections, whatever the number of rules: the first takes the inputs
    out of the map, the second decodes them, so that a hook may use one often;
    the third has the hooks.  Rules that may refuse rows depend on each other only by
    the fields they share: they are answered in layers, one projection each, and a rule
    that shares no field with an earlier one of them is in the first.
    ``decode`` is applied to each value that is used, if ``fields`` holds raw ones.
    """
    hooks = {**COMMON_HOOKS, **(hooks or {})}
    names = list(dict.fromkeys(n for rule in rules for n in rule.ins))
    at = {n: f"_in{i}" for i, n in enumerate(names)}
    value = decode or (lambda x: x)
    raw = [f"{fields}[{text.quoted(n)}] as _raw{i}" for i, n in enumerate(names)]
    unnamed = f"{_without(fields, names)} as _left"
    others = [f"`{c}`" for c in df.columns]
    decoded = [f"{value(f'_raw{i}')} as _in{i}" for i in range(len(names))]
    taken = df.selectExpr(*others, unnamed, *raw).selectExpr(*others, "_left", *decoded)

    gone: set[str] = set()  # on every row
    claims: dict[str, list[int]] = {}  # rules that take a field from some rows
    layer: dict[int, int] = {}
    answers: list[list[Column]] = []
    event: dict[str, Column] = {}

    def left(name: str) -> Column:
        """The field, unless an earlier rule has taken it."""
        if name in gone:
            return F.lit(None).cast("string")
        taken_by = [F.col(f"_rule{i}")["_ok"] for i in claims.get(name, ())]
        return F.when(~reduce(or_, taken_by), F.col(at[name])) if taken_by else F.col(at[name])

    with text.java_charsets(df.sparkSession):
        for i, rule in enumerate(rules):
            hook = rule.hook if callable(rule.hook) else hooks[rule.hook]
            result = hook({n: left(n) for n in rule.ins}, rule.outs)
            if isinstance(result, HookResult) and result.ok is not None:
                # its answer decides about other columns, so it is a column itself
                answer = F.struct(
                    *(c.alias(n) for n, c in result.values.items()), F.coalesce(result.ok, F.lit(False)).alias("_ok")
                )
                before = [layer[j] for n in rule.ins if n not in gone for j in claims.get(n, ())]
                layer[i] = 1 + max(before, default=-1)
                answers += [[]] * (layer[i] + 1 - len(answers))
                answers[layer[i]] = [*answers[layer[i]], answer.alias(f"_rule{i}")]
                row = F.col(f"_rule{i}")
                for name in result.values:
                    event[name] = F.when(row["_ok"], row[name]).otherwise(event.get(name))
                for name in set(rule.ins) - gone:
                    claims.setdefault(name, []).append(i)
            else:
                event.update(result.values if isinstance(result, HookResult) else result)
                gone.update(rule.ins)
        for columns in answers:
            taken = taken.select("*", *columns)
        depends = [f"(k != {text.quoted(n)} or not _rule{i}._ok)" for n, by in claims.items() if n not in gone for i in by]
        event.pop(leftovers, None)
        rest = _without(fields, gone, depends) if depends else "_left"
        if decode is not None:
            rest = text.map_values_sql(rest, [decode])
        outputs = [c.alias(n) for n, c in event.items() if n not in keep]
        return taken.select(*keep, *outputs, F.expr(rest).alias(leftovers))


def _without(fields: str, names: Collection[str], tests: Sequence[str] = ()) -> str:
    """SQL text of the map less some keys."""
    listed = [f"k not in ({', '.join(text.quoted(n) for n in sorted(names))})"] if names else []
    return f"map_filter({fields}, (k, v) -> {' and '.join([*listed, *tests]) or 'true'})"


def cast_sql(name: str, source: T.DataType, target: T.DataType) -> str:
    """Read a column as a table type; what does not fit becomes NULL.

    A number with a fraction is cut to an integer (by way of a decimal, which
    keeps all digits of a long identifier).
    """

    def to_long(x: str) -> str:
        return f"try_cast(try_cast({x} as decimal(38,9)) as bigint)"

    name = f"`{name}`"
    if source == target:
        return name
    if isinstance(target, T.MapType):
        m = name if isinstance(source, T.MapType) else text.string_to_map_sql(name)
        longs = isinstance(target.valueType, T.LongType)
        return f"transform_values({m}, (k, v) -> {to_long('v')})" if longs else m
    if isinstance(target, T.LongType):
        return to_long(name)
    if isinstance(source, T.MapType):
        return text.map_to_string_sql(name)
    return f"cast({name} as {target.simpleString()})"


def conform(df: DataFrame, schema: T.StructType, keep: Names = ()) -> DataFrame:
    """``keep``, the declared columns in their order and types, then the rest.

    What no rule fills is empty text, else NULL.
    """
    have = {f.name: f.dataType for f in df.schema}

    def column(f: T.StructField) -> str:
        c = cast_sql(f.name, have[f.name], f.dataType) if f.name in have else "null"
        c = f"coalesce({c}, '')" if isinstance(f.dataType, T.StringType) else f"cast({c} as {f.dataType.simpleString()})"
        return f"{c} as `{f.name}`"

    declared = {*schema.fieldNames(), *keep}
    extras = [f"`{n}`" for n in df.columns if n not in declared]
    return df.selectExpr(*(f"`{n}`" for n in keep), *(column(f) for f in schema if f.name not in keep), *extras)


Cut = Callable[[DataFrame], DataFrame]
