"""Byte-exact text functions built from Spark SQL expressions.

A string column here holds *bytes*: ``percent_decode`` may yield GBK bytes that
are not valid UTF-8, and they stay untouched until ``transcode`` turns them into
text.  Java-string based expressions (``split``, regular expressions) would
damage such bytes, so they only ever see valid UTF-8 or a *carrier*: the same
bytes read as ISO-8859-1, one character per byte.

The functions take a column by name, a plain column, or SQL text such as
``fields['url']``.  They are put together as SQL text (the ``*_sql`` functions):
a long expression then costs the driver one call and not one per node.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Sql = Callable[[str], str]

_REST = 1 << 30  # "up to the end" for slice
_NOT_AN_ESCAPE = "r'%(?![0-9A-Fa-f]{2})'"
_HIGH_ESCAPE = "r'%[89A-Fa-f][0-9A-Fa-f]'"
_BLANKS = r"' \t\n\r\u0000\u000b'"


def sql_of(x: Column | str) -> str:
    """SQL text of an argument: text itself, or the name of a plain column."""
    if isinstance(x, str):
        return x
    name = re.fullmatch(r"Column<'(\w+)'>", str(x))
    if name is None:
        raise TypeError(f"select {x} under a name first, or give it as SQL text")
    return name[1]


def quoted(value: str) -> str:
    """A text literal in SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# two threads of one session must not restore each other's settings
_settings = threading.RLock()


@contextmanager
def java_charsets(spark: SparkSession):
    """Allow charsets beyond the SQL standard list while a plan is analysed.

    ``decode`` captures both settings when it is resolved, so they need not be
    set when the plan runs.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    with _settings:
        before = {n: spark.conf.get(n) for n in names}
        try:
            for n in names:
                spark.conf.set(n, "true")
            yield
        finally:
            for n, v in before.items():
                spark.conf.set(n, v)


def to_carrier_sql(x: str) -> str:
    """The bytes of a string, one ISO-8859-1 character each."""
    return f"decode(cast({x} as binary), 'ISO-8859-1')"


def from_carrier_sql(x: str) -> str:
    return f"cast(encode({x}, 'ISO-8859-1') as string)"


def bind_sql(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _decode_escapes_sql(x: str) -> str:
    """Decode any escapes, also those that form no valid UTF-8."""
    text = f"regexp_replace(replace({to_carrier_sql(x)}, '+', ' '), {_NOT_AN_ESCAPE}, '%25')"
    tail = (
        f"transform(slice(pp, 2, {_REST}), p -> concat(substring(p, 1, 2),"
        " hex(encode(substring(p, 3), 'ISO-8859-1'))))"
    )
    head = "hex(encode(get(pp, 0), 'ISO-8859-1'))"
    return bind_sql(f"split({text}, '%')", "pp", f"cast(unhex(concat({head}, array_join({tail}, ''))) as string)")


def percent_decode_sql(x: str) -> str:
    return (
        f"case when not contains({x}, '%') then replace({x}, '+', ' ')"
        f" when is_valid_utf8({x}) and not {x} rlike {_HIGH_ESCAPE}"
        f" then url_decode(regexp_replace({x}, {_NOT_AN_ESCAPE}, '%25'))"
        f" else {_decode_escapes_sql(x)} end"
    )


def percent_decode(x: Column | str) -> Column:
    """Percent-decode byte by byte; ``+`` is a space, a malformed ``%`` stays."""
    return F.expr(percent_decode_sql(sql_of(x)))


def transcode_sql(x: str, charset: str = "GBK") -> str:
    return (
        f"case when is_valid_utf8({x}) and octet_length({x}) = char_length({x}) then {x}"
        f" else replace(decode(cast({x} as binary), '{charset}'), '\\ufffd', '?') end"
    )


def transcode(x: Column | str, charset: str = "GBK") -> Column:
    """Bytes in ``charset`` to UTF-8 text; undecodable bytes become ``?``.

    Select it within :func:`java_charsets` (``apply_rules`` does).
    """
    return F.expr(transcode_sql(sql_of(x), charset))


def decode_transcode(x: Column | str, charset: str = "GBK") -> Column:
    return F.expr(bind_sql(percent_decode_sql(sql_of(x)), "d", transcode_sql("d", charset)))


def escape_invalid(x: Column | str) -> Column:
    """Percent-escape the high bytes of a line that is not valid UTF-8."""
    x = sql_of(x)
    return F.expr(
        f"case when is_valid_utf8({x}) then {x} else array_join(transform(split({to_carrier_sql(x)}, ''),"
        " c -> case when c > '\\u007f' then concat('%', hex(encode(c, 'ISO-8859-1'))) else c end), '') end"
    )


_KEY = "substring_index(t, '=', 1)"
# what is between the first and the second "="; split_part would take a token apart whole
_VALUE = f"substr(substring_index(t, '=', 2), length({_KEY}) + 2)"


def second_part_sql(x: str, sep: str) -> str:
    """``split_part(x, sep, 2)``, which compiles a pattern for every row, for text of one-character separators."""
    after = f"substr(substring_index({x}, '{sep}', 2), length(substring_index({x}, '{sep}', 1)) + 2)"
    return f"case when is_valid_utf8({x}) then {after} else split_part({x}, '{sep}', 2) end"


def _last_wins_sql(x: str, sep: str) -> str:
    """Pairs with repeated keys: last value, first position, in O(n log n)."""
    token = f"named_struct('k', {_KEY}, 'i', i, 'v', {_VALUE})"
    tokens = f"array_sort(transform(split({x}, '{sep}'), (t, i) -> {token}))"
    merged = bind_sql(
        tokens,
        "o",
        "zip_with(filter(o, (e, j) -> not (get(o, j - 1).k <=> e.k)),"
        " filter(o, (e, j) -> not (get(o, j + 1).k <=> e.k)),"
        " (a, z) -> named_struct('i', a.i, 'k', a.k, 'v', z.v))",
    )
    return f"map_from_entries(transform(array_sort({merged}), e -> struct(e.k, e.v)))"


def raw_pairs_sql(x: str, sep: str) -> str:
    """``pairs_to_map`` for valid UTF-8.

    A line is split once; its entries make the map as they are, unless a key occurs
    twice.  That is looked for in the row, so the session's policy for repeated map
    keys does not matter.
    """
    keys = f"transform(ts, t -> {_KEY})"
    pairs = f"map_from_arrays(ks, transform(ts, t -> {_VALUE}))"
    unique = f"case when size(array_distinct(ks)) = size(ks) then {pairs} else {_last_wins_sql(x, sep)} end"
    return bind_sql(f"split({x}, '{sep}')", "ts", bind_sql(keys, "ks", unique))


def map_values_sql(m: str, steps: Sequence[Sql]) -> str:
    """Every value of a map taken through the steps, one after the other."""
    for step in steps:
        m = f"transform_values({m}, (k, v) -> {step('v')})"
    return m


def pairs_to_map_sql(x: str, sep: str, steps: Sequence[Sql] = ()) -> str:
    as_text = map_values_sql(raw_pairs_sql(x, sep), steps)
    carried = map_values_sql(raw_pairs_sql(to_carrier_sql(x), sep), [from_carrier_sql, *steps])
    as_bytes = bind_sql(
        carried,
        "m",
        f"map_from_arrays(transform(map_keys(m), q -> {from_carrier_sql('q')}), map_values(m))",
    )
    return f"case when is_valid_utf8({x}) then {as_text} when {x} is not null then {as_bytes} end"


def pairs_to_map(x: Column | str, sep: str, steps: Sequence[Sql] = ()) -> Column:
    """``k=v<sep>k=v`` to an ordered map.

    The value is the piece between the first and the second ``=``; a bare token
    has an empty value; of repeated keys the last value stays, in the first
    position.  ``steps`` are applied to every value.
    """
    return F.expr(pairs_to_map_sql(sql_of(x), sep, steps))


EMPTY_MAP = "cast(map() as map<string,string>)"


def kv_string_to_map(x: Column | str, charset: str = "GBK") -> Column:
    """``a='1' b='2'`` to a map, values unquoted, decoded and transcoded."""
    text = f"btrim({sql_of(x)}, {_BLANKS})"
    steps = (lambda v: f"""btrim({v}, "'")""", percent_decode_sql, lambda v: transcode_sql(v, charset))
    return F.expr(f"case when length({text}) > 0 then {pairs_to_map_sql(text, ' ', steps)} else {EMPTY_MAP} end")


def map_to_string_sql(x: str, sort_keys: bool = False) -> str:
    items = f"transform(map_entries({x}), e -> concat(e.key, ':', coalesce(cast(e.value as string), '')))"
    return f"array_join({f'array_sort({items})' if sort_keys else items}, ',')"


def map_to_string(x: Column | str, sort_keys: bool = False) -> Column:
    """``k:v,k:v`` in map order, without escaping; a null value is empty."""
    return F.expr(map_to_string_sql(sql_of(x), sort_keys))


def string_to_map_sql(x: str) -> str:
    keys = f"transform(split({x}, ','), t -> substring_index(t, ':', 1))"
    entry = "named_struct('k', substring_index(t, ':', 1), 'i', i, 'v', get(split(t, ':', 2), 1))"
    last = bind_sql(
        f"array_sort(transform(split({x}, ','), (t, i) -> {entry}))",
        "o",
        "filter(o, (e, j) -> not (get(o, j + 1).k <=> e.k))",
    )
    return (
        f"case when length({x}) = 0 then {EMPTY_MAP}"
        f" when size(array_distinct({keys})) = size({keys}) then str_to_map({x}, ',', ':')"
        f" else map_from_entries(transform({last}, e -> struct(e.k, e.v))) end"
    )


def string_to_map(x: Column | str) -> Column:
    """Read ``k:v,k:v`` back; a repeated key keeps its last value."""
    return F.expr(string_to_map_sql(sql_of(x)))


def sanitize(c: Column) -> Column:
    """Keep the text format's separators out of a value."""
    return F.replace(F.replace(c, F.lit("\x01"), F.lit("")), F.lit("\n"), F.lit("\x03"))


def visitor_id_clean(x: Column | str, size: int = 32) -> Column:
    """Trim double, then single quotes; keep the first ``size`` bytes."""
    trimmed = f"""btrim(btrim({sql_of(x)}, '"'), "'")"""
    return F.expr(f"cast(substring(cast({trimmed} as binary), 1, {size}) as string)")
