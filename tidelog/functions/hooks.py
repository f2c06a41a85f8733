"""Rule functions: input columns in, output columns out.

A hook takes ``(ins, outs)``, a dict of input columns and the names to fill,
and returns a dict of columns, or a :class:`HookResult` with an ``ok`` column if
it may refuse a row.  Everything stays in Catalyst; opaque code comes in as a
``pandas_udf`` through :func:`from_udf`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions import clock, text

Ins = dict[str, Column]


@dataclass(frozen=True)
class HookResult:
    """Columns, and whether the rule applies to the row (None: always)."""

    values: dict[str, Column]
    ok: Column | None = None


Hook = Callable[[Ins, Sequence[str]], "dict[str, Column] | HookResult"]


def filled(parts: dict[str, Column], outs: Sequence[str]) -> dict[str, Column]:
    """A hook's parts as a rule's outputs.

    ``column`` takes the part at its place, ``column=part`` the one it names; without
    outputs all parts keep their own names.
    """
    if not outs:
        return parts
    places = list(parts)
    found = {}
    for i, out in enumerate(outs):
        column, named, part = out.partition("=")
        if not named and i >= len(places) or named and part not in parts:
            raise ValueError(f"{out}: the hook has the parts {', '.join(places)}")
        found[column] = parts[part if named else places[i]]
    return found


def _of_last(function: Callable[[Column], Column]) -> Hook:
    """Fill every output from the last input."""

    def hook(ins: Ins, outs: Sequence[str]) -> dict[str, Column]:
        value = function(list(ins.values())[-1]) if ins else F.lit("")
        return {name: value for name in outs}

    return hook


copy = _of_last(lambda c: c)
copy_decode = _of_last(text.percent_decode)
copy_decode_utf8 = _of_last(text.decode_transcode)
copy_kv_map = _of_last(text.kv_string_to_map)
clean_visitor_id = _of_last(text.visitor_id_clean)


def date_time(ts: Column, zone: str = "UTC", date: str = "date", time: str = "time") -> Hook:
    """Date and time to year, month, day, time and epoch seconds.

    ``ts`` is the moment they stand for, from ``clock.event_time``.
    """

    def hook(ins: Ins, outs: Sequence[str]) -> dict[str, Column]:
        parts = {
            "year": F.year(ts).cast("string"),
            "month": F.substring_index(ins[date], "-", 1),
            "time": ins[time],
            "timestamp": clock.epoch_seconds(ts, zone).cast("string"),
            "day": F.split_part(ins[date], F.lit("-"), F.lit(2)),
        }
        return filled(parts, outs)

    return hook


def ip_place(lookup: Column) -> dict[str, Column]:
    """Split a lookup text ``<place>,<provider>`` into its parts."""
    # fixed values: the suffixes that end a province and a city
    pattern = "(?d)^(.*省)(.*市).*$"
    place = F.split_part(lookup, F.lit(","), F.lit(1))
    return {
        "provider": F.split_part(lookup, F.lit(","), F.lit(2)),
        "city": F.regexp_extract(place, pattern, 2),
        "province": F.regexp_extract(place, pattern, 1),
    }


def ip_geo(lookup: Column) -> Hook:
    """IP, provider, city and province; ``lookup`` comes from a range join."""

    def hook(ins: Ins, outs: Sequence[str]) -> dict[str, Column]:
        return filled({"ip": list(ins.values())[-1], **ip_place(F.coalesce(lookup, F.lit("")))}, outs)

    return hook


def _params(url: str, quirks: bool) -> Column:
    pairs = text.pairs_to_map_sql("ps", "&")
    parsed = pairs if quirks else f"case when length(ps) > 0 then {pairs} else {text.EMPTY_MAP} end"
    return F.expr(text.bind_sql(text.second_part_sql(url, "?"), "ps", parsed))


def url_split(quirks: bool = False, query_param: str = "word", host: str = "host", url: str = "url") -> Hook:
    """Full URL, host, path, parameters and search phrase.

    ``quirks`` gives a URL without parameters one empty pair.
    """
    # the last parameter of that name, its text up to a second "="
    phrase = text.quoted(rf"(?s)^(?:.*&)?{re.escape(query_param)}(?:=([^&=]*)[^&]*)?(?:&.*)?$")

    def hook(ins: Ins, outs: Sequence[str]) -> dict[str, Column]:
        h, u = (f"coalesce({text.sql_of(ins[n])}, '')" for n in (host, url))
        params = text.second_part_sql(u, "?")
        found = text.from_carrier_sql(f"regexp_extract({text.to_carrier_sql(params)}, {phrase}, 1)")
        parts = {
            "url": F.expr(f"concat({h}, {u})"),
            "hostname": F.expr(h),
            "path": F.expr(f"substring_index({u}, '?', 1)"),
            "params": _params(u, quirks),
            "query": F.expr(f"case when contains({params}, {text.quoted(query_param)}) then {found} else '' end"),
        }
        return filled(parts, outs)

    return hook


def referer_split(quirks: bool = False, referer: str = "refer") -> Hook:
    """Referer, its path, parameters and host; ``quirks`` leaves path and host empty."""

    def hook(ins: Ins, outs: Sequence[str]) -> dict[str, Column]:
        r = f"coalesce({text.sql_of(ins[referer])}, '')"

        def part(name: str) -> Column:
            return F.lit("") if quirks else F.expr(f"coalesce(try_parse_url({r}, '{name}'), '')")

        parts = {"referer": F.expr(r), "path": part("PATH"), "params": _params(r, quirks), "hostname": part("HOST")}
        return filled(parts, outs)

    return hook


def from_udf(function: Callable[..., Column], ok: str | None = None) -> Hook:
    """Use a ``pandas_udf`` that returns a struct with one field per output.

    ``ok`` names a boolean field of the struct that accepts or refuses the row.
    """

    def hook(ins: Ins, outs: Sequence[str]) -> HookResult:
        row = function(*ins.values())
        return HookResult({name: row[name] for name in outs}, row[ok] if ok else None)

    return hook


COMMON_HOOKS: dict[str, Hook] = {
    "copy": copy,
    "copy_decode": copy_decode,
    "copy_decode_utf8": copy_decode_utf8,
    "copy_kv_map": copy_kv_map,
    "clean_visitor_id": clean_visitor_id,
    "url_split": url_split(),
    "referer_split": referer_split(),
}
