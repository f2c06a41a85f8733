"""The example application: the request log of a made-up ticket shop."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.hooks import ip_geo, referer_split, url_split
from tidelog.operators.mapping import MapRule
from tidelog.plans.application import Application

# columns of the event table, in order.  s: string, l: bigint, ms: map of strings,
# ml: map of bigints.
EVENT_COLUMNS = """
sale s
sold_year l
sold_month l
sold_day l
sold_time s
sold_at l
holder s
buyer l
guest s
address s
network s
city s
province s
page s
site s
page_path s
page_params ms
search s
via s
via_path s
via_params ms
via_site s
device s
code l
took l
block ml
coupon s
event_loginfo ms
"""

# field -> column, in rule order.  The hook is copy where none is named.  The second
# rule takes sale, so the seventh finds buyer alone; shop_* columns are not declared.
COMMON_FIELDS = """
date time -> sold_year sold_month sold_time sold_at sold_day : date_time
sale -> sale
site page -> page site page_path page_params search : url_split
via -> via via_path via_params via_site : referer_split
device -> device : copy_decode
guest -> guest : copy_decode_utf8
sale buyer -> buyer
pass -> holder : clean_visitor_id
addr -> address network city province : ip_geo
block -> block : copy_kv_map
Price -> shop_price : copy_kv_map
memo -> shop_memo
gate -> shop_gate
desk -> shop_desk
code -> code
took -> took
"""

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "ms": T.MapType(T.StringType(), T.StringType()),
    "ml": T.MapType(T.StringType(), T.LongType()),
}


def schema_from_text(columns: str) -> T.StructType:
    """A schema from lines ``name type``."""
    pairs = (line.split() for line in columns.split("\n") if line.strip())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def rules_from_text(lines: str) -> tuple[MapRule, ...]:
    """Rules from lines ``in in -> out out : hook``."""
    rules = []
    for line in filter(str.strip, lines.split("\n")):
        ins, rest = line.split(" -> ")
        outs, _, hook = rest.partition(" : ")
        rules.append(MapRule(tuple(ins.split()), tuple(outs.split()), hook or "copy"))
    return tuple(rules)


def example_application(
    quirks: bool = False, lookup=None, place: str = "ip_place", more_rules: tuple[MapRule, ...] = (), more_columns: str = "", **settings
) -> Application:
    """The application; ``lookup`` is a join that adds the column ``place``."""
    looked_up = F.col(place) if lookup is not None else F.lit("")
    return Application(
        name="example",
        schema=schema_from_text(EVENT_COLUMNS + more_columns),
        rules=(*rules_from_text(COMMON_FIELDS), *more_rules),
        hooks={
            "ip_geo": ip_geo(looked_up),
            "url_split": url_split(quirks, host="site", url="page"),
            "referer_split": referer_split(quirks, referer="via"),
        },
        lookup=lookup,
        **settings,
    )


def wide_application(n_rules: int = 45, n_columns: int = 100, **settings) -> Application:
    """The example with more rules and declared columns, for the size of plans.

    Every sixth of the further rules reads a map; half of their columns are declared.
    """
    base = len(rules_from_text(COMMON_FIELDS))
    rules = tuple(
        MapRule((f"Extra{i}",), (f"extra_{i}",), "copy" if i % 6 else "copy_kv_map") for i in range(n_rules - base)
    )
    declared = len(schema_from_text(EVENT_COLUMNS))
    columns = "\n".join(f"extra_{2 * i} {'ls'[i % 2 if i % 3 else 1]}" for i in range(n_columns - declared))
    return example_application(more_rules=rules, more_columns=columns, **settings)
