"""Reading and writing record headers with built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_HEADERS = "cast(array() as array<struct<key:string,value:binary>>)"


def header_sql(name: str, headers: str = "headers", keys: str | None = None) -> str:
    """SQL for the value of the last header called ``name``, or null, as text.

    A record may repeat a header name; the last one counts. Counting the
    position from the end keeps that rule without building a map, so no session
    setting for duplicate map keys is needed. A missing name gives position 0,
    which lies outside the list. ``keys`` may name a column that already holds
    the reversed key list.
    """
    keys = keys or reversed_keys_sql(headers)
    return f"cast(get({headers}, size({headers}) - cast(array_position({keys}, '{name}') as int)).value as string)"


def reversed_keys_sql(headers: str = "headers") -> str:
    return f"reverse({headers}.key)"


def header_struct_sql(names: dict[str, str], headers: str = "headers", keys: str | None = None) -> str:
    """SQL for a struct of header texts, by field name."""
    fields = [f"'{field}', {header_sql(name, headers, keys)}" for field, name in names.items()]
    return f"named_struct({', '.join(fields)})"


def header_text(name: str, headers: str = "headers") -> Column:
    return F.expr(header_sql(name, headers))


def header_number(name: str, kind: str = "bigint", headers: str = "headers") -> Column:
    """Numeric header; text that is no number becomes null instead of failing the job."""
    return F.expr(f"try_cast({header_sql(name, headers)} as {kind})")


def header_list_sql(entries: dict[str, str]) -> str:
    """SQL for a header list of the given names and value expressions, leaving
    out null values."""
    parts = [
        f"if(({value}) is null, {_NO_HEADERS}, array(named_struct("
        f"'key', '{name}', 'value', cast(cast(({value}) as string) as binary))))"
        for name, value in entries.items()
    ]
    return f"concat({', '.join(parts)})"


def replaced_headers_sql(entries: dict[str, str], headers: str = "headers") -> str:
    """SQL for a header list in which the given names are rewritten (or dropped,
    when null) and all others kept."""
    names = ", ".join(f"'{name}'" for name in entries)
    kept = f"filter(coalesce({headers}, {_NO_HEADERS}), entry -> entry.key not in ({names}))"
    return f"concat({kept}, {header_list_sql(entries)})"
