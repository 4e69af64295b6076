"""Python-literal lists stored as text, e.g. ``[{'id': 931, 'name': "toy's"}]``.

These cells are not JSON, but plain ones differ from it in quotes and ``None`` alone: lists of
flat dicts, texts without escapes, and whole numbers.  One pattern without backtracking
tells whether a cell is plain; plain cells are respelled as JSON and read by ``from_json``,
all inside the JVM.  Only the rest (escapes, ``True``, nested values, broken lists) goes to
``ast.literal_eval`` in Arrow batches, where plain cells are NULL.  The parser is built
inside a function so that it travels to the executors by value.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ARROW_TYPES = {"bigint": pa.int64(), "string": pa.string()}

# Parts of plain cells.  Every repetition is possessive: one step a character, no backtracking, no stack.
_BLANK = r"[ \t\r\n]*+"
_TEXT = r"""(?:'[^'\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+")"""
_WHOLE = r"(?:0|-?+[1-9][0-9]{0,17}+)"
_VALUE = rf"(?:{_TEXT}|{_WHOLE}|None)"
#: A cell that begins like this holds no list.
_NO_LIST = r"""^(?:[A-Za-z0-9{'"]|$)"""
#: What stands in every list with an item that is no dict (and in few others).
_OTHER_ITEM = r"^\[[ \t\r\n]*+[^{\]]|\}[ \t\r\n]*+,[ \t\r\n]*+[^{]"
#: Marks of a text's ends while the double quotes inside it are escaped; plain cells hold no control characters in texts.
_BEGIN, _END = "\x01", "\x02"


def _listed(item: str) -> str:
    return rf"{_BLANK}(?:{item}{_BLANK}(?:,{_BLANK}{item}{_BLANK})*+)?+"


def _flat_dict(kinds: Mapping[str, str]) -> str:
    """Pattern of a plain dict; keys that stand for whole numbers have no text as value."""
    whole = "|".join(re.escape(name) for name, kind in kinds.items() if kind == "bigint")
    no_text = rf"""(?!(?:'(?:{whole})'|"(?:{whole})"){_BLANK}:{_BLANK}['"])""" if whole else ""
    return rf"\{{{_listed(rf'{no_text}{_TEXT}{_BLANK}:{_BLANK}{_VALUE}')}\}}"


def _plain(column: Column, kinds: Mapping[str, str]) -> Column:
    return column.rlike(rf"\A\[{_listed(rf'(?:{_flat_dict(kinds)}|{_VALUE})')}\]\z")


def _respelled(cell: Column) -> Column:
    """A plain cell, or one whose items were set in brackets, as JSON."""
    own = F.regexp_replace(cell, r"""'([^']*+)'|"([^"]*+)"|(None)""", f"{_BEGIN}$1$2{_END}$3")
    for old, new in ((f"{_BEGIN}{_END}None", "null"), ('"', '\\"'), (_BEGIN, '"'), (_END, '"')):
        own = F.replace(own, F.lit(old), F.lit(new))
    return own


def _plain_items(column: Column, kinds: Mapping[str, str], item_type: str) -> Column:
    """Items of a plain cell.  Where some may be no dict, each becomes a list of its own, empty if it is none."""
    missing = F.struct(*(F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()))
    split = F.regexp_replace(column, rf"({_flat_dict(kinds)})|{_VALUE}", "[$1]")
    split = F.transform(F.from_json(_respelled(split), f"array<{item_type}>"), lambda x: F.coalesce(F.get(x, F.lit(0)), missing))
    return F.when(column.rlike(_OTHER_ITEM), split).otherwise(F.from_json(_respelled(column), item_type))


def literal_items(column: Column, fields: Mapping[str, str]) -> Column:
    """Array of structs with the named fields; empty for NULL, broken or non-list text.

    ``fields`` maps each key of the items to ``bigint`` or ``string``.  An item
    that is not a dict yields a struct of NULLs, a missing key a NULL field; a
    ``bigint`` that is no whole number raises.
    """
    kinds = dict(fields)
    cell_type = pa.list_(pa.struct([pa.field(name, ARROW_TYPES[kind]) for name, kind in kinds.items()]))

    def field(item, name, kind):
        value = item.get(name)
        if value is None:
            return None
        if kind == "string":
            return value if isinstance(value, str) else str(value)
        number = int(value)  # strict, as a key cast should be: raises on what is no whole number
        if not -(2**63) <= number < 2**63:
            raise ValueError(f"{name} {value!r} has more than 64 bits")
        return number

    def parse(text):
        try:
            items = ast.literal_eval(text)
        except Exception:  # any cell that is not a literal counts as an empty list
            return []
        if not isinstance(items, list):
            return []
        return [
            {name: field(item, name, kind) for name, kind in kinds.items()} if isinstance(item, dict) else {}
            for item in items
        ]

    item_type = f"array<struct<{','.join(f'`{name}`:{kind}' for name, kind in kinds.items())}>>"

    @F.arrow_udf(item_type)
    def parse_batch(cells: pa.Array) -> pa.Array:
        return pa.array([None if text is None else parse(text) for text in cells.to_pylist()], type=cell_type)

    rest = F.when(~_plain(column, kinds) & ~column.rlike(_NO_LIST), column)
    return F.coalesce(
        parse_batch(rest), F.when(column.startswith("["), _plain_items(column, kinds, item_type)), F.array().cast(item_type)
    )


def first_name(items: Column, name: str = "name") -> Column:
    """``name`` of the very first parsed item; later items are never looked at."""
    return F.get(items, F.lit(0))[name]
