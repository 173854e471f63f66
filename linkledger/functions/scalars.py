"""Small SQL expressions shared by the operators.

Each function takes and returns SQL expression text, for ``selectExpr`` and ``F.expr``.
A whole rule reaches the JVM as one string, which is both shorter to read and much faster
to submit than the same rule built call by call. Everything is a built-in function.
"""

from __future__ import annotations

from linkledger.functions import fixed_values as V


def quoted(*values: str) -> str:
    """SQL string literals, comma-separated."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def first_filled(*choices: str) -> str:
    """First value that is neither null nor empty, else the last choice as it is."""
    *heads, last = choices
    return "coalesce(" + ", ".join([f"nullif({c}, '')" for c in heads] + [last]) + ")"


def lower_or_unknown(value: str) -> str:
    """Lower-case; only null becomes ``unknown``, an empty string stays empty."""
    return f"coalesce(lower({value}), '{V.UNKNOWN}')"


def kind_of(type_: str) -> str:
    """Lower-case workspace type; null and empty become ``unknown``."""
    return f"coalesce(nullif(lower({type_}), ''), '{V.UNKNOWN}')"


def upper_first(lowered: str) -> str:
    """Upper-case the first letter of an already lower-case string, leave the rest."""
    return f"concat(upper(left({lowered}, 1)), substring({lowered}, 2))"


def is_filled(value: str) -> str:
    return f"({value} IS NOT NULL AND {value} <> '')"


def json_truth(value: str, when_missing: bool) -> str:
    """Truth of a JSON leaf: null, false, zero and empty are false, anything else is true."""
    false = r'^(null|false|""|\[\]|\{\}|-?0+(\.0*)?([eE][-+]?[0-9]+)?)$'
    return f"CASE WHEN {value} IS NULL THEN {str(when_missing).lower()} ELSE NOT to_json({value}) RLIKE r'{false}' END"


def build_target(server: str, database: str, endpoint: str) -> str:
    """``Server: s | Database: d | Endpoint: e`` without the empty parts; null if none is left."""
    parts = [
        f"concat('{label}: ', nullif({value}, ''))"
        for label, value in (("Server", server), ("Database", database), ("Endpoint", endpoint))
    ]
    return f"nullif(concat_ws(' | ', {', '.join(parts)}), '')"


def cloud_flag(scope: str, connector: str) -> str:
    return f"({scope} = '{V.SCOPE_CLOUD}' OR {connector} IN ({quoted(*V.CLOUD_CONNECTORS)}))"


def contains_any(value: str, parts: tuple[str, ...]) -> str:
    """True if any of the literal parts occurs in the value."""
    return "(" + " OR ".join(f"contains({value}, {quoted(p)})" for p in parts) + ")"


def json_string(value: str) -> str:
    """JSON text of a string with every character outside printable ASCII escaped.

    Strings of plain characters, nearly all of them, are only quoted. The rest are
    escaped character by character; beyond the basic plane that gives a surrogate pair.
    """
    units = "lower(hex(encode(ch, 'UTF-16BE')))"
    escape = (
        "CASE ch WHEN '\"' THEN r'\\\"' WHEN r'\\' THEN r'\\\\' WHEN '\\n' THEN r'\\n' WHEN '\\r' THEN r'\\r' "
        "WHEN '\\t' THEN r'\\t' WHEN char(12) THEN r'\\f' WHEN char(8) THEN r'\\b' "
        "ELSE CASE WHEN ch RLIKE '^[ -~]$' THEN ch ELSE "
        f"regexp_replace({units}, '(....)', r'\\\\u$1') END END"
    )
    return (
        f"CASE WHEN {value} IS NULL THEN 'null' "
        f"WHEN {value} RLIKE r'[^ -~]|[\"\\\\]' "
        f"THEN concat('\"', array_join(transform(split({value}, ''), ch -> {escape}), ''), '\"') "
        f"ELSE concat('\"', {value}, '\"') END"
    )
