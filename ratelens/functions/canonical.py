"""Canonical JSON text and digests, driven by a declared schema.

Numeric fields travel as the text they have in the document, so a record read back hashes to the
same bytes as when it was written.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ratelens.functions.bind import bind

_RAW = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType, T.ShortType, T.BooleanType)


def raw_schema(schema: T.DataType) -> T.DataType:
    """The same schema with every number or boolean read as its source text."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, raw_schema(f.dataType), True) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(raw_schema(schema.elementType), True)
    return T.StringType() if isinstance(schema, _RAW) else schema


def _quoted(value: str) -> str:
    """SQL text: JSON string, non-ASCII characters as four-digit escapes (surrogate pairs above the first plane)."""
    def unit(code: str) -> str:
        return rf"concat(r'\u', lower(lpad(hex({code}), 4, '0')))"

    pair = f"concat({unit('floor((ascii(c) - 65536) / 1024) + 55296')}, {unit('(ascii(c) - 65536) % 1024 + 56320')})"
    char = f"case when ascii(c) < 127 then c when ascii(c) < 65536 then {unit('cast(ascii(c) as bigint)')} else {pair} end"
    inner = bind(f"to_json(named_struct('v', {value}))", "j", "substring(j, 6, length(j) - 6)")
    plain = rf"if(q rlike r'^[\x00-\x7E]*$', q, array_join(transform(split(q, ''), c -> {char}), ''))"
    return bind(inner, "q", plain)


def _plain_number(x: str) -> str:
    """Number text without the JVM's early exponents: plain from 1e-4 up to 1e16, else a form like 1.5e-07."""
    plain = rf"regexp_replace(regexp_replace(cast(cast({x} as decimal(38,20)) as string), '0+$', ''), r'\.$', '.0')"
    power = f"cast(substring_index({x}, 'E', -1) as int)"
    digits = rf"regexp_replace(substring_index({x}, 'E', 1), r'\.0$', '')"
    short = f"concat({digits}, if({power} < 0, 'e-', 'e+'), lpad(cast(abs({power}) as string), 2, '0'))"
    return f"case when {x} is null then 'null' when not contains({x}, 'E') then {x} when {power} between -4 and 15 then {plain} else {short} end"


def canonical_sql(value: str, schema: T.DataType, level: int = 0) -> str:
    """SQL text: sorted keys, no blanks, nulls kept. `value` has type raw_schema(schema)."""
    v = f"v{level}"
    if isinstance(schema, T.StructType):
        fields = sorted(schema.fields, key=lambda f: f.name)
        parts = [f"""'{"," if i else "{"}"{f.name}":', {canonical_sql(f"{v}.{f.name}", f.dataType, level + 1)}""" for i, f in enumerate(fields)]
        return bind(value, v, f"if({v} is null, 'null', concat({', '.join(parts)}, '}}'))")
    if isinstance(schema, T.ArrayType):
        items = f"transform({value}, {v} -> {canonical_sql(v, schema.elementType, level + 1)})"
        return f"coalesce(concat('[', array_join({items}, ','), ']'), 'null')"
    if isinstance(schema, (T.DoubleType, T.FloatType)):
        return bind(f"cast({value} as string)", v, _plain_number(v))
    if isinstance(schema, _RAW):
        return f"coalesce(cast({value} as string), 'null')"
    return f"if({value} is null, 'null', {_quoted(value)})"


def canonical_json(columns: T.StructType) -> str:
    """SQL text: canonical JSON object of the named columns."""
    row = ", ".join(f"'{f.name}', {f.name}" for f in columns.fields)
    return canonical_sql(f"named_struct({row})", columns)


def digests(text: str) -> str:
    """SQL text: two independent digests of a text, as one struct."""
    return bind(text, "t", "named_struct('sha256', sha2(t, 256), 'sha512', sha2(t, 512))")
