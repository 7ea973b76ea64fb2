"""Column expressions that print values the way the violation texts need them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a quoted text never shows as themselves: controls, formats,
# unassigned code points and every separator other than the plain space.
_UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def _code_points(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    return (
        F.when(char == "\\", "\\\\")
        .when(char == "\n", "\\n")
        .when(char == "\r", "\\r")
        .when(char == "\t", "\\t")
        .when(~char.rlike(_UNPRINTABLE), char)
        .when(code < 0x100, F.concat(F.lit("\\x"), _hex(code, 2)))
        .when(code < 0x10000, F.concat(F.lit("\\u"), _hex(code, 4)))
        .otherwise(F.concat(F.lit("\\U"), _hex(code, 8)))
    )


def quoted(text: Column) -> Column:
    """Quote a string as a Python literal: single quotes unless only double quotes fit."""
    needs_escape = text.contains("\\") | text.rlike(_UNPRINTABLE)
    body = F.when(
        needs_escape, F.array_join(F.transform(_code_points(text), _escape_char), "")
    ).otherwise(text)
    return (
        F.when(~text.contains("'"), F.concat(F.lit("'"), body, F.lit("'")))
        .when(~text.contains('"'), F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def float_text(text: Column) -> Column:
    """Print a JSON number with a fraction or exponent as a Python float prints."""
    number = text.try_cast("double")
    size = F.abs(number)
    scientific = number.cast("string")
    exponent = F.regexp_extract(scientific, r"E(-?[0-9]+)", 1).try_cast("int")
    mantissa = F.regexp_replace(
        F.regexp_extract(scientific, r"^(-?[0-9.]+)E", 1), r"\.0\z", ""
    )
    with_exponent = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.abs(exponent) < 10, "0").otherwise(""),
        F.abs(exponent).cast("string"),
    )
    digits = F.when(
        text.contains("E"),
        F.regexp_replace(number.try_cast("decimal(38,18)").cast("string"), r"\.?0+\z", ""),
    ).otherwise(text)
    positional = F.when(digits.contains("."), digits).otherwise(F.concat(digits, F.lit(".0")))
    return F.when((size == 0) | ((size >= 1e-4) & (size < 1e16)), positional).otherwise(
        with_exponent
    )


def shown(text: Column, kind: Column | None) -> Column:
    """The value as a violation text shows it; ``kind`` is its JSON type, None for strings.

    Objects and arrays, given as JSON, are printed as Python literals.
    """
    if kind is None:
        return quoted(text)
    wide_integer = kind.rlike(r"^DECIMAL\((19|[23][0-9]),0\)")
    fractional = (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    return (
        F.when(kind == "STRING", quoted(text))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(wide_integer, text)
        .when(fractional, float_text(text))
        .when(kind.rlike("^(ARRAY|OBJECT)"), literal_text(text))
        .otherwise(text)
    )


# A string, or any other token, of a JSON text.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_TOKENS = rf"({_STRING}|[-+0-9.eE]+|true|false|null|[\[\]{{}}:,])"
_FRACTIONAL = r"-?[0-9]+(?:\.[0-9]+(?:[eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)"


def _python_float(number: Column) -> Column:
    """A JSON number with a fraction or an exponent as a Python float prints."""
    return float_text(number.try_cast("double").cast("string"))


def literal_text(json: Column) -> Column:
    """A JSON list or object, nested to any depth, as Python prints its value."""

    def token(t: Column) -> Column:
        plain = F.get_json_object(F.concat(F.lit("["), t, F.lit("]")), "$[0]")
        return (
            F.when(t.startswith('"'), quoted(plain))
            .when(t.isin(":", ","), F.concat(t, F.lit(" ")))
            .when(t.isin("true", "false"), F.initcap(t))
            .when(t == "null", "None")
            .when(t.rlike("[.eE]"), _python_float(t))
            .otherwise(t)
        )

    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(_TOKENS), F.lit(1)), token), "")


def has_fraction(json: Column) -> Column:
    """Whether a JSON text may hold a number with a fraction or an exponent.

    Such a number follows a bracket, a comma, a colon or a blank, or begins the text, so
    a quoted one is not taken for it; other strings may be, which costs time only.
    """
    return json.rlike(r"(?:^|[:\[,\s])-?[0-9]+[.eE]")


def marked_numbers(json: Column) -> Column:
    """A JSON text whose fractional numbers became strings with a mark at both ends.

    A parser that normalises numbers leaves them as they are then; see
    :func:`unmarked_numbers`.  Strings of the text are matched first, so nothing
    inside them is taken for a number.
    """
    both = F.regexp_replace(json, f"({_STRING})|({_FRACTIONAL})", r'$1"\\u0001$2\\u0001"')
    return F.replace(both, F.lit(r'"\u0001\u0001"'), F.lit(""))


def unmarked_numbers(json: Column) -> Column:
    """The numbers that :func:`marked_numbers` hid, printed as Python floats."""
    parts = F.split(json, r'"?\\u0001"?', -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(i % 2 == 1, _python_float(p)).otherwise(p)), ""
    )


def _json_unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), _hex(code, 4))


def _escape_json_char(char: Column) -> Column:
    code = F.ascii(char)
    offset = code - 0x10000
    return (
        F.when(char.rlike("[ -~]"), char)
        .when(code < 0x10000, _json_unit(code))
        .otherwise(
            F.concat(
                _json_unit(F.shiftright(offset, 10) + 0xD800),
                _json_unit(offset.bitwiseAND(0x3FF) + 0xDC00),
            )
        )
    )


def ascii_json(json: Column) -> Column:
    """Escape every non-ASCII character of a JSON text."""
    return F.when(
        json.rlike("[^ -~]"),
        F.array_join(F.transform(_code_points(json), _escape_json_char), ""),
    ).otherwise(json)
