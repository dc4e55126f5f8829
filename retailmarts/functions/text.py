"""Text cleaning and lenient typing of raw fields."""

from __future__ import annotations

# The characters that count as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Shapes of a decimal number and of the review anchors.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
HEX_ID = r"^[a-f0-9]{32}$"
INSTANT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
SCORES = "'1', '2', '3', '4', '5'"

_BLANKS = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)


def stripped(c: str) -> str:
    """Column ``c`` without surrounding whitespace of any kind; NULL stays NULL.

    Fields that start and end with a visible ASCII character, nearly all, pass after two comparisons.
    """
    last = f"substring({c}, -1, 1)"
    clean = " AND ".join(f"{x} >= '!' AND {x} < '\\u0080'" for x in (c, last))
    return f"CASE WHEN {clean} THEN {c} ELSE btrim({c}, '{_BLANKS}') END"


# The conversions below expect a stripped field and mention it several times, so strip in a projection
# of its own.


def text(c: str) -> str:
    """Text; an absent field is ``''``, never NULL."""
    return f"coalesce({c}, '')"


def to_bigint(c: str) -> str:
    """Whole number, or NULL when blank or anything else (``'1.5'`` is not a whole number)."""
    return f"try_cast({c} AS BIGINT)"


def to_double(c: str) -> str:
    """Finite decimal number, or NULL.

    The shape test is needed because Spark's cast also accepts ``5d`` or ``nan``.
    """
    value = f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN try_cast({c} AS DOUBLE) END"
    return f"nullif(nullif({value}, DOUBLE('Infinity')), DOUBLE('-Infinity'))"


def to_instant(c: str) -> str:
    """Timestamp when the first 19 characters are a real date and time, else NULL.

    A fraction of a second after them is kept.  The usual shape takes Spark's plain cast, blanks and
    short text (the shortest instant has 14 characters) no parsing at all.
    """
    whole = f"try_to_timestamp(left({c}, 19), 'yyyy-M-d H:m:s')"
    return (
        f"CASE WHEN length({c}) < 14 THEN NULL"
        f" WHEN {is_instant(c)} THEN try_cast({c} AS TIMESTAMP)"
        f" WHEN length({c}) <= 19 THEN {whole}"
        f" WHEN {whole} IS NOT NULL THEN coalesce(try_cast({c} AS TIMESTAMP), {whole}) END"
    )


def packed(c: str) -> str:
    """An id as bytes, each another one: 16 bytes if it is 32 lower-case hexadecimal digits, which takes half the space
    in a shuffle, else its own bytes behind a mark, which are never 16."""
    return (
        f"CASE WHEN length({c}) = 32 AND lower(hex(unhex({c}))) = {c} THEN unhex({c})"
        f" WHEN octet_length({c}) = 15 THEN concat(X'FFFF', CAST({c} AS BINARY))"
        f" ELSE concat(X'00', CAST({c} AS BINARY)) END"
    )


def unpacked(c: str) -> str:
    """The id that ``packed`` made bytes of."""
    return (
        f"CASE WHEN octet_length({c}) = 16 THEN lower(hex({c}))"
        f" WHEN substring({c}, 1, 1) = X'FF' THEN CAST(substring({c}, 3) AS STRING)"
        f" ELSE CAST(substring({c}, 2) AS STRING) END"
    )


def is_hex_id(c: str) -> str:
    return f"({c} RLIKE r'{HEX_ID}')"


def is_instant(c: str) -> str:
    """Shape test only: month 13 passes."""
    return f"({c} RLIKE r'{INSTANT}')"


def is_score(c: str) -> str:
    return f"({c} IN ({SCORES}))"


# A field is quoted only if the quote is its first character; text after the closing quote belongs to
# it, and an unclosed quote runs to the end.  All quantifiers are possessive: linear time, no stack.
_FIELD = r'(?s),("(?:[^"]++|"")*+"[^,]*+|"(?:[^"]++|"")*+$|[^,]*+)'
_QUOTED = r'(?s)^"((?:[^"]++|"")*+)"?(.*+)$'


def csv_fields(record: str) -> str:
    """All fields of one CSV record, however many there are, as an array of strings.

    A record without a quote is cut at its commas, which gives the same fields sooner."""
    inner = f"""replace(regexp_extract(f, r'{_QUOTED}', 1), '""', '"')"""
    return (
        f"CASE WHEN instr({record}, '\"') = 0 THEN split({record}, ',', -1) ELSE"
        f" transform(regexp_extract_all(',' || {record}, r'{_FIELD}', 1), f -> CASE"
        f" WHEN startswith(f, '\"') THEN {inner} || regexp_extract(f, r'{_QUOTED}', 2) ELSE f END) END"
    )
