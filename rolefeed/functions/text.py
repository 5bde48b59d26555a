"""Text Column expressions: HTML to text (E1), truthiness helpers (E19),
truncation (E20), place joining (E13) and Python-style whitespace handling.

Everything here returns a ``Column`` of built-in functions. Expressions that
bind a value once (``let``) or treat every character reference of a text are
higher-order functions, which Spark evaluates outside whole-stage codegen.
"""
from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.isspace`` set: Java's Unicode White_Space plus the four
# information separators U+001C..U+001F.
WS_CLASS = r"[\s\x{1c}-\x{1f}]"
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_WS_RUN = r"(?U)" + WS_CLASS + "+"

# Named character references that are looked up first; all others are in the
# HTML5 table of the standard library.
COMMON_NAMES = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "copy;", "middot;", "apos;")
# A reference as HTML parsers see it: numeric, or up to 32 characters.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that are also recognised without the semicolon, longest first.
_OPEN_NAMES = sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    Keeps expression trees linear when a helper needs its input several
    times (a plain Python reuse would copy the whole input subtree into the
    plan at every use, and planning time grows with that tree)."""
    return F.element_at(F.transform(F.array(as_col(value)), fn), 1)


def let2(a, b, fn) -> Column:
    """``let`` for two values."""
    packed = F.array(F.struct(as_col(a).alias("a"), as_col(b).alias("b")))
    return F.element_at(F.transform(packed, lambda x: fn(x.getField("a"), x.getField("b"))), 1)


def nonblank(c) -> Column:
    """Python truthiness for a string: NULL and '' are falsy (E19 building block)."""
    c = as_col(c)
    return F.when(c != F.lit(""), c)


def nonblank_once(c) -> Column:
    """``nonblank`` of an expression that costs something: it stands in the plan,
    and is evaluated, once, wherever Spark shares no common subexpression (in
    the branches of a case, in a lambda)."""
    return F.get(F.array_remove(F.array(as_col(c)), F.lit("")), F.lit(0))


def first_truthy_once(*cols) -> Column:
    """``first_truthy`` of expressions that cost something, each evaluated once at most."""
    return F.coalesce(*[nonblank_once(c) for c in cols])


def first_truthy(*cols) -> Column:
    """Python ``a or b or c`` over strings: first non-NULL, non-'' value."""
    return F.coalesce(*[nonblank(c) for c in cols])


def or_empty(c) -> Column:
    """``x or ""``."""
    return F.coalesce(nonblank(c), F.lit(""))


def py_strip(c) -> Column:
    """``str.strip()``: trims every Unicode whitespace character at both ends."""
    return F.trim(as_col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Whitespace runs to one space, then strip."""
    return F.trim(F.regexp_replace(as_col(c), _WS_RUN, " "))


def truncate(c, n: int) -> Column:
    """First ``n`` characters (code points), E20."""
    return F.substring(as_col(c), 1, n)


def _character(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _numeric(digits: Column, base: int, longest: int) -> Column:
    """The character of a numeric reference: windows-1252 for 128-159, nothing
    for other control characters and non-characters, U+FFFD beyond Unicode."""
    short = F.regexp_replace(digits, "^0+", "")

    def body(n):
        windows = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
        table = F.create_map(*[F.lit(x) for pair in windows.items() for x in pair])
        silent = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
                  | F.pmod(n, F.lit(0x10000)).isin(0xFFFE, 0xFFFF))
        return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(n.between(0x80, 0x9F), F.try_element_at(table, n.cast("int")))
                .when(silent, "").otherwise(_character(n)))

    number = F.when(F.length(short) > longest, F.lit(1 << 30)).when(short == "", F.lit(0)).otherwise(F.conv(short, base, 10).cast("int"))
    return let(number.cast("bigint"), body)


_NAMES = None


def _named(name: Column) -> Column:
    """The value of a name, else that of its longest prefix that needs no
    semicolon and the rest, else the text as it stands."""
    global _NAMES
    if _NAMES is None:  # one string literal folded into one map constant
        _NAMES = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in sorted(html5.items()))), F.lit("\x02"), F.lit("\x01"))
    value = None
    for k in COMMON_NAMES:
        value = F.when(name == k, F.lit(html5[k])) if value is None else value.when(name == k, F.lit(html5[k]))
    open_ = F.regexp_extract(name, "^(?:" + "|".join(_OPEN_NAMES) + ")", 0)
    rest = let(open_, lambda p: F.when(p != "", F.concat(F.try_element_at(_NAMES, p), F.substring(name, F.length(p) + 1, F.length(name))))
               .otherwise(F.concat(F.lit("&"), name)))
    # only letters and digits, and one semicolon, make a name that is looked up
    return value.when(name.rlike("^[A-Za-z][A-Za-z0-9]*;?$"), F.coalesce(F.try_element_at(_NAMES, name), rest)).otherwise(rest)


def _decode_reference(t: Column) -> Column:
    name = F.substring(t, 2, 40)
    digits = F.regexp_replace(t, "[^0-9a-fA-F]", "")
    return (F.when(t.rlike("^&#[0-9]"), _numeric(digits, 10, 7)).when(t.rlike("^&#[xX]"), _numeric(F.regexp_replace(digits, "^[xX]", ""), 16, 6))
            .otherwise(_named(name)))


def unescape(c) -> Column:
    """HTML character references decoded in one pass, so ``&amp;lt;`` becomes
    ``&lt;``: the text is split at its references, each is decoded, and the
    pieces are put together again. No Python."""
    def body(c):
        pieces = F.split(c, REFERENCE, -1)
        decoded = F.concat(F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), 0), _decode_reference), F.array(F.lit("")))
        return F.array_join(F.zip_with(pieces, decoded, lambda a, b: F.concat(a, b)), "")

    c = as_col(c)
    return F.when(~c.contains("&"), c).otherwise(let(c, body))


def strip_html(c, already_unescaped: Column | None = None) -> Column:
    """Unescape first, tags to a space, whitespace runs to one space, strip.
    NULL or '' gives ''. Script/style content is kept, as in the reference."""
    c = as_col(c)
    s = already_unescaped if already_unescaped is not None else unescape(c)
    s = F.regexp_replace(s, r"<[^>]+>", " ")
    s = collapse_ws(s)
    return F.when(nonblank(c).isNull(), F.lit("")).otherwise(s)


def html_title(c) -> Column:
    """Text of the first <title> element (raw, still escaped)."""
    return F.regexp_extract(as_col(c), r"(?is)<title[^>]*>(.*?)</title>", 1)
