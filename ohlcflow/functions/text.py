"""FN-15: text holding escaped UTF-8 bytes (``b'\\xec\\x95\\x88'``) back to text.

Built-ins only, per row and whole texts: the escaped body is split into
tokens (runs of byte escapes, other escapes and plain runs); a byte run becomes
the hex of its bytes, and ``unhex`` with a UTF-8 check rebuilds the string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: single-character escapes of a byte literal and their bytes. ---
SIMPLE_ESCAPES = {
    "\\\\": "5C",
    "\\'": "27",
    '\\"': "22",
    "\\a": "07",
    "\\b": "08",
    "\\f": "0C",
    "\\n": "0A",
    "\\r": "0D",
    "\\t": "09",
    "\\v": "0B",
}
# --- end of fixed values ---

# One escape that stands for bytes: \xNN, \u00NN, up to three octal digits (to \377),
# or the character U+0080 to U+00FF that a byte was read as.
_BYTE = r"\\x[0-9a-fA-F]{2}|\\u00[0-9a-fA-F]{2}|\\[0-3]?[0-7]{1,2}|[\u0080-\u00ff]"
# Tokens of an escaped body: a run of such escapes of any kind, another \uNNNN, any
# other backslash escape, or a run of plain characters.
_TOKEN = rf"(?s)((?:{_BYTE})+|\\u[0-9a-fA-F]{{4}}|\\.|[^\\\u0080-\u00ff]+|\\)"
# Tokens of a text: runs of printable ASCII and runs of anything else.
_RUNS = r"([\x20-\x7e]+|[^\x20-\x7e]+)"


def _hex_escape(run: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-8"))), "(..)", r"\\x$1")


def _is_printable(t: Column) -> Column:
    first = F.ascii(t)
    return (first >= 32) & (first <= 126)


def escape_utf8(text: Column) -> Column:
    """Text to its byte-literal form ``b'...'``: printable ASCII kept (``\\`` and
    ``'`` escaped), tab/newline/return named, every other UTF-8 byte ``\\xNN``.

    ASCII escapes are whole-string literal replacements; the text is then cut
    into printable and other runs in one regex pass, and only the other runs
    go through ``hex``.
    """
    t = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, named in (("'", "\\'"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        t = F.replace(t, F.lit(raw), F.lit(named))
    runs = F.regexp_extract_all(t, F.lit(_RUNS), 1)
    body = F.array_join(F.transform(runs, lambda r: F.when(_is_printable(r), r).otherwise(_hex_escape(r))), "")
    return F.concat(F.lit("b'"), body, F.lit("'"))


def _byte_hex(t: Column, raw: Column) -> Column:
    """Hex digits of one byte escape; ``raw``: those of an unescaped character."""
    return (
        F.when(t.startswith("\\x"), F.substring(t, 3, 2))
        .when(t.startswith("\\u"), F.substring(t, 5, 2))
        .when(t.startswith("\\"), F.lpad(F.conv(F.substring(t, 2, 3), 8, 16), 2, "0"))
        .otherwise(raw)
    )


def _decoded(run: Column) -> Column:
    """The characters of a run of byte escapes; null if they are no UTF-8.

    Unescaped characters of the run are bytes misread as Latin-1 if that gives UTF-8,
    else themselves."""
    each = F.regexp_extract_all(run, F.lit(f"({_BYTE})"), 1)
    as_byte = F.transform(each, lambda t: _byte_hex(t, F.lpad(F.hex(F.ascii(t)), 2, "0")))
    as_text = F.transform(each, lambda t: _byte_hex(t, F.hex(F.encode(t, "UTF-8"))))
    text = lambda digits: F.try_validate_utf8(F.unhex(F.array_join(digits, "")).cast("string"))
    return F.coalesce(text(as_byte), text(as_text))


def _is_byte_run(t: Column) -> Column:
    return t.rlike(rf"^(?:{_BYTE})")


def _token_text(t: Column) -> Column:
    """A token's text; null for bytes that are no UTF-8."""
    simple = F.create_map(*[x for kv in SIMPLE_ESCAPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    # Plain runs, about half of the tokens and most of the text, are known by their first character.
    return (
        F.when(~t.startswith("\\") & (F.ascii(t) < 128), t)
        .when(_is_byte_run(t), _decoded(t))
        .when(~t.startswith("\\"), t)
        .when(t.rlike(r"^\\u[0-9a-fA-F]{4}$"), F.decode(F.unhex(F.substring(t, 3, 4)), "UTF-16BE"))
        .when(F.length(t) == 2, F.coalesce(F.unhex(F.element_at(simple, t)).cast("string"), t))
        .otherwise(t)
    )


def _texts(escaped: Column, strip_literal: bool) -> Column:
    """The tokens' texts; an element is null where bytes are broken."""

    def strip(e: Column) -> Column:
        wrapped = e.startswith("b'") & e.endswith("'") & (F.length(e) >= 3)
        return F.when(wrapped, F.substring(e, F.lit(3), F.length(e) - 3)).otherwise(e)

    # Bind the input once (a one-element transform acts as a let), so an
    # expensive input expression is not evaluated once per reference.
    def pieces(body: Column) -> Column:
        some = F.transform(F.regexp_extract_all(body, F.lit(_TOKEN), 1), _token_text)
        return F.when(body.rlike("[\\\\\u0080-\u00ff]"), some).when(body.isNotNull(), F.array(body))

    return _let(_let(escaped, strip) if strip_literal else escaped, pieces)


def repaired_utf8(escaped: Column, strip_literal: bool = True) -> Column:
    """``struct(text, broken)``: what :func:`repair_utf8` and :func:`is_broken_utf8` say, from
    one pass over the text."""

    def both(ts: Column) -> Column:
        broken = F.exists(ts, lambda t: t.isNull())
        return _let(broken, lambda b: F.struct(F.when(~b, F.array_join(ts, "")).alias("text"), b.alias("broken")))

    return _let(_texts(escaped, strip_literal), both)


def repair_utf8(escaped: Column, strip_literal: bool = True) -> Column:
    """Undo :func:`escape_utf8` and any mix of ``\\xNN``, ``\\uNNNN``, octal and named
    escapes, and of characters U+0080-U+00FF that are UTF-8 bytes misread as Latin-1.

    ``strip_literal`` removes one surrounding ``b'...'``. Unlike a blanket
    removal of every quote, apostrophes inside the text survive. Plain runs
    pass through untouched; each run of byte escapes, of whatever kinds, is decoded
    as UTF-8 on its own (the bytes of one character are always adjacent). Text whose
    escapes are no UTF-8 gives null, never an error: see :func:`is_broken_utf8`.
    """
    return repaired_utf8(escaped, strip_literal)["text"]


def is_broken_utf8(escaped: Column, strip_literal: bool = True) -> Column:
    """Whether :func:`repair_utf8` gives up on a text (null for a null text)."""
    return repaired_utf8(escaped, strip_literal)["broken"]


def _let(value: Column, fn) -> Column:
    return F.element_at(F.transform(F.array(value), fn), 1)
