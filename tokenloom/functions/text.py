"""Text expressions: pretokens, special-token segments, byte strings, symbols.

Byte strings are handled "lifted": one character U+0000..U+00FF per byte, so the
built-in string functions work on bytes. A token with more than one byte is one
character above that range, and a merge is an ordinary ``replace``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tokenloom.functions.arrays import bind, prefix_sums

# The pretoken pattern and the default delimiter.
PRETOKEN_PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END_OF_TEXT = "<|endoftext|>"

# 0xFF never occurs in UTF-8, so it can part pretokens without escaping.
BOUNDARY = "ÿ"
_BOUNDARY_BYTE = "cast(X'FF' as string)"


def pretokens(text: Column) -> Column:
    """Array of pretokens; (?U) gives Java's \\s its Unicode meaning."""
    return F.regexp_extract_all(text, F.lit("(?U)" + PRETOKEN_PATTERN), F.lit(0))


def longest_first(specials: Sequence[str]) -> list[str]:
    """Special tokens in match order: longest first, then by text."""
    return sorted(set(specials), key=lambda token: (-len(token), token))


def quoted(token: str) -> str:
    """A regex that matches ``token`` literally."""
    return r"\Q" + token.replace(r"\E", r"\E\\E\Q") + r"\E"


def segments(text: Column, specials: Sequence[str]) -> Column:
    """Array of (segment, is_special): specials are atomic, gaps keep their text."""
    if not specials:
        whole = F.array(F.struct(text.alias("segment"), F.lit(False).alias("is_special")))
        return F.filter(whole, lambda part: part["segment"] != "")
    pattern = F.lit("|".join(quoted(token) for token in longest_first(specials)))
    gaps = F.call_function("split", text, pattern, F.lit(-1))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    paired = F.zip_with(
        gaps,
        found,
        lambda gap, token: F.array(
            F.struct(gap.alias("segment"), F.lit(False).alias("is_special")),
            F.struct(token.alias("segment"), F.lit(True).alias("is_special")),
        ),
    )
    return F.filter(F.flatten(paired), lambda part: part["segment"] != "")


def pretokens_with_specials(text: Column, specials: Sequence[str] = ()) -> Column:
    """Pretokens of the text between specials, each special kept as one pretoken."""
    if not specials:
        return pretokens(text)
    return F.flatten(
        F.transform(
            segments(text, specials),
            lambda part: F.when(part["is_special"], F.array(part["segment"])).otherwise(
                pretokens(part["segment"])
            ),
        )
    )


def lift(text: Column) -> Column:
    """UTF-8 text to its lifted byte string."""
    return F.call_function("decode", text.cast("binary"), F.lit("ISO-8859-1"))


def lift_binary(data: Column) -> Column:
    """Binary to its lifted byte string."""
    return F.call_function("decode", data, F.lit("ISO-8859-1"))


def unlift(lifted: Column) -> Column:
    """Lifted byte string to binary."""
    return F.encode(lifted, "ISO-8859-1")


def lenient_text(data: Column) -> Column:
    """Binary to text; malformed sequences become U+FFFD."""
    return F.call_function("make_valid_utf8", data.cast("string"))


def bounded_join(words: Column) -> Column:
    """Pretokens as one lifted string, each between two boundary characters."""
    edge = F.expr(_BOUNDARY_BYTE)
    between = F.concat(edge, edge)
    return lift(F.concat(edge, F.call_function("array_join", words, between), edge))


def characters(text: Column) -> Column:
    """Array of the characters of a string (code points); empty for ''."""
    empty = F.array().cast("array<string>")
    return bind(text, lambda whole: F.when(whole == "", empty).otherwise(F.split(whole, "")))


# Every two neighbouring characters. The first guard skips the second half of a
# surrogate pair, so that a step is one character.
ADJACENT_PAIRS = r"regexp_extract_all({}, r'(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(..))', 1)"


def adjacent_pairs(symbols: str) -> Column:
    """Every two neighbouring characters of a column, overlaps included, in one pass."""
    return F.expr(ADJACENT_PAIRS.format(symbols))


def symbol(code: int) -> str:
    """The character that stands for a symbol code (surrogates are skipped)."""
    return chr(code if code < 0xD800 else code + 0x800)


def symbol_code(character: Column) -> Column:
    """Inverse of :func:`symbol` as an expression."""
    point = F.ascii(character)
    return F.when(point < 0xD800, point).otherwise(point - 0x800)


def printable_bytes() -> list[str]:
    """Printable character for each byte value.

    The 188 bytes that already print keep their character; the others take
    U+0100 onward in byte order.
    """
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [value for value in range(256) if value not in set(keep)]
    table = {value: chr(value) for value in keep}
    table.update({value: chr(0x100 + place) for place, value in enumerate(others)})
    return [table[value] for value in range(256)]


def to_printable(lifted: Column) -> Column:
    """Lifted byte string to its printable form."""
    return F.translate(lifted, "".join(map(chr, range(256))), "".join(printable_bytes()))


def from_printable(text: Column) -> Column:
    """Printable form back to the lifted byte string."""
    zero, *others = printable_bytes()
    # ``translate`` would delete a character mapped to U+0000.
    moved = F.translate(text, "".join(others), "".join(map(chr, range(1, 256))))
    return F.replace(moved, F.lit(zero), F.lit("\0"))


def overlapping_offsets(lifted: Column, needle: str) -> Column:
    """0-based offsets of every occurrence of ``needle``, overlaps included.

    A boundary character is put before each occurrence; offsets are the prefix
    sums of the lengths between boundaries, so long strings stay cheap.
    """
    marked = F.regexp_replace(lifted, F.lit(f"(?={quoted(needle)})"), F.lit(BOUNDARY))
    lengths = bind(
        F.split(marked, BOUNDARY),
        lambda parts: F.transform(
            F.slice(parts, F.lit(1), F.size(parts) - 1), lambda part: F.length(part)
        ),
    )
    return prefix_sums(lengths, F.lit(0))
