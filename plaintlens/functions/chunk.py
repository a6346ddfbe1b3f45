"""Recursive, overlapping text splitting as one native column expression.

The rule: take the separators from coarse to fine. Cut the text before each separator; pieces
shorter than ``size`` are packed greedily into chunks of at most ``size`` characters, each new
chunk starting early enough to repeat up to ``overlap`` characters of the one before; a piece of
``size`` characters or more is handed to the next finer separator.

The fold below walks the text one *chunk* (not one word) at a time. It keeps the unread rest of
the text, looks at a window of ``size`` characters for the last place to cut, then searches the
first piece start that satisfies the overlap. Work per chunk is a few string searches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaintlens.functions.bind import let
from plaintlens import constants as K
from plaintlens.functions.text import strip

# A Unicode noncharacter, reserved for internal use: marks the first character of a separator
# that can overlap itself ("\n\n" inside "\n\n\n") so that cuts are found left to right.
_MARK = "\ufdd0"


def _overlaps_itself(separator: str) -> bool:
    return any(separator.startswith(separator[i:]) for i in range(1, len(separator)))


def _characters(text: Column, size: int, overlap: int) -> Column:
    """Fixed windows over a text that has no separator left; its length is at least ``size``."""
    step = max(size - overlap, 1)
    last = F.ceil(F.greatest(F.length(text) - size, F.lit(0)) / step).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: strip(F.substr(text, i * step + 1, F.lit(size)))
    )
    return F.filter(windows, lambda d: d != "")


def _split(text: Column, separators: Sequence[str], size: int, overlap: int) -> Column:
    separator, finer = separators[0], separators[1:]
    if separator == "":
        return _characters(text, size, overlap)

    def restore(c: Column) -> Column:
        return c

    if _overlaps_itself(separator):
        plain, separator = separator, _MARK
        text = F.replace(text, F.lit(plain), F.lit(_MARK + plain[1:]))

        def restore(c: Column) -> Column:  # noqa: F811
            return F.replace(c, F.lit(_MARK), F.lit(plain[0]))

    sep, width = F.lit(separator), len(separator)
    state = "struct<rest:string,docs:array<string>>"

    def moved(rest: Column, docs: Column) -> Column:
        return F.struct(rest.alias("rest"), docs.alias("docs")).cast(state)

    def long_piece(rest: Column, docs: Column, after: Column) -> Column:
        """The first piece is too long for one chunk: split it further and step over it."""
        piece = restore(F.when(after > 0, F.substr(rest, F.lit(1), after - 1)).otherwise(rest))
        inner = _split(piece, finer, size, overlap) if finer else F.array(strip(piece))
        return moved(
            F.when(after > 0, F.substr(rest, after)).otherwise(F.lit("")), F.concat(docs, inner)
        )

    def packed(rest: Column, docs: Column, window: Column) -> Column:
        """Cut at the last separator in the window and step back for the overlap."""
        cut = (
            F.length(window) - F.instr(F.reverse(window), separator[::-1]) - (width - 1) + 1
        )

        def from_cut(cut: Column) -> Column:
            after = F.position(sep, rest, cut + 1)
            next_len = F.when(after > 0, after - cut).otherwise(
                F.length(F.substr(rest, cut, F.lit(size)))
            )

            def advance(n: Column) -> Column:
                threshold = F.greatest(cut - 1 - overlap, cut - 1 + n - size)
                start = F.when(n >= size, cut).otherwise(F.position(sep, rest, threshold + 1))
                return moved(
                    F.substr(rest, start),
                    F.array_append(docs, strip(restore(F.substr(rest, F.lit(1), cut - 1)))),
                )

            return let(next_len, advance)

        return let(cut, from_cut)

    def step(st: Column, _: Column) -> Column:
        rest, docs = st["rest"], st["docs"]

        def look(v: Column) -> Column:
            window, after = v["window"], v["after"]
            first_len = F.when(after > 0, after - 1).otherwise(F.length(window))
            return (
                F.when(first_len >= size, long_piece(rest, docs, after))
                .when(
                    F.length(window) <= size,
                    moved(F.lit(""), F.array_append(docs, strip(restore(rest)))),
                )
                .otherwise(packed(rest, docs, window))
            )

        view = F.struct(
            F.substr(rest, F.lit(1), F.lit(size + width)).alias("window"),
            F.position(sep, rest, F.lit(2)).alias("after"),
        )
        return F.when(rest == "", st).otherwise(let(view, look))

    # Any two consecutive steps move on by more than size - overlap characters.
    steps = F.ceil(F.length(text) / max(size - overlap, 1)).cast("int") * 2 + 2
    folded = F.aggregate(
        F.sequence(F.lit(1), steps),
        moved(text, F.array().cast("array<string>")),
        step,
        lambda st: st["docs"],
    )
    return F.filter(folded, lambda d: d != "")


def split_text(
    text: Column,
    size: int = K.CHUNK_SIZE,
    overlap: int = K.CHUNK_OVERLAP,
    separators: Sequence[str] = tuple(K.SEPARATORS),
) -> Column:
    """Array of overlapping chunks of ``text``, none longer than ``size`` characters."""
    if size < 1 or overlap < 0 or overlap > size:
        raise ValueError("need size >= 1 and 0 <= overlap <= size")
    return _split(text, separators, size, overlap)


def split_cleaned(
    text: Column, size: int = K.CHUNK_SIZE, overlap: int = K.CHUNK_OVERLAP
) -> Column:
    """:func:`split_text` for cleaned text, where only a space or nothing can separate."""
    return split_text(text, size, overlap, (" ", ""))
