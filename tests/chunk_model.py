"""A slow, plain statement of the splitting rule, used only to check the Spark expression."""

import re


def pieces_before(text, sep):
    """Cut ``text`` in front of every occurrence of ``sep``."""
    if sep == "":
        return list(text)
    starts = [0] + [m.start() for m in re.finditer(re.escape(sep), text)] + [len(text)]
    return [text[a:b] for a, b in zip(starts, starts[1:]) if a < b]


def pack(pieces, size, overlap):
    """Greedy packing by piece index: [first, last) windows that share an overlap."""
    out, first, last = [], 0, 0
    while last < len(pieces):
        while last < len(pieces) and sum(map(len, pieces[first : last + 1])) <= size:
            last += 1
        out.append("".join(pieces[first:last]))
        if last == len(pieces):
            break
        while first < last and (
            sum(map(len, pieces[first:last])) > overlap
            or sum(map(len, pieces[first : last + 1])) > size
        ):
            first += 1
    return out


def split(text, size, overlap, seps=("\n\n", "\n", ". ", " ", "")):
    out, run = [], []
    for piece in pieces_before(text, seps[0]):
        if len(piece) < size or seps[0] == "":
            run.append(piece)
            continue
        out += pack(run, size, overlap)
        run = []
        out += split(piece, size, overlap, seps[1:])
    out += pack(run, size, overlap)
    return [s for s in (c.strip() for c in out) if s]
