"""Aligning two tokenizations of the same bytes: groups, links and corpus-wide link counts.

Tokenizer A (a byte-level BPE in the tokenizers format) encodes " " + text; tokenizer B (a
sentencepiece model, which adds the space itself) encodes the text; both without special tokens,
whose strings inside texts stay plain text. Each token stands for bytes: A's entry decoded from
its byte alphabet, B's piece in UTF-8 with U+2581 as a space and <0xHH> as byte HH. A text whose
joined A or B bytes differ from " " + text (B's normaliser changed it) has no tokens. Offsets
where an A token and a B token both end cut the two streams into groups; the two tokens ending at
a cut form a link. A link's count is how many links of the corpus hold the same (A id, B id).

Method (associative fragment monoid): a text is cut into byte ranges; each range yields a
fragment: an open head (tokens up to its first cut, which close a group begun before), closed
groups and an open tail. Fragments compose associatively (tail of the left and head of the right
form one group). A space after a character that is none is a cut of both tokenizers, whatever
stands around it (checked on their vocabularies), so a space and the word behind it are a closed
fragment of their own: it is encoded once and kept, as codes in bounded arrays, and a task composes
those of up to ``CHUNK_BYTES`` by concatenation. Ranges of a text beyond that are merged pairwise in rounds
of Spark groupings, written as SQL expressions. A text of one range leaves its task as digest and
links, 8 bytes a link before compression; only longer ones store groups. Link counts are a
grouping by (A id, B id) with map-side combining, the best count of each B id a grouping of
those; the links are joined to their counts (broadcast when the count table is within
``BROADCAST_ROWS``, counted first).

Defined cases: null or empty text, or a text that a tokenizer does not give back byte for byte:
zeros and an empty groups_sha256. Very long texts: tokenised in one task (memory linear in the
text), grouped across tasks by the rounds. Repeated rows give one row each; a null doc_id is kept
as null. Columns besides doc_id and text are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import arrow_batches, byte_slices, written
from plaintlens.llm.pretokens import Numbers, Recent

#: Bytes of one fragment's range.
CHUNK_BYTES = 64 << 10
#: Text a task aligns at once, and new segments that the libraries encode at once: their encodings
#: take far more memory than the text.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024
ENCODED_PARTS, ENCODED_CHARS = 4096, 64 << 10
#: Rows that go to a Python worker at once, in bytes: executor and worker both hold them.
BATCH_BYTES = 4 << 20
#: Link count rows broadcast up to this many (counted first); beyond, a shuffle join.
BROADCAST_ROWS = 4_000_000

FRAGMENT = (
    "cut boolean, ha array<long>, hb array<long>, body string, ta array<long>, tb array<long>"
)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others in order for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    table = {chr(b): b for b in own}
    table.update({chr(256 + i): b for i, b in enumerate(rest)})
    return table


def a_table(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    alphabet = byte_alphabet()
    vocab = tok.get_vocab(with_added_tokens=False)
    pieces = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        pieces[i] = bytes(alphabet[c] for c in token)
    return tok, pieces


def b_table(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            pieces.append(None)  # never part of a text given back byte for byte
        else:
            pieces.append(piece.replace("▁", " ").encode("utf-8"))
    return sp, pieces


def _group(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def fragments(a_ids, a_ends, b_ids, b_ends, chunk: int) -> list[dict]:
    """Fragments of the byte ranges (k*chunk, (k+1)*chunk] of one document's token streams."""
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    total = int(a_ends[-1]) if len(a_ends) else 0
    out = []
    for lo in range(0, max(total, 1), chunk):
        hi = lo + chunk
        ia = np.flatnonzero((a_ends > lo) & (a_ends <= hi))
        ib = np.flatnonzero((b_ends > lo) & (b_ends <= hi))
        here = cuts[(cuts > lo) & (cuts <= hi)]
        ra, rb = a_ids[ia].tolist(), b_ids[ib].tolist()
        if not len(here):
            out.append(dict(cut=False, ha=ra, hb=rb, body="", links=[], ta=[], tb=[]))
            continue
        ga = np.searchsorted(here, a_ends[ia], side="left")  # group of each A token in the range
        gb = np.searchsorted(here, b_ends[ib], side="left")
        n = len(here)
        sa = np.searchsorted(ga, np.arange(n + 2), side="left")
        sb = np.searchsorted(gb, np.arange(n + 2), side="left")
        groups = [(ra[sa[g] : sa[g + 1]], rb[sb[g] : sb[g + 1]]) for g in range(n + 1)]
        links = [dict(a=g[0][-1], b=g[1][-1]) for g in groups[:n]]
        out.append(
            dict(
                cut=True,
                ha=groups[0][0],
                hb=groups[0][1],
                body=";".join(_group(*g) for g in groups[1:n]),
                links=links,
                ta=groups[n][0],
                tb=groups[n][1],
            )
        )
    return out


#: A space with no white space before it: both tokenizers cut there. (U+180E counts as white space
#: in some Unicode versions only.)
_CUT = re.compile(r"(?<=[^\s\u180e])(?= )")
_ODD = re.compile(r"[\s\u180e](?: |\Z)")
#: The same of a text without the space before it, where nearly all texts need no such look.
_SPACES = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_TEXT = rf"\A(?: |\z)|{_SPACES}(?: |\z)"
#: Different segments kept in a Python worker.
CACHED = 600_000

_WORKER: dict = {}


def cuts_at_words(a_path: str, sp) -> bool:
    """Whether no token of either tokenizer can hold a space behind another character."""
    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return (
        spec["normalizer"] is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and not any("▁" in piece.lstrip("▁") for piece in pieces)
    )


def segments(text: str) -> list[str]:
    """The text behind each space that is a cut; " " before each and joined they are " " + text."""
    whole = " " + text
    if not _ODD.search(whole):
        return text.split(" ")
    parts = _CUT.split(whole)
    if len(parts) > 1 and parts[-1] == " ":  # B does not encode an empty text
        parts[-2:] = [parts[-2] + " "]
    return [part[1:] for part in parts]


class Encoder:
    """Segments as codes, 4 bytes a token in the order of the groups' text: twice the id, B's behind
    A's, plus one for the last token of its group. b"" where a tokenizer does not give the bytes back."""

    def __init__(self, a_path: str, b_path: str):
        self.tok, bytes_a = a_table(a_path)
        self.sp, bytes_b = b_table(b_path)
        self.n_a = len(bytes_a)
        self.bytes_a = pa.array(bytes_a, pa.binary())
        self.bytes_b = pa.array([piece or b"" for piece in bytes_b], pa.binary())
        self.len_a = np.fromiter(map(len, bytes_a), np.int64, len(bytes_a))
        self.len_b = np.fromiter((len(piece or b"") for piece in bytes_b), np.int64, len(bytes_b))
        self.at_words = cuts_at_words(a_path, self.sp)
        sides = ((len(bytes_a), ",|"), (len(bytes_b), ",;"))
        self.text = pa.array([f"{i}{mark}" for n, marks in sides for i in range(n) for mark in marks], pa.string())
        self.cache = Recent(CACHED)

    def split(self, text: str) -> list[str]:
        return segments(text) if self.at_words else [text]

    def split_all(self, texts: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
        """Rows of ``texts`` in another order, and the segments of each."""
        odd = np.full(len(texts), True)
        if self.at_words:
            odd = pc.match_substring_regex(texts, _ODD_TEXT).to_numpy(zero_copy_only=False)
        plain, odd = np.flatnonzero(~odd), np.flatnonzero(odd)
        parts = [self.split(text) if text else [] for text in texts.take(pa.array(odd)).to_pylist()]
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        return np.append(plain, odd), pa.concat_arrays([lists, pa.array(parts, lists.type)])

    def codes(self, parts: pa.Array) -> Numbers:
        """Those of different ``parts``, new ones through the libraries."""
        return self.cache.numbers(parts, self._new)

    def _new(self, parts: list[str]) -> list[bytes]:
        # in one string, segments are cut where white space ends none of them
        alone = {part for part in parts if not self.at_words or not part or part[-1].isspace() or part[-1] == "\u180e"}
        found = {}
        for whole in (False, True):
            for some in _groups([part for part in parts if (part in alone) != whole]):
                found.update(zip(some, self._encoded(some, whole)))
        return [found[part] for part in parts]

    def _of_a(self, parts: list[str], sizes: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all parts, and how many each has. whole: by one call for all."""
        if whole:
            ids = self.tok.encode_batch_fast([" " + " ".join(parts)], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.int64)
            ends, wanted = np.cumsum(self.len_a[ids]), np.cumsum(sizes)
            at = np.searchsorted(ends, wanted)
            if at[-1] + 1 == len(ids) and (ends[at] == wanted).all():
                return ids, np.diff(at, prepend=-1)
        listed = [
            one.ids
            for one in self.tok.encode_batch_fast([" " + part for part in parts], add_special_tokens=False)
        ]
        return _flat(listed)

    def _encoded(self, parts: list[str], whole: bool) -> list[bytes]:
        sizes = np.fromiter((len(part.encode()) + 1 for part in parts), np.int64, len(parts))
        ids_a, n_a = self._of_a(parts, sizes, whole)
        ids_b, n_b = _flat(self.sp.encode(parts, num_threads=1))
        given = np.ones(len(parts), bool)

        def kept(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return ids[np.repeat(given, n)], n * given

        for ids, n, lens in ((ids_a, n_a, self.len_a), (ids_b, n_b, self.len_b)):
            given &= _sums(lens[ids], n) == sizes
            given &= _sums(lens[ids] == 0, n) == 0  # control and unknown tokens are no bytes
        (ids_a, n_a), (ids_b, n_b) = kept(ids_a, n_a), kept(ids_b, n_b)
        want = np.frombuffer("".join([f" {p}" for p, ok in zip(parts, given) if ok]).encode(), np.uint8)
        other = (_joined_bytes(self.bytes_a, ids_a) != want) | (_joined_bytes(self.bytes_b, ids_b) != want)
        if other.any():
            given[np.searchsorted(np.cumsum(sizes * given), np.flatnonzero(other), side="right")] = False
            (ids_a, n_a), (ids_b, n_b) = kept(ids_a, n_a), kept(ids_b, n_b)
        if not given.any():
            return [b""] * len(parts)
        # every part ends at a cut: all of them are one pair of token streams
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)  # groups
        codes = np.empty(len(ids_a) + len(ids_b), "<u4")
        codes[np.arange(len(ids_a)) + np.searchsorted(of_b, of_a, side="left")] = 2 * ids_a + (cuts[of_a] == ends_a)
        codes[np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, side="right")] = 2 * (self.n_a + ids_b) + (cuts[of_b] == ends_b)
        raw, ends = codes.tobytes(), (4 * np.cumsum(n_a + n_b)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def stream(self, part: str, chunk: int) -> tuple[int, int, list[dict]] | None:
        """(A tokens, B tokens, fragments) of a segment beyond one range; None as b"" above."""
        ia = self.tok.encode(" " + part, add_special_tokens=False).ids
        (ia, _), (ib, _) = _flat([ia]), _flat([self.sp.encode(part)])
        want = (" " + part).encode()
        if (self.len_b[ib] == 0).any() or any(
            _joined_bytes(table, ids).tobytes() != want for table, ids in ((self.bytes_a, ia), (self.bytes_b, ib))
        ):
            return None
        return len(ia), len(ib), fragments(ia, np.cumsum(self.len_a[ia]), ib, np.cumsum(self.len_b[ib]), chunk)

    def written(self, codes: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The codes as text, and where each begins and ends there; ";" stands behind every group."""
        taken = self.text.take(pa.array(codes))
        return memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int32)[: len(codes) + 1]


def _groups(parts: list[str]) -> Iterator[list[str]]:
    """Runs of ``parts`` that the libraries encode at once."""
    some, size = [], 0
    for part in parts:
        if some and (len(some) == ENCODED_PARTS or size + len(part) > ENCODED_CHARS):
            yield some
            some, size = [], 0
        some.append(part)
        size += len(part)
    if some:
        yield some


def _flat(listed: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, listed), np.int64, len(listed))
    return np.fromiter(chain.from_iterable(listed), np.int64, int(n.sum())), n


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of ``n`` values."""
    total, ends = np.append(0, np.cumsum(values)), np.cumsum(n)
    return total[ends] - total[ends - n]


def _joined_bytes(table: pa.Array, ids: np.ndarray) -> np.ndarray:
    _, ends, data = table.take(pa.array(ids)).buffers()
    return np.frombuffer(data or b"", np.uint8)[: np.frombuffer(ends, np.int32)[len(ids)]]


def _range(encoder: Encoder, codes: list[np.ndarray]) -> dict:
    """The fragment of adjacent closed segments: their concatenation, the first group as head."""
    text, _ = encoder.written(np.concatenate(codes))
    head, _, body = str(text, "ascii").removesuffix(";").partition(";")
    ha, hb = ([int(i) for i in side.split(",")] for side in head.split("|"))
    return dict(cut=True, ha=ha, hb=hb, body=body, ta=[], tb=[])


def ranges(encoder: Encoder, text: str, chunk: int) -> tuple[int, int, list[dict]]:
    """A tokens, B tokens and fragments of a text of more than one range; (0, 0, []) if a tokenizer
    does not give it back."""
    parts = encoder.split(text)
    sizes = [len(part.encode()) + 1 for part in parts]
    coded = pa.array([part for part, size in zip(parts, sizes) if size <= chunk], pa.string()).dictionary_encode()
    flat, stops = encoder.codes(coded.dictionary)
    starts = np.append(0, stops[:-1])
    codes = (flat[starts[i] : stops[i]] for i in coded.indices.to_numpy())
    n_a, n_b, out, held, held_size = 0, 0, [], [], 0
    for part, size in zip(parts, sizes):
        if held and held_size + size > chunk:
            out.append(_range(encoder, held))
            held, held_size = [], 0
        if size > chunk:
            found = encoder.stream(part, chunk)
            if found is None:
                return 0, 0, []
            # links are the last ids of closed groups: read back from them at the end
            out += [{k: v for k, v in frag.items() if k != "links"} for frag in found[2]]
            n_a, n_b = n_a + found[0], n_b + found[1]
        else:
            held.append(next(codes))
            held_size += size
            if not len(held[-1]):
                return 0, 0, []
            own = held[-1] < 2 * encoder.n_a
            n_a, n_b = n_a + int(own.sum()), n_b + int((~own).sum())
    return n_a, n_b, out + ([_range(encoder, held)] if held else [])


def tokenized(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Per row and range: row, doc_id, n_a, n_b, k (range number), n_k (ranges); a row of one range
    has digest and links, ranges of longer ones their fragment frag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        # one thread a task: Spark runs the tasks side by side already, and each thread of the
        # library would hold its own buffers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if (a_path, b_path, chunk) not in _WORKER:
            _WORKER.clear()
            _WORKER[a_path, b_path, chunk] = Encoder(a_path, b_path)
        encoder = _WORKER[a_path, b_path, chunk]
        for batch in batches:
            for part in byte_slices(batch, "text", limit=SLICE_BYTES, rows=SLICE_ROWS):
                yield from _aligned(encoder, part, chunk)

    return docs.mapInArrow(
        run,
        "row long, doc_id long, n_a long, n_b long, k int, n_k int, n_links long, digest string, "
        f"links array<struct<a: int, b: int>>, frag struct<{FRAGMENT}>",
    )


def _aligned(encoder: Encoder, batch: pa.RecordBatch, chunk: int) -> Iterator[pa.RecordBatch]:
    texts = pc.fill_null(batch.column("text"), "")
    long = pc.greater_equal(pc.binary_length(texts), chunk)
    yield _short(encoder, batch.filter(pc.invert(long)))
    for one in batch.filter(long).to_pylist():
        n_a, n_b, frags = ranges(encoder, one["text"], chunk)
        for k, frag in enumerate(frags or [None]):
            row = dict(one, n_a=n_a, n_b=n_b, k=k, n_k=max(1, len(frags)), n_links=0, links=[], frag=frag)
            row["digest"] = None if frags else ""
            yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


def _short(encoder: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts of one range."""
    n = batch.num_rows
    order, lists = encoder.split_all(pc.fill_null(batch.column("text"), ""))
    batch = batch.take(pa.array(order))
    coded = lists.flatten().dictionary_encode()
    flat, stops = encoder.codes(coded.dictionary)
    at, words = coded.indices.to_numpy(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.diff(stops, prepend=0)
    size, of = own[at], np.repeat(np.arange(n), words)
    size[(np.bincount(of[size == 0], minlength=n) > 0)[of]] = 0  # one segment without tokens: none at all
    ends = np.cumsum(size)
    source = np.repeat((stops - own)[at] - (ends - size), size)
    source += np.arange(len(source))
    codes = flat[source].astype(np.int64)
    last = np.append(0, ends)[np.append(0, np.cumsum(words))]
    of_a, closes = codes < 2 * encoder.n_a, codes % 2 == 1
    n_a = _sums(of_a, np.diff(last))
    a, b = codes[of_a & closes] // 2, codes[~of_a & closes] // 2 - encoder.n_a
    n_links = _sums(of_a & closes, np.diff(last))
    text, places = encoder.written(codes)
    places = places[last].tolist()
    digests = [hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(places, places[1:])]
    pairs = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["a", "b"])
    offsets = pa.array(np.append(0, np.cumsum(n_links)), pa.int32())
    columns = {
        "row": batch.column("row"),
        "doc_id": batch.column("doc_id"),
        "n_a": n_a,
        "n_b": np.diff(last) - n_a,
        "k": np.zeros(n, np.int32),
        "n_k": np.ones(n, np.int32),
        "n_links": n_links,
        "digest": pa.array(digests, pa.string()),
        "links": pa.ListArray.from_arrays(offsets, pairs),
        "frag": pa.nulls(n, _SCHEMA.field("frag").type),
    }
    return pa.RecordBatch.from_pydict(columns, schema=_SCHEMA)


_LONGS = pa.list_(pa.int64())
_SCHEMA = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("k", pa.int32()),
        ("n_k", pa.int32()),
        ("n_links", pa.int64()),
        ("digest", pa.string()),
        ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
        (
            "frag",
            pa.struct(
                [
                    ("cut", pa.bool_()),
                    ("ha", _LONGS),
                    ("hb", _LONGS),
                    ("body", pa.string()),
                    ("ta", _LONGS),
                    ("tb", _LONGS),
                ]
            ),
        ),
    ]
)


def _group_sql(a: Column, b: Column) -> Column:
    return F.concat(F.array_join(a, ","), F.lit("|"), F.array_join(b, ","))


def _links(frag: Column) -> Column:
    """(a, b) of every closed group of a fragment: the head when cut, then each body group."""
    pair = "array<struct<a: long, b: long>>"
    head = F.when(
        frag["cut"],
        F.array(F.struct(F.try_element_at(frag["ha"], F.lit(-1)).alias("a"), F.try_element_at(frag["hb"], F.lit(-1)).alias("b"))),
    ).otherwise(F.array().cast(pair))
    groups = F.when(frag["body"] != "", F.split(frag["body"], ";")).otherwise(F.array().cast("array<string>"))

    def last(g: Column, side: int) -> Column:
        return F.try_element_at(F.split(F.split(g, r"\|")[side], ","), F.lit(-1)).cast("long")

    body = F.transform(groups, lambda g: F.struct(last(g, 0).alias("a"), last(g, 1).alias("b")))
    return F.concat(head, body).cast(pair)


def compose(left: Column, right: Column) -> Column:
    """The fragment of two adjacent ranges; associative."""
    joined_body = F.concat_ws(
        ";",
        F.when(left["body"] != "", left["body"]),
        _group_sql(F.concat(left["ta"], right["ha"]), F.concat(left["tb"], right["hb"])),
        F.when(right["body"] != "", right["body"]),
    )
    both = F.struct(
        F.lit(True).alias("cut"), left["ha"].alias("ha"), left["hb"].alias("hb"), joined_body.alias("body"),
        right["ta"].alias("ta"), right["tb"].alias("tb"),
    )
    right_only = F.struct(
        F.lit(True).alias("cut"), F.concat(left["ha"], right["ha"]).alias("ha"), F.concat(left["hb"], right["hb"]).alias("hb"),
        right["body"].alias("body"), right["ta"].alias("ta"), right["tb"].alias("tb"),
    )
    left_only = F.struct(
        F.lit(True).alias("cut"), left["ha"].alias("ha"), left["hb"].alias("hb"), left["body"].alias("body"),
        F.concat(left["ta"], right["ha"]).alias("ta"), F.concat(left["tb"], right["hb"]).alias("tb"),
    )
    neither = F.struct(
        F.lit(False).alias("cut"), F.concat(left["ha"], right["ha"]).alias("ha"), F.concat(left["hb"], right["hb"]).alias("hb"),
        F.lit("").alias("body"), left["ta"].alias("ta"), left["tb"].alias("tb"),
    )
    return (
        F.when(left["cut"] & right["cut"], both)
        .when(right["cut"], right_only)
        .when(left["cut"], left_only)
        .otherwise(neither)
    )


def merged(multi: DataFrame) -> DataFrame:
    """One fragment per row: ranges of long documents composed pairwise, round by round."""
    rounds = multi.agg(F.max("n_k")).first()[0]
    level = multi
    width = 1
    while rounds is not None and width < rounds:
        level = (
            level.groupBy("row", "doc_id", "n_a", "n_b", "n_k", (F.col("k") / 2).cast("int").alias("k"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("k").alias("at"), F.col("frag").alias("frag")))).alias("pair"))
            .select(
                "row", "doc_id", "n_a", "n_b", "k", "n_k",
                F.when(F.size("pair") == 1, F.col("pair")[0]["frag"])
                .otherwise(compose(F.col("pair")[0]["frag"], F.col("pair")[1]["frag"]))
                .alias("frag"),
            )
        )
        width *= 2
        level = written(level, "alignment-round")
    return level


def align(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        frags = written(tokenized(rows, a_path, b_path, chunk), "alignment-fragments")
    one = frags.where(F.col("n_k") == 1).select("row", "doc_id", "n_a", "n_b", "n_links", "digest", "links")
    multi = frags.where(F.col("n_k") > 1).select("row", "doc_id", "n_a", "n_b", "k", "n_k", "frag")
    frag = F.col("frag")
    text = F.concat_ws(";", _group_sql(frag["ha"], frag["hb"]), F.when(frag["body"] != "", frag["body"]))
    long = merged(multi).select(
        "row", "doc_id", "n_a", "n_b", F.sha2(text, 256).alias("digest"),
        _links(frag).cast("array<struct<a: int, b: int>>").alias("links"),
    )
    long = long.select("row", "doc_id", "n_a", "n_b", F.size("links").cast("long").alias("n_links"), "digest", "links")
    # rows of one range are a written table already: it is read, not copied
    whole = one.unionByName(written(long, "alignment-long"))

    links = whole.select("row", F.explode("links").alias("l")).select("row", F.col("l.a").alias("a"), F.col("l.b").alias("b"))
    counts = links.groupBy("a", "b").agg(F.count("*").alias("count"))
    counts = written(counts, "alignment-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("top"))
    counts = counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    per_row = (
        links.join(counts, ["a", "b"])
        .groupBy("row")
        .agg(F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
    )
    return whole.join(per_row, "row", "left").select(
        "doc_id",
        F.col("n_a").cast("long").alias("n_a"),
        F.col("n_b").cast("long").alias("n_b"),
        F.col("n_links").alias("n_groups"),
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        F.col("digest").alias("groups_sha256"),
    )
