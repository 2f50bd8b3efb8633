"""Token ids in binary segments of patched frame-of-reference (PFOR) blocks.

Segment layout, little-endian: magic ``PFR1``; u32 number of ids, of documents and of blocks;
u32 byte offset of every block, counted from the first; u32 length of every document; blocks.
A block holds 128 ids, the last one filled up with its own last id: u32 minimum, u8 bit width,
u8 number of exceptions; the ids less the minimum, their low ``width`` bits packed; the
exceptions' positions, u8 each; their high parts, u16 each up to ids of 16 bits over the
minimum, else u32 each, as a top bit in the width says.  The width is that of one of a few
percentiles of the block, rounded up so that a few ids fill whole bytes, the one that makes the
block smallest.

Segments are rows of a Parquet table, so that Spark's committer decides which attempt of a task
counts and any store Spark writes to will do.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import shared_folder
from .common import steps

MAGIC = b"PFR1"
BLOCK = 128
#: How many of a block's ids a candidate width holds: 90, 95, 98 and 100 percent.
HELD = np.array([116, 122, 126, 128])
#: Ids of a segment, roughly; a longer document has a segment of its own.
SEGMENT = 1 << 20
END_ID = 2
#: Bytes of text of one step of tokenizing.
STEP = 8 << 20
#: Pieces of text whose ids a worker remembers, and the longest of them.
CACHE, LONGEST = 1 << 18, 64
WIDE = 0x80
_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("over", "u1")])


def encode_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One segment from the ids of its documents, end to end, and their lengths."""
    n_blocks = -(-len(ids) // BLOCK)
    filled = np.concatenate([ids, np.repeat(ids[-1:], n_blocks * BLOCK - len(ids))])
    table = filled.astype(np.uint32).reshape(n_blocks, BLOCK)
    low = table.min(axis=1) if n_blocks else np.empty(0, np.uint32)
    rest = table - low[:, None]
    width, wide = _widths(rest)
    exact = rest >> width[:, None].astype(np.uint32)
    exact[width == 32] = 0
    row, place = np.nonzero(exact)
    over = np.bincount(row, minlength=n_blocks)
    head = np.empty(n_blocks, _HEAD)
    head["low"], head["width"], head["over"] = low, width | np.where(wide, WIDE, 0), over
    heads, step = head.tobytes(), _HEAD.itemsize
    places, parts = place.astype(np.uint8).tobytes(), exact[row, place]
    small, large = parts.astype("<u2").tobytes(), parts.astype("<u4").tobytes()
    packed = _packed(rest, width)
    blocks = []
    past = np.cumsum(over)
    for k, (bits, stop, n, big) in enumerate(zip(packed, past.tolist(), over.tolist(), wide.tolist())):
        first = stop - n
        high = large[4 * first : 4 * stop] if big else small[2 * first : 2 * stop]
        blocks.append(heads[k * step : k * step + step] + bits + places[first:stop] + high)
    sizes = np.fromiter(map(len, blocks), np.uint32, n_blocks)
    offsets = np.cumsum(sizes, dtype=np.uint32) - sizes
    return b"".join(
        [
            MAGIC + struct.pack("<III", len(ids), len(lengths), n_blocks),
            offsets.astype("<u4").tobytes(),
            np.asarray(lengths).astype("<u4").tobytes(),
            *blocks,
        ]
    )


def _widths(rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest candidate width of each block, and whether its exceptions are u32."""
    if not len(rest):
        return np.empty(0, np.uint8), np.empty(0, bool)
    held = np.partition(rest, HELD - 1, axis=1)[:, HELD - 1]
    exact = np.ceil(np.log2(held.astype(np.float64) + 1)).astype(np.int64)
    # Widths at which four ids, above 16 bits two, fill whole bytes of a 64-bit number.
    widths = np.where(exact <= 16, exact + exact % 2, -(-exact // 4) * 4)
    wide = widths[:, -1] > 16
    cost = BLOCK * widths + (BLOCK - HELD) * np.where(wide, 40, 24)[:, None]
    best = widths[np.arange(len(rest)), cost.argmin(axis=1)]
    return best.astype(np.uint8), wide


def _packed(rest: np.ndarray, width: np.ndarray) -> list[bytes]:
    out: list[bytes] = [b""] * len(rest)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if not w:
            continue
        lanes = _lanes(w)
        mask = np.uint64((1 << int(w)) - 1)
        values = (rest[rows].astype(np.uint64) & mask).reshape(len(rows), -1, lanes)
        joined = values[:, :, 0].copy()
        for lane in range(1, lanes):
            joined |= values[:, :, lane] << np.uint64(lane * w)
        raw = joined.view(np.uint8).reshape(*joined.shape, 8)[:, :, : lanes * w // 8]
        raw = np.ascontiguousarray(raw).reshape(len(rows), -1)
        size = raw.shape[1]
        data = raw.tobytes()
        for i, row in enumerate(rows.tolist()):
            out[row] = data[i * size : (i + 1) * size]
    return out


def _lanes(width: int) -> int:
    return 4 if width <= 16 else 2


class Segment:
    """A reader of one segment; any run of ids is reached through the block starts."""

    def __init__(self, data: bytes) -> None:
        if bytes(memoryview(data)[:4]) != MAGIC:
            raise ValueError("not a token segment")
        self.data = np.frombuffer(data, np.uint8)
        self.n_ids, n_docs, n_blocks = struct.unpack_from("<III", data, 4)
        self.lengths = np.frombuffer(data, "<u4", n_docs, 16 + 4 * n_blocks).astype(np.int64)
        base = 16 + 4 * (n_blocks + n_docs)
        self.offsets = np.frombuffer(data, "<u4", n_blocks, 16).astype(np.int64) + base

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.empty(0, np.uint32)
        first = start // BLOCK
        run = self._blocks(np.arange(first, (stop - 1) // BLOCK + 1)).ravel()
        return run[start - first * BLOCK : stop - first * BLOCK]

    def _blocks(self, which: np.ndarray) -> np.ndarray:
        at = self.offsets[which]
        head = self.data[at[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).ravel()
        width = (head["width"] & ~np.uint8(WIDE)).astype(np.int64)
        wide = head["width"] >= WIDE
        out = np.zeros((len(which), BLOCK), np.uint32)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            if w:
                size = BLOCK * w // 8
                raw = self.data[at[rows][:, None] + (_HEAD.itemsize + np.arange(size))]
                lanes = _lanes(w)
                filled = np.zeros((len(rows) * BLOCK // lanes, 8), np.uint8)
                filled[:, : lanes * w // 8] = raw.reshape(len(filled), -1)
                joined = filled.view("<u8").ravel()
                mask = np.uint64((1 << int(w)) - 1)
                for lane in range(lanes):
                    values = (joined >> np.uint64(lane * w)) & mask
                    out[rows, lane::lanes] = values.reshape(len(rows), -1)
        over = head["over"].astype(np.int64)
        places = at + _HEAD.itemsize + BLOCK * width // 8
        for big, size in ((False, 2), (True, 4)):
            rows = np.flatnonzero((over > 0) & (wide == big))
            if len(rows):
                n = over[rows]
                each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(rows, n)
                column = self.data[places[row] + each]
                parts = (places[row] + over[row] + size * each)[:, None] + np.arange(size)
                high = self.data[parts].copy().view(f"<u{size}").ravel().astype(np.uint32)
                out[row, column] |= high << width[row].astype(np.uint32)
        return out + head["low"][:, None]

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document, decoding about ``SEGMENT`` ids at a time."""
        ends = np.cumsum(self.lengths)
        first = at = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, at + SEGMENT, "right")))
            run = self.ids(at, int(ends[last - 1]))
            yield from np.split(run, ends[first : last - 1] - at)
            first, at = last, int(ends[last - 1])


class Encoder:
    """Text to ids, a piece at a time, remembering the ids of pieces seen.

    The byte-level tokenizer never joins what lies either side of a single space between two
    other characters, so texts are cut there and a cut piece takes the space before it.  Its
    pre-tokenizer cuts plain words, with punctuation after them, in a known way: these go
    straight to the tokenizer's BPE model.  All other pieces are encoded in full, many at a
    time, held apart by the end-of-text token.

    The strings of special tokens in a text are these tokens, as the tokenizer file has it, or
    ordinary text with ``special_as_text``.  A file of another kind, be it another pre-tokenizer,
    a normalizer or none special token to hold pieces apart, has its texts encoded whole.
    """

    def __init__(self, path: str, special_as_text: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        if special_as_text:
            self.plain.encode_special_tokens = True
        special = self.tokenizer.get_added_tokens_decoder()
        apart = [(i, t.content) for i, t in special.items() if t.special]
        self.by_pieces = bool(apart) and _byte_level(self.tokenizer.to_str())
        self.between_id, self.between = apart[0] if apart else (None, None)
        self.specials = [t.content for t in special.values()]
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.short: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        """The ids as u32 bytes."""
        if not text:
            return b""
        if not self.by_pieces or any(s in text for s in self.specials):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.known) > CACHE:
            self.known.clear()
        ids = self._cut(text.split(" "))
        return self._cut(_CUT.split(text)) if ids is None else ids

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id after it, end to end, and their numbers.

        All texts are cut at once, each different piece is looked up once, and the ids are
        gathered by the pieces' numbers.
        """
        texts = texts.fill_null("")
        whole = np.zeros(len(texts), bool) if self.by_pieces else np.ones(len(texts), bool)
        for special in self.specials if self.by_pieces else ():
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(~whole)
        if len(self.known) > CACHE:
            self.known.clear()
        lists = pc.split_pattern(texts.take(pa.array(rows)), " ")
        cuts = lists.offsets.to_numpy().astype(np.int64)
        cuts, pieces = cuts - cuts[0], lists.flatten()
        first, last = cuts[:-1], cuts[1:] - 1
        several = last > first
        inner = np.ones(len(pieces), bool)
        inner[first] = inner[last] = False
        coded = pieces.filter(pa.array(inner)).dictionary_encode()
        begin, end = (_strings(pieces.take(pa.array(at))) for at in (first, last[several]))
        found = self._found(_strings(coded.dictionary))
        ends = [self._ending(piece, ids) for piece, ids in zip(end, self._found(end))]

        code = np.empty(len(pieces), np.int64)
        code[inner] = coded.indices.to_numpy()
        code[last[several]] = len(found) + np.arange(len(end))
        code[first] = len(found) + len(end) + np.arange(len(begin))
        # Texts of which a cut is not between two others go the slow way.
        entries = [*found, *ends]
        bad = np.fromiter((e is None for e in entries), bool, len(entries))
        bad = np.r_[bad, np.fromiter((not p or p[-1].isspace() for p in begin), bool, len(begin)) & several]
        slow = np.logical_or.reduceat(bad[code], first) if len(rows) else np.empty(0, bool)
        entries = [e or b"" for e in entries] + self._encoded(begin) if begin else []
        entries.append(np.array([END_ID], "<u4").tobytes())
        code = np.insert(code, cuts[1:], len(entries) - 1)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        size = sizes[code]
        pool, start = np.frombuffer(b"".join(entries), "<u4"), np.cumsum(sizes) - sizes
        ids = pool[np.repeat(start[code] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        counts = np.add.reduceat(size, first + np.arange(len(rows))) if len(rows) else size[:0]
        if len(rows) == len(texts) and not slow.any():
            return ids, counts
        out = dict(zip(rows.tolist(), np.split(ids, np.cumsum(counts)[:-1])))
        for row in [*np.flatnonzero(whole).tolist(), *rows[slow].tolist()]:
            own = np.frombuffer(self(texts[row].as_py()), "<u4")
            out[row] = np.r_[own, np.uint32(END_ID)]
        ordered = [out[row] for row in range(len(texts))]
        return np.concatenate(ordered), np.fromiter(map(len, ordered), np.int64, len(ordered))

    def _cut(self, pieces: list[str]) -> bytes | None:
        """Ids of pieces cut at spaces; None if one of the spaces is not between two others."""
        first = pieces[0]
        if len(pieces) > 1 and (not first or first[-1].isspace()):
            return None
        found = self._found(pieces[1:])
        if found:
            found[-1] = self._ending(pieces[-1], found[-1])
        if None in found:
            return None
        return b"".join([*self._encoded([first]), *found])

    def _ending(self, piece: str, ids: bytes | None) -> bytes | None:
        """A text's last piece may end with white space."""
        if ids is None and piece and not piece[0].isspace():
            return self._encoded([" " + piece])[0]
        return ids

    def _found(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of pieces with a space before them; None for empty ones and those at whose ends
        there is more white space."""
        known = self.known
        found = list(map(known.get, pieces))
        hard: list[int] = []
        words, tokenize, short = _WORDS.fullmatch, self.model.tokenize, self.short
        for i in [i for i, f in enumerate(found) if f is None]:
            piece = pieces[i]
            match = words(piece)
            if match:
                word, marks, below, more = match.groups()
                ids = known.get(word) if marks or below else None
                if ids is None:
                    level = word if word.isascii() else word.translate(_BYTE_LEVEL)
                    ids = array("I", [t.id for t in tokenize("\u0120" + level)]).tobytes()
                    if len(word) <= LONGEST:
                        known[word] = ids
                if marks:
                    ids += short.get(marks) or self._remembered(marks)
                if below:
                    ids += self._remembered("\n") + self._bpe(below)
                    if more:
                        ids += self._remembered(more)
                elif marks and len(piece) <= LONGEST:
                    known[piece] = ids
                found[i] = ids
            elif piece and not piece[0].isspace() and not piece[-1].isspace():
                hard.append(i)
        rest = list(dict.fromkeys(pieces[i] for i in hard))
        if rest:
            full = dict(zip(rest, self._encoded([" " + p for p in rest])))
            for i in hard:
                found[i] = full[pieces[i]]
            known.update((p, f) for p, f in full.items() if len(p) <= LONGEST)
        return found

    def _bpe(self, word: str) -> bytes:
        """Ids of a word, or of characters in byte-level form already, by the model alone."""
        level = word if word.isascii() or word == "\u010a" else word.translate(_BYTE_LEVEL)
        return array("I", [t.id for t in self.model.tokenize(level)]).tobytes()

    def _remembered(self, marks: str) -> bytes:
        if len(marks) > 4:
            return self._bpe(marks)
        if marks not in self.short:
            self.short[marks] = self._bpe("\u010a" if marks == "\n" else marks)
        return self.short[marks]

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start = 0
        while start < len(pieces):
            stop, size = start, 0
            while stop < len(pieces) and (size < 1 << 16 or stop == start):
                size += len(pieces[stop])
                stop += 1
            joined = self.between.join(pieces[start:stop])
            ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(ids == self.between_id)
            data, begin = ids.tobytes(), 0
            for cut in [*cuts.tolist(), len(ids)]:
                out.append(data[4 * begin : 4 * cut])
                begin = cut + 1
            start = stop
        return out


def _strings(column: pa.Array) -> list[str]:
    """As ``to_pylist``, several times faster."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _byte_level(file: str) -> bool:
    """Whether a tokenizer cuts texts the way that ``Encoder`` relies on."""
    parts = json.loads(file)
    cut, model = parts["pre_tokenizer"] or {}, parts["model"]
    plain = ("continuing_subword_prefix", "end_of_word_suffix", "unk_token", "dropout")
    return (
        parts["normalizer"] is None
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex") is True
        and cut.get("add_prefix_space") is False
        and model["type"] == "BPE"
        and not any(model.get(p) for p in plain)
        and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in parts["added_tokens"])
    )


_CUT = re.compile(r"(?<=\S) (?=\S)")
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-/:-@\[-`{-~"
#: A word with punctuation after it, perhaps followed by a line end and another such word.
_WORDS = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)(?:\n([{_LETTERS}]+)([{_MARKS}]*))?")
#: Byte-level BPE writes bytes 0xA1 to 0xAC and 0xAE to 0xFF as themselves and the other bytes
#: that are not printable ASCII as U+0100 on, in order.
_OTHER = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_CHARACTER = {b: chr(256 + _OTHER.index(b)) if b in _OTHER else chr(b) for b in range(256)}
_BYTE_LEVEL = {
    code: "".join(_CHARACTER[b] for b in chr(code).encode()) for code in range(0xC0, 0x250)
}


def pieces_of(text: str) -> list[str]:
    """Cut at every single space between two characters that are not white space."""
    return _CUT.split(text)


@lru_cache
def vocabulary_size(path: str) -> int:
    """One more than the greatest id."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0) + 1


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = True) -> Encoder:
    """One encoder a worker process, which outlives tasks."""
    key = path, special_as_text
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def id_ranges(docs: DataFrame, id_col: str, parts: int, drawn: int = 16) -> list[tuple]:
    """Where the ranges after the first begin, as ``(known, id, hash)`` in ascending order.

    About ``drawn`` ids a range are drawn by a hash, so the driver holds some ``parts * drawn``
    of them, and no text is read.  An id that fills several ranges has them cut by equal shares
    of the hash of the text.
    """
    fine = 1 << 40
    share = min(fine, -(-parts * drawn * fine // max(1, docs.count())))
    seeded = F.xxhash64(F.lit(17), id_col, F.monotonically_increasing_id())
    rows = docs.select(F.col(id_col).alias("id"), F.pmod(seeded, F.lit(fine)).alias("h"))
    rows = rows.where(F.col("h") < share).select("id").collect()
    ids = sorted((r["id"] is not None, r["id"]) if r["id"] is not None else (False,) for r in rows)
    cuts = [ids[len(ids) * k // parts] for k in range(1, parts)] if ids else []
    out = []
    for key, same in groupby(cuts):
        n = len(list(same))
        whole = key if key[0] else (False, None)
        # One cut begins with the id; more share out the id's own rows.
        out += [(*whole, (1 << 64) * k // n - (1 << 63)) for k in range(n)]
    return out


def _part_of(known: bool, id_: object, hash_: int, cuts: list[tuple]) -> int:
    """The range of a row: how many cuts are not beyond it."""
    low, high = 0, len(cuts)
    while low < high:
        middle = (low + high) // 2
        if _beyond(cuts[middle], known, id_, hash_):
            high = middle
        else:
            low = middle + 1
    return low


def _beyond(cut: tuple, known: bool, id_: object, hash_: int) -> bool:
    if cut[0] != known:
        return cut[0]
    if known and cut[1] != id_:
        return cut[1] > id_
    return cut[2] > hash_


def write_segments(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_as_text: bool = True,
) -> None:
    """Tokenize and write segments under ``path`` in ascending order of the id.

    Texts are tokenized where they are read; their ids, not the texts, are dealt to ranges of
    the id, sorted and written.  Null ids come first; rows of the same id follow a hash of their
    texts, then their ids' bytes.  A null text is an empty one: its end id alone.  A segment's
    row has the range of ids (``part``) it belongs to and the position of its first token in
    that range, its documents' ids and the bytes; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = spark.sparkContext.broadcast(id_ranges(docs, id_col, parts))
    narrow = np.dtype("<u2" if vocabulary_size(tokenizer) <= 1 << 16 else "<u4")

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special_as_text)
        for batch in batches:
            sizes = pc.binary_length(batch.column("text").cast(pa.large_binary())).fill_null(0)
            for start, stop in steps(sizes.to_numpy(zero_copy_only=False), STEP):
                part = batch.slice(start, stop - start)
                ids, counts = encode.batch(part.column("text"))
                where = [
                    _part_of(i is not None, i, h, cuts.value)
                    for i, h in zip(part.column("id").to_pylist(), part.column("hash").to_pylist())
                ]
                ends = (np.cumsum(np.r_[0, counts]) * narrow.itemsize).astype("<i4")
                body = pa.Array.from_buffers(
                    pa.binary(), len(counts),
                    [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(narrow))],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("hash"), pa.array(where, pa.int32()), body],
                    names=["id", "hash", "part", "ids"],
                )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        part, start, size = None, 0, 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("ids")).to_numpy() // narrow.itemsize
            own = batch.column("part").to_numpy()
            at = 0
            while at < len(own):
                if held and (own[at] != part or size >= SEGMENT):
                    yield _segment(held, part, start, narrow)
                    start = start + size if own[at] == part else 0
                    held, size = [], 0
                part = int(own[at])
                # Documents up to the one that fills the segment, within the range of ids.
                same = int(np.searchsorted(own[at:], part, "right"))
                full = int(np.searchsorted(np.cumsum(lengths[at : at + same]), SEGMENT - size)) + 1
                stop = at + min(same, full)
                held.append(batch.slice(at, stop - at))
                size += int(lengths[at:stop].sum())
                at = stop
        if held:
            yield _segment(held, part, start, narrow)

    read = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("hash"),
        F.col(text_col).alias("text"),
    )
    dealt = read.mapInArrow(tokenized, f"id {id_type}, hash bigint, part int, ids binary")
    (
        dealt.repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", F.asc_nulls_first("id"), "hash", "ids")
        .select("id", "part", "ids")
        .mapInArrow(
            segments, f"part int, start bigint, n_ids bigint, ids array<{id_type}>, body binary"
        )
        .write.parquet(path)
    )


def _segment(
    held: list[pa.RecordBatch], part: int, start: int, narrow: np.dtype
) -> pa.RecordBatch:
    bodies = [b.column("ids") for b in held]
    lengths = np.concatenate([pc.binary_length(b).to_numpy() for b in bodies]) // narrow.itemsize
    ids = np.concatenate([_numbers(b, narrow) for b in bodies]).astype("<u4")
    names = pa.concat_arrays([b.column("id") for b in held])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([start], pa.int64()),
            pa.array([len(ids)], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
            pa.array([encode_segment(ids, lengths)], pa.binary()),
        ],
        names=["part", "start", "n_ids", "ids", "body"],
    )


def _numbers(column: pa.Array, narrow: np.dtype) -> np.ndarray:
    """What a binary column holds, end to end, as numbers."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, "<i4")[column.offset : column.offset + len(column) + 1]
    first, size = int(ends[0]), int(ends[-1] - ends[0])
    return np.frombuffer(data, narrow, size // narrow.itemsize, first) if size else np.empty(0, narrow)


def read_segments(spark, path: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """Per document from the segments: id, ``start``, ``n_tokens`` and ``ids_crc32``.

    Ranges are shifted by the tokens of the ranges before them, one row per task that wrote.
    """
    table = spark.read.parquet(path)
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bodies = zip(batch.column("start").to_pylist(), batch.column("body"))
            for k, (start, body) in enumerate(bodies):
                segment = Segment(body.as_buffer())
                crcs = [zlib.crc32(d.tobytes()) for d in segment.documents()]
                starts = start + np.cumsum(segment.lengths) - segment.lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        lists[k].values,
                        pa.array(starts, pa.int64()),
                        pa.array(segment.lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        table.join(F.broadcast(shift), "part")
        .select("ids", (F.col("start") + F.col("shift")).alias("start"), "body")
        .mapInArrow(read, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
        .withColumnRenamed("id", id_col)
    )


def token_output(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_as_text: bool = True,
) -> DataFrame:
    """Write the segments to a fresh shared folder and return what they hold, read back."""
    spark = docs.sparkSession
    path = shared_folder(spark, "token-segments")
    write_segments(
        docs, path, tokenizer, id_col=id_col, text_col=text_col, special_as_text=special_as_text
    )
    return read_segments(spark, path, docs.schema[id_col].dataType.simpleString(), id_col)
