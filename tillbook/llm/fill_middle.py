"""Fill-in-the-middle texts, one pyarrow.compute pipeline a batch.

A text is cut into units, a word with the white space before it each (white space at the end is
a unit too).  Two draws cut the units into prefix, middle and suffix.  A batch of texts becomes
one list array of units, which is flattened with the index of the text that each unit is from;
a unit's ordinal in its text gives its role; per role the units are filtered, made lists again
and joined.  No step looks at a single row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import steps

#: Text of one step of the pipeline, unless a single text is longer: bounds what a task holds.
STEP = 4 << 20
#: Ends a unit while a batch is cut; UTF-8 has no such byte.
_END = b"\xff"
_DRAWS = ("h1", "h2", "h3", "h4")
_RAW = pa.large_binary()


@dataclass(frozen=True)
class Middle:
    """Parameters; the defaults are those of the registered query."""

    seed: int = 42
    #: Percent of texts left as they are, and of the others those in ``spm`` form.
    plain: int = 50
    spm: int = 80
    #: Marks before prefix, suffix and middle.  A text with one of them stays plain.
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")


def draws(id_: Column, seed: int) -> dict[str, Column]:
    """Four 32-bit numbers from the SHA-256 of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return {
        name: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
        for k, name in enumerate(_DRAWS)
    }


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The units of all texts end to end, and for each the index of its text."""
    ended = pc.replace_substring_regex(
        texts, pattern=rb"[^\x20\x09-\x0D]+", replacement=rb"\0" + _END
    )
    lists = pc.split_pattern(ended, pattern=_END)
    unit, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # After a last word, and in an empty text, the cut leaves an empty piece.
    real = pc.greater(pc.binary_length(unit), 0)
    return unit.filter(real), parent.filter(real)


def rearranged(texts: pa.Array, drawn: list[pa.Array], how: Middle) -> dict[str, pa.Array]:
    """Columns ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of the texts."""
    unit, parent = units(texts)
    count = np.bincount(parent.to_numpy(), minlength=len(texts))
    n, first = pa.array(count, pa.int64()), pa.array(np.cumsum(count) - count, pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(unit)), pa.int64()), first.take(parent))

    h1, h2, h3, h4 = drawn
    one, two = _modulo(h1, pc.add(n, 1)), _modulo(h2, pc.add(n, 1))
    low = pc.min_element_wise(one, two).take(parent)
    high = pc.max_element_wise(one, two).take(parent)
    before, after = pc.less(ordinal, low), pc.greater_equal(ordinal, high)
    roles = before, after, pc.invert(pc.or_(before, after))
    prefix, suffix, middle = (
        _joined(unit.filter(role), parent.filter(role), len(texts)) for role in roles
    )

    plain = pc.or_(pc.equal(pc.binary_length(texts), 0), pc.greater_equal(_modulo(h3, 100), how.plain))
    for mark in how.marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark.encode()))
    spm = pc.less(_modulo(h4, 100), how.spm)
    p, s, m, no = (pa.scalar(v.encode(), _RAW) for v in (*how.marks, ""))
    output = pc.if_else(
        spm,
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, no),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, no),
    )
    nothing = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, nothing, _characters(prefix)),
        "middle_chars": pc.if_else(plain, nothing, _characters(middle)),
        "output": _text(pc.if_else(plain, texts, output)),
    }


def _joined(unit: pa.Array, parent: pa.Array, rows: int) -> pa.Array:
    """The units of one role as one piece a text, empty where there is none."""
    ends = np.cumsum(np.bincount(parent.to_numpy(), minlength=rows))
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), unit)
    return pc.binary_join(lists, pa.scalar(b"", _RAW))


def _modulo(number: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, by), by))


def _text(raw: pa.Array) -> pa.Array:
    return raw.cast(pa.string(), safe=False)


def _characters(raw: pa.Array) -> pa.Array:
    return pc.utf8_length(_text(raw)).cast(pa.int64())


def fill_in_middle(
    docs: DataFrame,
    how: Middle = Middle(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, units ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle);
    plain texts have null lengths.  What a document becomes depends on its id, its text and the
    seed alone, so nothing is shuffled and repeated rows agree.  A null text is an empty one and
    plain; a null id is drawn for like an empty one.  A text of any length is one row of one
    step.  An empty table gives none; columns other than the two named are not read.
    """
    id_field = docs.schema[id_col]
    read = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"),
        *[h.alias(name) for name, h in draws(F.col(id_col), how.seed).items()],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").cast(_RAW)
            for start, stop in steps(pc.binary_length(raw).to_numpy(), STEP):
                part = batch.slice(start, stop - start)
                texts = raw.slice(start, stop - start)
                out = rearranged(texts, [part.column(h) for h in _DRAWS], how)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *out.values()], names=["id", *out]
                )

    made = read.mapInArrow(
        run,
        f"id {id_field.dataType.simpleString()}, n bigint, form string, "
        "prefix_chars bigint, middle_chars bigint, output string",
    )
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = Middle().marks) -> Column:
    """The text that an output was made from, by the output and its form alone.

    No piece holds a mark, and a mark cannot begin inside another one, so each occurs once.
    """
    p, s, m = marks

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), second, 1)

    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
