"""Fill-in-the-middle transformation: a constant-memory two-pass streaming matcher.

A text's units are the matches of a pattern, left to right. The first pass counts them; the second advances a lazy match iterator to the two
ranks at which the text is cut. Beside the text itself and its output nothing is held: no list of units, no list of places.

Ranks and form are drawn by four numbers of the SHA-256 of a seed and the row's id, so a run gives the same cuts again. A text that is empty or
holds one of the marks, or that its draw leaves alone, is output as it is (plain). Null texts count as empty, a null id as an empty string;
repeated ids stay rows of their own; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import deque
from itertools import count, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import byte_slices, free_names, unused

UNIT = r"[A-Za-z]+|[^A-Za-z]"
#: Before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


def n_units(unit: re.Pattern, text: str) -> int:
    """First pass: the matches, counted one by one."""
    counter = count()
    deque(zip(unit.finditer(text), counter, strict=False), maxlen=0)
    return next(counter)


def places(unit: re.Pattern, text: str, low: int, high: int) -> tuple[int, int]:
    """Second pass: where the match of rank low and that of rank high (counted from 1, low <= high) end; 0 for rank 0."""
    matches = unit.finditer(text)
    first = next(islice(matches, low - 1, None)).end() if low else 0
    return first, next(islice(matches, high - low - 1, None)).end() if high > low else first


def transform(unit: re.Pattern, text: str, digest: str, plain_from: int, spm_below: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle, and output of one text whose draw is the hex digest."""
    n = n_units(unit, text)
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or h3 % 100 >= plain_from or any(m in text for m in MARKS):
        return n, PLAIN, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = places(unit, text, low, high)
    p, s, m = MARKS
    if h4 % 100 < spm_below:
        return n, SPM, a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, PSM, a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def fill_in_middle(
    docs: DataFrame, seed: int | str = 1, unit: str = UNIT, plain_from: int = 90, spm_below: int = 20, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 2_000_000
) -> DataFrame:
    """keep columns, n, form, prefix_chars, middle_chars (null if plain) and output of every row; the pattern has to match at every character.

    Of 100 texts those drawn at plain_from or above stay plain, and of the others those drawn under spm_below have their suffix first.
    """
    names = free_names(keep, "n", "form", "prefix_chars", "middle_chars", "output")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    told = docs.select(*keep, draw.alias(unused(docs, "draw")), F.coalesce(F.col(text_col), F.lit("")).alias(unused(docs, "text_to_cut")))
    kinds = ("long", "string", "long", "long", "string")
    out = docs.select(*keep, *(F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds, strict=True))).schema
    n_keep = len(keep)

    def run(batches):
        pattern = re.compile(unit)
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            for part in byte_slices(batch, n_keep + 1, slice_bytes):
                rows = [transform(pattern, t.as_py(), d.as_py(), plain_from, spm_below) for d, t in zip(part.column(n_keep), part.column(n_keep + 1), strict=True)]
                made = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_keep)), *made], names=[*keep, *names])

    return told.mapInArrow(run, out)


def restored(output: Column, form: Column) -> Column:
    """The text of an output. No part of it holds a mark, and none can arise where a part meets a mark, so cutting at the marks gives the parts."""
    parts = F.split(output, "|".join(map(re.escape, MARKS)), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == PLAIN, output).when(form == SPM, spm).otherwise(psm)
