"""Fill-in-the-middle transformation: texts cut at two places by units, their parts put in another order between marks.

Where a cut lies in bytes is found by a run-length encoding. A text's bytes are maximal runs of one class, and each run
keeps the number of units before it; the run that holds a cut is found by binary search, and its place in the run by
arithmetic. For code points the classes are the widths of their UTF-8 forms: the k-th code point of a run of width w is
w * k bytes from its start. For words (blank bytes close them) the classes are blank and not blank, and a run that is not
blank is one unit, with the blanks after it.

A text of more than BLOCK bytes is encoded in blocks one after the other, and only the blocks with a cut are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes whose classes are held at once.
BLOCK = 1_000_000
#: The bytes of a code point, by its first byte; other bytes of a code point have none.
_WIDTH = np.array([1 if b < 0x80 else 0 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)], np.uint8)
#: Class 1: blank bytes.
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)]).astype(np.uint8)


def width_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Runs of code points of one width: (first byte, units before, width) of each, and all units. data begins with a code
    point; one that it cuts off counts."""
    width = _WIDTH[data]
    first = np.flatnonzero(width)
    kind = width[first]
    begin = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(first) else first
    return first[begin], begin, kind[begin].astype(np.int64), len(first)


def char_bytes(data: np.ndarray, cuts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The byte offsets of ascending cuts given in code points, none beyond the end."""
    out, units = np.full(len(cuts), len(data), np.int64), 0
    for at in range(0, len(data), block):
        part = data[at : at + block]
        lead = int(np.argmax(_WIDTH[part[:4]] > 0)) if len(part) else 0  # bytes of a code point that began in the block before
        begin, before, width, n = width_runs(part[lead:])
        here = np.flatnonzero((cuts >= units) & (cuts < units + n))
        run = np.searchsorted(before, cuts[here] - units, "right") - 1
        out[here] = at + lead + begin[run] + (cuts[here] - units - before[run]) * width[run]
        units += n
    return out


def word_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of blank and other bytes: (first byte, words begun before) of each."""
    kind = _BLANK[data]
    begin = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(data) else np.empty(0, np.int64)
    word = kind[begin] == 0
    return begin, np.cumsum(word) - word


def word_bytes(data: np.ndarray, cuts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The byte offsets of ascending cuts given in words: where the word of that number begins, or the end. Cut 0 is the
    start of the text, so blanks before the first word go with it."""
    out, units, open_word = np.full(len(cuts), len(data), np.int64), 0, False
    for at in range(0, len(data), block):
        part = data[at : at + block]
        begin, before = word_runs(part)
        is_word = _BLANK[part[begin]] == 0
        if open_word and is_word[0]:  # the block before ended within this word
            before, is_word[0] = np.maximum(before - 1, 0), False
        first, number = begin[is_word], before[is_word]
        here = np.flatnonzero((cuts >= units) & (cuts < units + len(first)))
        out[here] = at + first[np.searchsorted(number, cuts[here] - units, "left")]
        units += len(first)
        open_word = bool(_BLANK[part[-1]] == 0)
    out[cuts == 0] = 0
    return out


def count_words(data: np.ndarray, block: int = BLOCK) -> int:
    total, open_word = 0, False
    for at in range(0, len(data), block):
        word = _BLANK[data[at : at + block]] == 0
        total += int(np.count_nonzero(word[1:] & ~word[:-1])) + int(word[0] and not open_word)
        open_word = bool(word[-1])
    return total


UNITS = {"chars": char_bytes, "words": word_bytes}


def arranged(text: str, lo: int, hi: int, form: str, unit: str) -> tuple[str, int, int]:
    """The output of a text cut at units lo and hi, and the code points of prefix and middle."""
    data = text.encode("utf-8", "surrogatepass")
    a, b = UNITS[unit](np.frombuffer(data, np.uint8), np.array([lo, hi])).tolist()
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass") for part in (data[:a], data[a:b], data[b:]))
    p, s, m = MARKS
    out = [s, suffix, p, prefix, m, middle] if form == "spm" else [p, prefix, s, suffix, m, middle]
    return "".join(out), len(prefix), len(middle)


def restored(output: Column, form: Column) -> Column:
    """The text that fill_middle made an output of. No text with a mark in it was cut, and no mark can arise where parts
    meet marks (a mark's first and last characters differ), so the marks part the output without doubt."""
    part = F.split(output, "|".join(MARKS))
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle(docs: DataFrame, percent: int = 90, spm_percent: int = 20, seed: int = 1, unit: str = "chars", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with columns n, form, output, prefix_chars and middle_chars, which replace those of these names.

    n is the number of a text's units, code points ("chars") or words ("words"). Four 32-bit numbers are taken from the
    SHA-256 of `seed:id`. The first two modulo n + 1 are the cuts, in ascending order. form is plain where the text is null,
    empty or holds a mark, or the third number modulo 100 reaches `percent`; else spm (suffix first) where the fourth modulo
    100 is below `spm_percent`, else psm. A plain output is the text (null: empty), without prefix_chars and middle_chars.
    Rows without an id are plain. Repeated rows are cut alike; equal texts of other ids are not. All other columns pass
    through as they are; empty docs give an empty table.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)
    text = F.coalesce(F.col(text_col), F.lit(""))

    @F.pandas_udf("long")
    def words(texts: pd.Series) -> pd.Series:
        return pd.Series([count_words(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)) for t in texts], dtype="int64")

    @F.pandas_udf("output string, prefix_chars long, middle_chars long")
    def cut(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, lo, hi, form in parts:
            rows = [(t, None, None) if f == "plain" else arranged(t, int(a), int(b), f, unit) for t, a, b, f in zip(texts, lo, hi, form, strict=True)]
            yield pd.DataFrame({"output": [r[0] for r in rows], **{c: pd.array([r[k] for r in rows], "Int64") for k, c in ((1, "prefix_chars"), (2, "middle_chars"))}})

    if unit not in UNITS:
        raise ValueError(f"units are {', '.join(UNITS)}")
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    mine = {"n", "form", "output", "prefix_chars", "middle_chars"}
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c not in mine]).alias("row"), text.alias("text"), (F.length(text).cast("long") if unit == "chars" else words(text)).alias("n"), *[x.alias(f"h{i}") for i, x in enumerate(h)])
    plain = F.col("h0").isNull() | (F.col("text") == "")
    for mark in MARKS:
        plain = plain | F.contains(F.col("text"), F.lit(mark))
    a, b = F.col("h0") % (F.col("n") + 1), F.col("h1") % (F.col("n") + 1)
    form = F.when(plain | (F.col("h2") % 100 >= percent), "plain").when(F.col("h3") % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("row", "text", "n", F.coalesce(F.least(a, b), F.lit(0)).alias("lo"), F.coalesce(F.greatest(a, b), F.lit(0)).alias("hi"), form.alias("form"))
    rows = rows.select("row", "n", "form", cut("text", "lo", "hi", "form").alias("made"))
    return rows.select("row.*", "n", "form", "made.output", "made.prefix_chars", "made.middle_chars")
