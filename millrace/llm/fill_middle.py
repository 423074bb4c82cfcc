"""Fill-in-middle: texts cut in three at token borders, and put together in another order.

Tokens are runs of ASCII letters and single other characters. The UTF-8 of a slice of texts is viewed
as 64-bit words; arithmetic on whole words marks each byte that ends a token, the marks of each word
are counted, and the k-th mark is found by a search in the running counts and a select within the word.
"""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many stay plain; of a hundred others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SEED = 1
#: Bytes of texts that are viewed as one array of words.
SLICE_BYTES = 4 << 20


def _each(byte: int):
    """A word with this byte at all eight places."""
    import numpy as np

    return np.uint64(byte * 0x0101010101010101)


class Marks:
    """A mark at the top bit of some bytes of an array of words, with rank and select."""

    def __init__(self, words):
        import numpy as np

        self.words = words
        self.upto = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def rank(self, at):
        """How many marks stand before each byte ``at``."""
        import numpy as np

        below = (np.uint64(1) << (np.uint64(8) * (at & 7).astype(np.uint64))) - np.uint64(1)
        return self.upto[at >> 3] + np.bitwise_count(self.words[at >> 3] & below)

    def select(self, nth):
        """The byte of the mark with each number, from 0."""
        import numpy as np

        word = np.searchsorted(self.upto, nth, "right") - 1
        wanted = (nth - self.upto[word] + 1).astype(np.uint64)
        # Byte i of the product counts the marks of bytes 0 to i; it is large enough from the wanted one on.
        counts = (self.words[word] >> np.uint64(7)) * _each(0x01)
        enough = ((counts | _each(0x80)) - wanted * _each(0x01)) & _each(0x80)
        return 8 * word + 8 - np.bitwise_count(enough)


def unit_marks(joined: bytes) -> tuple[Marks, Marks]:
    """Marks of the bytes that end a token, and of those that start a character."""
    import numpy as np

    x = np.frombuffer(joined + bytes(16 - len(joined) % 8), "<u8")
    high, low = _each(0x80), _each(0x7F)

    def following(marks):
        """The mark of the byte after each."""
        return (marks >> np.uint64(8)) | (np.append(marks[1:], np.uint64(0)) << np.uint64(56))

    inner = x & ~(x << np.uint64(1)) & high  # 10xxxxxx: not the first byte of a character
    folded = (x | _each(0x20)) & low
    letter = (folded + _each(0x80 - ord("a"))) & ~(folded + _each(0x80 - ord("z") - 1)) & ~x & high
    ends = high & ~following(inner) & ~(letter & following(letter))
    return Marks(ends), Marks(high & ~inner)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 that depend on the id alone; a null id counts as an empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    return struct.unpack(">4I", hashlib.sha256(name.encode()).digest()[:16])


def _batches(seed: int, plain: int, suffix_first: int):
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            all_ids, all_raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, stop in slices(all_raws, SLICE_BYTES):
                ids, raws = all_ids[first:stop], all_raws[first:stop]
                # The line break after each text is no letter, so no token goes on into the next.
                ends, chars = unit_marks(b"".join(x for raw in raws for x in (raw, b"\n")))
                size = np.fromiter(map(len, raws), np.int64, len(raws))
                start = np.cumsum(size + 1) - size - 1
                before = ends.rank(start)
                n = ends.rank(start + size) - before
                h = np.array([draws(d, seed) for d in ids], np.int64).reshape(-1, 4)

                def border(units):
                    return np.where(units > 0, ends.select(before + np.maximum(units, 1) - 1) + 1, start)

                one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
                a, b = border(np.minimum(one, two)), border(np.maximum(one, two))
                c0, c1, c2 = chars.rank(start), chars.rank(a), chars.rank(b)
                forms, outputs, plainly = [], [], []
                for k, raw in enumerate(raws):
                    i, j = int(a[k] - start[k]), int(b[k] - start[k])
                    alone = not raw or h[k, 2] % 100 >= 100 - plain or any(m in raw for m in marks)
                    plainly.append(alone)
                    if alone:
                        forms.append("plain")
                        outputs.append(raw)
                    elif h[k, 3] % 100 < suffix_first:
                        forms.append("spm")
                        outputs.append(b"".join((marks[1], raw[j:], marks[0], raw[:i], marks[2], raw[i:j])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((marks[0], raw[:i], marks[1], raw[j:], marks[2], raw[i:j])))
                none = np.array(plainly, bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                    pa.array(c1 - c0, pa.int64(), mask=none), pa.array(c2 - c1, pa.int64(), mask=none),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_middle(docs: DataFrame, seed: int = SEED, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every row.

    The borders are two numbers of tokens drawn by the id; form is ``plain`` (the text itself, the two
    counts null), ``psm`` or ``spm``. Empty texts, null texts (taken as empty) and texts that hold one
    of the three marks are plain. Null ids are drawn like an id without digits. Repeated rows each get
    their row, rows of one id the same draws; an empty table gives none; other columns are not looked at.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    return slim.mapInArrow(
        _batches(seed, plain, suffix_first), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. A text with a mark in it is plain, so each mark stands once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
