"""Token ids of whole texts, in tasks: each distinct stretch of a text is encoded once per worker."""

from __future__ import annotations

import os
import re
from array import array
from itertools import accumulate, chain, repeat

#: Distinct stretches a worker remembers unless told otherwise; beyond, it starts anew.
REMEMBERED = 1_500_000
#: Texts of about this many bytes are worked on at a time.
SLICE_BYTES = 4_000_000
END = 0
#: Marks that close a stretch.
MARKS = ".,;:!?"

_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    """The path of the byte-level BPE vocabulary among the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, remembered: int = REMEMBERED) -> "Encoder":
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].remembered = remembered
    return _ENCODERS[path]


class Encoder:
    """Ids with ``END`` appended to each text.

    The vocabulary's rule for splitting a text before it is encoded always cuts before white space
    that follows another character, and around a line break that stands alone. So texts are cut
    there, and each distinct stretch is given to the tokenizer once. A single mark that closes a
    stretch behind a letter or digit is a piece of its own by that rule, and is left away before.
    Texts where two characters of white space meet are encoded whole.
    """

    _white = re.compile(r"\s")
    _meeting = re.compile(r"\s\s")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_file(path), REMEMBERED
        names = self.tokenizer.get_vocab()
        # Ids whose text starts with a space, and that of a line break, as byte-level names spell them.
        self.opens = np.zeros(max(names.values()) + 1, bool)
        self.opens[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self.line_break = names["\u010a"]
        self.closing = np.array([0, *(names[m] for m in MARKS)], np.uint32)
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.flat, self.starts = array("I"), array("q", [0])
        # Of each stretch, whether white space meets in it (1), and whether it ends with some (2).
        self.blanks = bytearray()

    def encode(self, texts):
        """Ids of all texts in a row (uint32) and the number of each text's ids; texts are an Arrow array or a list."""
        import numpy as np
        import pyarrow as pa

        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if len(self.known) > self.remembered:
            self._forget()
        at, mark, bounds = self._stretches(texts)
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.uint32)
        first = starts[at]
        size = starts[at + 1] - first + (mark > 0)
        ends = np.cumsum(size)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(first - (ends - size), size)
        ids = flat.take(places, mode="clip") if len(flat) else np.empty(len(places), np.uint32)
        blanks = np.frombuffer(self.blanks, np.uint8)[at]
        del starts, flat
        marked = np.flatnonzero(mark)
        ids[ends[marked] - 1] = self.closing[mark[marked]]
        # White space at the end of a text meets no other.
        blanks[bounds[1:][np.diff(bounds) > 0] - 1] &= 1
        whole = set((np.searchsorted(bounds, np.flatnonzero(blanks), "right") - 1).tolist())
        whole.update(np.flatnonzero(np.diff(bounds) == 0).tolist())
        upto = np.concatenate(([0], ends))[bounds].tolist()
        out, lengths = [], np.empty(len(texts), np.int64)
        end = np.array([END], np.uint32)
        for k in range(len(texts)):
            if k in whole:
                own = np.array(self.tokenizer.encode_batch_fast([texts[k].as_py()], add_special_tokens=False)[0].ids, np.uint32)
            else:
                own = ids[upto[k] : upto[k + 1]]
            out += [own, end]
            lengths[k] = len(own) + 1
        return (np.concatenate(out) if out else np.empty(0, np.uint32)), lengths

    def _stretches(self, texts):
        """The numbers of all texts' stretches in a row, the marks that close them, and where those of each text start.

        A text that shows itself that it is to be encoded whole has none.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # Stretches without a space before them begin with \0, which must not be in the text either.
        texts = texts.fill_null("")
        apart = [pc.match_substring(texts, odd) for odd in ("\0", "\n\n", "\n ")]
        mark, none = pa.scalar("\0", pa.large_string()), pa.scalar("", pa.large_string())
        begun = pc.if_else(pc.or_(pc.or_(*apart[:2]), apart[2]), pa.scalar(None, pa.large_string()), pc.binary_join_element_wise(mark, texts, none))
        cut = pc.split_pattern(pc.replace_substring(begun, "\n", " \0\n \0"), " ")
        coded = cut.values.dictionary_encode()
        closed, mark = self._closed(coded.dictionary)
        open_ = coded.dictionary.filter(pa.array(~closed))
        cores = pa.concat_arrays([open_, pc.ascii_rtrim(coded.dictionary.filter(pa.array(closed)), MARKS)]).dictionary_encode()
        # Only the distinct ones of these texts become strings here.
        names = cores.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            unknown = [names[k] for k in missing]
            self._learn(unknown)
            at[missing] = np.fromiter(map(self.known.__getitem__, unknown), np.int64, len(unknown))
        core = np.empty(len(closed), np.int64)
        core[np.concatenate((np.flatnonzero(~closed), np.flatnonzero(closed)))] = at[cores.indices.to_numpy()]
        which = coded.indices.to_numpy()
        return core[which], mark[which], cut.offsets.to_numpy().astype(np.int64)

    @staticmethod
    def _closed(names):
        """Of each name, whether one of ``MARKS`` follows a letter or digit (ASCII or Latin-1) at its end, and which, from 1."""
        import numpy as np

        bounds = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
        raw = np.concatenate((np.zeros(3, np.uint8), np.frombuffer(names.buffers()[2] or b"", np.uint8)))
        which, plain = np.zeros(256, np.uint8), np.zeros(256, bool)
        which[list(MARKS.encode())] = np.arange(1, len(MARKS) + 1)
        plain[[c for c in range(128) if chr(c).isalnum()]] = True
        size, ends = np.diff(bounds), bounds[1:] + 3
        mark, before = which[raw[ends - 1]], raw[ends - 2]
        # \xC3 and another byte are a letter, but for two signs.
        latin = (size > 2) & (raw[ends - 3] == 0xC3) & (before != 0x97) & (before != 0xB7) & (before >= 0x80)
        closed = (mark > 0) & (size > 1) & (plain[before] | latin)
        return closed, mark * closed

    def _learn(self, marked: list[str]):
        """Give many stretches to the tokenizer as one text, at whose spaces or line breaks it cuts."""
        import numpy as np

        white = []
        if "" in marked or "\0" in marked or self._white.search("".join(marked)):
            white = [m for m in marked if not m or m == "\0" or self._white.search(m)]
            apart = set(white)
            marked = [m for m in marked if m not in apart]
        after_break = [m for m in marked if m[0] == "\0"]
        spaced = [m for m in marked if m[0] != "\0"]
        for names, between in ((spaced, " "), (after_break, "\n")):
            for at in range(0, len(names), 20_000):
                some = names[at : at + 20_000]
                joined = between + between.join(some).replace("\0", "")
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                cut = np.flatnonzero(self.opens[ids] if between == " " else ids == self.line_break)
                if len(cut) != len(some) or cut[0]:
                    self._learn_singly(some)
                elif between == " ":
                    self._add(some, ids, np.append(cut, len(ids)))
                else:
                    self._add(some, np.delete(ids, cut), np.append(cut, len(ids)) - np.arange(len(cut) + 1))
        self._learn_singly(white)

    def _learn_singly(self, marked: list[str]):
        import numpy as np

        if marked:
            texts = [m[1:] if m[:1] == "\0" else " " + m for m in marked]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self._add(marked, np.array(list(chain.from_iterable(found)), np.uint32), np.array([0, *accumulate(map(len, found))]))
            for k, (name, text) in enumerate(zip(marked, texts), len(self.blanks) - len(texts)):
                # What is around a line break was looked at in the text. A line break may stand before what is marked.
                if text != "\n":
                    before = "\n" if name[:1] == "\0" else ""
                    self.blanks[k] = bool(self._meeting.search(before + text)) + 2 * text[-1:].isspace()

    def _add(self, names: list[str], ids, bounds):
        """Remember the ids of stretches, which stand between the bounds."""
        before = len(self.starts) - 1
        self.flat.frombytes(ids.tobytes())
        self.starts.frombytes((bounds[1:] - bounds[0] + self.starts[-1]).astype("int64").tobytes())
        self.blanks += bytes(len(names))
        self.known.update(zip(names, range(before, before + len(names))))


def slices(texts, at_a_time: int = SLICE_BYTES):
    """Ranges of an Arrow array of texts of about ``at_a_time`` bytes."""
    import pyarrow.compute as pc

    first = size = 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= at_a_time:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)
