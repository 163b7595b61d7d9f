"""Token ids of whole texts by the public tokenizers, each distinct word encoded once.

Both vocabularies cut a text into pieces before they merge, and no piece spans the edge of a
word: the ids of a text are those of its words, one after the other. Words recur, so a worker
keeps the ids of those it has met, up to ``CACHE_WORDS``, in a few flat arrays. Words are told
apart by two independent hashes of 64 bits, and all is looked up and put together in numpy.
Where white space is irregular the byte vocabulary's pieces depend on what surrounds them, and
the text is encoded as a whole. So it is where it may hold the string of a special token.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from functools import cache

import numpy as np

from typeferry.llm.common import kept_by_worker
from typeferry.llm.words import span_sums

CACHE_WORDS = 500_000  # some 30 bytes each
BATCH_BYTES = 450_000  # of texts whose words are looked up together
JOINED = 2_000  # new words encoded in one call


def regular(text: str) -> bool:
    """Whether all white space is single spaces and line breaks between two words."""
    if text[0] in " \n" or text[-1] in " \n":
        return False
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    flat = text.replace("\n", " ")  # other white space is not printable
    return flat.isprintable() or flat.split(" ") == flat.split()


@dataclass(frozen=True)
class Cut:
    """How a vocabulary's texts are cut: whether a word takes along the space or line break
    before it, and a string that can stand between words and has one id."""

    takes: bool
    between: str


CUTS = {"word_bpe_49k.json": Cut(False, " \x01 "), "byte_bpe_50k.json": Cut(True, "\n")}


class WordIds:
    """The ids of known words, by hash.

    Two tables sorted by hash, a large one and one of recent words that is merged into it
    when it has grown; and the ids of all, one after the other.
    """

    FIELDS = (("one", np.uint64), ("two", np.uint64), ("start", np.int64), ("length", np.int32),
              ("used", np.int32))

    def __init__(self, dtype: np.dtype):
        self.large, self.recent = self._empty(), self._empty()
        self.ids = np.empty(1 << 10, dtype)
        self.size = 0  # of ids that are filled

    def _empty(self) -> dict[str, np.ndarray]:
        return {name: np.empty(0, kind) for name, kind in self.FIELDS}

    def __len__(self) -> int:
        return len(self.large["one"]) + len(self.recent["one"])

    def find(self, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of the ids of each hash, -1 where it is not known, and the
        second hash."""
        start, length = np.full(len(one), -1), np.zeros(len(one), np.int32)
        two = np.zeros(len(one), np.uint64)
        for table in (self.large, self.recent):
            if len(table["one"]):
                at = np.minimum(np.searchsorted(table["one"], one), len(table["one"]) - 1)
                hit = table["one"][at] == one
                own = at[hit]
                start[hit], length[hit] = table["start"][own], table["length"][own]
                two[hit] = table["two"][own]
                table["used"][own] += 1
        return start, length, two

    def add(
        self, one: np.ndarray, two: np.ndarray, found: list[np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """New words, sorted by hash, with their ids; start and length of each."""
        length = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.concatenate([*found, np.empty(0, self.ids.dtype)])
        if self.size + len(flat) > len(self.ids):
            room = np.empty(2 * (self.size + len(flat)), self.ids.dtype)
            room[: self.size] = self.ids[: self.size]
            self.ids = room
        self.ids[self.size : self.size + len(flat)] = flat
        start = self.size + np.cumsum(length, dtype=np.int64) - length
        self.size += len(flat)
        new = {"one": one, "two": two, "start": start, "length": length,
               "used": np.ones(len(one), np.int32)}
        self.recent = self._merged(self.recent, new)
        return start, length

    def tidy(self) -> None:
        """Merges the tables, or lets go of the words used least, when they have grown."""
        if len(self.recent["one"]) > CACHE_WORDS // 16:
            self.large, self.recent = self._merged(self.large, self.recent), self._empty()
        if len(self) > CACHE_WORDS:
            table = self._merged(self.large, self.recent)
            most = np.argsort(-table["used"], kind="stable")[: CACHE_WORDS // 2]
            table = {name: values[np.sort(most)] for name, values in table.items()}
            self.ids = gathered(self.ids, table["start"], table["length"])
            self.size = len(self.ids)
            table["start"] = np.cumsum(table["length"], dtype=np.int64) - table["length"]
            table["used"] //= 2
            self.large, self.recent = table, self._empty()

    @staticmethod
    def _merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        order = np.argsort(np.concatenate([a["one"], b["one"]]), kind="stable")
        return {name: np.concatenate([a[name], b[name]])[order] for name in a}


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Spans of ``values``, one after the other."""
    upto = np.cumsum(lengths, dtype=np.int64)
    shift = np.repeat(starts - (upto - lengths), lengths)
    return values[shift + np.arange(len(shift))]


class Encoder:
    """Encodes texts to ids: ``numpy`` arrays of unsigned 16-bit integers, or 32-bit ones for
    vocabularies beyond 65,536 ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)", re.I)
        self.mark = os.path.commonprefix([t.content.lower() for t in added])
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.cut = CUTS.get(os.path.basename(path))
        self.known = WordIds(self.dtype)
        if self.cut:
            self.between = self._library([self.cut.between])[0]
            self.line_break = self._library(["\n"])[0]

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in found]

    def _special(self, text: str) -> bool:
        """Whether a text may hold the string of a special token, which the library gives the
        token's id; it then encodes the text whole."""
        return (not self.mark or self.mark in text.lower()) and bool(self.special.search(text))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, self.dtype)] * len(texts)
        some: list[tuple[int, bytes]] = []
        size = 0
        for at, text in enumerate(texts):
            if not text:
                continue
            if not self.cut or self._special(text) or (self.cut.takes and not regular(text)):
                out[at] = self._library([text])[0]
                continue
            some.append((at, text.encode()))
            size += len(some[-1][1])
            if size >= BATCH_BYTES:
                self._by_words(some, out)
                some, size = [], 0
        if some:
            self._by_words(some, out)
        return out

    def _by_words(self, texts: list[tuple[int, bytes]], out: list[np.ndarray]) -> None:
        """Ids of texts without irregular white space, put together from those of words."""
        raw = b"\n".join([x for _, x in texts])
        edges = np.cumsum([0, *(len(x) + 1 for _, x in texts)])[:-1]
        data = np.frombuffer(raw, np.uint8)
        inside = np.concatenate([[False], (data != 32) & (data != 10), [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = change[::2], change[1::2]
        words = np.searchsorted(starts, np.append(edges, len(raw) + 1))  # first of each text
        if self.cut.takes:
            starts = starts - 1
            starts[words[:-1]] += 1
        one, two = span_sums(data, starts, ends)
        own, first, which = np.unique(one, return_index=True, return_inverse=True)
        check = two[first]
        start, length, known = self.known.find(own)
        there = start >= 0
        if not np.array_equal(two, check[which]) or (known[there] != check[there]).any():
            for at, text in texts:  # two words of one hash
                out[at] = self._library([text.decode()])[0]
            return
        new = np.flatnonzero(~there)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            found = self._encoded([raw[a:b] for a, b in spans])
            start[new], length[new] = self.known.add(own[new], check[new], found)
        own_length = length[which]
        ids = gathered(self.known.ids, start[which], own_length)
        cuts = np.append(0, np.cumsum(own_length, dtype=np.int64))[words]
        for (at, _), a, b in zip(texts, cuts[:-1], cuts[1:]):
            out[at] = ids[a:b]
        self.known.tidy()

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of new words, many in a call, told apart by the id between them."""
        texts = [w.decode() for w in words]
        out: list[np.ndarray] = [self.line_break] * len(texts)
        broken = [i for i, t in enumerate(texts) if t[:1] == "\n"]
        for i in broken:
            texts[i] = texts[i][1:]
        between = self.cut.between
        for i in range(0, len(texts), JOINED):
            part = texts[i : i + JOINED]
            ids = self._library([between.join(part)])[0]
            cuts = np.flatnonzero(ids == self.between[0])
            if len(self.between) == 1 and len(cuts) == len(part) - 1:
                starts, stops = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
                out[i : i + JOINED] = [ids[a:b] for a, b in zip(starts, stops)]
            else:  # a word holds what stands between
                out[i : i + JOINED] = self._library(part)
        for i in broken:
            out[i] = np.concatenate([self.line_break, out[i]])
        return out


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


kept_by_worker(encoder.cache_clear)


def public_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
