"""Token ids of whole texts with the tokenizers library, a batch of texts at a time.

Both vocabularies split a text before merging, and no piece runs on from a
character that isn't white space into one that is. A text's ids are therefore
those of its chunks (white space, then what follows up to the next white
space), one after the other. Words repeat, so Arrow finds the distinct chunks
of a batch, the library encodes those that this worker hasn't met yet, and
numpy puts the ids together. Texts with white space beyond ASCII go through the
library whole.

A chunk of one blank, Latin-1 letters and perhaps ASCII punctuation, which is
nearly every one, needs no search for its pieces: it is cut into the word (with
the blank where the vocabulary keeps it) and the punctuation, and both go
straight to the library's merge model.

The tokenizer is used as loaded. A text with the string of one of its added
tokens, in either case, goes through the library whole, too.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa

from kinrank.llm.common import ranges, values

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: UTF-8 of the white space characters beyond ASCII.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Bytes of letters that are letters under any Unicode version and in lower case one character each (ASCII, and
#: two-byte ones that begin with 0xC3), and of ASCII punctuation.
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = True
MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
PLAIN = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
MARKS = re.compile(rb"[!-/:-@\[-`{-~]+")
KNOWN = 600_000                       # distinct chunks that a worker keeps; it forgets all beyond that
TOGETHER = 2000                       # chunks encoded in one call

_loaded: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """This worker's encoder for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = [re.escape(t.content.encode()) for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = re.compile(b"|".join([WIDE_SPACE.pattern, *added]), re.I)
        self.model = self.tok.model
        probe = self.tok.encode(" A", add_special_tokens=False).ids
        self.blank = probe != self.tok.encode("A", add_special_tokens=False).ids     # blanks are kept
        self.lower = probe == self.tok.encode(" a", add_special_tokens=False).ids
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]        # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        letters = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.letters = "".join(letters.get(b, chr(b)) for b in range(256))
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.first, self.count = array("I"), array("q"), array("q")

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks that aren't known. Those that begin with white space
        and hold more are encoded many in one string: they meet as in a text."""
        names, found, joined = [], [], []
        merge, show, is_plain, is_marks, lower, blank = (self.model.tokenize, codecs.charmap_decode, PLAIN.fullmatch,
                                                         MARKS.fullmatch, self.lower, self.blank)
        for c in chunks:
            if is_plain(c):
                word = c.decode().lower().encode() if lower else c
                found.append([t.id for t in merge(show(word if blank else word[1:], "strict", self.letters)[0])])
            elif is_marks(c):
                found.append([t.id for t in merge(c.decode())])
            elif SPACE[c[0]] and not SPACE[c[-1]]:
                joined.append(c)
                continue
            else:
                found.append(self.tok.encode(c.decode(), add_special_tokens=False).ids)
            names.append(c)
        for i in range(0, len(joined), TOGETHER):
            part = joined[i:i + TOGETHER]
            texts = [c.decode() for c in part]
            begin = np.cumsum([0, *map(len, texts)])[:-1]
            e = self.tok.encode("".join(texts), add_special_tokens=False)
            starts = np.array([s for s, _ in e.offsets], np.int64)
            of = np.searchsorted(begin, starts, "right") - 1
            cut = np.searchsorted(of, np.arange(len(part) + 1), "left").tolist()
            ids = e.ids
            names += part
            found += [ids[s:t] for s, t in zip(cut, cut[1:])]
        size = [len(x) for x in found]
        self.known.update(zip(names, range(len(self.first), len(self.first) + len(names))))
        self.first.extend(accumulate(size[:-1], initial=len(self.flat)) if size else ())
        self.count.extend(size)
        self.flat.extend(chain.from_iterable(found))

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts buf[off[i]:off[i+1]], and how many each has."""
        n = len(off) - 1
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        raw = buf.tobytes()
        odd = {int(np.searchsorted(off, m.start(), "right")) - 1 for m in self.whole.finditer(raw)}
        if odd:
            return self._encode_whole(raw, off, odd)
        space = SPACE[buf]
        edge = np.zeros(len(buf), bool)
        edge[1:] = space[1:] & ~space[:-1]
        edge[off[:-1][off[:-1] < off[1:]]] = True
        begin = self._cut(buf, np.flatnonzero(edge), edge)
        ends = np.append(begin[1:], len(buf)).astype(np.int32)
        bounds = np.concatenate([begin[:1].astype(np.int32), ends])
        chunks = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        coded = chunks.dictionary_encode()
        data, at = values(coded.dictionary)
        data, at = data.tobytes(), at.tolist()
        distinct = [data[i:j] for i, j in zip(at, at[1:])]
        if len(self.known) > KNOWN:
            self.forget()
        new = [c for c in distinct if c not in self.known]
        if new:
            self._learn(new)
        slot = np.array([self.known[c] for c in distinct], np.int64)[coded.indices.to_numpy()]
        count = np.array(self.count, np.int64)[slot]
        ids = np.array(self.flat, np.uint32)[ranges(np.array(self.first, np.int64)[slot], count)]
        upto = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(begin, off, "left")]
        return ids, np.diff(upto)

    @staticmethod
    def _cut(buf: np.ndarray, begin: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Where the chunks begin once those of a blank, letters and then
        punctuation are cut between the two."""
        letter, mark = LETTER[buf], MARK[buf]
        odd = ~(letter | mark)
        odd[1:] |= letter[1:] & mark[:-1]
        before = np.cumsum(odd, dtype=np.int32)
        last = np.append(begin[1:], len(buf)) - 1
        plain = (buf[begin] == 32) & (before[last] == before[begin]) & letter[np.minimum(begin + 1, len(buf) - 1)] & (last > begin)
        at = np.flatnonzero(mark[1:] & letter[:-1]) + 1
        edge[at[plain[np.searchsorted(begin, at, "right") - 1]]] = True
        return np.flatnonzero(edge)

    def _encode_whole(self, raw: bytes, off: np.ndarray, odd: set[int]) -> tuple[np.ndarray, np.ndarray]:
        ids, count, i, n = [], [], 0, len(off) - 1
        while i < n:
            if i in odd:
                x = np.array(self.tok.encode(raw[off[i]:off[i + 1]].decode(), add_special_tokens=False).ids, np.uint32)
                ids.append(x)
                count.append(np.array([len(x)], np.int64))
                i += 1
                continue
            j = i
            while j < n and j not in odd:
                j += 1
            x, c = self.encode(np.frombuffer(raw, np.uint8)[off[i]:off[j]], off[i:j + 1] - off[i])
            ids.append(x)
            count.append(c)
            i = j
        return np.concatenate(ids), np.concatenate(count)
