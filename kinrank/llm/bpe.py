"""Operator 13, byte-level BPE without merging: longest matches and backtracking.

A vocabulary ranks byte strings. BPE joins, again and again, the leftmost of
the neighbouring parts whose union ranks lowest. Its result is the only way to
cut a piece into tokens such that every two neighbours are compatible, i.e. BPE
of the two together gives the two. So nothing need be merged: tokens are taken
from the left, the longest match first; one that isn't compatible with the
token before it gives way to the next shorter match; a place where nothing fits
is marked dead, and the token before it gives way in turn. Each place dies at
most once, so a piece takes time in proportion to its length.

Bytes stand as Latin-1 characters in a pyahocorasick automaton of the tokens,
which says how far a place's characters agree with any token; the longest token
on that way and the next shorter one of every token are kept. Whether two tokens are compatible follows from how each was
joined: at any rank, what meets at their border is a part on the right edge of
the first and one on the left edge of the second, and the two would have joined
if their union ranks below the joins that both still have to come.

Tokens that BPE never forms out of their own bytes can't be matched, but a piece
that is in the vocabulary as a whole is that token, as tiktoken has it.
"""

from __future__ import annotations

import base64
from array import array
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, ship

KNOWN = 600_000                       # pieces whose ids a worker keeps
PAIRS = 1_000_000                     # pairs whose compatibility a worker keeps
LONG_TEXT = 1 << 20                   # characters of a text whose pieces are held at a time

_loaded: dict[tuple[str, str], "Bpe"] = {}


def tokenizer(path: str, pattern: str) -> "Bpe":
    """This worker's tokenizer for a file of ranks and a pattern of pieces."""
    if (path, pattern) not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        _loaded[path, pattern] = Bpe(ranks, pattern)
    return _loaded[path, pattern]


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern)
        self.token = {r: t for t, r in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}       # what a token is joined of; none for single bytes
        self.matches = ahocorasick.Automaton()
        for t, r in ranks.items():
            if len(t) == 1 or self._joined(t, r):
                self.matches.add_word(t.decode("latin-1"), r)
        self.longest = max(map(len, ranks), default=1)
        self.length = {r: len(t) for t, r in ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}        # ids of pieces
        self.fits: dict[int, bool] = {}                     # of pairs, the first token in the upper bits
        self.head: dict[str, int] = {}                      # the longest token of a beginning
        self.shorter: dict[int, int] = {}                   # the next shorter match of a token

    def _joined(self, t: bytes, rank: int) -> bool:
        """Whether BPE forms this token out of its bytes; keeps its last two parts."""
        parts = [t[i:i + 1] for i in range(len(t))]
        get = self.ranks.get
        while len(parts) > 2:
            low, at = min(((get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(rank, 0))
            if low >= rank:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if parts[0] not in self.ranks or parts[1] not in self.ranks:
            return False
        self.halves[rank] = self.ranks[parts[0]], self.ranks[parts[1]]
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE of the two tokens' bytes gives these two tokens."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        found = self.fits[a << 32 | b] = self._compatible(a, b)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        ranks, token, halves = self.ranks, self.token, self.halves
        # Back in time: `until` is the rank of the join that ends what now meets at the border. A join further
        # left comes first among equals, one further right last.
        until: float = float("inf")
        while True:
            union = ranks.get(token[a] + token[b])
            if union is not None and union < until:
                return False
            left, right = halves.get(a), halves.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                until, a = a, left[1]
            else:
                until, b = b + 0.5, right[0]

    def _longest(self, path: str) -> int:
        """The longest token that begins ``path``, characters that tokens begin with; -1 if none."""
        for n in range(len(path), 0, -1):
            if self.matches.exists(path[:n]):
                return self.matches.get(path[:n])
        return -1

    def _next(self, token: int) -> int:
        """The longest token that is a shorter beginning of this one; -1 if none."""
        return self._longest(self.token[token][:-1].decode("latin-1"))

    def piece(self, raw: bytes) -> list[int]:
        """The ids of one piece."""
        if raw in self.ranks:
            return [self.ranks[raw]]
        text, size = raw.decode("latin-1"), len(raw)
        reach, head, shorter, length, fits, longest = (self.matches.longest_prefix, self.head, self.shorter, self.length,
                                                       self.fits, self.longest)
        dead: set[int] = set()
        ids: list[int] = []
        at = 0
        last = t = -1
        while at < size:
            if t < 0:
                path = text[at:at + longest]
                path = path[:reach(path)]
                t = head.get(path, -2)
                if t == -2:
                    t = head[path] = self._longest(path)
            while t >= 0:
                end = at + length[t]
                if end not in dead:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | t)
                    if fit or (fit is None and self.compatible(last, t)):
                        break
                below = shorter.get(t, -2)
                if below == -2:
                    below = shorter[t] = self._next(t)
                t = below
            if t >= 0:
                ids.append(t)
                last, t, at = t, -1, end
                continue
            # nothing fits here: the token before gives way to the next shorter one
            while t < 0:
                if not ids:
                    raise ValueError("a byte of the text is not in the vocabulary")
                dead.add(at)
                t = ids.pop()
                at -= length[t]
                if t not in shorter:
                    shorter[t] = self._next(t)
                t = shorter[t]
            last = ids[-1] if ids else -1
        return ids

    def encode(self, text: str) -> array:
        out, known = array("I"), self.known
        if len(text) <= LONG_TEXT:
            runs = [self.split.findall(text)]
        else:
            found = (m.group() for m in self.split.finditer(text))
            runs = iter(lambda: list(islice(found, LONG_TEXT >> 3)), [])
        for pieces in runs:
            ids = list(map(known.get, pieces))
            if None in ids:
                if len(known) > KNOWN:
                    known.clear()
                for p in set(pieces):
                    if p not in known:
                        known[p] = tuple(self.piece(p.encode()))
                ids = [known[p] for p in pieces]
            out.extend(chain.from_iterable(ids))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def encode_documents(docs: DataFrame, path: str, pattern: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, carried, ids``: the token ids of each whole text as
    little-endian unsigned 32-bit integers, one row per row of ``docs``.

    Null and empty texts have no ids; strings of special tokens are ordinary
    text. Rows are encoded alone, so repeated rows, ties and null ids change
    nothing; texts of any length take memory for their ids and one stretch of
    pieces. Columns named in ``carry`` come back in the struct ``carried``,
    others are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    d = docs.select("doc_id", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(0).alias("carried"),
                    F.coalesce("text", F.lit("")).alias("_t"))

    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = pa.array([_little(bpe.encode(t.as_py())) for t in part.column("_t")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("carried"), ids], names=["doc_id", "carried", "ids"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "_t")
    return arrow_sized(d, size=ROW_BATCH_BYTES).mapInArrow(run, f"{kinds}, ids binary")


def decode_documents(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that the column ``ids`` stands
    for; null ids decode to no bytes. An id that the vocabulary lacks is an error."""
    ship(tokens.sparkSession)
    d = tokens.select(*[c for c in tokens.columns if c != "decoded"])

    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            raw = [bpe.decode(_ids(x.as_py() or b"")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], names=[*b.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)
    return d.mapInArrow(run, f"{kinds}, decoded binary")


def _little(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def _ids(raw: bytes) -> array:
    import sys

    out = array("I", raw)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def op13(spark, sf_dir):
    import public_tokenizers

    from kinrank.llm.common import table

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = encode_documents(table(spark, sf_dir, "documents"), path, pattern)
    return (decode_documents(coded.select("doc_id", "ids"), path, pattern)
            .select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")))
