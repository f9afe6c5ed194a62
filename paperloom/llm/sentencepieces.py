"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text is cut where no vocabulary entry can span: before each run of the blank symbol, around line feeds, and between marks
and other characters where no entry joins them. Within such a chunk, adjacent symbol pairs stand in an agenda ordered by the
score of what they merge to (then by position); the best is merged until none is left. The agendas of many chunks of about
one length advance together, one merge each at a time. Each distinct chunk of an Arrow batch is also encoded and decoded by the
sentencepiece library, and any difference is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import documents, steps

BLANK = "▁"
ENCODED = "doc_id long, n_tokens long, ids string, decoded string"
#: Bytes of text whose distinct chunks are worked on together, and symbols of chunks that advance together.
BATCH_BYTES = 8_000_000
ROOM = 2_000_000
#: ASCII marks (and the carriage return), between which and other characters chunks can end.
MARKS = "\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_NONE = np.int32(2**31 - 1)
_SLOTS = 20
_HASH = np.uint64(0x9E3779B97F4A7C15)


def chunk_pattern(pieces) -> re.Pattern:
    """Cuts as the module's text says. Characters that an entry joins to a mark (from either side of the line between marks
    and others) take part in no cut between the two: what holds one goes on to the next blank or line feed."""
    marks = set(MARKS)
    odd = {c for p in pieces for x, y in zip(p, p[1:]) if BLANK not in (x, y) and (x in marks) != (y in marks) for c in (x, y) if c not in marks}
    m, o = re.escape(MARKS), re.escape("".join(sorted(odd)))
    after = f"(?![{o}])" if odd else ""
    return re.compile(f"▁*+[{m}]++{after}|▁*+[^▁\n{m}{o}]++{after}|▁*+[^▁\n]++|▁++|\n")


class Merger:
    """Encodes with the entries of a merge-type vocabulary file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = lib.vocab_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {pieces[i]: i for i in plain}
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("an entry spans chunks; this vocabulary isn't supported")
        self.unknown = lib.unk_id()
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        raw = {i: bytes((b,)) for b, i in self.bytes.items()} | {self.unknown: b" \xe2\x81\x87 "}
        self.raw = pa.array([raw.get(i, p.replace(BLANK, " ").encode()) for i, p in enumerate(pieces)], pa.large_binary())
        self.decimal = pa.array([str(i) for i in range(n)], pa.large_string())
        self.find = chunk_pattern(self.ids).findall
        self.lead = lib.encode("\n", num_threads=1)
        #: Symbols: entries by their id, other characters by ``size`` and their code point.
        self.symbol = np.arange(0x110000, dtype=np.int64) + n
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        # Place in the order of merging: by score, best first; equal scores share a place.
        places = {s: k for k, s in enumerate(sorted({-lib.get_score(i) for i in plain}))}
        of = lambda s: self.ids.get(s, n + ord(s) if len(s) == 1 else None)
        pairs = [(a, b, places[-lib.get_score(i)], i) for p, i in self.ids.items() for k in range(1, len(p)) if (a := of(p[:k])) is not None and (b := of(p[k:])) is not None]
        self._table(*(np.array(x, np.int64) for x in zip(*pairs)) if pairs else [np.zeros(0, np.int64)] * 4)

    def _table(self, a: np.ndarray, b: np.ndarray, place: np.ndarray, whole: np.ndarray) -> None:
        """The pairs by hash, in open addresses."""
        self.slots = max(_SLOTS, int(len(a) * 3).bit_length())
        n = 1 << self.slots
        self.key, self.place, self.whole = np.full(n, -1, np.int64), np.full(n, _NONE, np.int32), np.zeros(n, np.int64)
        key = (a << 32) | b
        at, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.key[at[todo]] == -1]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.key[at[put]], self.place[at[put]], self.whole[at[put]] = key[put], place[put], whole[put]
            todo = todo[self.key[at[todo]] != key[todo]]
            at[todo] = (at[todo] + 1) & (n - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _HASH) >> np.uint64(64 - self.slots)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of merging a and b, and the entry they become; ``_NONE`` where they merge to none (or one is -1, no symbol)."""
        key = (a << 32) | b
        at = self._slot(key)
        todo = np.flatnonzero((self.key[at] != key) & (self.key[at] != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.key) - 1)
            todo = todo[(self.key[at[todo]] != key[todo]) & (self.key[at[todo]] != -1)]
        place = self.place[at]
        place[(a < 0) | (b < 0)] = _NONE
        return place, self.whole[at]

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text with its blanks as symbols and one more in front; none for an empty text."""
        return self.find(BLANK + text.replace(" ", BLANK)) if text else []

    def merged(self, symbols: np.ndarray) -> np.ndarray:
        """Runs the agenda of each row of symbols (-1 after a row's end); a merged pair is at its first place, -1 at the second.

        The agenda of a row is the places of its pairs in blocks with the least of each block, so that a merge looks at
        about the square root of the row.
        """
        rows, n = symbols.shape
        width = n if n <= 64 else int(np.ceil(np.sqrt(n)))
        blocks = -(-n // width)
        sym = np.full((rows, blocks * width), -1, np.int64)
        sym[:, :n] = symbols
        n = blocks * width
        agenda = np.full((rows, n), _NONE, np.int32)
        agenda[:, :-1] = self.pair(sym[:, :-1].ravel(), sym[:, 1:].ravel())[0].reshape(rows, n - 1)
        after = np.tile(np.arange(1, n + 1, dtype=np.int32), (rows, 1))
        before = np.tile(np.arange(-1, n - 1, dtype=np.int32), (rows, 1))
        least = agenda.reshape(rows, blocks, width).min(2)
        by_block = agenda.reshape(rows, blocks, width)
        r = np.flatnonzero(least.min(1) != _NONE)
        while len(r):
            block = least[r].argmin(1) if blocks > 1 else np.zeros(len(r), np.int64)
            i = block * width + by_block[r, block].argmin(1)
            j = after[r, i].astype(np.int64)
            left = sym[r, i]
            sym[r, i] = left = self.pair(left, sym[r, j])[1]
            sym[r, j] = -1
            k = after[r, j].astype(np.int64)
            after[r, i] = k
            inside = k < n
            right = np.where(inside, sym[r, np.minimum(k, n - 1)], -1)
            before[r[inside], k[inside]] = i[inside]
            agenda[r, j] = _NONE
            agenda[r, i] = self.pair(left, right)[0]
            h = before[r, i].astype(np.int64)
            own = np.flatnonzero(h >= 0)
            agenda[r[own], h[own]] = self.pair(sym[r[own], h[own]], left[own])[0]
            if blocks > 1:
                for x, y in ((r, i), (r, j), (r[own], h[own])):
                    least[x, y // width] = by_block[x, y // width].min(1)
                r = r[least[r].min(1) != _NONE]
            else:
                r = r[agenda[r].min(1) != _NONE]
        return sym

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each chunk begin (one more entry at the end)."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat, first = self.symbol[code], np.cumsum(size) - size
        # Chunks of one length, or of lengths a quarter apart, go together.
        kind = np.where(size <= 32, size, 32 + np.ceil(4 * np.log2(np.maximum(size, 1) / 32)).astype(np.int64))
        order = np.argsort(kind, kind="stable")
        out = np.full(len(flat), -1, np.int64)
        cut = np.append(np.flatnonzero(np.diff(kind[order], prepend=-1)), len(order))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            longest = int(size[order[a:b]].max())
            step = max(1, ROOM // longest)
            for at in range(a, b, step):
                own = order[at : min(at + step, b)]
                place = first[own][:, None] + np.arange(longest)
                valid = np.arange(longest) < size[own][:, None]
                sym = np.where(valid, flat[np.minimum(place, len(flat) - 1)], -1)
                out[place[valid]] = self.merged(sym)[:, :longest][valid]
        # Characters that no entry holds become bytes, or the unknown entry.
        row = np.repeat(np.arange(len(chunks)), size)
        alive = out >= 0
        out, row = out[alive], row[alive]
        times = np.ones(len(out), np.int64)
        strange = np.flatnonzero(out >= self.size)
        if len(strange):
            letters, which = np.unique(out[strange], return_inverse=True)
            spelt = [[self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown] for c in (letters - self.size).tolist()]
            times[strange] = np.array([len(s) for s in spelt])[which]
            ids = np.repeat(out, times)
            ids[np.repeat(out >= self.size, times)] = np.fromiter(chain.from_iterable(spelt[w] for w in which.tolist()), np.int64)
            out, row = ids, np.repeat(row, times)
        return out, np.searchsorted(row, np.arange(len(chunks) + 1))

    def decode(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """The text of each chunk's ids, without the rule that the text's first blank goes."""
        parts = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), self.raw.take(pa.array(ids)))
        joined = pc.binary_join(parts, pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.large_string())

    def checked(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """ids, where those of each chunk begin, and the decoded chunks; the library has to say the same."""
        ids, first = self.encode(chunks)
        texts = self.decode(ids, first)
        # A line feed before the chunk keeps the library's own leading blank apart.
        skip = len(self.lead)
        theirs = self.library.encode(["\n" + c.replace(BLANK, " ") for c in chunks], num_threads=1)
        size = np.fromiter(map(len, theirs), np.int64, len(theirs)) - skip
        flat = np.fromiter(chain.from_iterable(theirs), np.int64)
        head = np.cumsum(size + skip) - (size + skip)
        keep = np.ones(len(flat), bool)
        keep[(head[:, None] + np.arange(skip)).ravel()] = False
        back = pc.utf8_slice_codeunits(pa.array(self.library.decode(theirs, num_threads=1), pa.large_string()), 1)
        if not (np.array_equal(size, np.diff(first)) and np.array_equal(flat[keep], ids) and back.equals(texts)):
            wrong = next(c for i, c in enumerate(chunks) if theirs[i][skip:] != ids[first[i] : first[i + 1]].tolist() or back[i].as_py() != texts[i].as_py())
            raise ValueError(f"the sentencepiece library differs on {wrong!r}")
        return ids, first, texts


_mergers: dict[str, Merger] = {}


def _listed(values: pa.Array, codes: pa.Array, first: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), values.take(codes)), pa.scalar(by, pa.large_string()))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and the decoded text of each row.

    Null and empty texts have no ids and decode to ''; rows of one doc_id, and rows without one, are each encoded. An empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        if model not in _mergers:
            _mergers[model] = Merger(model)
        merger = _mergers[model]
        for batch in steps(batches, limit=BATCH_BYTES):
            found = [merger.chunks(t) for t in batch.column(1).to_pylist()]
            at = np.zeros(len(found) + 1, np.int64)
            np.cumsum([len(x) for x in found], out=at[1:])
            coded = pa.array(list(chain.from_iterable(found)), pa.large_string()).dictionary_encode()
            del found
            if len(coded.dictionary):
                ids, first, texts = merger.checked(coded.dictionary.to_pylist())
                size = np.diff(first)
                written = _listed(merger.decimal, pa.array(ids), first, ",")
                n = np.append(0, np.cumsum(size[coded.indices.to_numpy()]))[at]
                n, written, back = np.diff(n), _listed(written, coded.indices, at, ","), pc.utf8_slice_codeunits(_listed(texts, coded.indices, at, ""), 1)
            else:
                n, written, back = np.zeros(batch.num_rows, np.int64), pa.array([""] * batch.num_rows), pa.array([""] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), written.cast(pa.string()), back.cast(pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return documents(docs).mapInArrow(run, ENCODED)
