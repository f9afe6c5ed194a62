"""Best-fit packing of tokenised documents into sequences of bounded length.

Bounded-space online best-fit: pieces arrive in a deterministic order, a fixed number of bins is open, an integer used as
a bitset marks the free spaces for which an open bin exists, and a piece goes to the bin with the least free space that
holds it. When too many bins are open, the fullest closes first. Tasks pack disjoint shares of the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, gather, lean, steps, word_codes

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"
#: Documents for each packing task; a task's last bins stay partly empty, so few large tasks pack tighter.
SHARE = 16_384


#: Bytes of text whose distinct words are tokenised together.
STEP = 24_000_000
#: A mark at a word's end; the vocabulary's own split keeps a run of marks apart from letters and digits before it.
_MARKS = ".,!?;:"
#: Word stems that a worker remembers; beyond, it starts anew.
REMEMBERED = 800_000


class Stems:
    """The ids of the word stems that this worker has met, in one array."""

    def __init__(self, path: str):
        self.path, self.index, self.ids, self.ends = path, {}, np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def codes(self, stems: list[str]) -> np.ndarray:
        """Places in ``ends`` of the stems, which are distinct; new ones are encoded."""
        if len(self.index) + len(stems) > REMEMBERED:
            self.__init__(self.path)
        get = self.index.get
        out = np.fromiter((get(s, -1) for s in stems), np.int64, len(stems))
        new = np.flatnonzero(out < 0)
        if len(new):
            texts = [stems[i] for i in new.tolist()]
            coded = [x.ids for x in _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), np.uint32, sizes.sum())])
            out[new] = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(new))
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.index.update(zip(texts, out[new].tolist()))
        return out


def token_ids(path: str, batch: pa.RecordBatch, end_id: int = 0):
    """(doc_id, ids) of each row; ids end with ``end_id``.

    The vocabulary drops white space before it looks for words, so a text's ids are those of its words in a row. A word of
    ASCII alone is lower-cased, as the vocabulary does, and parted into a stem that ends with a letter or digit and the
    marks behind it, where the vocabulary's split parts it too; each distinct stem of a batch is encoded once. All other
    words go to the library as they are: it composes letters before it lower-cases them, which may leave marks of its own at
    a word's end, and it looks for its added tokens, whose case matters, before either.
    """
    words, codes, first = word_codes(batch.column(1))
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
    lower = pc.if_else(plain, pc.ascii_lower(words), words)
    bare = pc.utf8_rtrim(lower, _MARKS)
    sound = pc.and_(plain, pc.match_substring_regex(bare, "[a-z0-9]$"))
    marks = pc.if_else(sound, _tail(lower, bare), pa.scalar("", lower.type))
    parts = pa.concat_arrays([pc.if_else(sound, bare, lower), marks]).dictionary_encode()
    store = _memory.setdefault(path, Stems(path))
    index = store.codes(parts.dictionary.to_pylist())[parts.indices.to_numpy(zero_copy_only=False)]
    flat, ends = gather(store.ids, store.ends, np.stack([index[: len(words)], index[len(words) :]], 1).ravel())
    ends = ends[::2]
    last, keys, row, n = np.uint32(end_id), batch.column(0).to_pylist(), 0, batch.num_rows
    while row < n:  # some texts at a time, so that the arrays stay small
        to = max(row + 1, min(n, int(np.searchsorted(first, first[row] + 400_000, "right")) - 1))
        every, begin = gather(flat, ends, codes[first[row] : first[to]])
        at = begin[first[row : to + 1] - first[row]]
        for k in range(row, to):
            yield keys[k], np.append(every[at[k - row] : at[k - row + 1]], last)
        row = to


def _tail(whole: pa.Array, head: pa.Array) -> pa.Array:
    """What follows ``head`` in ``whole``; both are strings of which the second is a prefix."""
    keep, size = pc.binary_length(head).to_numpy(zero_copy_only=False), pc.binary_length(whole).to_numpy(zero_copy_only=False)
    out = np.full(len(whole), "", object)
    cut = np.flatnonzero(keep < size)
    out[cut] = [w[-n:] for w, n in zip(whole.take(pa.array(cut)).to_pylist(), (size - keep)[cut].tolist())]
    return pa.array(out, whole.type)


#: What a vocabulary must do to texts, in this order, for ``token_ids`` to hold.
_NORMALISED = ["NFC", "Replace", "Lowercase"]
_memory: dict = {}
_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # an executor's cores are shared by its tasks
        import json

        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        steps_ = (json.loads(found.to_str())["normalizer"] or {}).get("normalizers", [])
        if [x["type"] for x in steps_] != _NORMALISED:
            raise ValueError(f"{path} normalises texts in another way than words can be encoded one by one")
        _loaded[path] = found
    return _loaded[path]


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece; null and empty texts are the end id alone. Only documents longer than ``length`` are cut."""

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches, limit=STEP):
            rows = []
            for key, ids in token_ids(tokenizer, batch, end_id):
                for n, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    rows.append((key, n, start, len(part), zlib.crc32(part.tobytes())) + ((part.tobytes(),) if with_ids else ()))
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    schema = PIECES + (", ids binary" if with_ids else "")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return documents(docs, batch=STEP).mapInArrow(lean(cut), schema)


class OpenBins:
    """At most ``room`` open bins; ``free`` has bit f set while a bin with f free tokens is open."""

    def __init__(self, length: int, room: int):
        self.length, self.room, self.free, self.open, self.n, self.next = length, room, 0, {}, 0, 0

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``size`` tokens."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            which = self._take(space)
        else:
            space, which = self.length, self.next
            self.next += 1
        left = space - size
        if left:
            if self.n >= self.room:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            self.open.setdefault(left, []).append(which)
            self.free |= 1 << left
            self.n += 1
        return which, self.length - space

    def _take(self, space: int) -> int:
        bins = self.open[space]
        which = bins.pop()
        if not bins:
            del self.open[space]
            self.free ^= 1 << space
        self.n -= 1
        return which


def pack(found: DataFrame, length: int = 2048, room: int = 4096, shares: int | None = None) -> DataFrame:
    """Adds sequence_id and offset to rows of pieces.

    ``shares`` tasks each pack the pieces that a hash deals to them, in the order of that hash, so a task that is run
    again gives the same bins. By default there is a share for each 16,384 rows of pieces, counted first.
    """
    if shares is None:
        shares = max(1, -(-found.count() // SHARE))
    spread = found.withColumn("_h", F.xxhash64("doc_id", "piece"))
    rest = [f.name for f in found.schema.fields]

    def fit(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        bins, base = OpenBins(length, room), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            new = [pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in rest] + new, [*rest, "sequence_id", "offset"])

    schema = found.schema.add("sequence_id", "long").add("offset", "long")
    ordered = spread.repartition(shares, "_h").sortWithinPartitions("_h", "doc_id", "piece", "start", "ids_crc32")
    return ordered.mapInArrow(lean(fit), schema)


def best_fit(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, room: int = 4096, with_ids: bool = False) -> DataFrame:
    """Packs all documents; see ``pieces`` and ``pack``. Repeated doc_ids are packed as rows of their own; an empty table gives no rows."""
    shares = max(1, -(-docs.count() // SHARE))
    return pack(pieces(docs, tokenizer, length, end_id, with_ids), length, room, shares)
