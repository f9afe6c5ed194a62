"""Language-model scores from the subword lattice.

The scores of a subword vocabulary's entries weight all segmentations of a word; the log-space forward recursion over the
word's lattice sums them to its marginal probability, and a text's is the product over its words and its end. Scores of
unigram vocabularies are log-probabilities and are used as they are; merge-type vocabularies carry ranks, which stand for
the probabilities of a power law. A second score has the weights re-estimated from the training documents by expected counts
(forward and backward). A third adds an arc over each whole training word to these lattices, weighted by its discounted count,
and gives what the discount leaves to the entries. No entry spans a word's first blank, so words are scored apart, many at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, lean, materialise, steps, word_codes

BLANK = "▁"
#: Every task knows the training counts of words that are a ``HEAD``-th of all tokens or more, of which there are ``HEAD``
#: at most; the rest is joined by word.
HEAD = 400_000
#: Bytes of text whose distinct words are scored together.
STEP = 24_000_000
#: Times the weights are re-estimated.
ROUNDS = 2
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a span's hash that are looked up before the sorted hashes are searched.
_SIFT = 20
_LOG10 = float(np.log(10))


@dataclass
class Vocabulary:
    """Entries by hash, with natural-log weights; the last weight is the text's end."""

    keys: np.ndarray  # sorted hashes of the entries
    entry: np.ndarray  # the entry of each
    weight: np.ndarray
    by_byte: np.ndarray  # entry of each byte value; the unknown entry where the vocabulary has no bytes
    longest: int
    sizes: np.ndarray  # lengths of entries
    sift: np.ndarray  # whether an entry's hash has these leading bits

    @property
    def end(self) -> float:
        return float(self.weight[-1])

    def spelt(self, letter: str) -> list[int]:
        """The entries that stand in for a letter which no entry holds: its bytes, or the unknown entry once."""
        entries = [int(self.by_byte[b]) for b in letter.encode("utf-8", "surrogatepass")]
        return entries if len(set(self.by_byte.tolist())) > 1 else entries[:1]


def _hash(codes: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in codes:
            h = h * _BASE + np.uint64(c) + np.uint64(1)
    return h


def load(path: str) -> Vocabulary:
    """The entries of a sentencepiece file: plain pieces in which a blank only leads, single bytes, and the end."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    n = lib.vocab_size()
    pieces = [lib.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)) and BLANK not in pieces[i][1:]]
    hashes = np.array([_hash(np.frombuffer(pieces[i].encode("utf-32-le"), np.uint32)) for i in plain], np.uint64)
    order = np.argsort(hashes)
    by_byte = np.full(256, lib.unk_id())
    for i in range(n):
        if lib.is_byte(i):
            by_byte[int(pieces[i][3:5], 16)] = i
    scores = np.array([lib.get_score(i) for i in range(n)])
    if (scores[plain] <= 0).all() and scores[plain].min() < -1000:  # ranks of merges
        weight = -np.log(20.0 + np.minimum(-scores, n))
        weight = np.append(weight, np.log(1 / 20))
        weight -= np.log(np.exp(weight).sum())
    else:  # log-probabilities; the unknown entry is as much less likely as the library has it, the end as likely as the best
        weight = scores.astype(float)
        weight[lib.unk_id()] = weight[plain].min() - 10
        weight = np.append(weight, weight[plain].max())
    sizes = np.unique([1, *(len(pieces[i]) for i in plain)])
    sift = np.zeros(1 << _SIFT, bool)
    sift[_leading(hashes)] = True
    return Vocabulary(hashes[order], np.array(plain)[order], weight, by_byte, int(sizes[-1]), sizes, sift)


def _leading(hashes: np.ndarray) -> np.ndarray:
    """Bits by which hashes are sifted; those of short strings lead with zeros, so they are multiplied once more."""
    with np.errstate(over="ignore"):
        return ((hashes * _BASE) >> np.uint64(64 - _SIFT)).view(np.int64)


def _groups(words: list[str], room: int = 400_000):
    """(places, matrix of code points with the blank in front) of words of one length at a time."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for n, own in by.items():
        step = max(1, room // (n + 1))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            flat = np.frombuffer("".join(BLANK + words[i] for i in part).encode("utf-32-le"), np.uint32)
            yield np.array(part), flat.reshape(len(part), n + 1)


def _edges(v: Vocabulary, codes: np.ndarray):
    """(from, to, rows, entries, weights) for all spans of the words that are entries; bytes stand in for letters that none holds."""
    rows, n = codes.shape
    prefix = np.zeros((n + 1, rows), np.uint64)
    for j in range(n):
        prefix[j + 1] = prefix[j] * _BASE + codes[:, j] + np.uint64(1)
    power = np.ones(v.longest + 1, np.uint64)
    for j in range(v.longest):
        power[j + 1] = power[j] * _BASE
    for to in range(1, n + 1):
        for size in v.sizes[v.sizes <= to].tolist():
            h = prefix[to] - prefix[to - size] * power[size]
            own = np.flatnonzero(v.sift[_leading(h)])
            at = np.minimum(np.searchsorted(v.keys, h[own]), len(v.keys) - 1)
            hit = v.keys[at] == h[own]
            own, at = own[hit], at[hit]
            if len(own):
                entry = v.entry[at]
                yield to - size, to, own, entry, v.weight[entry]
            if size == 1 and len(own) < rows:
                lost = np.setdiff1d(np.arange(rows), own, True)
                yield to - 1, to, lost, None, _spelt(v, codes[lost, to - 1])


def marginals(v: Vocabulary, words: list[str], more: Vocabulary | None = None) -> np.ndarray:
    """Natural-log probability of each word, its leading blank included, over all segmentations.

    With ``more``, the same entries with other weights, there are two rows, the second for these.
    """
    out = np.zeros((2, len(words)))
    both = [v] if more is None else [v, more]
    with np.errstate(over="ignore"):
        for own, codes in _groups(words):
            alpha = np.full((len(both), codes.shape[1] + 1, len(own)), -np.inf)
            alpha[:, 0] = 0
            for a, b, rows, entry, w in _edges(v, codes):
                for k, x in enumerate(both):
                    if k:
                        w = x.weight[entry] if entry is not None else _spelt(x, codes[rows, a])
                    alpha[k, b, rows] = np.logaddexp(alpha[k, b, rows], alpha[k, a, rows] + w)
            out[: len(both), own] = alpha[:, -1]
    return out[0] if more is None else out


def _spelt(v: Vocabulary, codes: np.ndarray) -> np.ndarray:
    letters, which = np.unique(codes, return_inverse=True)
    return np.array([sum(float(v.weight[e]) for e in v.spelt(chr(c))) for c in letters.tolist()])[which]


def expected(v: Vocabulary, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each entry in the words, as often as ``counts`` has them."""
    out = np.zeros(len(v.weight))
    with np.errstate(over="ignore"):
        for own, codes in _groups(words, 150_000):
            edges = list(_edges(v, codes))
            alpha = np.full((codes.shape[1] + 1, len(own)), -np.inf)
            beta = alpha.copy()
            alpha[0], beta[-1] = 0, 0
            for a, b, rows, _, w in edges:
                alpha[b, rows] = np.logaddexp(alpha[b, rows], alpha[a, rows] + w)
            for a, b, rows, _, w in reversed(edges):
                beta[a, rows] = np.logaddexp(beta[a, rows], beta[b, rows] + w)
            each = counts[own]
            for a, b, rows, entry, w in edges:
                share = np.exp(alpha[a, rows] + w + beta[b, rows] - alpha[-1, rows]) * each[rows]
                if entry is not None:
                    out += np.bincount(entry, share, minlength=len(out))
                else:
                    for c, s in zip(codes[rows, a].tolist(), share.tolist()):
                        for e in v.spelt(chr(c)):
                            out[e] += s
    return out


def word_counts(docs: DataFrame, training: Column) -> DataFrame:
    """word, c, every: how often each lower-cased (A-Z) word occurs in the training documents and in all."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in steps(batches, limit=STEP):
            words, codes, first = word_codes(pc.ascii_lower(b.column(1)))
            chosen = np.repeat(b.column(2).to_numpy(zero_copy_only=False), np.diff(first))
            own, every = (np.bincount(x, minlength=len(words)) for x in (codes[chosen], codes))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(own, pa.int64()), pa.array(every, pa.int64())], ["word", "c", "every"])

    marked = documents(docs, batch=STEP).withColumn("chosen", F.coalesce(training, F.lit(False)))
    return marked.mapInArrow(lean(run), "word string, c long, every long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("every").alias("every"))


def learn(counts: DataFrame, ends: int, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Vocabulary:
    """Re-estimates the entries' weights from the words of ``counts``; the driver gets one sum for each entry."""
    import dataclasses

    v, n, sc = vocabulary, len(vocabulary.weight), counts.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast(v)

        def run(batches: Iterator[pa.RecordBatch], shared=shared):
            total = np.zeros(n)
            for b in batches:
                total += expected(shared.value, b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).astype(float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.float64())], ["entry", "uses"])

        uses = np.zeros(n)
        for r in counts.select("word", "c").mapInArrow(lean(run), "entry int, uses double").groupBy("entry").agg(F.sum("uses").alias("uses")).collect():
            uses[r["entry"]] = r["uses"]
        uses[-1] = ends
        live = np.append(np.isin(np.arange(n - 1), np.append(v.entry, v.by_byte)), True)
        uses = np.where(live, uses + 0.1, 0)
        with np.errstate(divide="ignore"):
            v = dataclasses.replace(v, weight=np.log(uses / uses.sum()))
    return v


@dataclass(frozen=True)
class Lexicon:
    """Whole training words as arcs beside the entries: absolute discounting, by Ney's estimate with one more word of each count."""

    tokens: int
    types: int
    once: int
    twice: int

    @property
    def discount(self) -> float:
        return (self.once + 1) / (self.once + 2 * self.twice + 2)

    def score(self, c: Column, entries: Column) -> Column:
        """log10 probability of a word of count ``c`` whose segmentations add up to ``entries`` (log10, which may be below a double's exponents)."""
        if not self.tokens:
            return entries
        left = self.discount * self.types / self.tokens
        return F.when(c > 0, F.log10((c - self.discount) / self.tokens + left * F.pow(F.lit(10.0), entries))).otherwise(entries + float(np.log10(left)))


def word_scores(counts: DataFrame, given: Vocabulary, model: Vocabulary) -> DataFrame:
    """``counts`` with log10 probabilities of each word: score by the vocabulary's weights, adapted by the model's."""
    shared = counts.sparkSession.sparkContext.broadcast((given, model))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = marginals(shared.value[0], b.column(0).to_pylist(), shared.value[1]) / _LOG10
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found[0]), pa.array(found[1])], ["word", "c", "every", "score", "adapted"])

    return counts.select("word", "c", "every").mapInArrow(lean(run), "word string, c long, every long, score double, adapted double")


def score(docs: DataFrame, training: Column, vocabulary: str, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, adapted_score and lexicon_score of each document.

    score is by the vocabulary's own scores, adapted_score by weights that ``rounds`` of expected counts learn; for
    lexicon_score each training word is an entry beside these (``Lexicon``).

    ``training`` is over doc_id. Null and empty texts are the end alone. Rows with the same doc_id are scored apart,
    as are rows without one; an empty table gives no rows. A word is worked on as a whole, in time in proportion to its length,
    and once, however many documents have it. Words that are a ``head``-th of all tokens or more go to every task (``head``
    words at most) with their scores; other words are joined by word.
    """
    every = documents(docs, batch=STEP)
    counts = materialise(word_counts(docs, training), "zstd")
    ends = every.filter(training).count()
    known = F.col("c") > 0
    total = counts.agg(F.sum("c").alias("n"), F.count_if(known).alias("v"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2)], F.sum("every").alias("every")).collect()[0]
    n, v = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    given = load(vocabulary)
    model = learn(counts.filter(known), ends, given, rounds)
    lexicon = Lexicon(n, v, total["n1"], total["n2"])
    scored = materialise(word_scores(counts, given, model), "zstd").withColumn("lexicon", lexicon.score(F.col("c"), F.col("adapted")))
    # At most ``head`` rows, as their counts add up to all words.
    parts = ("base", "score", "adapted", "lexicon")
    top = scored.filter(F.col("every") * head >= (total["every"] or 0)).select("word", "c", *parts[1:]).toArrow()
    common = [top.column("word").combine_chunks(), *(np.append(top.column(c).to_numpy(), 0) for c in ("c", *parts[1:]))]
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(common)
    floor = float(np.log10(n + 1 * (v + 1)))

    def run(batches: Iterator[pa.RecordBatch]):
        names, *of_name = shared.value
        for b in steps(batches, limit=STEP):
            words, codes, first = word_codes(pc.ascii_lower(b.column(1)))
            at = pc.fill_null(pc.index_in(words.cast(names.type), names), len(names)).to_numpy(zero_copy_only=False)
            c, *logs = (x[at] for x in of_name)

            def summed(of_word: np.ndarray) -> np.ndarray:
                """Sums of a number of each word, by document."""
                return np.diff(np.append(0.0, np.cumsum(of_word[codes]))[first])

            rows, size, serial = b.num_rows, np.diff(first), b.column(2)
            sums = [pa.array(summed(x)) for x in (np.where(c > 0, np.log10(c + 1.0), 0.0), *logs)]
            yield pa.RecordBatch.from_arrays([b.column(0), serial, pa.array(size + 1, pa.int64()), pa.array(np.rint(summed(c > 0)).astype(np.int64)), *sums, pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int64())], columns)
            tail = np.flatnonzero((at == len(names))[codes])
            if len(tail):
                doc = np.repeat(np.arange(rows), size)[tail]
                key, times = np.unique(doc * len(words) + codes[tail], return_counts=True)
                where = pa.array(key // len(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(where), serial.take(where), *(pa.nulls(len(key), t) for t in (pa.int64(), pa.int64(), *[pa.float64()] * len(sums))), words.take(pa.array(key % len(words))).cast(pa.string()), pa.array(times, pa.int64())], columns
                )

    schema = "doc_id long, serial long, n_tokens long, n_known long, " + ", ".join(f"{c} double" for c in parts) + ", word string, times long"
    columns = [x.split()[0] for x in schema.split(", ")]
    found = materialise(every.withColumn("serial", F.monotonically_increasing_id()).mapInArrow(lean(run), schema), "zstd")
    whole = found.filter("word is null").select("doc_id", "serial", "n_tokens", "n_known", *parts)
    # Words outside the head occur in few documents each, so no key is hot.
    rest = found.filter("word is not null").select("serial", "word", "times").join(scored.drop("every"), "word")
    of = {"base": F.when(known, F.log10(F.col("c") + 1)).otherwise(0.0), **{c: F.col(c) for c in parts[1:]}}
    rest = rest.select(F.lit(None).cast("long").alias("doc_id"), "serial", F.lit(None).cast("long").alias("n_tokens"), F.when(known, F.col("times")).otherwise(0).alias("n_known"), *[(F.col("times") * of[c]).alias(c) for c in parts])
    both = whole.unionByName(rest).groupBy("serial").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), *[F.sum(c).alias(c) for c in ("n_known", *parts)])
    known_end = int(ends > 0)
    end = {"base": float(np.log10(ends + 1)), "score": given.end / _LOG10, "adapted": model.end / _LOG10}
    whole_text = {c: F.col(c) + F.lit(end[c]) for c in end} | {"lexicon": F.col("lexicon") + lexicon.score(F.lit(ends), F.lit(end["adapted"]))}
    return both.select(
        "doc_id", "n_tokens", (F.col("n_known") + known_end).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (whole_text["base"] - F.col("n_tokens") * F.lit(floor)).alias("base_score"), whole_text["score"].alias("score"), whole_text["adapted"].alias("adapted_score"), whole_text["lexicon"].alias("lexicon_score"),
    )
