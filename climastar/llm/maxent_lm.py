"""Language-model scoring: hashed maximum-entropy model with class-factored softmax.

P(word | context) = P(class | context) x P(word | class, context).  Both factors are softmaxes of 64 outcomes over the same hashed
features of the three words before: one word, two words, the second and the third alone.  A frequent word is a class of its own;
others share classes that cluster their endings by the words they follow, in which the 63 most frequent are outcomes and the
remaining ones one more, shared out by smoothed counts.

Training is synchronous: every round sums over all tasks before anything is updated, so that the result does not depend on how the
corpus is dealt.  The first round is closed: from weights of zero the expected counts of a feature are its total times the
prior, and the step (as in iterative scaling) is the smoothed logarithm of observed over expected, over all training text.  Later rounds fit the step
sizes, by feature kind and by how often the feature was seen, on all training text too: each takes the next, larger part of the documents, sums the
gradient of the likelihood and its outer products (whose expectation is the curvature), and takes a Newton step by the curvature of all rounds so
far.  So every document counts in the steps and, once, in their sizes; there each decision is left out of the counts that judge it.

Words are looked up once: a written table has the codes of every text, which counting, fitting and scoring read.

The feature table has a row for every ``DECISIONS_PER_ROW`` training tokens, up to ``MOST_ROWS``, for each feature.  Unigram counts cover all
training text and stay distributed: only words of at least a threshold frequency, at most ``TOP_WORDS`` of them, are broadcast;
counts of the others are joined.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .langid import held_out
from .simhash_dedup import word_blocks

END = b"\n"                  # no word: words have no white space
ALPHA = 0.1
TOP_WORDS = 1 << 17
OUT = 64                     # outcomes of a softmax
OWN_CLASSES = 40             # the end and the most frequent words
SHARED = OUT - OWN_CLASSES
ENDINGS = 256
FEATURES = 4
DECISIONS_PER_ROW = 1024
LEAST_ROWS, MOST_ROWS = 1 << 10, 1 << 13       # of each feature
SMOOTH = 4.0                 # prior decisions of a feature
SEEN = 16                    # buckets of how often a feature was seen
MOST_STEP, MOST_SIZE = 12.0, 1.6      # four of them stay within single precision under an exponential
LEAST_SIZE = 1e-3            # weights are divided by it
STEP = 0.4                   # step sizes at first,
RIDGE = 10.0                 # and how much they are held there
PARTS = 64                   # of the documents; the rounds take
ROUNDS = 1, 7, 56            # so many of them, all in the end
BATCH = 1 << 16              # tokens laid out at a time,
COUNTED = 1 << 19            # whose features are counted at once,
MOST_COUNTED = 1 << 30       # and in one table of 32-bit counts
ROWS = 2048                  # texts scored at a time
CHUNK = 1 << 10              # decisions in one softmax
BLOCKS = 64                  # slices in which the table is summed
CACHE = 100_000
_BYTES = 1 << 20             # of texts whose words are numbered together (twice as many for codes),
_FLUSH = 75_000              # and distinct words that are counted together, at least
PLACES = 2 * FEATURES * SEEN
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WHITE = b"\x20\t\n\v\f\r"
_SOLID = bytes(x not in _WHITE for x in range(256))


def ending(word: bytes) -> int:
    """Bucket of a word by its last three letters (punctuation aside, of its last eight bytes)."""
    return xxhash.xxh32_intdigest(word[-8:].rstrip(b".,;:!?")[-3:]) % ENDINGS if word != END else 0


class _Endings(dict):
    """last four bytes of a word -> ending, -1 where it hangs on the bytes before them"""

    def __missing__(self, last: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[last] = code = -1 if len(last) == 4 and len(last.rstrip(b".,;:!?")) < 3 else ending(last)
        return code

    def of(self, words: list[bytes]) -> list[int]:
        codes = [self[w[-4:]] for w in words]
        if -1 in codes:
            codes = [ending(w) if c < 0 else c for w, c in zip(words, codes)]
        return codes

    def of_array(self, words: pa.Array) -> np.ndarray:
        """As ``of`` a column of words."""
        if not len(words):
            return np.zeros(0, np.int64)
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
        data = np.frombuffer(data, np.uint8)
        length = np.diff(offsets)
        last = np.minimum(length, 4) << 32                   # number and value of the last four bytes, of which few differ
        for k in range(4):
            last |= np.where(length > k, data.take(offsets[1:] - 1 - k, mode="clip"), 0).astype(np.int64) << 8 * k
        last = pa.array(last).dictionary_encode()
        ends = [(x & 0xFFFFFFFF).to_bytes(4, "big")[4 - (x >> 32):] for x in last.dictionary.to_pylist()]
        codes = np.array([self[x] for x in ends], np.int64)[last.indices.to_numpy()]
        at = np.flatnonzero(codes < 0)
        codes[at] = [ending(w) for w in words.take(pa.array(at)).to_pylist()]
        return codes


@dataclass
class Words:
    """Words of consecutive texts, by their place among the distinct ones."""

    distinct: pa.Array
    index: np.ndarray
    ends: np.ndarray                      # words before each end of a text


def _numbered(texts: pa.Array, size: int) -> Iterator[Words]:
    """Words, A-Z lower-cased, of a column of texts (null: empty) in pieces of about ``size`` bytes; a long text goes on in the next one, cut
    at white space."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = memoryview(data or b"")
    at, done, stop = int(offsets[0]), 1, int(offsets[-1])
    while done < len(offsets):
        end = min(at + size, stop)
        if end < stop:                                       # on to the next end of a text or white space
            end = int(offsets[np.searchsorted(offsets, end)])
            for cut in range(at + size, end, size):
                white = re.search(rb"[\x20\x09-\x0D]", data[cut:min(cut + size, end)])
                if white:
                    end = cut + white.start()
                    break
        raw = bytes(data[at:end]).lower()
        upto = done + int(np.searchsorted(offsets[done:], end, side="right"))
        ends = offsets[done:upto] - at
        solid = np.frombuffer(raw.translate(_SOLID), bool)
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        cuts = ends[(ends > 0) & (ends < len(raw))]
        first[cuts], last[cuts - 1] = solid[cuts], solid[cuts - 1]
        starts = np.flatnonzero(first)
        places = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(np.flatnonzero(last) + 1 - starts, out=places[1:])
        del solid, first, last
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(raw.translate(None, _WHITE))])
        words = words.dictionary_encode()
        yield Words(words.dictionary.cast(pa.binary()), words.indices.to_numpy(), np.searchsorted(starts, ends))
        at, done = end, upto


# --- counts ------------------------------------------------------------------------------------

def count_words(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(token binary, ending int, c long) of column ``text``, one end per row included, written; and how
    often words of one ending follow those of another (ENDINGS x ENDINGS)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "ending", "c"]
        seen: list[pa.RecordBatch] = []
        pairs = np.zeros(ENDINGS * ENDINGS, np.int64)
        codes, texts = _Endings(), 0

        def merged() -> pa.Table:
            together = pa.Table.from_batches(seen).group_by("token", use_threads=False).aggregate([("ending", "max"), ("c", "sum")])
            return together.select(["token", "ending_max", "c_sum"]).rename_columns(names)

        for b in batches:
            last = np.zeros(0, np.int64)
            for words in _numbered(b.column(0), _BYTES):
                own = codes.of_array(words.distinct)
                follow = np.concatenate([last, own[words.index]])
                other = np.ones(len(follow), bool)            # words that follow another in their text
                other[:1] = False
                first = words.ends + len(last)                # of the next text
                other[first[first < len(follow)]] = False
                at = np.flatnonzero(other)
                pairs += np.bincount(follow[at] * ENDINGS + follow[at - 1], minlength=len(pairs))
                last = follow[first[-1] if len(first) else 0:][-1:]
                seen.append(pa.RecordBatch.from_arrays([words.distinct, pa.array(own.astype(np.int32)),
                                                        pa.array(np.bincount(words.index, minlength=len(own)))], names=names))
                if sum(x.num_rows for x in seen) > 2 * _FLUSH:
                    together = merged()
                    seen = together.to_batches()
                    if together.num_rows > _FLUSH:
                        yield from seen
                        seen = []
            texts += b.num_rows
        if seen:
            yield from merged().to_batches()
            seen = []
        pa.default_memory_pool().release_unused()             # other tasks run in this worker
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array([END] * (texts > 0) + [None] * len(at), pa.binary()), pa.array([ending(END)] * (texts > 0) + at.tolist(), pa.int32()),
                                          pa.array([texts] * (texts > 0) + pairs[at].tolist(), pa.int64())], names=names)

    counted = staged(docs.select("text").mapInArrow(run, "token binary, ending int, c long")
                     .groupBy("token", "ending").agg(F.sum("c").alias("c")), "lm-counts")
    follow = np.zeros(ENDINGS * ENDINGS)
    for r in counted.where("token is null").select("ending", "c").collect():      # at most ENDINGS x ENDINGS
        follow[r.ending] = r.c
    return counted.where("token is not null"), follow.reshape(ENDINGS, ENDINGS)


def cluster_endings(follow: np.ndarray, k: int, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """k classes of endings by k-means over what they follow (logarithm of how much likelier than by chance)."""
    total = follow.sum() + 1e-9
    chance = (follow.sum(1, keepdims=True) + 1.0) * (follow.sum(0, keepdims=True) + 1.0) / total
    x = np.log((follow + 1.0) / (chance + 1.0))
    weight = follow.sum(1) + 1e-9
    x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), k, replace=False, p=weight / weight.sum())] if (weight > 1).sum() >= k else x[:k]
    label = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        label = ((x[:, None, :] - centre[None]) ** 2).sum(2).argmin(1)
        for j in range(k):
            if (label == j).any():
                centre[j] = np.average(x[label == j], axis=0, weights=weight[label == j])
    return label


# --- model -------------------------------------------------------------------------------------

@dataclass
class Vocabulary:
    """What every task needs of the words; of bounded size."""

    n: int                                # training tokens
    v: int                                # distinct ones
    top: dict[bytes, int]                 # word -> index from 1
    logp: np.ndarray                      # base log10 probability by that index
    place: dict[bytes, tuple[int, int]]   # words that are an outcome: class, and outcome in it
    shared: np.ndarray                    # class by ending
    prior: np.ndarray                     # P(outcome) by counts: of classes, then in each shared class
    codes: np.ndarray | None = None       # see _Codes, by index in top

    def slim(self) -> Vocabulary:
        """Without the words, for texts that are packed."""
        codes, words = np.zeros(len(self.top) + 1, np.int64), _Codes(self)
        for word, at in self.top.items():
            codes[at] = words.__missing__(word)
        return replace(self, top={}, logp=np.zeros(1), place={}, codes=codes)

    def base(self, c):
        return np.log10((c + ALPHA) / (self.n + ALPHA * (self.v + 1)))


class _Codes(dict):
    """word -> outcome in its class << 56 | class << 50 | index in top (0: not there) << 32 | hash."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.place, self.top, self.shared, self.endings = vocabulary.place, vocabulary.top, vocabulary.shared.tolist(), _Endings()
        self.classes = vocabulary.shared.astype(np.int64)

    def __missing__(self, word: bytes) -> int:
        top = self.top.get(word)
        at = self.endings[word[-4:]]
        shared = self.shared[ending(word) if at < 0 else at]
        if top is None:                                      # such words seldom come again, and are no outcomes
            return shared << 50 | xxhash.xxh32_intdigest(word)
        cls, member = self.place.get(word) or (shared, 0)
        self[word] = code = member << 56 | cls << 50 | top << 32 | xxhash.xxh32_intdigest(word)
        return code

    def of_array(self, words: pa.Array, top: pa.Array, codes: np.ndarray) -> np.ndarray:
        """Of a column of words; ``top`` has those of the vocabulary in their order, ``codes`` theirs by index."""
        found = pc.index_in(words, value_set=top).fill_null(-1).to_numpy()
        out = codes[found + 1]
        at = np.flatnonzero(found < 0)
        others = words.take(pa.array(at))
        out[at] = self.classes[self.endings.of_array(others)] << 50
        out[at] |= np.array([xxhash.xxh32_intdigest(w) for w in others.to_pylist()], np.int64)
        return out


def vocabulary(counts: DataFrame, follow: np.ndarray) -> Vocabulary:
    s = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # The least count that at most TOP_WORDS words have, to an eighth of an octave.
    step = F.floor(F.log2("c") * 8).cast("int").alias("k")
    steps = sorted(((r.k, r["count"]) for r in counts.groupBy(step).count().collect()), reverse=True)
    found, least = 0, None
    for k, n in steps:
        if found + n > TOP_WORDS:
            break
        found, least = found + n, k
    rows = [] if least is None else counts.where(step >= least).select("token", "c").collect()          # at most TOP_WORDS
    rows = sorted(((bytes(r.token), r.c) for r in rows), key=lambda r: (r[0] != END, -r[1], r[0]))
    shared = OWN_CLASSES + cluster_endings(follow, SHARED)
    place = {w: (i, 0) for i, (w, _) in enumerate(rows[:OWN_CLASSES])}
    mass = np.full(OUT, ALPHA)                                # room for an unknown word in every class
    inside = np.zeros((SHARED, OUT))
    for r in counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        mass[shared[r.ending]] += r.c + ALPHA * r.n
    for w, c in rows[:OWN_CLASSES]:
        mass[shared[ending(w)]] -= c + ALPHA
        mass[place[w][0]] += c + ALPHA
    taken = [1] * SHARED
    for w, c in rows[OWN_CLASSES:]:
        cls = int(shared[ending(w)]) - OWN_CLASSES
        if taken[cls] < OUT:
            place[w] = cls + OWN_CLASSES, taken[cls]
            inside[cls, taken[cls]] = c + ALPHA
            taken[cls] += 1
    inside[:, 0] = np.maximum(mass[OWN_CLASSES:] - inside.sum(1), ALPHA)
    prior = np.concatenate([mass[None] / (s.n + ALPHA * (s.v + 1)), inside / inside.sum(1, keepdims=True)])
    out = Vocabulary(s.n, s.v, {w: i + 1 for i, (w, _) in enumerate(rows)}, np.zeros(len(rows) + 1), place, shared, np.maximum(prior, 1e-30))
    out.logp[1:] = out.base(np.array([c for _, c in rows], float))
    return out


@dataclass
class Decisions:
    """Softmax decisions of some tokens: the class of each, and the word in it where the class is shared."""

    rows: np.ndarray                      # of the feature table, FEATURES x n
    kind: np.ndarray                      # 0: among classes, else in that shared class
    out: np.ndarray                       # what was decided
    token: np.ndarray                     # whose decision it is


def row_count(bits: int) -> int:
    """Rows of the table: 2 ** bits for each feature's class decisions, and a sixteenth of that for those in each shared class."""
    return FEATURES * ((1 << bits) + SHARED * (1 << bits - 4))


def row_kinds(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Kind of decision and feature of every row of the table."""
    kinds = np.concatenate([np.zeros(1 << bits, np.int64), np.repeat(np.arange(1, SHARED + 1), 1 << bits - 4)])
    return np.tile(kinds, FEATURES), np.repeat(np.arange(FEATURES), len(kinds))


def decisions(codes: np.ndarray, starts: np.ndarray, real: np.ndarray, bits: int) -> Decisions:
    """Of the tokens that are ``real``; ``starts``: place of the document's first token known for each."""
    h = (codes & 0xFFFFFFFF).astype(np.uint64)
    at = np.flatnonzero(real)
    before = at - starts[at]                                 # tokens of the document

    def back(k: int) -> np.ndarray:
        return np.where(before >= k, h.take(at - k, mode="wrap"), np.uint64(0x5EED + k))

    p1, p2, p3 = back(1), back(2), back(3)
    seen = np.stack([p1 + np.uint64(1), p1 * np.uint64(31) + p2 * np.uint64(0xC2B2AE3D) + np.uint64(2), p2 + np.uint64(3 << 40), p3 + np.uint64(5 << 40)]) * _MIX
    mine = codes[at]
    cls, member = mine >> 50 & 63, mine >> 56
    inner = np.flatnonzero(cls >= OWN_CLASSES)
    kind = cls[inner] - OWN_CLASSES
    n, low = len(at), (kind << bits - 4) + (1 << bits)
    rows = np.empty((FEATURES, n + len(inner)), np.int64)
    for f, x in enumerate(seen):
        first = f * (row_count(bits) // FEATURES)
        np.add((x >> np.uint64(64 - bits)).view(np.int64), first, out=rows[f, :n])
        np.add((x[inner] >> np.uint64(64 - (bits - 4))).view(np.int64), low + first, out=rows[f, n:])
    return Decisions(rows, np.concatenate([np.zeros(len(at), np.int64), kind + 1]), np.concatenate([cls, member[inner]]),
                     np.concatenate([np.arange(len(at)), inner]))


class Model:
    """Hashed weights: a step for every row and outcome, times the step size of the row's place, which is its sort of decision (among
    classes or in one), its feature and how often it was seen."""

    def __init__(self, vocabulary: Vocabulary, bits: int, counts: np.ndarray, size: np.ndarray | None = None):
        self.vocabulary, self.bits = vocabulary, bits
        kinds, features = row_kinds(bits)
        self.steps = np.empty(counts.shape, np.float32)
        total = counts.sum(axis=1, dtype=np.float64)
        for at in range(0, len(counts), 1 << 12):            # a few megabytes at a time
            part = slice(at, at + (1 << 12))
            prior, n = vocabulary.prior[kinds[part]], total[part, None]
            self.steps[part] = np.log((counts[part] + SMOOTH * prior) / ((n + SMOOTH) * prior)).clip(-MOST_STEP, MOST_STEP)
        self.total = total.astype(np.float32)
        seen = np.minimum(np.log2(total + 1).astype(np.int64), SEEN - 1)
        self.place = (((kinds > 0) * FEATURES + features) * SEEN + seen).astype(np.int32)
        self.size = np.full(PLACES, STEP) if size is None else size
        self.base = np.log(vocabulary.prior).astype(np.float32)

    def odds(self, weights: np.ndarray) -> np.ndarray:
        """Exponentials of the weights, those of the first feature times the outcomes' prior: a decision's product of its rows is in
        proportion to the outcomes' probabilities."""
        odds = np.exp(weights)
        kinds, _ = row_kinds(self.bits)
        for at in range(0, len(odds) // FEATURES, 1 << 12):
            part = slice(at, min(at + (1 << 12), len(odds) // FEATURES))
            odds[part] *= self.vocabulary.prior[kinds[part]]
        return odds

    def scorer(self) -> Callable[[Decisions], np.ndarray]:
        """Natural logarithm of every decision's probability."""
        odds = self.odds(self.weights())

        def log_probability(d: Decisions) -> np.ndarray:
            out = np.zeros(len(d.out))
            s, one = np.empty((CHUNK, OUT), np.float32), np.empty((CHUNK, OUT), np.float32)       # small enough to stay in the cache
            for at in range(0, len(d.out), CHUNK):
                part = slice(at, at + CHUNK)
                m = len(d.out[part])
                mine, more = s[:m], one[:m]
                odds.take(d.rows[0, part], axis=0, out=mine, mode="clip")
                for rows in d.rows[1:-1]:
                    odds.take(rows[part], axis=0, out=more, mode="clip")
                    mine *= more
                odds.take(d.rows[-1, part], axis=0, out=more, mode="clip")
                decided = np.log(odds.ravel().take(d.rows[:, part] * OUT + d.out[part], mode="clip"), dtype=float).sum(axis=0)
                out[part] = decided - np.log(np.vecdot(mine, more), dtype=float)
            return out

        return log_probability

    def slopes(self, d: Decisions) -> tuple[np.ndarray, np.ndarray, float]:
        """Gradient and curvature of the log likelihood by the step sizes, and the log likelihood."""
        grad, curve, likelihood = np.zeros(PLACES), np.zeros(PLACES * PLACES), 0.0
        for at in range(0, len(d.out), CHUNK):
            part = slice(at, at + CHUNK)
            places = [self.place[rows[part]].astype(np.int64) for rows in d.rows]
            steps = [self.steps.take(rows[part], axis=0) for rows in d.rows]
            s = self.base[d.kind[part]]
            for x, place in zip(steps, places):
                s += x * self.size.astype(np.float32)[place][:, None]
            s -= s.max(axis=1, keepdims=True)
            n = np.arange(len(s))
            mine = s[n, d.out[part]].astype(float)
            p = np.exp(s, out=s)
            total = p.sum(axis=1, keepdims=True)
            likelihood += float((mine - np.log(total[:, 0])).sum())
            p /= total
            weighted = [p * x for x in steps]
            mean = [x.sum(axis=1) for x in weighted]
            for j in range(FEATURES):
                grad += np.bincount(places[j], steps[j][n, d.out[part]] - mean[j], minlength=PLACES)
                for k in range(j, FEATURES):
                    both = np.einsum("ij,ij->i", weighted[j], steps[k]) - mean[j] * mean[k]
                    curve += np.bincount(places[j] * PLACES + places[k], both, minlength=PLACES * PLACES)
                    if k > j:
                        curve += np.bincount(places[k] * PLACES + places[j], both, minlength=PLACES * PLACES)
        return grad, curve, likelihood


    def weights(self) -> np.ndarray:
        return self.steps * self.size.astype(np.float32)[self.place][:, None]

    def slopes_left_out(self, d: Decisions, weights: np.ndarray, odds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """As ``slopes``, with each decision left out of the counts that it is judged by, and the sum of the gradients' outer products
        for the curvature; ``odds`` are those of the weights."""
        n = len(d.out)
        odds = self.odds(weights) if odds is None else odds
        decided, norm = np.empty(n, np.float32), np.empty(n, np.float32)
        own, mean = np.empty((FEATURES, n), np.float32), np.empty((FEATURES, n), np.float32)
        s, one = np.empty((CHUNK, OUT), np.float32), np.empty((CHUNK, OUT), np.float32)
        flat, ones = weights.ravel(), np.ones(OUT, np.float32)
        for at in range(0, n, CHUNK):
            part = slice(at, at + CHUNK)
            m = len(d.out[part])
            mine, more = s[:m], one[:m]
            odds.take(d.rows[0, part], axis=0, out=mine, mode="clip")
            for rows in d.rows[1:]:
                odds.take(rows[part], axis=0, out=more, mode="clip")
                mine *= more
            decided[part] = mine[np.arange(m), d.out[part]]
            np.vecdot(mine, ones, out=norm[part])            # a sum that does not hang on the place in the batch
            for j, rows in enumerate(d.rows):
                weights.take(rows[part], axis=0, out=more, mode="clip")
                np.vecdot(mine, more, out=mean[j, part])
            flat.take(d.rows[:, part] * OUT + d.out[part], out=own[:, part], mode="clip")
        # Sums of weights are those of steps times the sizes.
        places = self.place.take(d.rows, mode="clip")
        weight = self.size.astype(np.float32).take(places, mode="clip")
        own /= weight
        mean /= weight
        # Only the step of what was decided has one less in its count; a smaller total moves all outcomes alike.
        prior = self.vocabulary.prior.astype(np.float32).ravel().take(d.kind * OUT + d.out, mode="clip")
        count = np.exp(own) * (self.total.take(d.rows, mode="clip") + np.float32(SMOOTH)) * prior
        less = own + np.log(np.maximum(count - 1, np.float32(SMOOTH) * prior) / count)
        less = np.clip(less, -MOST_STEP, MOST_STEP)
        without = decided * np.exp(((less - own) * weight).sum(axis=0))
        total = np.maximum(norm - decided, 0) + without
        slope = (less - (mean - decided * own + without * less) / total).astype(float)
        places = places.astype(np.int64)
        grad, curve = np.zeros(PLACES), np.zeros(PLACES * PLACES)
        for j in range(FEATURES):
            grad += np.bincount(places[j], slope[j], minlength=PLACES)
            for k in range(j, FEATURES):
                both = np.bincount(places[j] * PLACES + places[k], slope[j] * slope[k], minlength=PLACES * PLACES)
                curve += both
                if k > j:
                    curve += both.reshape(PLACES, PLACES).T.ravel()
        return grad, curve, float(np.log(np.maximum(without / total, 1e-30)).sum(dtype=float))


# --- passes over texts ---------------------------------------------------------------------------

def _pieces(texts: Iterator[str | None], codes: _Codes) -> Iterator[tuple[int, np.ndarray, int, list[bytes]]]:
    """(index of the text, codes, how many of them only are context, words) in pieces: a very long text comes in several, each with
    the codes of the three words before it; the last has the end."""
    for i, t in enumerate(texts):
        before = np.zeros(0, np.int64)
        held: list[bytes] | None = None
        for words in word_blocks(t or ""):
            if held:
                c = np.concatenate([before, np.fromiter(map(codes.__getitem__, held), np.int64, len(held))])
                yield i, c, len(before), held
                before = c[-3:]
            held = words
        held = [*(held or []), END]
        yield i, np.concatenate([before, np.fromiter(map(codes.__getitem__, held), np.int64, len(held))]), len(before), held


class _Layout:
    """Pieces laid out one after the other."""

    def __init__(self):
        self.codes, self.starts, self.real, self.doc, self.size = [], [], [], [], 0

    def add(self, i: int, codes: np.ndarray, context: int) -> None:
        real = np.ones(len(codes), bool)
        real[:context] = False
        self.codes.append(codes)
        self.starts.append(np.full(len(codes), self.size))
        self.real.append(real)
        self.doc.append(np.full(len(codes) - context, i))
        self.size += len(codes)

    def decisions(self, bits: int) -> Decisions:
        return decisions(*(np.concatenate(x) for x in (self.codes, self.starts, self.real)), bits)


def _packed(codes: np.ndarray) -> tuple[bytes, bytes]:
    """Five bytes a token: index in top and 0, or hash and 1 + shared class."""
    top = codes >> 32 & 0x3FFFF
    return (np.where(top > 0, top, codes & 0xFFFFFFFF).astype("<u4").tobytes(),
            np.where(top > 0, 0, (codes >> 50 & 63) - OWN_CLASSES + 1).astype(np.uint8).tobytes())


def _cut(data: bytes, lengths: np.ndarray) -> pa.Array:
    """Binary values of the ``lengths`` that lie one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(b: pa.RecordBatch, table: np.ndarray, size: int) -> Iterator[_Layout]:
    """Layouts of ``size`` tokens of whole packed texts; a text that goes on has the three codes before."""
    lengths = pc.binary_length(b.column("kind")).to_numpy(zero_copy_only=False)
    begin = np.cumsum(lengths) - lengths
    code = np.frombuffer(b"".join(b.column("code").to_pylist()), "<u4")
    kind = np.frombuffer(b"".join(b.column("kind").to_pylist()), np.uint8)
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    for at in range(0, len(code), size):
        context = min(3, at)
        part = slice(at - context, at + size)
        c, k = code[part], kind[part].astype(np.int64)
        now = _Layout()
        now.codes = [np.where(k == 0, table[np.where(k == 0, c, 0)], k + (OWN_CLASSES - 1) << 50 | c)]
        now.starts = [np.maximum(begin[doc[part]] - (at - context), 0)]
        now.real = [np.arange(len(c)) >= context]
        now.doc = [doc[at:at + size]]
        now.size = len(c)
        yield now


def _columns(docs: DataFrame) -> list[str]:
    """Column ``text``, or without it ``code`` and ``kind`` of the packed text."""
    return ["text"] if "text" in docs.columns else ["code", "kind"]


def _laid_out(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, size: int) -> Iterator[_Layout]:
    codes, now = _Codes(vocabulary), _Layout()
    for b in batches:
        if "text" not in b.schema.names:
            yield from _unpacked(b, vocabulary.codes, size)
            continue
        for i, c, context, _ in _pieces((t.as_py() for t in b.column("text")), codes):
            now.add(i, c, context)
            if now.size >= size:
                yield now
                now = _Layout()
    if now.size:
        yield now


def feature_counts(docs: DataFrame, vocabulary: Vocabulary, bits: int) -> np.ndarray:
    """How often each row of the table met each outcome in column ``text`` (or packed ones): rows x OUT, summed exactly over all tasks, and
    returned in single precision."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "block int, salt int, w binary"
    size = row_count(bits) * OUT
    per = size // FEATURES

    def packed(block, salt, parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(salt, pa.int32()), pa.array([x.astype("<i8" if x.max(initial=0) >> 31 else "<i4").tobytes()
                                          for x in parts], pa.binary())], names=["block", "salt", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counted, held, found = None, 0, 0, []
        part = TaskContext.get().partitionId() % 16

        def settle() -> None:
            """Counts the places held, a feature at a time: its rows lie together."""
            for f in range(FEATURES):
                mine = total[f * per:(f + 1) * per]
                np.add(mine, np.bincount(np.concatenate([x[f] for x in found]), minlength=per), out=mine, casting="unsafe")
            found.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for i, x in enumerate(np.split(total, BLOCKS)):
                yield packed([i], [part], [x])

        for now in _laid_out(batches, shared.value, BATCH):
            if total is None:
                total = np.zeros(size, np.int32)
            d = now.decisions(bits)
            found.append([((rows - f * per // OUT) * OUT + d.out).astype(np.int32) for f, rows in enumerate(d.rows)])
            held += now.size
            counted += now.size
            if held >= COUNTED:
                settle()
                held = 0
            if counted >= MOST_COUNTED:
                if found:
                    settle()
                yield from out()
                total[:], counted, held = 0, 0, 0
        if total is not None:
            if found:
                settle()
            yield from out()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sum of the slices of each (block, salt), as they stream by."""
        last, total = None, None
        for b in batches:
            for block, salt, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = raw.as_buffer()
                x = np.frombuffer(raw, "<i8" if raw.size == size // BLOCKS * 8 else "<i4")
                if (block, salt) != last:
                    if last is not None:
                        yield packed([last[0]], [last[1]], [total])
                    last, total = (block, salt), x.astype(np.int64)
                else:
                    total += x
        if last is not None:
            yield packed([last[0]], [last[1]], [total])

    part = docs.select(*_columns(docs)).mapInArrow(run, schema)
    for keys in (["block", "salt"], ["block"]):              # two steps, so that no task reads a slice of every task
        part = part.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(summed, schema)
        part = part.withColumn("salt", F.lit(0))
    out = np.zeros(size, np.float32)
    slices = np.split(out, BLOCKS)
    for r in part.toLocalIterator():                         # BLOCKS rows
        slices[r.block][:] = np.frombuffer(r.w, "<i8" if len(r.w) == size // BLOCKS * 8 else "<i4")
    shared.destroy()
    return out.reshape(-1, OUT)


def newton_round(docs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient, curvature and log likelihood (see ``Model.slopes_left_out``) summed over column ``text`` (or packed ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    size = PLACES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total = shared.value, np.zeros(size + size * size + 1)
        weights = m.weights()
        odds = m.odds(weights)
        for now in _laid_out(batches, m.vocabulary, BATCH):
            grad, curve, likelihood = m.slopes_left_out(now.decisions(m.bits), weights, odds)
            total += np.concatenate([grad, curve, [likelihood]])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "x"])

    out = np.zeros(size + size * size + 1)
    for at, x in docs.select(*_columns(docs)).mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x")).collect():     # a row for each sum
        out[at] = x
    shared.destroy()
    return out[:size], out[size:-1].reshape(size, size), float(out[-1])


def part_of(text: Column) -> Column:
    """One of ``PARTS`` parts by a text's hash: equal texts lie in one."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(PARTS)).cast("int")


def train(learn: DataFrame, vocabulary: Vocabulary) -> Model:
    """Fits all rows of column ``text``, or of ``code``, ``kind`` and ``part``: all of them are counted, and each is in the part of
    one round that fits the step sizes."""
    wanted = max(LEAST_ROWS, min(MOST_ROWS, vocabulary.n // DECISIONS_PER_ROW))
    bits = int(wanted).bit_length() - 1
    model = Model(vocabulary, bits, feature_counts(learn, vocabulary, bits))
    if "part" not in learn.columns:
        learn = learn.withColumn("part", part_of(F.col("text")))
    known, first = RIDGE * np.eye(PLACES), 0
    for parts in ROUNDS:
        grad, curve, _ = newton_round(learn.where(F.col("part").between(first, first + parts - 1)), model)
        known += curve
        size = (model.size + np.linalg.solve(known, grad)).clip(-MOST_SIZE, MOST_SIZE)
        model.size = np.where(np.abs(size) < LEAST_SIZE, LEAST_SIZE, size)
        first += parts
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows whose crc32(id as text) modulo 10 is not 0; rows without an id are scored only.  Tokens are
    words, A-Z lower-cased, and one end per text; NULL and blank texts have the end alone.  Scores are log10
    probabilities.  Without training rows all counts are zero and the score is the base score.  A text's context reaches over any length; sums do
    not depend on the number of tasks but for rounding.  Repeated rows
    count and are scored each; other columns are ignored; an empty table gives an empty result."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("held", held_out("id", 10, 0))
    learn = rows.where(~F.col("held")).select("text")
    counts, follow = count_words(learn)
    voc = vocabulary(counts, follow)
    slim = voc.slim()
    top_words = pa.array(voc.top, pa.binary())
    shared = docs.sparkSession.sparkContext.broadcast((replace(voc, top={}, place={}, codes=slim.codes), top_words))
    id_type = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, top_words = shared.value
        codes = _Codes(voc)
        end = int(codes.of_array(pa.array([END], pa.binary()), top_words, voc.codes)[0])
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            k, done = b.num_rows, 0
            n, known, base, rare = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k), np.zeros(k, np.int64)
            packed: list[tuple[bytes, bytes]] = []
            words, times = [], []
            for piece in _numbered(b.column("text"), 2 * _BYTES):
                own = codes.of_array(piece.distinct, top_words, voc.codes)
                c = np.insert(own[piece.index], piece.ends, end)
                packed.append(_packed(c))
                begun = np.concatenate([[0], piece.ends])    # the last text may go on
                doc = done + np.repeat(np.arange(len(begun)), np.diff([*begun, len(piece.index)]) + (np.arange(len(begun)) < len(piece.ends)))
                top = c >> 32 & 0x3FFFF
                n += np.bincount(doc, minlength=k)
                known += np.bincount(doc[top > 0], minlength=k)
                base += np.bincount(doc, voc.logp[top], minlength=k)
                # Each text's words that are not broadcast, and how often.
                at = np.flatnonzero(own[piece.index] >> 32 & 0x3FFFF == 0)
                text = done + np.searchsorted(piece.ends, at, side="right")
                both, often = np.unique(text * len(own) + piece.index[at], return_counts=True)
                rare += np.bincount(both // max(len(own), 1), minlength=k)
                words.append(piece.distinct.take(pa.array(both % max(len(own), 1))))
                times.append(often)
                done += len(piece.ends)
            offsets = pa.array(np.concatenate([[0], np.cumsum(rare)]).astype(np.int32))
            words = pa.ListArray.from_arrays(offsets, pa.concat_arrays(words))
            times = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times)))
            code, kind = (_cut(b"".join(x[j] for x in packed), n * width) for j, width in enumerate((4, 1)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held"), b.column("part"), pa.array(n), pa.array(known), pa.array(base),
                                              code, kind, words, times],
                                             names=["id", "held", "part", "n", "known", "base", "code", "kind", "rare", "times"])

    first = staged(rows.withColumn("part", part_of(F.col("text")))
                   .mapInArrow(encode, f"id {id_type}, held boolean, part int, n long, known long, base double, code binary, kind binary, "
                                       "rare array<binary>, times array<long>")
                   .withColumn("row", F.monotonically_increasing_id()), "lm-codes")       # a label, fixed by the written table
    # Without training rows no decision is made.
    model = train(first.where(~F.col("held")).select("code", "kind", "part"), slim) if voc.n else None
    fitted = docs.sparkSession.sparkContext.broadcast(model)

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.value
        log_probability = model.scorer() if model else None
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            gain = np.zeros(b.num_rows)
            for now in _unpacked(b, model.vocabulary.codes, BATCH) if model else ():
                d = now.decisions(model.bits)
                better = log_probability(d) - np.log(model.vocabulary.prior)[d.kind, d.out]
                gain += np.bincount(np.concatenate(now.doc)[d.token], better / np.log(10), minlength=len(gain))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(gain)], names=[*kept, "gain"])

    kept = ["row", "id", "held", "n", "known", "base"]
    scored = first.select(*kept, "code", "kind").mapInArrow(gains, f"row long, id {id_type}, held boolean, n long, known long, base double, gain double")
    # Counts of the words that are not broadcast.
    rare = (first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("row", F.col("x.rare").alias("token"), F.col("x.times").alias("times")))
    one = F.log10((F.coalesce("c", F.lit(0)) + F.lit(ALPHA)) / F.lit(voc.n + ALPHA * (voc.v + 1)))
    tail = (rare.join(counts.select("token", "c"), "token", "left").groupBy("row")
            .agg(F.sum(one * F.col("times")).alias("tail"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more")))
    joined = scored.join(tail, "row", "left")
    base = F.col("base") + F.coalesce("tail", F.lit(0.0))
    return joined.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
                         (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(voc.n).cast("long").alias("train_tokens"),
                         base.alias("base_score"), (base + F.col("gain")).alias("score"))
