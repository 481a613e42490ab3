"""Byte-level BPE encoding and decoding by a pair occurrence index.

All distinct words of a batch of texts are laid out as one array of symbols.
An index maps each adjacent pair that is a merge to all its positions; active ranks
are taken in ascending order from a heap, every occurrence of the pair is merged at once,
and the lists of the pairs that appear beside the merged symbols are
extended.  A symbol is thus touched once per merge that concerns it, however
often its word occurs.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words kept encoded in a Python worker, and the text taken into one index.
CACHE_WORDS = 200_000
CACHE_CHARS = 10_000_000
BATCH_CHARS = 2_000_000
#: Words in one index, and their characters; a longer word has an index of its own, of some 30 bytes a character.
LEARN_WORDS = 25_000
LEARN_CHARS = 1_000_000
_MANY = 48                   # occurrences merged by numpy,
_BLOCK = 1 << 20             # so many at a time


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Tokenizer:
    """Vocabulary, merges and splitting rule of a byte-level BPE file (``tokenizers`` JSON)."""

    # Fixed value: the public pattern by which byte-level tokenizers split texts into words.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre["add_prefix_space"] \
                or spec["normalizer"] or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token")):
            raise ValueError("only plain byte-level BPE is supported")
        alphabet = _byte_alphabet()
        self.bytes_of: dict[int, bytes] = {}
        for token, i in model["vocab"].items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        ids = {b: i for i, b in self.bytes_of.items()}
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.rank: dict[int, tuple[int, int]] = {}           # by both symbols
        vocab = model["vocab"]
        made: set[str] = set(alphabet)
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            if a not in made or b not in made or a + b in made:
                raise ValueError("merges must be in the order in which their parts are made")
            made.add(a + b)
            self.rank[(vocab[a] << 32) + vocab[b]] = (r, vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with strip or single_word are not supported")
        self.bytes_of.update({i: t.encode() for t, i in self.added.items()})
        words = regex.compile(self.PATTERN)
        self.words = words.findall
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")").split \
            if self.added else None
        self.cache: dict[str, bytes] = {}                    # ids of a word, as 32-bit integers
        self.older: dict[str, bytes] = {}
        self.cached = 0                                      # characters of the words in the younger cache
        self.pieces = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    def split(self, text: str) -> list[str]:
        """Words in order; added tokens stand as words of their own."""
        if self.cut is None or not any(t in text for t in self.added):
            return self.words(text)
        out: list[str] = []
        for part in self.cut(text):
            out += [part] if part in self.added else self.words(part)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode words that are not in the cache yet, together, by the pair index.

        The cache has two generations: when the younger one is full, it becomes the older one, whose words are taken
        over when they are met again, so that frequent words stay."""
        if len(self.cache) > CACHE_WORDS // 2 or self.cached > CACHE_CHARS // 2:
            self.older, self.cache, self.cached = self.cache, {}, 0
        new = words - self.cache.keys()
        again = new & self.older.keys()
        self.cache.update((w, self.older[w]) for w in again)
        part: list[str] = []
        size = 0
        for w in new - again:
            if part and (len(part) == LEARN_WORDS or size + len(w) > LEARN_CHARS):
                self._encode(part)
                part, size = [], 0
            part.append(w)
            size += len(w)
        if part:
            self._encode(part)
        self.cached += sum(map(len, new))

    def _encode(self, part: list[str]) -> None:
        plain = [w for w in part if w not in self.added]
        self.cache.update({w: np.array([self.added[w]], "<u4").tobytes() for w in part if w in self.added})
        self.cache.update(zip(plain, merge_words(plain, self.byte_ids, self.rank)))

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [self.split(t) for t in texts]
        distinct = set().union(*split) if split else set()
        self.learn(distinct)
        get = self.cache.__getitem__
        for words in split:
            yield np.frombuffer(b"".join(map(get, words)), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


def merge_words(words: list[str], byte_ids: np.ndarray, rank: dict[int, tuple[int, int]]) -> list[bytes]:
    """Token ids of each word, as little-endian unsigned 32-bit integers.

    ``sym`` holds the symbols of all words, each word followed by a separator -1;
    ``nxt``/``prv`` link the living symbols.  Positions in an index list may be stale or repeated;
    they are tested before use.  Merges only make pairs of higher rank (the vocabulary is
    checked for that), so ascending ranks over all words give what each word alone
    would; positions of one list are merged from left to right, long lists a block at a time.
    """
    blobs = [w.encode("utf-8", "surrogatepass") for w in words]
    data = np.frombuffer(b"\0".join(blobs) + b"\0", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)) + 1) - 1
    n = len(data)
    symbols = byte_ids.astype(np.int32)[data]
    symbols[ends] = -1
    # Arrays for single symbols, and numpy views of the same memory for many.
    sym, nxt, prv = (array("i", x.tobytes()) for x in (symbols, np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)))
    sym_, nxt_, prv_ = (np.frombuffer(x, np.int32) for x in (sym, nxt, prv))
    del symbols
    few: dict[int, list[int]] = {}                           # pair -> positions
    many: dict[int, list[np.ndarray]] = {}                   # and more of them
    heap: list[tuple[int, int]] = []

    def found(pairs: np.ndarray, at: np.ndarray) -> None:
        """Enters the positions of pairs into the index."""
        order = np.argsort(pairs, kind="stable")
        keys, at = pairs[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        for k, lo, hi in zip(keys[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]):
            r = rank.get(k)
            if r is not None:
                mine = few.get(k)
                if mine is None:
                    mine = few[k] = []
                    heapq.heappush(heap, (r[0], k))
                if hi - lo < _MANY:
                    mine.extend(at[lo:hi].tolist())
                else:
                    many.setdefault(k, []).append(at[lo:hi].astype(np.int32))

    for lo in range(0, n - 1, _BLOCK):
        one, two = sym_[lo:lo + _BLOCK].astype(np.int64), sym_[lo + 1:lo + 1 + _BLOCK].astype(np.int64)
        good = np.flatnonzero((one[:len(two)] >= 0) & (two >= 0))
        if len(good):
            found((one[good] << 32) + two[good], good + lo)
    while heap:
        pair = heapq.heappop(heap)[1]
        at = few.pop(pair, None)
        if at is None:
            continue
        large = many.pop(pair, [])
        a, b, made = pair >> 32, pair & 0xFFFFFFFF, rank[pair][1]
        if large or len(at) >= _MANY:
            places = np.unique(np.concatenate([*large, np.array(at, np.int32)]))
            for lo in range(0, len(places), _BLOCK):
                i = places[lo:lo + _BLOCK]
                i = i[sym_[i] == a]
                i = i[sym_[nxt_[i]] == b]
                if a == b and len(i):                        # of a run of equal symbols every second one begins a pair
                    starts = np.concatenate([[True], nxt_[i[:-1]] != i[1:]])
                    number = np.arange(len(i))
                    i = i[(number - np.maximum.accumulate(np.where(starts, number, 0))) % 2 == 0]
                if not len(i):
                    continue
                j = nxt_[i]
                k = nxt_[j]
                sym_[i], sym_[j] = made, -2                  # -2: merged into a symbol to its left
                nxt_[i], prv_[k] = k, i
                h = prv_[i]
                left, right = np.where(h >= 0, sym_[h], -1).astype(np.int64), sym_[k].astype(np.int64)
                x, y = left >= 0, right >= 0
                new = np.concatenate([(left[x] << 32) + made, (made << 32) + right[y]])
                if len(new):
                    found(new, np.concatenate([h[x], i[y]]))
            continue
        at.sort()
        for i in at:
            if sym[i] != a:
                continue
            j = nxt[i]
            if sym[j] != b:
                continue
            k, h = nxt[j], prv[i]
            sym[i] = made
            sym[j] = -2
            nxt[i], prv[k] = k, i
            beside = [(sym[h] << 32) + made, h] if h >= 0 and sym[h] >= 0 else []
            if sym[k] >= 0:
                beside += [(made << 32) + sym[k], i]
            for p, q in zip(beside[::2], beside[1::2]):
                r = rank.get(p)
                if r is not None:
                    mine = few.get(p)
                    if mine is None:
                        few[p] = [q]
                        heapq.heappush(heap, (r[0], p))
                    else:
                        mine.append(q)
    alive = np.flatnonzero(sym_ != -2)
    flat = sym_[alive].astype("<u4").tobytes()
    out, start = [], 0
    for end in (4 * np.searchsorted(alive, ends)).tolist():
        out.append(flat[start:end])
        start = end + 4
    return out


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    """One per Python worker."""
    return Tokenizer(path)


def _spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BATCH_CHARS bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    first, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= BATCH_CHARS or i == len(sizes) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def _texts(column: pa.Array, first: int, end: int) -> list[str]:
    return ["" if t is None else t for t in column.slice(first, end - first).to_pylist()]


def _ddl(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``out``, an array of token ids of the whole text (NULL and empty texts: no ids);
    with ``decoded``, also a column of that name with the text decoded from the ids.  Columns that have these names
    are replaced.  A task holds the ids of a few megabytes of text at a time."""
    kept = [f for f in docs.schema.fields if f.name not in (out, decoded)]
    fields = f"{_ddl(kept)}, `{out}` array<int>" + (f", `{decoded}` string" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in batches:
            for first, end in _spans(b.column(text_col)):
                found = list(tok.encode_batch(_texts(b.column(text_col), first, end)))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                columns = [b.column(f.name).slice(first, end - first) for f in kept]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32))))
                if decoded:
                    columns.append(pa.array([tok.decode_bytes(x).decode("utf-8", "replace") for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [out] + ([decoded] if decoded else []))

    return docs.mapInArrow(run, fields)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """All columns and ``out``, the text of the ids; bytes that are no UTF-8 become U+FFFD, NULL ids stay NULL."""
    kept = [f for f in tokens.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in batches:
            for first in range(0, b.num_rows, 500):
                part = b.slice(first, 500)
                texts = [tok.decode_bytes(x.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") if x.is_valid else None
                         for x in part.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(texts, pa.string())],
                                                 names=[f.name for f in kept] + [out])

    return tokens.mapInArrow(run, f"{_ddl(kept)}, `{out}` string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encodes whole texts, decodes the ids and digests both.

    The ids are digested as little-endian unsigned 32-bit integers.  NULL texts count as empty; an
    empty text has no tokens and the digests of no bytes.  Repeated rows are returned each,
    other columns ignored; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for first, end in _spans(b.column("text")):
                for ids in tok.encode_batch(_texts(b.column("text"), first, end)):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(tok.decode_bytes(ids).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
