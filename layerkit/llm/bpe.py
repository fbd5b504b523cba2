"""BPE encoding and decoding with the rules of a public tokenizer file.

``encode`` turns every text into token ids. A text is split at white space; a run between
is cut at the strings of added tokens, normalised (NFC, lower case) and split into words,
and each word's UTF-8 bytes become the symbols of a doubly linked list, the last one
carrying the word-end mark. A priority queue holds the merge ranks of neighbouring symbols; the smallest rank,
leftmost first, is merged and its two new pairs are queued. An entry whose symbols have
changed since it was queued is stale and skipped. ``decode`` takes the vocabulary string of
every id and concatenates them with a blank in between, as a file without a decoder asks.

Ids are those of the ``tokenizers`` library for files of this kind (byte-level BPE with a
word-end mark); any other kind raises ``ValueError``. Runs that hold code points from
U+0530 on, whose classes differ between Unicode versions, are normalised and split by the
library's own components; the merges are those above for every word. The different runs of
a slice of texts are worked on once, and their ids put in place for all texts together.

Defined results: a null or empty text has no ids and decodes to an empty text; rows that
repeat are encoded each; a very long text is worked through in stretches that end at
white space, so beside its ids only a stretch is held (a longer run is one stretch); an
empty table gives an empty result; rows keep all their columns in ``row``, so the added
columns cannot clash with them.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import SPACES, as_row, quoted
from .runs import runs, stretches

# What the file's steps call white space, and what they take as words.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}

#: Bytes that are no ASCII white space: nothing composes, merges or matches across the others.
RUN = np.array([b not in SPACES for b in range(256)])
STRETCH = 1 << 20     # bytes of text worked on at a time
JOINED = 1 << 18      # ids made into strings at a time
REMEMBERED = 1 << 17  # distinct words of a generation, two of which a process keeps; a bound on memory, not on results


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: printable
    bytes for themselves, the others 256, 257, ... in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in plain else extra))
        extra += byte not in plain
    return out


class Codec:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        spec = json.loads(library.to_str())
        model, added = spec["model"], spec["added_tokens"]
        kinds = {k: [s["type"] for s in spec[k].get("normalizers", spec[k].get("pretokenizers", [spec[k]]))] for k in STEPS if spec[k]}
        plain = not any(re.search(r"\s", t["content"]) or t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        if model["type"] != "BPE" or kinds != STEPS or spec["decoder"] or not model["end_of_word_suffix"] or not plain \
                or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": WORDS}:
            raise ValueError(f"not a byte-level BPE tokenizer with a word-end mark: {path}")
        self.vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [self.vocabulary[c] for c in letters]
        self.last = [self.vocabulary[c + end] for c in letters]
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault((self.vocabulary[a], self.vocabulary[b]), rank)
        self.made = [self.vocabulary[a + b] for a, b in model["merges"]]
        self.added = {t["content"]: t["id"] for t in added}
        names = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.marked = self.cut.search if names else None
        every = {**self.vocabulary, **self.added}
        self.strings = pa.array([s for s, _ in sorted(every.items(), key=lambda kv: kv[1])], pa.string())
        if sorted(every.values()) != list(range(len(every))):
            raise ValueError(f"token ids are not 0 to {len(every) - 1}")
        self.words = regex.compile(WORDS.replace(r"\s", BLANK))
        self.newer = re.compile("[\u0530-\U0010ffff]")
        self.normalizer = library.normalizer
        from tokenizers import Regex, pre_tokenizers
        self.splitter = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)
        #: words met lately, and those met before as many others
        self.known: dict[str, tuple[int, ...]] = {}
        self.earlier: dict[str, tuple[int, ...]] = {}

    def merged(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8", "surrogatepass")
        symbol = [self.inner[b] for b in raw]
        symbol[-1] = self.last[raw[-1]]
        n, ranks, made = len(symbol), self.ranks, self.made
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # an entry is rank * n + place: the smallest rank first, and of its places the leftmost
        queue = [rank * n + i for i, pair in enumerate(zip(symbol, symbol[1:])) if (rank := ranks.get(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j < 0 or ranks.get((symbol[i], symbol[j])) != rank:
                continue  # stale: one of the two was merged meanwhile
            symbol[i], symbol[j] = made[rank], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (rank := ranks.get((symbol[i], symbol[k]))) is not None:
                    heapq.heappush(queue, rank * n + i)
            if (h := before[i]) >= 0 and (rank := ranks.get((symbol[h], symbol[i]))) is not None:
                heapq.heappush(queue, rank * n + h)
        return [s for s in symbol if s >= 0]

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.earlier.get(word)
            if ids is None:
                ids = tuple(self.merged(word))
            if len(word) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known, self.earlier = {}, self.known
                self.known[word] = ids
        return ids

    def run(self, text: str) -> tuple[int, ...]:
        """Ids of a text without ASCII white space."""
        parts = self.cut.split(text) if self.cut and self.marked(text) else [text]
        if len(parts) > 1:
            return tuple(i for p in parts for i in ([self.added[p]] if p in self.added else self.run(p) if p else []))
        if not text.isascii():
            if self.newer.search(text):
                return tuple(i for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text)) for i in self._word(w))
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a last sigma is not special in the file
        text = text.lower()
        if text.isalpha():  # below U+0530 the same as the class of letters: most runs are one word,
            return self._word(text)
        if text[:-1].isalpha() and text[-1].isascii():  # or one word and a sign
            return self._word(text[:-1]) + self._word(text[-1])
        return tuple(i for word in self.words.findall(text) for i in self._word(word))

    def encode(self, body: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(ids, where each text's ids begin and end) of texts that lie at ``offsets`` of ``body``."""
        values, _, heads = runs(body, offsets, RUN, lower=False)
        coded = values.dictionary_encode()
        flat, ends = array("i"), [0]
        for text in coded.dictionary.cast(pa.large_string()).to_pylist():
            flat.extend(self.run(text))
            ends.append(len(flat))
        known = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
        placed = known.take(coded.indices)
        return placed.flatten(), np.append(0, np.cumsum(np.diff(placed.offsets.to_numpy())))[heads]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """(row, ids) of batches (row, text), a slice of texts at a time."""
    made = codec(tokenizer)

    def out(group: list) -> pa.RecordBatch:
        part, ids = group[0][0], pa.concat_arrays([g[1] for g in group])
        offsets = group[0][2] if len(group) == 1 else np.array([0, len(ids)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)
        return pa.RecordBatch.from_arrays([part.column(0), lists], names=["row", "ids"])

    held: list = []
    for part, body, offsets in stretches(batches, "text", RUN, STRETCH):
        if held and held[0][0] is not part:  # a longer text comes in several stretches
            yield out(held)
            held = []
        held.append((part, *made.encode(body, offsets)))
    if held:
        yield out(held)


def encode(docs: DataFrame, tokenizer: str, *, text: str = "text") -> DataFrame:
    """``row`` (all columns of a row) and ``ids`` (array of int), one row for each row."""
    rows = docs.select(as_row(docs), quoted(text).cast("string").alias("text"))
    schema = rows.select("row", F.lit(None).cast("array<int>").alias("ids")).schema
    return rows.mapInArrow(lambda batches: encoded(batches, tokenizer), schema)


def joined(lists: pa.Array, strings: Callable[[pa.Array], pa.Array]) -> Iterator[Iterator[str]]:
    """For each list of ids (a null is empty) its strings with a blank in between, in
    pieces to be joined by a blank; about ``JOINED`` ids are worked on at a time."""
    lists = lists.cast(pa.large_list(pa.int32()))
    ids, ends = lists.flatten(), np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))

    def text(offsets: np.ndarray) -> pa.Array:
        some = strings(ids.slice(offsets[0], offsets[-1] - offsets[0]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), some), " ")

    a = 0
    while a < len(lists):
        b = int(np.searchsorted(ends, ends[a] + JOINED, "right")) - 1
        if b > a:
            yield from ([one] for one in text(ends[a:b + 1]).to_pylist())
        else:
            b = a + 1
            yield (text(np.array([i, min(i + JOINED, ends[b])]))[0].as_py() for i in range(ends[a], ends[b], JOINED))
        a = b


def texts(lists: pa.Array, tokenizer: str) -> Iterator[Iterator[str]]:
    """The text of each list of token ids, in pieces to be joined by a blank."""
    return joined(lists, codec(tokenizer).strings.take)


def decode(rows: DataFrame, tokenizer: str, *, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with one more column: the text of its token ids (null: empty)."""
    @arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        return pa.array((" ".join(pieces) for pieces in texts(lists, tokenizer)), pa.string())

    return rows.withColumn(to, text(quoted(ids)))


def _digest(pieces: Iterator[str]) -> str:
    """SHA-256 (lower-case hex) of pieces joined by one blank."""
    made = hashlib.sha256()
    for i, piece in enumerate(pieces):
        made.update((" " + piece if i else piece).encode())
    return made.hexdigest()


def query(docs: DataFrame, tokenizer: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, number of tokens, and the digests of the ids and of the decoded text. Encoding,
    decoding and the digests follow each other on a slice of texts within one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in encoded(batches, tokenizer):
            ids = batch.column(1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pc.list_value_length(ids).cast(pa.int64()),
                pa.array((_digest(p) for p in joined(ids, lambda some: some.cast(pa.string()))), pa.string()),
                pa.array((_digest(p) for p in texts(ids, tokenizer)), pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(quoted(key).alias("row"), quoted(text).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
