"""Spelling variants of the words of a corpus, found with pivotal grams.

1. Words are counted: runs of letters with A-Z lower-cased, one code point of some runs
   deleted by the rule below, long enough and frequent enough.
2. The bigrams of the words get one global order: rare ones first, by how many words hold
   them (a table of ``SLOTS`` counts, whatever the alphabet), then by their code points. A
   word's prefix is its first 3 places of bigrams in that order, and further places of the
   last one's bigram: one edit changes at most two places, so two near words share one of
   them. Among the prefix, dynamic programming chooses the two disjoint bigrams of the
   least total count, the word's pivots: one edit leaves at least one of them whole.
3. Of two near words, let the first be the one whose prefix ends earlier in the order: its
   whole pivot then lies in the other's prefix. So pivots meet the prefixes of words that
   end at or after them, by bigram, place and length: a pivot stays where it is when the
   edit lies behind it and moves by the change of length when it lies before. Candidates
   are verified by their edit distance.
4. A word's form is its most frequent near word; following forms to their end is a jump to
   the form's form, repeated until nothing changes (forms grow five-fold, so paths are short).

The joins shuffle on (bigram, place, length); no group is gathered in one task, and a key
that many words share is split by adaptive execution as any skewed join.

Defined results: a null or empty text has no words; rows that repeat count each, and so do
rows with a null id (its text form is empty); equal counts among near words give the
smallest in code-point order; a word without near words is its own root; very long texts
are read in stretches, very long runs are words like others; an empty table gives an empty
result; only the named columns are read, so extra columns cannot clash.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored
from .runs import runs, stretches

# The rule of the registered query.
SHORTEST, FEWEST, TIMES, EVERY = 6, 5, 5, 199
#: Bytes of runs [A-Za-zÀ-ÿ]: ASCII letters, and 0xC3 with the byte that follows it.
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b == 0xC3 for b in range(256)])

STRETCH, SLOTS, DISTINCT = 1 << 20, 1 << 16, 1 << 18


def _crc_table() -> np.ndarray:
    """Of the reflected polynomial 0xEDB88320, the one that crc32 means."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc_of_runs(values: pa.Array, before: np.ndarray, most: int = 64) -> np.ndarray:
    """crc32 of each run appended to a text whose crc32 is ``before``; byte by byte for
    all runs at once, runs of more than ``most`` bytes each by themselves."""
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    body = np.frombuffer(values.buffers()[2], np.uint8) if len(values) else np.zeros(0, np.uint8)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    long = int(np.searchsorted(-size[order], -most, "left"))
    order, out = order[long:], np.zeros(len(values), np.uint32)
    for i in np.flatnonzero(size > most):
        out[i] = zlib.crc32(body[bounds[i]:bounds[i + 1]], int(before[i]))
    state, start, left = ~before[order].astype(np.uint32), bounds[:-1][order], -size[order]
    for k in range(int(-left[0]) if len(left) else 0):
        n = int(np.searchsorted(left, -k, "left"))  # runs that have a byte k
        state[:n] = _CRC[(state[:n] ^ body[start[:n] + k]) & 0xFF] ^ state[:n] >> 8
    out[order] = ~state
    return out


def word_counts(docs: DataFrame, *, text: str = "text", key: str = "doc_id", every: int = EVERY,
                shortest: int = SHORTEST, fewest: int = FEWEST, stretch: int = STRETCH, distinct: int = DISTINCT) -> DataFrame:
    """(word, n). Where the crc32 of ``<key>:<run>`` is a multiple of ``every``, the run
    loses the code point at that number modulo its length."""
    inside = LETTER.copy()
    inside[0x80:0xC0] = True  # second bytes; those of other characters are taken out below

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for part, body, offsets in stretches(batches, "text", inside, stretch):
            flat = body.copy()
            second = flat[1:]
            second[(second >= 0x80) & (second < 0xC0) & (flat[:-1] != 0xC3)] = 0x20
            values, starts, heads = runs(flat, offsets, inside)
            if not len(values):
                continue
            begun = np.array([zlib.crc32(f"{'' if name is None else name}:".encode()) for name in part.column(0).to_pylist()], np.uint32)
            hashed = crc_of_runs(values, np.repeat(begun, np.diff(heads)))
            hit = hashed % every == 0
            words, times = values.filter(pa.array(~hit)).value_counts().flatten()
            words = words.cast(pa.large_string())
            fits = pc.greater_equal(pc.utf8_length(words), shortest)
            for word, n in zip(words.filter(fits).to_pylist(), times.filter(fits).to_pylist()):
                held[word] += n
            for i in np.flatnonzero(hit):
                run = values[int(i)].as_py().decode()
                at = int(hashed[i]) % len(run)
                if len(run) > shortest:
                    held[run[:at] + run[at + 1:]] += 1
            if len(held) >= distinct:
                yield out()
                held.clear()
        yield out()

    rows = docs.select(quoted(key).cast("string").alias("key"), quoted(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def gram_slots(words: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """For each slot, how many places of the words hold a bigram of it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(slots, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                np.add.at(held, _slots(_grams(word), slots), 1)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["slot", "n"])

    out = np.zeros(slots, np.int64)
    for r in words.select("word").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r["slot"]] = r["n"]
    return out


def _grams(word: str) -> np.ndarray:
    """A number for each place's bigram."""
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    return points[:-1] << 21 | points[1:]


def _slots(grams: np.ndarray, slots: int) -> np.ndarray:
    return ((grams >> 21) * 31 + (grams & 0x1FFFFF)) % slots


def prefix(grams: np.ndarray, count: np.ndarray, edits: int = 1) -> np.ndarray:
    """Places of the rarest ``2 * edits + 1`` bigrams, and all places of the last one's bigram."""
    order = np.lexsort((grams, count))
    last = grams[order[min(2 * edits, len(order) - 1)]]
    n = min(2 * edits + 1, len(order))
    while n < len(order) and grams[order[n]] == last:
        n += 1
    return order[:n]


def pivots(places: list[int], count: list[int], wanted: int = 2) -> list[int]:
    """Of bigrams at ascending ``places``, the ``wanted`` disjoint ones of the least total
    count (fewer if there are no more), by dynamic programming: best[k] holds the best
    choice of k among the places read, ``before`` the same without those that touch the next."""
    best: list = [(0, ())] + [None] * wanted
    read = []
    for place, n in zip(places, count):
        old = 0
        while old < len(read) and read[old][0] <= place - 2:
            old += 1
        before = read[old - 1][1] if old else [(0, ())] + [None] * wanted
        now = list(best)
        for k in range(1, wanted + 1):
            if before[k - 1] is not None:
                made = (before[k - 1][0] + n, (*before[k - 1][1], place))
                if now[k] is None or made < now[k]:
                    now[k] = made
        best = now
        read.append((place, best))
    return list(next(b for b in reversed(best) if b is not None)[1])


def _keyed(words: DataFrame, slots: np.ndarray) -> DataFrame:
    """word, n_chars, the end of its prefix in the global order (count, gram), the prefix
    as (gram, place), the pivots likewise."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                grams = _grams(word)
                count = slots[_slots(grams, len(slots))]
                places = prefix(grams, count)
                last = places[-1]
                ordered = sorted(int(p) for p in places)
                chosen = pivots(ordered, [int(count[p]) for p in ordered])
                out.append({"word": word, "n_chars": len(word), "last_count": int(count[last]), "last_gram": int(grams[last]),
                            "prefix": [{"gram": int(grams[p]), "place": p} for p in ordered],
                            "pivots": [{"gram": int(grams[p]), "place": p} for p in chosen]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    gram = pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int32())]))
    arrow = pa.schema([("word", pa.string()), ("n_chars", pa.int32()), ("last_count", pa.int64()), ("last_gram", pa.int64()),
                       ("prefix", gram), ("pivots", gram)])
    grams = "array<struct<gram: long, place: int>>"
    return words.select("word").mapInArrow(run, f"word string, n_chars int, last_count long, last_gram long, prefix {grams}, pivots {grams}")


def near_pairs(words: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(a, b): the pairs of different words that are one edit apart, once each. ``words``
    must be stored; every word has at least four code points."""
    spark = words.sparkSession
    keyed = stored(_keyed(words, gram_slots(words, slots)), spark, "variant-grams")
    # where the other word may hold a whole pivot: (shift of its place, change of length)
    moves = F.array(*[F.struct(F.lit(s).alias("shift"), F.lit(d).alias("change")) for s, d in ((0, 0), (0, 1), (0, -1), (1, 1), (-1, -1))])
    left = (keyed.select(F.col("word").alias("a"), "n_chars", F.struct("last_count", "last_gram").alias("end"), F.explode("pivots").alias("g"))
            .select("a", "n_chars", "end", "g", F.explode(moves).alias("m"))
            .select("a", F.col("end").alias("a_end"), F.col("g.gram").alias("gram"), (F.col("g.place") + F.col("m.shift")).alias("place"),
                    (F.col("n_chars") + F.col("m.change")).alias("n_chars")))
    right = (keyed.select(F.col("word").alias("b"), "n_chars", F.struct("last_count", "last_gram").alias("b_end"), F.explode("prefix").alias("g"))
             .select("b", "b_end", "n_chars", F.col("g.gram").alias("gram"), F.col("g.place").alias("place")))
    found = left.join(right, ["gram", "place", "n_chars"]).where((F.col("a_end") <= F.col("b_end")) & (F.levenshtein("a", "b", 1) == 1))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def variants(words: DataFrame, *, times: int = TIMES, slots: int = SLOTS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of ``words`` (word, n)."""
    spark = words.sparkSession
    words = stored(words.select("word", "n"), spark, "variant-words")
    pairs = near_pairs(words, slots)
    both = pairs.union(pairs.select("b", "a"))
    about = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = (both.join(about, "b").groupBy(F.col("a").alias("word"))
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("other"))).alias("top")))
    fits = -F.col("top.less") >= times * F.col("n")
    out = stored(words.join(near, "word", "left")
                 .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(fits, F.col("top.other")).alias("form"), F.when(fits, -F.col("top.less")).alias("form_n")), spark, "variant-forms")
    root = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # root -> root of the root: the way left halves
        ahead = root.select(F.col("word").alias("at"), F.col("root").alias("further"))
        new = stored(root.join(ahead, F.col("root") == F.col("at"), "left")
                     .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), spark, "variant-roots")
        root = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            break
    return out.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    return variants(word_counts(docs, text=text, key=key))


SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
run AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
coded AS (SELECT run, times, hex(encode(concat(doc_id, ':', run))) AS code FROM run),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(len(code) // 2),
             lambda i: 16 * (instr('0123456789ABCDEF', substr(code, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(code, 2 * i + 2, 1)) - 1)),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS h
  FROM coded, crc_table),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
gaps AS (SELECT word, n, unnest(range(length(word))) AS gap FROM words),
hole AS (SELECT word, n, left(word, gap) AS head, substr(word, gap + 2) AS tail FROM gaps),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM hole a JOIN hole b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM hole h JOIN words w ON h.head || h.tail = w.word
  UNION SELECT w.word, h.word, h.n FROM hole h JOIN words w ON h.head || h.tail = w.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 5 * n THEN other END AS form,
         CASE WHEN top >= 5 * n THEN top END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)),
path AS (
  SELECT word, word AS place FROM formed
  UNION ALL SELECT path.word, formed.form FROM path JOIN formed ON path.place = formed.word WHERE formed.form IS NOT NULL),
root AS (SELECT path.word, path.place AS root FROM path JOIN formed ON path.place = formed.word WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN root USING (word)
"""
