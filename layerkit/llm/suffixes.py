"""Suffix-array dedup: byte passages that occur in a document with a smaller id.

Every position whose ``WIDTH`` bytes also start in a document with a smaller id is
marked, and the bytes covered by marked strings are removed. The suffixes are dealt into
buckets and one bucket is sorted at a time:

* The bucket of a suffix is the hash of its minimizer, the smallest (of equal ones the
  rightmost) of the hashed ``K``-byte grams among its first WIDTH bytes; that hash is mixed
  once more, as the smallest ones would crowd into a small part of the buckets and of the bit
  map. Equal strings have equal minimizers at equal places, and the suffixes of a run that
  share one travel as a single stretch of bytes.
* In a bucket the suffixes at a difference cover of the places modulo 7 are ranked first
  (prefix doubling in steps of 7, to 42 bytes). All suffixes are then sorted by their
  first 8 bytes, the cover rank that stands at most 3 bytes further on, and the last 8
  of their WIDTH bytes; long ties cost no further comparison. Memory is bounded by the
  bucket.

A text that a document with a smaller id has as a whole, too, is removed whole and takes
no further part: whatever its strings would mark, those of the smaller id mark as well.
This holds for the ``packed.TOP`` largest groups of copies; others go the general way.

Only minimizers that occur twice can matter: a counting pass over all documents
leaves a bit map of bounded size, and other suffixes stay where they are. The most
frequent minimizers (at most ``packed.TOP``, ``OFTEN`` runs or more, in one text or in many) would make
hot buckets; their suffixes are counted and, where they occur twice, bucketed one by one
by the hash of all their bytes; the most frequent of those are settled by a table of
smallest ids of fixed size. Any
other bucket key so holds less than a fixed small share of all suffixes.

Defined results: a null text is empty and stays so; a text of fewer than WIDTH bytes is
kept whole; documents of equal id, repeated rows among them, take nothing from each
other; a null id counts as larger than any other; ``removed`` keeps the rows of emptied
texts, with an empty text; kept bytes that are no longer whole characters at a cut are
dropped from its text; an empty table gives an empty result; extra columns ride along
and cannot clash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix64, quoted, stored, text_blocks, tidy
from .jaccard import BITS, id_map
from .packed import SCHEMA, TOP, Packed, bucket_count, bucket_shift, bucketed, each_bucket, in_map, look_up, map_and_top, map_bits, top_bits
from .winnow import grams, window_minima

WIDTH, K = 50, 24
W = WIDTH - K + 1
OFTEN, OFTEN_UNITS = 8192, 64
#: Bytes of a bucket that are sorted together, about; a bucket is cut between its keys.
BLOCK = 1 << 19
#: Stretches compressed together, at 1024 buckets; more for more buckets, as small blobs compress badly.
FLUSH = 51_200
#: Bytes looked at together; a longer text is cut into stretches that overlap by WIDTH - 1.
STRETCH = 1 << 19
#: Buckets of documents come from the id modulo this prime.
PRIME = 1_000_003
_LOW = np.uint64((1 << 24) - 1)
_LAST = np.iinfo(np.int64).max
HEAD = np.dtype([("key", "<u4"), ("doc", "<i8"), ("text", "<u4"), ("start", "<u4"), ("lead", "u1"), ("size", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("text", "<u4"), ("start", "<u4"), ("end", "<u4")])


def minimizers(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of positions that share a minimizer, in the texts at [starts, ends) of
    ``body``: (first position, positions in the run, minimizer place, its hash)."""
    none = np.zeros(0, np.int64)
    if len(body) < WIDTH:
        return none, none, none, none.astype(np.uint64)
    hashed = grams(body, K)
    place = _LOW - np.arange(len(hashed), dtype=np.uint64)
    np.bitwise_or(hashed & ~_LOW, place, out=place)
    least = window_minima(place, W)  # hash and place of the minimizer of the string at each position
    valid = np.maximum(ends - starts - WIDTH + 1, 0)
    rest = ends - starts - valid
    inside = np.repeat(np.tile([True, False], len(starts)), np.stack([valid, rest], 1).ravel())[:len(least)]
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[starts[valid > 0]] = True
    new &= inside
    stop = ~inside
    stop[starts[(starts < len(stop)) & (valid > 0)]] = True
    last = inside.copy()
    last[:-1] &= new[1:] | stop[1:]
    first = np.flatnonzero(new)
    at = (_LOW - (least[first] & _LOW)).astype(np.int64)
    return first, np.flatnonzero(last) - first + 1, at, mix64(hashed[at])


class Part:
    """Texts of one stretch of memory and the runs in them."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, docs: np.ndarray, marks: np.ndarray, base: int):
        self.body, self.docs, self.marks, self.base = body, docs, marks, base
        self.starts, ends = offsets[:-1], offsets[1:]
        self.first, self.many, self.at, self.hash = minimizers(body, self.starts, ends)
        self.row = np.searchsorted(self.starts, self.first, "right") - 1
        empty = np.flatnonzero(np.diff(offsets) == 0)
        if len(empty):  # a position belongs to the last text that begins there
            filled = np.flatnonzero(np.diff(offsets) > 0)
            self.row = filled[np.searchsorted(self.starts[filled], self.first, "right") - 1] if len(filled) else self.row


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    for part, body, offsets in text_blocks(batches, "text"):
        docs = part.column(0).fill_null(_LAST).to_numpy()
        marks = part.column(1).to_numpy().astype(np.uint32)
        if len(body) <= STRETCH:
            yield Part(body, offsets, docs, marks, 0)
            continue
        for a in range(0, len(body), STRETCH):
            some = body[a:a + STRETCH + WIDTH - 1]
            yield Part(some, np.array([0, len(some)]), docs, marks, a)


def slim(docs: DataFrame, text: str, key: str) -> DataFrame:
    """id, mark (tells texts of equal id apart), text, and its 128-bit digest."""
    words = F.coalesce(quoted(text).cast("string"), F.lit(""))
    return docs.select(quoted(key).cast("long").alias("id"), F.pmod(F.xxhash64(words), F.lit(1 << 32)).alias("mark"), words.alias("text"), *digest(words))


def digest(words: Column) -> list[Column]:
    return [F.xxhash64(words).alias("d1"), F.xxhash64(F.lit(PRIME), words).alias("d2")]


def copied(frame: DataFrame) -> DataFrame:
    """(d1, d2, least): smallest id of the largest groups of equal texts of WIDTH bytes
    or more, ``TOP`` rows at most."""
    number = F.coalesce("id", F.lit(_LAST))
    groups = (frame.where(F.octet_length("text") >= WIDTH).groupBy("d1", "d2")
              .agg(F.min(number).alias("least"), F.max(number).alias("most"), F.count(F.lit(1)).alias("many")).where("least < most"))
    return stored(groups.orderBy(F.col("many").desc(), "d1", "d2").limit(TOP).select("d1", "d2", "least"), frame.sparkSession, "suffix-copies")


def with_later(frame: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows with ``later``: a smaller id is known to have the same text."""
    later = F.coalesce(F.coalesce("id", F.lit(_LAST)) > F.col("least"), F.lit(False))
    return frame.join(F.broadcast(copies), ["d1", "d2"], "left").withColumn("later", later)


# ---- one bucket -----------------------------------------------------------------------

def words_of(body: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number that sorts like them (zeros follow
    the last byte)."""
    x = np.concatenate((body.astype(np.uint64), np.zeros(7, np.uint64)))
    for step in (1, 2, 4):
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
    return x


def dense(values: np.ndarray) -> np.ndarray:
    """Rank of each value, equal values alike."""
    order = np.argsort(values)
    s = values[order]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate(([False], s[1:] != s[:-1])))[:len(s)]
    return out


def both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Rank by the first, then by the second of two ranks (-1 comes before all)."""
    return dense(first * (int(second.max(initial=0)) + 2) + second + 1)


def sort_bucket(head: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, ...]:
    """The suffix array of a bucket's stretches, by key, place and first WIDTH bytes:
    (stretch and offset of each suffix, their order, number of the string at each rank)."""
    size = head["size"].astype(np.int32)
    begin = np.cumsum(size, dtype=np.int32) - size
    many = size - WIDTH + 1
    which = np.repeat(np.arange(len(head), dtype=np.int32), many)
    offset = np.arange(len(which), dtype=np.int32) - np.repeat(np.cumsum(many, dtype=np.int32) - many, many)
    place = offset - head["lead"].astype(np.int32)[which]  # relative to the minimizer
    spot = begin[which] + offset
    # ranks of the difference cover {0, 1, 3} modulo 7 of the places, by 42 bytes; the
    # longer ranks only where a suffix may look for one, at most 3 bytes past its start
    along = np.arange(len(body), dtype=np.int32) - np.repeat(begin, size)
    residue = (along - np.repeat(head["lead"].astype(np.int32), size)) % 7
    room = np.repeat(size, size) - along
    cover = np.flatnonzero(((residue == 0) | (residue == 1) | (residue == 3)) & (room >= 7))
    text = words_of(body)
    ranked = np.full(len(body), -1, np.int64)

    def longer(at: np.ndarray, rank: np.ndarray, step: int, tail: np.ndarray) -> np.ndarray:
        """Rank by ``rank`` at each place of the cover, then by ``tail`` ``step`` bytes on."""
        out = np.full(len(body), -1, np.int64)
        out[at] = both(rank[at], tail[at + step])
        return out

    ranked[cover] = dense(text[cover] >> np.uint64(8))
    rank14 = longer(cover[room[cover] >= 14], ranked, 7, ranked)
    asked = cover[room[cover] >= 42]
    rank28 = longer(asked, rank14, 14, rank14)
    rank42 = longer(asked, rank28, 28, rank14)
    ahead = np.array([0, 0, 1, 0, 3, 2, 1])[place % 7]  # to the next cover place: residues 0, 1, 3
    rank = both(dense(dense(head["key"])[which] * 128 + place + 64), dense(text[spot]))
    rank = both(both(rank, rank42[spot + ahead]), dense(text[spot + WIDTH - 8]))
    order = np.argsort(rank)
    return which, offset, order, rank[order]


def repeated(head: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Spans of the bucket's strings that a document with a smaller id also has."""
    which, offset, order, string = sort_bucket(head, body)
    doc = head["doc"][which]
    first = np.flatnonzero(np.concatenate(([True], string[1:] != string[:-1])))
    least = np.minimum.reduceat(doc[order], first)
    marked = np.zeros(len(doc), bool)
    marked[order] = doc[order] > least[string]  # ranks are dense: 0, 1, 2, ...
    return spans_of(head["doc"], head["text"], head["start"].astype(np.int64), which, offset, marked)


def blocks(head: np.ndarray, body: np.ndarray) -> list[np.ndarray]:
    """``repeated`` for the blocks of a bucket, which hold whole keys."""
    order = np.argsort(head["key"], kind="stable")
    size = head["size"].astype(np.int64)
    begin = (np.cumsum(size) - size)[order]
    head, size = head[order], size[order]
    after = np.cumsum(size)
    edge = np.flatnonzero(head["key"][1:] != head["key"][:-1]) + 1
    out, a = [], 0
    while a < len(head):
        last = int(np.searchsorted(after, after[a] - size[a] + BLOCK, "right"))
        if last >= len(head):
            b = len(head)
        else:  # the last edge before it, or else the next one
            k = int(np.searchsorted(edge, last, "right"))
            b = int(edge[k - 1]) if k and edge[k - 1] > a else int(edge[k]) if k < len(edge) else len(head)
        n = size[a:b]
        into = np.repeat((begin[a:b] - (after[a:b] - n - (after[a] - size[a]))).astype(np.int32), n) + np.arange(int(n.sum()), dtype=np.int32)
        out.append(repeated(head[a:b], body[into]))
        a = b
    return out


def spans_of(doc, text, start, which, offset, marked) -> np.ndarray:
    """Runs of marked offsets in each stretch, as spans of bytes."""
    begins = marked.copy()
    begins[1:] &= ~marked[:-1] | (which[1:] != which[:-1])
    ends = marked.copy()
    ends[:-1] &= ~marked[1:] | (which[1:] != which[:-1])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    out = np.zeros(len(a), SPAN)
    of = which[a]
    out["doc"], out["text"], out["start"], out["end"] = doc[of], text[of], start[of] + offset[a], start[of] + offset[b] + WIDTH
    return out


# ---- over the corpus ------------------------------------------------------------------

def blobs(bucket: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, list[bytes], np.ndarray]:
    """Rows sorted by bucket as one blob for each bucket: (buckets, blobs, cuts)."""
    heads, first = np.unique(bucket, return_index=True)
    cuts = np.append(first, len(rows))
    return pa.array(heads.astype(np.int32)), [rows[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], cuts


def columns(head: np.ndarray) -> bytes:
    """HEAD rows by columns and bytes of each column, which compresses better."""
    return np.ascontiguousarray(head.view(np.uint8).reshape(-1, HEAD.itemsize).T).tobytes()


def rows_of(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(HEAD.itemsize, -1).T).ravel().view(HEAD)


def spans(docs: DataFrame, size: int) -> DataFrame:
    """(bucket, spans): packed SPAN rows, bucketed by document; ``docs`` is ``slim``, with
    about ``size`` bytes of text."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    buckets = bucket_count(spark)
    shift = bucket_shift(buckets)
    places = map_bits(2 * size // (W + 1))  # one run in (W + 1) / 2 bytes, about
    together = min(max(FLUSH, FLUSH // 1024 * buckets), 4 * FLUSH)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packed(buckets)
        for p in parts(batches):
            if len(p.hash):
                yield from pack.add(p.hash)
        yield from pack.out()

    bits, often, *_ = map_and_top(docs.mapInArrow(tidy(held), SCHEMA), lambda n, low, high: n > 1, OFTEN, buckets, "suffix-minimizers", size=places)
    shared = sc.broadcast((bits, often))

    def units_of(p: Part, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each string of the given runs by itself: (run, position, hash of its bytes)."""
        run = np.repeat(runs, p.many[runs])
        place = np.arange(len(run)) - np.repeat(np.cumsum(p.many[runs]) - p.many[runs], p.many[runs]) + p.first[run]
        return run, place, grams(p.body, WIDTH)[place] if len(run) else np.zeros(0, np.uint64)

    table = (np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.int64))  # without hot minimizers
    if len(often):
        def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pack = Packed(buckets, least=True)
            for p in parts(batches):
                run, _, h = units_of(p, np.flatnonzero(look_up(shared.value[1], p.hash)[0]))
                if len(h):
                    yield from pack.add(h, p.docs[p.row[run]])
            yield from pack.out()

        bits, hashes, _, low = map_and_top(docs.mapInArrow(tidy(units), SCHEMA), lambda n, low, high: n > 1, OFTEN_UNITS, buckets, "suffix-units")
        table = (bits, hashes, low)
    settled = sc.broadcast(table)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches for the buckets (head, body), and spans already settled (head, null)."""
        waiting, size = [], 0

        def out():
            key, head, body = (np.concatenate(c) for c in zip(*waiting))
            order = np.argsort(key)
            begin = np.cumsum(head["size"].astype(np.int64)) - head["size"]
            ids, first = np.unique(key[order] >> shift, return_index=True)
            small = zstandard.ZstdCompressor(level=3).compress
            heads, bodies = [], []
            for rows in np.split(order, first[1:]):
                n = head["size"][rows].astype(np.int64)
                after = np.cumsum(n) - n
                heads.append(small(columns(head[rows])))
                bodies.append(small(body[np.repeat(begin[rows] - after, n) + np.arange(int(n.sum()))].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())],
                                             names=["bucket", "head", "body"])

        def stretch(p: Part, key, run, place, size_, lead):
            nonlocal waiting, size
            head = np.zeros(len(run), HEAD)
            row = p.row[run]
            head["key"], head["doc"], head["text"], head["start"], head["lead"], head["size"] = (key << (np.uint64(64) - shift)) >> np.uint64(32), p.docs[row], p.marks[row], p.base + place - p.starts[row], lead, size_
            after = np.cumsum(size_) - size_
            waiting.append((key, head, p.body[np.repeat((place - after).astype(np.int32), size_) + np.arange(int(size_.sum()), dtype=np.int32)]))
            size += len(head)

        for p in parts(batches):
            if not len(p.first):
                continue
            bits, often = shared.value
            hot = look_up(often, p.hash)[0]
            cold = np.flatnonzero(in_map(bits, top_bits(p.hash, places)) & ~hot)
            stretch(p, p.hash[cold], cold, p.first[cold], p.many[cold] + WIDTH - 1, p.at[cold] - p.first[cold])
            hot = np.flatnonzero(hot)
            if len(hot):
                run, place, h = units_of(p, hot)
                twice, hashes, low = settled.value
                known, at = look_up(hashes, h)
                marked = np.zeros(len(h), bool)
                marked[known] = p.docs[p.row[run[known]]] > low[at[known]]
                if marked.any():
                    row = p.row[run]
                    # neighbouring positions of one text join, whatever their runs
                    rest = np.cumsum(np.concatenate(([True], (place[1:] != place[:-1] + 1) | (row[1:] != row[:-1])))) - 1
                    begin = np.flatnonzero(np.diff(rest, prepend=-1))
                    done = spans_of(p.docs[row[begin]], p.marks[row[begin]], p.base + place[begin] - p.starts[row[begin]], rest,
                                    np.arange(len(rest)) - begin[rest], marked)
                    yield pa.RecordBatch.from_arrays([pa.array([int(top_bits(h[:1])[0]) % buckets], pa.int32()), pa.array([done.tobytes()], pa.binary()), pa.array([None], pa.binary())],
                                                     names=["bucket", "head", "body"])
                new = np.flatnonzero(~known & in_map(twice, top_bits(h)))
                # a lone string is its own bucket key; the hash of its minimizer keeps keys apart
                stretch(p, mix64(h[new] ^ p.hash[run[new]]), run[new], place[new], np.full(len(new), WIDTH), p.at[run[new]] - place[new])
            if size > together:
                yield from out()
                waiting, size = [], 0
        if size:
            yield from out()

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0

        def out():
            rows = np.concatenate(found)
            bucket = np.mod(rows["doc"], PRIME) % buckets
            order = np.argsort(bucket, kind="stable")
            ids, packed, _ = blobs(bucket[order], rows[order])
            return pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], names=["bucket", "spans"])

        for _, rows in each_bucket(batches):
            found += [np.frombuffer(r[0], SPAN) for r in rows if r[1] is None]
            some = [r for r in rows if r[1]]
            if some:
                large = zstandard.ZstdDecompressor().decompress
                found += blocks(np.concatenate([rows_of(large(r[0])) for r in some]), np.concatenate([np.frombuffer(large(r[1]), np.uint8) for r in some]))
            n = sum(map(len, found))
            if n > 1 << 19:
                yield out()
                found, n = [], 0
        if any(len(f) for f in found):
            yield out()

    return stored(bucketed(docs.mapInArrow(tidy(dealt), "bucket int, head binary, body binary")).mapInArrow(tidy(sorted_), "bucket int, spans binary"), spark, "suffix-spans")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct document ids of a task's spans."""
    seen = np.zeros(0, np.int64)
    for b in batches:
        seen = np.unique(np.concatenate([seen, *(np.frombuffer(v.as_buffer(), SPAN)["doc"] for v in b.column(0))]))
        if len(seen) > 1 << 18:
            yield pa.RecordBatch.from_arrays([pa.array(seen)], names=["id"])
            seen = seen[:0]
    yield pa.RecordBatch.from_arrays([pa.array(seen)], names=["id"])


def removed(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """row (the document's other columns), id, n_bytes, n_removed, n_spans, kept (bytes)."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    buckets = bucket_count(spark)
    bounded_batches(spark)
    frame = slim(docs, text, key)
    copies = copied(frame)
    length = frame.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    marks = spans(with_later(frame, copies).where("not later").select("id", "mark", "text"), length)
    touched = sc.broadcast(id_map(marks.select("spans").mapInArrow(tidy(_ids), "id long")))

    @F.pandas_udf("boolean")
    def may_change(ids: pd.Series) -> pd.Series:
        return pd.Series(in_map(touched.value, ids.to_numpy(np.int64) % BITS))

    others = [c for c in docs.columns if c != text]
    words = F.coalesce(quoted(text).cast("string"), F.lit(""))
    rows = with_later(docs.select(F.struct(*[quoted(c).alias(c) for c in others]).alias("row"), quoted(key).cast("long").alias("id"), words.alias("text"),
                                  *digest(words)), copies).select("row", "id", "text", "later")
    number = F.coalesce("id", F.lit(_LAST))
    size = F.octet_length("text").cast("long")
    whole = rows.where(F.col("later") | ~may_change(number)).select(
        "row", "id", size.alias("n_bytes"), F.when(F.col("later"), size).otherwise(0).cast("long").alias("n_removed"),
        F.col("later").cast("long").alias("n_spans"), F.when(F.col("later"), F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"))

    dealt = (rows.where(~F.col("later")).where(may_change(number)).drop("later").withColumn("mark", F.pmod(F.xxhash64("text"), F.lit(1 << 32)))
             .withColumn("bucket", (F.pmod(number, F.lit(PRIME)) % buckets).cast("int")))
    both = dealt.withColumn("spans", F.lit(None).cast("binary")).unionByName(
        marks.select(F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"),
                     F.lit(None).cast("long").alias("mark"), "bucket", "spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of a bucket come before its texts."""
        now, held, table = None, [], {}
        for b in batches:
            at = {n: i for i, n in enumerate(b.schema.names)}
            bucket, cuts = b.column(at["bucket"]).to_pylist(), b.column(at["spans"])
            ids, mark, texts = b.column(at["id"]), b.column(at["mark"]), b.column(at["text"])
            take, numbers, kept = [], [], []
            for i, place in enumerate(bucket):
                if place != now:
                    now, held, table = place, [], None
                if cuts[i].is_valid:
                    held.append(np.frombuffer(cuts[i].as_buffer(), SPAN))
                    continue
                if table is None:
                    table = by_text(held)
                raw = texts[i].as_py().encode()
                found = table.get((ids[i].as_py() if ids[i].is_valid else _LAST, mark[i].as_py()), ())
                left, last, gone = [], 0, 0
                for a, e in found:
                    left.append(raw[last:a])
                    gone += e - a
                    last = e
                take.append(i)
                kept.append(b"".join([*left, raw[last:]]))
                numbers.append((len(raw), gone, len(found)))
            if take:
                n = np.array(numbers, np.int64)
                yield pa.RecordBatch.from_arrays([b.column(at["row"]).take(pa.array(take)), ids.take(pa.array(take)), pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(n[:, 2]),
                                                  pa.array(kept, pa.binary())], names=["row", "id", "n_bytes", "n_removed", "n_spans", "kept"])

    changed = (both.repartition("bucket").sortWithinPartitions("bucket", F.col("spans").isNull())
               .mapInArrow(tidy(cut), whole.schema))
    return whole.unionByName(changed)


def by_text(held: list[np.ndarray]) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """(id, mark) -> disjoint maximal spans, in order."""
    if not held:
        return {}
    rows = np.sort(np.concatenate(held), order=["doc", "text", "start"])
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for doc, text, a, b in rows.tolist():
        spans_ = out.setdefault((doc, text), [])
        if spans_ and a <= spans_[-1][1]:
            spans_[-1] = (spans_[-1][0], max(b, spans_[-1][1]))
        else:
            spans_.append((a, b))
    return out


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: str = "n_chars") -> DataFrame:
    """The documents with their repeated passages removed; ``size`` follows the text."""
    cleaned = removed(docs, text=text, key=key)
    kept = F.pandas_udf(_characters, "string")(F.col("kept"))
    out = cleaned.withColumn("kept_text", F.when(F.col("n_removed") == 0, F.col("kept").cast("string")).otherwise(kept))
    cols = []
    for f in docs.schema:
        if f.name == text:
            cols.append(F.col("kept_text").cast(f.dataType).alias(f.name))
        elif f.name == size:
            cols.append(F.when(F.col("n_removed") == 0, F.col("row").getField(f.name)).otherwise(F.length("kept_text")).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col("row").getField(f.name).alias(f.name))
    return out.select(*cols)


def _characters(kept):
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def query(docs: DataFrame) -> DataFrame:
    return removed(docs.select("doc_id", "text")).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                                                          F.sha2("kept", 256).alias("kept_sha256"))
