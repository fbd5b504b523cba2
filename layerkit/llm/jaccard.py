"""N-gram Jaccard join: a grouped prefix join over word shingles.

Texts become sets of 64-bit shingle hashes (five words, A-Z lower-cased). With all sets
in one order, two sets of similarity ``TIMES / OUT_OF`` or more must share an element
among the first ``n - ceil(t * n) + 1`` of each: the prefix. The order puts frequent
shingles last, so that passages which many documents share do not fill the prefixes.

1. Documents with equal sets collapse into one group (prefix, size and digest agree);
   its smallest id stands for it from here on.
2. Min-hash keys propose one leader for each group; the links that verify exactly make
   first components. They only save work: pairs inside one need no further look, so a
   large cluster of near copies is never expanded into pairs.
3. The prefix join proper: shingle counts fix the order; prefix elements that only one
   group, or only one component, holds are left out; the others form posting lists,
   whose pairs pass the size, position and parity filters (all exact). A posting names the
   elements before it, so that a pair comes out of the first list it shares, not of all of
   them. The longest lists beyond ``LIST``
   members are dealt over a triangle of blocks; any other list holds less than a fixed
   small share of all postings.
4. Candidate pairs whose parity maps differ too much are dropped (an exact bound), the
   others are verified on the whole sets, and the components of all
   verified links are returned.

Counts cover all documents. What is broadcast has a fixed size: bit maps of ``BITS``
bits and ``HOT`` shingles for the order (any order gives the same links).

Defined results: a null or empty text, or one without words, has no shingles and is
linked with nothing; a text of fewer than five words has one shingle, the whole
sequence; rows that repeat an id stand for one document, which is linked with all that
any of its texts is linked with; rows with a null id are linked with nothing and have a
null component; an empty table gives an empty result; only the named columns are read,
so extra columns cannot clash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_row, bounded_batches, mix64, quoted, stored, text_blocks, tidy
from .components import components
from .packed import SCHEMA, Packed, bucket_count, bucket_shift, bucketed, each_bucket, in_map, look_up, map_and_top, most_frequent, top_bits
from .words import shingle_sets

TIMES, OUT_OF = 75, 100
KEYS, VOTES = 8, 3
PARITY, FOLDED = 2048, 512
HOT, FREQUENT = 1 << 19, 24
BITS = 1 << 26
LIST = 8192
_SALTS = mix64(np.arange(1, KEYS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Smallest intersection of linked sets of sizes n and m."""
    return -(-TIMES * (n + m) // (OUT_OF + TIMES))


def prefix_size(n):
    return n - -(-TIMES * n // OUT_OF) + 1


# ---- scans of the texts -------------------------------------------------------------

def slim(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(quoted(key).cast("long").alias("id"), quoted(text).cast("string").alias("text"))


def each_set(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    """(slice, ids, sets) of the rows whose id may be ``wanted`` (a bit map; None: all)."""
    for part, body, offsets in text_blocks(batches, "text"):
        if wanted is not None:
            ids = part.column(0).fill_null(-1).to_numpy()
            keep = (part.column(0).is_valid().to_numpy(zero_copy_only=False)) & in_map(wanted, ids % BITS)
            if not keep.any():
                continue
            part = part.filter(pa.array(keep))
            take = np.repeat(keep, np.diff(offsets))
            offsets = np.concatenate(([0], np.cumsum(np.diff(offsets)[keep])))
            body = body[take]
        yield part, part.column(0).fill_null(-1).to_numpy(), shingle_sets(body, offsets)


def id_map(ids: DataFrame) -> np.ndarray:
    """Bit map of ``BITS`` bits of the ids (modulo ``BITS``): it may let others pass."""
    place = F.pmod(F.col("id"), F.lit(BITS)) + 1
    rows = (ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())  # at most BITS / 32768 rows
    out = np.zeros((BITS // 32768, 4096), np.uint8)
    for bucket, bits in rows:
        out[bucket - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def sketches(docs: DataFrame) -> DataFrame:
    """(id, n, d1, d2, keys, parity): size, 128-bit digest, min-hash keys and parity map
    of every set; bit b of the map tells whether an odd number of its hashes end in b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, sets in each_set(batches):
            size = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(size)
            digest = np.zeros((2, len(sets)), np.uint64)
            keys = np.zeros((len(sets), KEYS), np.uint64)
            parity = np.zeros((len(sets), PARITY), np.uint8)
            if len(some):
                every = np.concatenate([sets[i] for i in some])
                first = np.cumsum(size[some]) - size[some]
                digest[0, some] = np.add.reduceat(mix64(every), first)
                digest[1, some] = np.add.reduceat(mix64(every ^ np.uint64(0x5851F42D4C957F2D)), first)
                at = np.repeat(np.arange(len(some)), size[some]) * PARITY + (every % np.uint64(PARITY)).astype(np.int64)
                parity[some] = (np.bincount(at, minlength=len(some) * PARITY) & 1).reshape(-1, PARITY)
                for k, salt in enumerate(_SALTS):
                    keys[some, k] = np.minimum.reduceat((every ^ salt) * np.uint64(0x9E3779B97F4A7C15), first)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                 pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), KEYS).cast(pa.list_(pa.int64())),
                 pa.array([row.tobytes() for row in np.packbits(parity, axis=1)], pa.binary())],
                names=["id", "n", "d1", "d2", "keys", "parity"])
    return docs.mapInArrow(tidy(run), "id long, n long, d1 long, d2 long, keys array<long>, parity binary")


# ---- exact verification ------------------------------------------------------------

def possible(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``pairs`` without those that cannot be similar enough: two sets differ in at
    least as many elements as their parity maps differ in bits."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint64).reshape(-1, PARITY // 64) for i in (4, 5))
            differ = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            keep = pa.array(differ <= n - 2 * overlap(b.column(2).to_numpy(), b.column(3).to_numpy()))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    side = lambda name, k: groups.select(F.col("id").alias(name), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}"))
    return pairs.join(side("a", 1), "a").join(side("b", 2), "b").select("a", "b", "n1", "n2", "p1", "p2").mapInArrow(tidy(near), "a long, b long")


def verified(docs: DataFrame, pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of groups whose whole sets are similar enough."""
    spark = docs.sparkSession
    pairs = stored(possible(pairs, groups), spark, "jaccard-possible")
    wanted = spark.sparkContext.broadcast(id_map(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, found in each_set(batches, wanted.value):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in found], pa.binary())], names=["id", "set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(OUT_OF * common >= TIMES * (len(both) - common) > 0)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    table = docs.mapInArrow(tidy(sets), "id long, set binary")
    left, right = table.select(F.col("id").alias("a"), F.col("set").alias("x")), table.select(F.col("id").alias("b"), F.col("set").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(check), "a long, b long").distinct()


def leaders(groups: DataFrame) -> DataFrame:
    """One proposed link (a, b) with b < a for each group that shares min-hash keys:
    to the smallest group of its key buckets that most keys agree on."""
    keyed = groups.select("id", "n", F.posexplode("keys").alias("k", "key"))
    first = keyed.groupBy("k", "key").agg(F.min(F.struct("id", "n")).alias("lead"), F.count(F.lit(1)).alias("many")).where("many > 1").select("k", "key", "lead")
    votes = (keyed.join(first, ["k", "key"]).where((F.col("lead.id") < F.col("id")) & (OUT_OF * F.least("n", "lead.n") >= TIMES * F.greatest("n", "lead.n")))
             .groupBy(F.col("id").alias("a"), F.col("lead.id").alias("b")).agg(F.count(F.lit(1)).alias("votes"))
             .where(F.col("votes") >= VOTES))
    return votes.groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))


class Order:
    """The element order: rare shingles by hash, then frequent ones, rarest first."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        rank = np.lexsort((hashes, counts))
        sort = np.argsort(hashes)
        self.hashes = hashes[sort]
        self.rank = np.empty(len(hashes), np.int64)
        self.rank[rank] = np.arange(1, len(hashes) + 1)
        self.rank = self.rank[sort]

    def prefix(self, elements: np.ndarray) -> np.ndarray:
        """The prefix of a sorted set, in order."""
        size = prefix_size(len(elements))
        if len(self.hashes) == 0:
            return elements[:size]
        at = np.minimum(np.searchsorted(self.hashes, elements), len(self.hashes) - 1)
        rank = np.where(self.hashes[at] == elements, self.rank[at], 0)
        rare = np.flatnonzero(rank == 0)
        if len(rare) >= size:
            return elements[rare[:size]]
        return elements[np.argsort(rank, kind="stable")[:size]]


def frequent(docs: DataFrame, groups_map, buckets: int) -> Order:
    """The order, from how many sets hold each shingle in their leading part by hash."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packed(buckets)
        for _, _, sets in each_set(batches, groups_map.value):
            heads = [s[:prefix_size(len(s)) + len(s) // 16] for s in sets if len(s)]
            if heads:
                yield from pack.add(np.concatenate(heads))
        yield from pack.out()

    hashes, counts, _ = most_frequent(docs.mapInArrow(tidy(emit), SCHEMA), FREQUENT, HOT)
    return Order(hashes, counts)


# ---- the prefix join -----------------------------------------------------------------

#: Pairs looked at, and found pairs held, at a time: a bound on a task's memory.
PAIRS_HELD = 1 << 17
#: Postings that a task gathers before it lets them out.
POSTINGS_HELD = 100_000
#: Elements before its own that a posting names, so that a pair comes out of its first common list only.
BEFORE = 4

POSTING = np.dtype([("cell", "<u8"), ("hash", "<u8"), ("id", "<i8"), ("component", "<i8"), ("n", "<i4"), ("at", "<i4"), ("block", "<i4"), ("low", "<i4"), ("high", "<i4"), ("parity", "<u8", (FOLDED // 64,)), ("before", "<u8", (BEFORE,))])


def named_before(h: np.ndarray) -> np.ndarray:
    """For each of a set's posted elements, in order, the ``BEFORE`` posted ones before it (0: none)."""
    out = np.zeros((len(h), BEFORE), np.uint64)
    for k in range(min(BEFORE, len(h))):
        out[k + 1:, k] = h[:len(h) - k - 1]
    return out


def list_pairs(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Candidate pairs (a, b), a > b, of one posting list (one block pair of it).

    Two sets that share an element named before this one meet in its list, too. All
    filters let at least as much pass there, so this list leaves the pair to it."""
    rows = np.sort(rows, order=["n", "id"])
    n = rows["n"].astype(np.int64)
    # the largest partner that what is left behind the smaller set's place allows
    end = np.searchsorted(n, (OUT_OF + TIMES) * (n - rows["at"]) // TIMES - n, "right")
    low, high = rows["low"][0], rows["high"][0]
    step = max(1, PAIRS_HELD // len(rows))
    for a in range(0, len(rows), step):
        left = np.repeat(np.arange(a, min(a + step, len(rows))), np.maximum(end[a:a + step] - np.arange(a, min(a + step, len(rows))) - 1, 0))
        if not len(left):
            continue
        run = np.concatenate(([True], left[1:] != left[:-1]))
        right = np.arange(len(left)) - np.flatnonzero(run)[np.cumsum(run) - 1] + left + 1
        rest = 1 + np.minimum(n[left] - rows["at"][left] - 1, n[right] - rows["at"][right] - 1)
        ok = (rows["component"][left] != rows["component"][right]) & (rest >= overlap(n[left], n[right]))
        if low != high:  # pairs inside one block belong to its own cell
            ok &= rows["block"][left] != rows["block"][right]
        left, right = left[ok], right[ok]
        for i in range(BEFORE):
            for j in range(BEFORE):
                x, y = rows["before"][left, i], rows["before"][right, j]
                ok = (x != y) | (x == 0)
                left, right = left[ok], right[ok]
        differ = np.zeros(len(left), np.int64)
        for k in range(rows["parity"].shape[1]):
            differ += np.bitwise_count(rows["parity"][left, k] ^ rows["parity"][right, k])
        ok = differ <= n[left] + n[right] - 2 * overlap(n[left], n[right])
        x, y = rows["id"][left[ok]], rows["id"][right[ok]]
        yield np.stack([np.maximum(x, y), np.minimum(x, y)])


def candidates(docs: DataFrame, groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of groups in different first components that the filters leave."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    buckets = bucket_count(spark)
    standing = sc.broadcast(id_map(groups.select("id")))
    order = sc.broadcast(frequent(docs, standing, buckets))

    def all_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packed(buckets)
        for _, _, sets in each_set(batches, standing.value):
            heads = [order.value.prefix(s) for s in sets if len(s)]
            if heads:
                yield from pack.add(np.concatenate(heads))
        yield from pack.out()

    bits, *_ = map_and_top(docs.mapInArrow(tidy(all_prefixes), SCHEMA), lambda n, low, high: n > 1, LIST, buckets, "jaccard-shared")
    shared = sc.broadcast(bits)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, sets in each_set(batches, standing.value):
            out = []
            for s in sets:
                head = order.value.prefix(s) if len(s) else s
                at = np.flatnonzero(in_map(shared.value, top_bits(head)))
                out.append((len(s), head[at].tobytes(), at.astype("<i4").tobytes()))
            n, hashes, at = zip(*out)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(at, pa.binary())],
                                             names=["id", "n", "hash", "at"])

    standing_rows = groups.select("id", "n", "parity").join(labels.select(F.col("node").alias("id"), "component"), "id", "left") \
        .select("id", F.col("n").alias("size"), "parity", F.coalesce("component", "id").alias("component"))
    heads = stored(docs.mapInArrow(tidy(prefixes), "id long, n long, hash binary, at binary").where(F.octet_length("hash") > 0)
                   .join(standing_rows, "id").where("n = size").select("id", "n", "component", "hash", "at", "parity"), spark, "jaccard-prefixes")

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packed(buckets)
        for b in batches:
            for tag, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = np.frombuffer(blob, np.uint64)
                yield from pack.add(h, np.full(len(h), tag, np.int64))
        yield from pack.out()

    across = sc.broadcast(map_and_top(heads.select("component", "hash").mapInArrow(tidy(tagged), SCHEMA), lambda n, low, high: low < high, LIST, buckets,
                                      "jaccard-across")[:3])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, long, size = across.value
        shift = bucket_shift(buckets)

        def out(rows):
            every = np.concatenate(rows)
            every = every[np.argsort(every["cell"], kind="stable")]
            heads_, first = np.unique(every["cell"], return_index=True)
            cuts = np.append(first, len(every))
            return pa.RecordBatch.from_arrays([pa.array(heads_.astype(np.int32)), pa.array([every[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())],
                                              names=["bucket", "rows"])

        rows, held = [], 0
        for b in batches:
            for id_, n, component, blob, at, parity in zip(*(c.to_pylist() for c in b.columns)):
                h, at = np.frombuffer(blob, np.uint64), np.frombuffer(at, "<i4")
                keep = in_map(bits, top_bits(h))
                h, at = h[keep], at[keep]
                row = np.zeros(len(h), POSTING)
                row["hash"], row["id"], row["component"], row["n"], row["at"], row["cell"] = h, id_, component, n, at, h >> shift
                row["before"] = named_before(h)
                row["parity"] = np.bitwise_xor.reduce(np.frombuffer(parity, np.uint64).reshape(-1, FOLDED // 64), 0)
                is_long, place = look_up(long, h)
                rows.append(row[~is_long])
                for i in np.flatnonzero(is_long):  # a member of block i meets every block j in cell {i, j}
                    blocks = int(-(-size[place[i]] // LIST))
                    mine = int(mix64(np.array([id_], np.int64).view(np.uint64))[0] % np.uint64(blocks))
                    spread = np.repeat(row[i:i + 1], blocks)
                    other = np.arange(blocks)
                    spread["block"], spread["low"], spread["high"] = mine, np.minimum(mine, other), np.maximum(mine, other)
                    mixed = mix64(spread["hash"] + (spread["low"].astype(np.uint64) << np.uint64(32)) + spread["high"].astype(np.uint64))
                    spread["cell"] = mixed >> shift
                    rows.append(spread)
                held += len(h)
                if held > POSTINGS_HELD:
                    yield out(rows)
                    rows, held = [], 0
        if held:
            yield out(rows)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(blobs):
            rows = np.concatenate([np.frombuffer(x, POSTING) for x in blobs])
            rows = rows[np.lexsort((rows["high"], rows["low"], rows["hash"]))]
            edge = np.flatnonzero((rows["hash"][1:] != rows["hash"][:-1]) | (rows["low"][1:] != rows["low"][:-1]) | (rows["high"][1:] != rows["high"][:-1])) + 1
            cuts = np.concatenate(([0], edge, [len(rows)]))
            held, n = [], 0
            for a, b in zip(cuts[:-1], cuts[1:]):
                for some in list_pairs(rows[a:b]) if b - a > 1 else ():
                    held.append(some)
                    n += some.shape[1]
                    if n > PAIRS_HELD:
                        yield batch(held)
                        held, n = [], 0
            if held:
                yield batch(held)

        def batch(held):
            both = np.unique(np.concatenate(held, 1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for _, blobs in each_bucket(batches):
            yield from found([b[0] for b in blobs])

    return bucketed(heads.mapInArrow(tidy(postings), "bucket int, rows binary")).mapInArrow(tidy(pairs), "a long, b long").distinct()


def join(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = slim(docs, text, key)
    sketch = stored(sketches(texts), spark, "jaccard-sketches")
    # equal sets are one group; its smallest id stands for it
    groups = stored(sketch.where("n > 0 and id is not null").groupBy("n", "d1", "d2").agg(F.min("id").alias("id"), F.min("keys").alias("keys"), F.min("parity").alias("parity")), spark, "jaccard-groups")
    first = stored(verified(texts, leaders(groups), groups), spark, "jaccard-first")
    pairs = stored(candidates(texts, groups, components(first)), spark, "jaccard-pairs")
    links = first.unionByName(stored(verified(texts, pairs, groups), spark, "jaccard-links"))
    # rows of a group hang on the id that stands for it
    member = sketch.where("n > 0 and id is not null").select("id", "n", "d1", "d2").distinct() \
        .join(groups.select("n", "d1", "d2", F.col("id").alias("stands")), ["n", "d1", "d2"]).select("id", "stands")
    labels = components(links.unionByName(member.where("id <> stands").select(F.col("id").alias("a"), F.col("stands").alias("b"))))
    return (sketch.select("id", F.col("n").alias("n_shingles")).join(labels.withColumnRenamed("node", "id"), "id", "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")))


def keep_one(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without near copies: of each component one row of its smallest id;
    rows with a null id stay. Rows that share that id are told apart by their text: each
    different text stays once, so none is lost that another document was dropped for."""
    chosen = join(docs, text=text, key=key).where("id = component_id").select(F.col("id").alias("_kept")).distinct()
    rows = docs.select(as_row(docs), quoted(key).cast("long").alias("_id"))
    kept = rows.where(F.col("_id").isNotNull()).join(chosen, F.col("_id") == F.col("_kept"), "left_semi") \
        .withColumn("_text", F.sha2(F.coalesce(F.col("row").getField(text).cast("string"), F.lit("")).cast("binary"), 256)).dropDuplicates(["_id", "_text"]).drop("_text")
    return kept.unionByName(rows.where(F.col("_id").isNull())).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return join(docs).withColumnRenamed("id", "doc_id")
