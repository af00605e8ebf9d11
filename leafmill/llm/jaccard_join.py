"""N-gram Jaccard join by grouped prefixes.

A document is the set of its word n-grams. Sets are ordered rare grams first; two sets at or over the threshold share a
gram among the first few of each (their prefixes). Documents with equal sets are one class, classes with equal prefix
and size one group. Groups, not documents, are indexed by prefix grams; group pairs pass size, prefix and position
filters, then members are expanded and verified on their full sets.

Links matter only as far as they connect, so no clique is expanded: verification runs in two passes. The first follows a
few neighbours of each group in its lists of equal grams; the second takes every remaining pair that passes the filters
and whose members are not connected yet. Each link between different components is found that way, and no pair inside a
connected cluster is looked at again.

The order of grams comes from counts of heavy grams over all documents (at most `heavy_limit` of them, a fixed bound).
It only decides which grams come first; any order gives the same result.

Cases: null and empty texts, and texts of blanks, have empty sets and link with nothing; repeated rows are equal sets;
a text with fewer than n words has one gram, the whole sequence; a null id is carried through and never names a component.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.session import arrow_rows, drop_scratch, materialize, shuffle_partitions
from leafmill.llm.graph import components

_BITS = 25
_SMALL = 16
_BLOCK = 50_000
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25, 0xA0761D6478BD642F)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(_ODD[0])
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(_ODD[1])
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None, cache: dict) -> np.ndarray:
    """Hashes of the words between blanks, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram at each position; of the whole sequence where there are fewer than n words."""
    if not len(words):
        return words
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        total += (words[i : len(words) - size + 1 + i] ^ np.uint64(i)) * np.uint64(_ODD[i % len(_ODD)])
    return mixed(total + np.uint64(size))


def unique(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by sorting, which beats hashing on sets of this size."""
    x = np.sort(x)
    return x[np.append([True], x[1:] != x[:-1])] if len(x) else x


def portions(texts: list, most: int = 1_000_000):
    """texts in runs of up to `most` characters, single longer ones alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text or "") > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield held


def batch_grams(texts: list[str | None], n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes of all texts one after the other, number of them in each text); texts of fewer than n words have none."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    whole = np.fromiter(map(cache.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(counts.sum()))
    if len(whole) < n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    grams = gram_hashes(whole, n)
    inside = np.arange(len(grams)) + n <= np.repeat(np.cumsum(counts), counts)[: len(grams)]
    return grams[inside], np.maximum(counts - n + 1, 0)


def gram_set(text: str | None, n: int, cache: dict) -> np.ndarray:
    return unique(gram_hashes(word_hashes(text, cache), n))


def sketch(grams: np.ndarray, slots: int = 512) -> np.ndarray:
    """Parities of the grams in slots, packed in longs. Two sketches differ in at most as many bits as the sets in grams."""
    parity = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (slots - 1), minlength=slots) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def overlap_needed(a, b, percent: int):
    return -(-percent * (a + b) // (100 + percent))


def probe_length(size, percent: int):
    return size + (-percent * size) // 100 + 1


def index_length(size, percent: int):
    return size + (-2 * percent * size) // (100 + percent) + 1


class Order:
    """Sorts a set: rare grams by hash, then the heavy ones by count. The keys name the grams from then on."""

    def __init__(self, heavy: np.ndarray):
        """heavy: heavy grams, lightest first."""
        self.grams = np.sort(heavy)
        self.rank = np.argsort(heavy)  # place in `heavy` of each sorted gram

    def keys(self, grams: np.ndarray) -> np.ndarray:
        keys = grams >> np.uint64(1)
        if len(self.grams) and len(grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            hit = self.grams[at] == grams
            keys[hit] = np.uint64(1 << 63) | self.rank[at[hit]].astype(np.uint64)
        return np.sort(keys)


def heavy_grams(texts: DataFrame, n: int, limit: int, least_seen: int = 4) -> np.ndarray:
    """Grams of least_seen documents or more, lightest first, at most limit.

    Each task counts the grams that repeat within its chunks of documents and tells at most limit of them; sums are
    taken over all tasks. A histogram by powers of 2 ** (1/8) gives the count from which at most limit grams are left.
    """

    def run(batches):
        cache, parts, held = _WordHash(), [], 0
        grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def fold():
            nonlocal grams, counts, parts, held
            if not parts:
                return
            g, c = np.unique(np.concatenate(parts), return_counts=True)
            g, c = np.append(grams, g[c > 1]), np.append(counts, c[c > 1])
            grams, at = np.unique(g, return_inverse=True)
            counts = np.bincount(at, weights=c, minlength=len(grams)).astype(np.int64)
            if len(grams) > 2 * limit:
                keep = np.sort(np.argsort(-counts, kind="stable")[:limit])
                grams, counts = grams[keep], counts[keep]
            parts, held = [], 0

        for batch in batches:
            for text in batch.column(0).to_pylist():
                parts.append(gram_set(text, n, cache))
                held += len(parts[-1])
            if held > 1_500_000:
                fold()
        fold()
        keep = np.flatnonzero(counts > 3)
        keep = keep[np.argsort(-counts[keep], kind="stable")[:limit]]
        yield pa.RecordBatch.from_arrays([pa.array(grams[keep].view(np.int64)), pa.array(counts[keep])], ["gram", "seen"])

    seen = texts.mapInArrow(run, "gram long, seen long").groupBy("gram").agg(F.sum("seen").alias("seen"))
    seen = materialize(seen.withColumn("level", F.floor(F.log2("seen") * 8).cast("int")), "heavy")
    levels = sorted(((r["level"], r["n"]) for r in seen.groupBy("level").agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for level, many in levels:
        if total + many > limit:
            break
        least, total = level, total + many
    if least is None:
        return np.zeros(0, np.uint64)
    rows = seen.where((F.col("level") >= least) & (F.col("seen") >= least_seen)).select("gram", "seen").toPandas().sort_values(["seen", "gram"])
    drop_scratch(texts.sparkSession, seen)
    return rows["gram"].to_numpy(np.int64).view(np.uint64)


def _slots(x: Column) -> Column:
    return F.pmod(F.xxhash64(x), F.lit(1 << _BITS)) + 1


def _name(grams, data: bytes = b"") -> int:
    """64-bit name of a set, or of a size with the bytes of a prefix."""
    head, body = (grams.to_bytes(8, "little"), data) if isinstance(grams, int) else (len(grams).to_bytes(8, "little"), grams.tobytes())
    return int.from_bytes(hashlib.blake2b(head + body, digest_size=8).digest(), "little", signed=True)


class Members:
    """A fixed-size bitmap over hashed values: no false "absent", some false "present", for up to MOST values."""

    MOST = 8_000_000

    def __init__(self, values: DataFrame, column: str):
        slot = _slots(F.col(column))
        rows = (
            values.select(slot.alias("slot"))
            .select(F.bitmap_bucket_number("slot").alias("bucket"), F.bitmap_bit_position("slot").alias("bit"))
            .groupBy("bucket")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
            .collect()
        )
        self.bits = np.zeros((1 << _BITS) // 8, dtype=np.uint8)
        for row in rows:
            part = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
            start = (row["bucket"] - 1) * len(part)
            self.bits[start : start + len(part)] = part
        self.shared = values.sparkSession.sparkContext.broadcast(self.bits)

    @staticmethod
    def hit(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
        at = slots - 1  # bucket k holds the values after (k - 1) * 32768
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _pairs_pass(n1, p1, n2, p2, percent):
    """Filters of a pair that meets at a gram: sizes, prefix of the smaller one, positions."""
    swap = n1 > n2
    small, at_s = np.where(swap, n2, n1), np.where(swap, p2, p1)
    large, at_l = np.where(swap, n1, n2), np.where(swap, p1, p2)
    return (
        (100 * small >= percent * large)
        & ((at_s < index_length(small, percent)) | (small == large))
        & (1 + np.minimum(small - at_s - 1, large - at_l - 1) >= overlap_needed(small, large, percent))
    )


def _runs(batches, n_columns, limit=None):
    """(columns, cut key): whole runs of equal keys (first column), from rows sorted by it.

    With a limit, a run of more rows comes in several parts; its key is then told as the cut key with each of them.
    """
    rest, cut_key = None, None
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_columns)]
        if rest is not None:
            cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
        if not len(cols[0]):
            continue
        cut = np.flatnonzero(cols[0] != cols[0][-1])
        cut = cut[-1] + 1 if len(cut) else 0
        rest = [c[cut:] for c in cols]
        if cut:
            yield [c[:cut] for c in cols], cut_key
        if limit and len(rest[0]) > limit:
            cut_key = rest[0][0]
            yield rest, cut_key
            rest = None
    if rest is not None and len(rest[0]):
        yield rest, cut_key


def _bounds(keys):
    starts = np.append([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1)
    return starts, np.append(starts[1:], len(keys)) - starts


_SKETCH = [f"s{i}" for i in range(8)]
#: Sets over this size, whose differences 512 slots can't tell apart, have a second sketch of that many slots.
_LARGE, _WIDE = 800, 8192
_MET = "kind int, x long, y long, z long"


def _met_batch(out):
    kinds = np.concatenate([np.full(len(o[1]), o[0], np.int32) for o in out]) if out else np.zeros(0, np.int32)
    cols = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in (1, 2, 3)]
    return pa.RecordBatch.from_arrays([pa.array(kinds), *[pa.array(c) for c in cols]], ["kind", "x", "y", "z"])


def _meet(percent: int):
    """From postings (gram, grp, place) sorted by gram: kind 0 neighbours in a list, 1 pairs of a short list, 2 postings of a long one."""

    def run(batches):
        for (gram, grp, place), cut_key in _runs(batches, 3, _BLOCK):
            starts, lengths = _bounds(gram)
            long = (lengths > _SMALL) | (gram[starts] == cut_key if cut_key is not None else False)
            size, pos = place >> 32, place & 0xFFFFFFFF
            out = []

            def told(kind, i, j, grp=grp, size=size, pos=pos, out=out):
                ok = _pairs_pass(size[i], pos[i], size[j], pos[j], percent)
                a, b = grp[i[ok]], grp[j[ok]]
                out.append((kind, np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), np.int64)))

            for m in range(2, _SMALL + 1):
                at = starts[(lengths == m) & ~long]
                if len(at):
                    i, j = np.triu_indices(m, 1)
                    told(1, (at[:, None] + i).ravel(), (at[:, None] + j).ravel())
            for s, m in zip(starts[long], lengths[long], strict=True):
                at = np.arange(s, s + m)
                scale = np.floor(np.log(size[at]) / np.log(100 / percent) * 2)
                shuffled = mixed(grp[at].view(np.uint64) ^ gram[s : s + 1].view(np.uint64))
                at = at[np.lexsort((shuffled, scale))]
                told(0, at[:-1], at[1:])
                out.append((2, gram[at], grp[at], place[at]))
            yield _met_batch(out)

    return run


def _rest(percent: int, closest: bool):
    """From shards of long lists, sorted by shard: pairs of members in different components.

    closest: of the pairs of a member with one component, only that with the most similar sketches.

    role 0: members of the list's largest component, 2: other members, 1: a block of the same other members. A shard holds
    one block of each side, so it stays bounded however many members are outside of the largest component.
    """

    def run(batches):
        for (shard, role, place, member, comp, *parts), _ in _runs(batches, 13):
            marks = np.stack(parts, axis=1)
            starts, lengths = _bounds(shard)
            size, pos = place >> 32, place & 0xFFFFFFFF
            for s, m in zip(starts, lengths, strict=True):
                at = np.arange(s, s + m)
                base = at[role[at] != 1]
                base = base[np.lexsort((member[base], size[base]))]
                sizes = size[base]
                for i in at[role[at] == 1]:
                    j = base[np.searchsorted(sizes, -(-percent * size[i] // 100), "left") : np.searchsorted(sizes, 100 * size[i] // percent, "right")]
                    j = j[(comp[j] != comp[i]) & ((role[j] == 0) | (member[j] > member[i]))]
                    x = np.full(len(j), i)
                    ok = _pairs_pass(size[x], pos[x], size[j], pos[j], percent)
                    apart = np.bitwise_count((marks[j] ^ marks[i]).view(np.uint64)).sum(axis=1, dtype=np.int64)
                    ok &= apart <= size[x] + size[j] - 2 * overlap_needed(size[x], size[j], percent)
                    x, j, apart = x[ok], j[ok], apart[ok]
                    if closest and len(j):
                        order = np.lexsort((member[j], apart, comp[j]))
                        order = order[np.append([True], comp[j[order[1:]]] != comp[j[order[:-1]]])]
                        x, j = x[order], j[order]
                    a, b = member[x], member[j]
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _plausible(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) without those whose wide sketches rule the threshold out; pairs without two of them stay."""

    def run(batches):
        for batch in batches:
            keep = []
            for m, x, n, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                if x is None or y is None:
                    keep.append(True)
                    continue
                bits = int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum())
                keep.append(bits <= m + n - 2 * overlap_needed(m, n, percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    one = wide.select(F.col("member").alias("a"), F.col("size").alias("m"), F.col("wide").alias("x"))
    two = wide.select(F.col("member").alias("b"), F.col("size").alias("n"), F.col("wide").alias("y"))
    return pairs.join(one, "a", "left").join(two, "b", "left").select("a", "b", "m", "x", "n", "y").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that are at or over the threshold."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(unique(np.concatenate([x, y])))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    left = sets.select(F.col("member").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("member").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long")


def _unconnected(members, lead, met, met_pairs, roots, near, side, parts: int, percent: int, closest: bool) -> DataFrame:
    """(a, b): pairs of members that met, pass the filters and are in different components of roots."""
    labelled = members.join(roots, members["member"] == roots["node"], "left").withColumn("comp", F.coalesce("root", "member")).drop("root", "node", "first_doc")
    labelled = materialize(labelled, "labelled")
    short = met_pairs.where("kind = 1").select("grp_1", "grp_2").union(lead.where("many > 1").select("grp", "grp"))
    one, two = side(labelled, ("grp", "member", "comp"), 1), side(labelled, ("grp", "member", "comp"), 2)
    apart = short.join(one, "grp_1").join(two.withColumnRenamed("grp_2", "other"), F.expr("grp_2 = other and comp_1 <> comp_2 and (grp_1 <> grp_2 or member_1 < member_2)") & near)
    apart = apart.select(F.least("member_1", "member_2").alias("a"), F.greatest("member_1", "member_2").alias("b"))

    long_lists = met.where("kind = 2").select(F.col("x").alias("gram"), F.col("y").alias("grp"), F.col("z").alias("place")).join(labelled.select("grp", "member", "comp"), "grp")
    by_comp = long_lists.groupBy("gram", "comp").agg(F.count("*").alias("n"))
    lists = by_comp.groupBy("gram").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("comps")).where("comps > 1")
    # Cells of a list: `down` blocks of all members by `across` blocks of those outside the largest component.
    lists = lists.select("gram", "largest", F.ceil(F.col("n") / _BLOCK).cast("int").alias("down"), F.ceil((F.col("n") - F.col("most")) / _BLOCK).cast("int").alias("across"))
    other = F.col("comp") != F.col("largest")
    block = lambda n, salt: F.pmod(F.xxhash64("member", F.lit(salt)), n).cast("int")
    seat = lambda i, j, role: F.struct((i * F.col("across") + j).alias("shard"), role.alias("role"))
    base = F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda j: seat(block(F.col("down"), 0), j, F.when(other, 2).otherwise(0)))
    guests = F.when(other, F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda i: seat(i, block(F.col("across"), 1), F.lit(1))))
    seats = F.concat(base, F.coalesce(guests, F.array().cast("array<struct<shard:int,role:int>>")))
    long_pairs = (
        long_lists.join(lists, "gram")
        .join(labelled.select("member", *_SKETCH), "member")
        .select("gram", "place", "member", "comp", *_SKETCH, F.explode(seats).alias("seat"))
        .select(F.xxhash64("gram", "seat.shard").alias("shard"), "seat.role", "place", "member", "comp", *_SKETCH)
        .repartition(parts, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_rest(percent, closest), "a long, b long")
    )
    return apart.union(long_pairs).distinct()


def link_components(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", heavy_limit: int = 100_000) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row of df.

    Two rows link where 100 * shared >= percent * union of their n-gram sets; component_id is the smallest doc_id that
    links reach from a row, itself included. class_id is the smallest doc_id among rows with the same set.
    """
    spark = df.sparkSession
    arrow_rows(spark)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    heavy = spark.sparkContext.broadcast(heavy_grams(docs.select("text"), n, heavy_limit))

    def sign(batches):
        cache, order = _WordHash(), Order(heavy.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                grams = gram_set(text, n, cache)
                size = len(grams)
                if not size:
                    rows.append((0, None, None, None, None, *[None] * 8))
                    continue
                prefix = order.keys(grams)[: probe_length(size, percent)].tobytes()
                rows.append((size, _name(grams), _name(size, prefix), prefix, sketch(grams, _WIDE).tobytes() if size > _LARGE else None, *sketch(grams).tolist()))
            cols = list(zip(*rows, strict=True)) or [()] * 13
            arrays = [pa.array(c, pa.binary() if i in (3, 4) else pa.int64()) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "size", "member", "grp", "prefix", "wide", *_SKETCH])

    signed = docs.mapInArrow(sign, "doc_id long, size long, member long, grp long, prefix binary, wide binary, " + ", ".join(f"{c} long" for c in _SKETCH))
    signed = materialize(signed, "signed")
    marks = [F.max(c).alias(c) for c in ("size", *_SKETCH)]  # equal for all rows of a member
    members = signed.where("size > 0").groupBy("member", "grp").agg(F.min("doc_id").alias("first_doc"), *marks)
    members = materialize(members, "members")
    wide = signed.where("wide is not null").select("member", "size", "wide").dropDuplicates(["member"])
    wide = materialize(wide, "wide-sketches")

    def postings(batches):
        for batch in batches:
            grams, groups, places = [], [], []
            for grp, size, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                keys = np.frombuffer(prefix, np.int64)
                grams.append(keys)
                groups.append(np.full(len(keys), grp, np.int64))
                places.append((size << 32) + np.arange(len(keys), dtype=np.int64))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (grams, groups, places)], ["gram", "grp", "place"])

    parts = shuffle_partitions(spark)
    groups = signed.where("size > 0").select("grp", "size", "prefix").dropDuplicates(["grp"])
    index = groups.mapInArrow(postings, "gram long, grp long, place long")
    arrow_rows(spark, 20_000)  # narrow rows
    met = materialize(index.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(_meet(percent), _MET), "met")
    arrow_rows(spark)

    def sets_of(pairs):
        """(member, grams) of at least the members of pairs (a, b), read from the texts again."""
        needed = members.join(pairs.select(F.explode(F.array("a", "b")).alias("member")).distinct(), "member", "left_semi")
        keys = needed.select(F.coalesce("first_doc", F.lit(-1)).alias("key"))
        few = keys.count() <= Members.MOST
        bits = Members(keys, "key").shared if few else None

        def run(batches):
            cache = _WordHash()
            for batch in batches:
                texts = batch.column(1)
                if few:
                    texts = texts.filter(pa.array(Members.hit(bits.value, batch.column(0).to_numpy(zero_copy_only=False))))
                found = [g for g in (gram_set(t, n, cache) for t in texts.to_pylist()) if len(g)]
                yield pa.RecordBatch.from_arrays([pa.array([_name(g) for g in found], pa.int64()), pa.array([g.tobytes() for g in found], pa.binary())], ["member", "grams"])

        chosen = docs.withColumn("key", F.coalesce("doc_id", F.lit(-1)))
        if not few:  # the bitmap would let most texts pass
            chosen = chosen.join(keys.distinct(), "key", "left_semi")
        return materialize(chosen.select(_slots(F.col("key")).alias("slot"), "text").mapInArrow(run, "member long, grams binary"), "sets")

    def side(table, key, suffix):
        """(grp or member renamed, size and sketch with a suffix) for near()."""
        return table.select(*[F.col(c).alias(f"{c}_{suffix}") for c in (*key, "size", *_SKETCH)])

    bits_apart = " + ".join(f"bit_count({c}_1 ^ {c}_2)" for c in _SKETCH)
    near = F.expr(f"{bits_apart} <= size_1 + size_2 - 2 * ceil({percent} * (size_1 + size_2) / {100 + percent}.0D)")

    # First pass: a few neighbours of each group, through one member each, and neighbours within groups.
    lead = members.groupBy("grp").agg(F.min(F.struct("member", "size", *_SKETCH)).alias("m"), F.count("*").alias("many")).select("grp", "many", "m.*")
    lead = materialize(lead, "leads")
    met_pairs = met.where("kind < 2").groupBy(F.col("x").alias("grp_1"), F.col("y").alias("grp_2")).agg(F.max("kind").alias("kind"))
    met_pairs = met_pairs.join(side(lead, ("grp", "member", "many"), 1), "grp_1").join(side(lead, ("grp", "member", "many"), 2), "grp_2")
    met_pairs = met_pairs.withColumn("near", near).where("near or many_1 > 1 or many_2 > 1")
    met_pairs = materialize(met_pairs.select("grp_1", "grp_2", "member_1", "member_2", "kind", "near"), "met-pairs")
    some = F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("member_1", "member_2").alias("h"), F.col("member_2").alias("b")))), 1, 2)
    first = met_pairs.where("near").groupBy(F.col("member_1").alias("a")).agg(some.alias("some")).select("a", F.explode("some").alias("s")).select("a", "s.b")
    inside = side(members.join(lead.where("many > 1").select("grp"), "grp", "left_semi"), ("grp", "member"), 1)
    inside = inside.join(side(lead.where("many > 1"), ("grp", "member"), 2), F.expr("grp_1 = grp_2 and member_1 <> member_2")).where(near)
    first = first.union(inside.select("member_1", "member_2")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = materialize(_plausible(first.where("a <> b").distinct(), wide, percent), "pairs")
    first_sets = sets_of(first)
    links = materialize(_verified(first, first_sets, percent), "links")
    roots = materialize(components(links), "roots")

    drop_scratch(spark, first_sets)

    # Second pass: whatever passes the filters and is not connected yet; first only the closest pairs, which connect most.
    seen = first
    for closest in (True, False):
        pairs = _unconnected(members, lead, met, met_pairs, roots, near, side, parts, percent, closest).join(seen, ["a", "b"], "left_anti")
        pairs = materialize(_plausible(pairs, wide, percent), "pairs")
        sets = sets_of(pairs)
        links = materialize(_verified(pairs, sets, percent).union(links), "links")
        drop_scratch(spark, sets)
        roots = materialize(components(links), "roots")
        seen = seen.union(pairs)

    named = members.join(roots, members["member"] == roots["node"], "left").select("member", "first_doc", F.coalesce("root", "member").alias("comp"))
    names = named.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    named = named.join(names, "comp").select("member", F.col("first_doc").alias("class_id"), "component_id")
    return (
        signed.select("doc_id", "size", "member")
        .join(named, "member", "left")
        .select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    )
