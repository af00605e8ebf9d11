"""Document fingerprints by SpotSigs.

A signature is a common word (the anchor) with the two content words that follow it, common words skipped. A text's
fingerprint is the set of its signatures, each a 32-bit hash. Sets are compared by Jaccard, and pairs whose set lengths
alone rule the threshold out are never compared.

Cases: a null text is an empty one; its fingerprint is "". Two empty fingerprints have likeness 1, one empty and one
not 0. The start of a text is an anchor, so every text with a word has a signature; a text without words but with other
characters has one signature, of its characters. Where eight words pass without a common word (tables, lists, other
languages), content words whose hash is divisible by four become anchors, until the next common word.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.session import arrow_rows, shuffle_partitions

#: Common words of English, French, German and Spanish.
COMMON = frozenset(
    """a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the
    their them there they this to was we were what when which who will with would you
    au aux avec ce ces dans de des du elle en est et il ils la le les leur lui mais ne nous on ou par pas pour qu que
    qui sa se ses son sont sur un une vous
    als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
    ist mit nach nicht noch oder sich sie sind so um und vom von vor war was wie wir zu zum zur
    al como con del el ella entre era esta este fue ha las lo los mas me mi muy más no o para pero por se ser si sin
    sobre su sus te todo una y ya""".split()
)
_WORD = re.compile(r"[^\W_]+")
_FLAG = 1 << 32
_LONG_GAP = 8
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _WordHash(dict):
    """crc32 of a word, with a flag bit for common words. Emptied when full, so it stays small."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        value = zlib.crc32(word.encode("utf-8", "surrogatepass")) | (_FLAG if word in COMMON else 0)
        self[word] = value
        return value


_HASHES = _WordHash()


def signatures(text: str | None) -> np.ndarray:
    """The text's signature set: sorted distinct unsigned 32-bit hashes."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.array([zlib.crc32(text.encode("utf-8", "surrogatepass"))] if text else [], dtype="<u4")
    codes = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.int64, count=len(words))
    common = codes >= _FLAG
    at = np.arange(len(codes))
    since = at - np.maximum.accumulate(np.where(common, at, -1))
    anchors = np.flatnonzero(common | ((since >= _LONG_GAP) & ((codes & 3) == 0)))
    content = np.append(codes[~common], [0, 0, 0]).astype(np.uint64)  # chains past the end hold zeros
    seen = np.cumsum(~common)  # content words up to and with each word
    first = np.append([0], seen[anchors])  # position of the chain; the start of the text comes first
    heads = np.append([1], codes[anchors] & 0xFFFFFFFF).astype(np.uint64)
    mixed = heads * _M1 ^ (content[first] + np.uint64(7)) * _M2 ^ (content[first + 1] + np.uint64(13)) * _M3
    mixed ^= mixed >> np.uint64(29)
    mixed *= _M1
    found = np.sort((mixed >> np.uint64(32)).astype("<u4"))
    return found[np.append([True], found[1:] != found[:-1])]


def encode(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode("ascii")


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard of two signature sets; 0 without a comparison where their lengths keep it under floor."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < floor * large:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (small + large - shared)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_signatures, fingerprint) of every row of df."""
    arrow_rows(df.sparkSession)

    def run(batches):
        for batch in batches:
            sets = [signatures(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([encode(s) for s in sets])],
                ["doc_id", "n_signatures", "fingerprint"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_signatures long, fingerprint string"
    )


def near_pairs(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_a, doc_b, likeness): pairs of different signature sets with likeness of threshold or more.

    Sets fall into partitions by length, each as wide as the threshold allows, so that a set meets only its own and the
    next partition. There, sets meet if they share one of their first (smallest-hash) signatures. Equal sets are one
    class, with the smallest doc_id as its name; empty sets take no part.
    """
    spark = df.sparkSession
    classes = (
        fingerprints(df, id_col, text_col)
        .where("n_signatures > 0")
        .groupBy("fingerprint", "n_signatures")
        .agg(F.min("doc_id").alias("doc"))
    )
    width = float(np.log(1 / threshold))
    arrow_rows(spark)
    kind = classes.schema["doc"].dataType.simpleString()

    def heads(batches):
        for batch in batches:
            docs, lengths, slots, keys = [], [], [], []
            for doc, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = decode(fp)
                n = len(s)
                slot = int(np.log(n) / width)
                first = s[: n - int(np.ceil(threshold * n - 1e-9)) + 1].tolist()
                for part in (slot, slot + 1):
                    docs += [doc] * len(first)
                    lengths += [n] * len(first)
                    slots += [(part << 1) | (part != slot)] * len(first)
                    keys += first
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, batch.column(0).type), pa.array(lengths, pa.int64()), pa.array(slots, pa.int64()), pa.array(keys, pa.int64())],
                ["doc", "n", "slot", "key"],
            )

    index = classes.select("doc", "fingerprint").mapInArrow(heads, f"doc {kind}, n long, slot long, key long")
    left, right = index.alias("l"), index.where("slot % 2 = 0").alias("r")
    met = (
        left.join(right, (F.col("l.key") == F.col("r.key")) & (F.shiftright("l.slot", 1) == F.shiftright("r.slot", 1)))
        .where("(l.slot % 2 = 1 or l.doc < r.doc)")
        .where(F.expr(f"least(l.n, r.n) >= {threshold} * greatest(l.n, r.n)"))
        .select(F.least("l.doc", "r.doc").alias("doc_a"), F.greatest("l.doc", "r.doc").alias("doc_b"))
        .distinct()
    )
    a = classes.select(F.col("doc").alias("doc_a"), F.col("fingerprint").alias("fa"))
    b = classes.select(F.col("doc").alias("doc_b"), F.col("fingerprint").alias("fb"))

    def verify(batches):
        for batch in batches:
            like = [likeness(decode(x), decode(y), threshold) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(like, pa.float64())], ["doc_a", "doc_b", "likeness"])

    return (
        met.join(a, "doc_a")
        .join(b, "doc_b")
        .select("doc_a", "doc_b", "fa", "fb")
        .mapInArrow(verify, f"doc_a {kind}, doc_b {kind}, likeness double")
        .where(F.col("likeness") >= threshold)
    )


_EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long"
)


def _edit_rows(batches):
    """Rows sorted by bucket, visitor flag and descending doc_id: each row with the next one of its bucket."""
    held, out = None, []

    def flush():
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        names = [c.split()[0] for c in _EDIT_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in batches:
        for bucket, visitor, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            text = text or ""
            own = signatures(text)
            if held is not None and held[0] == bucket:
                _, before_id, before, before_set = held
                half = len(before) // 2
                edited = before[: len(before) - half] + text[:half]
                edited_set = signatures(edited)
                out.append(
                    (
                        before_id,
                        len(before),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        encode(before_set),
                        encode(edited_set),
                        likeness(before_set, edited_set),
                        likeness(before_set, own),
                        len(before_set),
                    )
                )
                if len(out) >= 128:
                    yield flush()
                    out = []
            held = None if visitor else (bucket, doc_id, text, own)
    if out:
        yield flush()


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets_per_partition: int = 4) -> DataFrame:
    """Each text's fingerprint against that of its edited text and of the next document, by descending doc_id.

    The edited text has its last floor(n/2) code points replaced by as many from the start of the next document; after
    the last document comes the first. Rows with equal doc_id are ordered by text, null doc_ids come last.

    Documents are dealt once, by ranges of doc_id. The first document of each range also visits the range before, so
    that each range is read as a stream with one row of look-ahead. Range bounds and first ids (a few numbers for each
    partition) pass through the driver; rows find their range by bisection. Rows of one id, or without one, share a range.
    """
    spark = df.sparkSession
    arrow_rows(spark)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    parts = shuffle_partitions(spark)
    n = parts * buckets_per_partition
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000).alias("c")).first()["c"]
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)
    nowhere = len(bounds) + 1  # the range of rows without an id, behind all others

    def ranges(ids: pa.Array) -> np.ndarray:
        """The number of bounds over each id, so that ranges ascend as ids descend."""
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), nowhere, len(bounds) - np.searchsorted(bounds, values, "right")).astype(np.int32)

    def largest(batches):
        first: dict[int, int | None] = {}
        for batch in batches:
            for bucket, doc_id in zip(ranges(batch.column(0)).tolist(), batch.column(0).to_pylist(), strict=True):
                first[bucket] = doc_id if bucket not in first or doc_id is None else max(first[bucket], doc_id)
        yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int32()), pa.array(list(first.values()), pa.int64())], ["bucket", "first"])

    firsts = docs.select("doc_id").mapInArrow(largest, "bucket int, first long").groupBy("bucket").agg(F.max("first").alias("first")).orderBy("bucket").collect()
    if not firsts:
        return spark.createDataFrame([], _EDIT_SCHEMA)
    seats = [r["bucket"] for r in firsts]
    before = np.full(nowhere + 1, -1, np.int32)  # the range before each one that has rows; the last one, for the first
    first_of = np.full(nowhere + 1, np.iinfo(np.int64).min, np.int64)
    for i, row in enumerate(firsts):
        before[row["bucket"]] = seats[i - 1]
        if row["first"] is not None:
            first_of[row["bucket"]] = row["first"]

    def deal(batches):
        for batch in batches:
            bucket = ranges(batch.column(0))
            ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            visiting = np.flatnonzero(first_of[bucket] == ids)
            twice = pa.array(np.concatenate([np.arange(len(ids)), visiting]))
            where = np.concatenate([bucket, before[bucket[visiting]]])
            visitor = np.concatenate([np.zeros(len(ids), bool), np.ones(len(visiting), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(visitor), batch.column(0).take(twice), batch.column(1).take(twice)], ["bucket", "visitor", "doc_id", "text"])

    return (
        docs.mapInArrow(deal, "bucket int, visitor boolean, doc_id long, text string")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "visitor", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
        .mapInArrow(_edit_rows, _EDIT_SCHEMA)
    )
