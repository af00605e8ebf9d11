"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: numbers, names (capital words inside a sentence) and units (after a number) are replaced by typed
placeholders, the rest is lower-cased words. Windows of template tokens of benchmark items are looked up by hash in those
of all documents. Along each alignment of a document with an item, the values in the slots must agree up to a renaming:
each item value stands against one document value and the other way round. A document leaks an item if consistent
alignments cover enough of the item's windows, or one of them runs on for long; so re-parameterised questions are caught
as well as exact copies.

Names are told by their capitals, so three kinds of evidence are looked for, each with a coverage of its own: templates as
above; templates of the case-folded text, in which names are literal words; and these together with the windows of few
literal words, which are compared as they are, numbers and units too. White space of any kind and length counts as one blank.

Cases: null and empty texts have no windows; items shorter than a window are one window of their own length; windows
with under half literal words count as they are only, and not at all where an item is shorter than a window; items without any window leak nowhere; repeated rows give repeated matches, told once for each (doc_id, item_id)
with the kind that covers most; rows with a null id take no part, as there is nothing to report or drop them by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.session import materialize

NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"
#: Units of measure, as words after a number.
UNITS = """mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec secs min mins h hr hrs ms hz khz mhz ghz kb mb gb tb w kw kwh v a j kj cal kcal
pa bar k c f second seconds minute minutes hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers
kilometre kilometres mile miles foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres
dollar dollars euro euros cent cents percent degrees degree""".split()
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:] \p{Lu})[\p{L}\p{N}]*+"
_NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*"
_UNITS = "(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
_UNIT = "(?<=[0-9] ?)" + _UNITS
#: The plain characters come first in these classes, as they are the quick ones to tell.
_SPACE = r"[\s\u0080-\uffff&&[\s\p{Z}]]++"
_GAP = r"[^a-zA-Z\p{L}" + NUMBER + "-" + NAME + "]++"
#: Kinds of windows.
TEMPLATE, FOLDED, WORDS = 0, 1, 2
#: Hashes of windows that are broadcast at most (8 bytes each).
BLOCK = 1_000_000


def template(text: Column) -> Column:
    """Array of template tokens."""
    text = F.regexp_replace(text, _SPACE, " ")
    marked = F.regexp_replace(F.regexp_replace(text, _NAME, f" {NAME} "), f"([0-9] ?){_UNITS}", f"$1 {UNIT} ")
    marked = F.regexp_replace(marked, _NUMBER, f" {NUMBER} ")
    cut = F.array_remove(F.split(F.regexp_replace(F.lower(marked), _GAP, " "), " "), "")
    return F.coalesce(cut, F.array().cast("array<string>"))


def slot_values(text: Column) -> Column:
    """Array of what stands in the slots, in order, lower-cased."""
    text = F.regexp_replace(text, _SPACE, " ")
    return F.transform(F.regexp_extract_all(text, F.lit(f"{_NAME}|{_NUMBER}|{_UNIT}"), F.lit(0)), F.lower)


def folded_words(text: Column) -> Column:
    """Array of the case-folded words and numbers of a text."""
    found = F.regexp_extract_all(F.lower(F.upper(text)), F.lit(_NUMBER + r"|\p{L}+"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _is_number(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def folded_template(words: Column) -> Column:
    """Template tokens in the places of folded_words(); names stay words."""
    unit = lambda w, i: w.isin(UNITS) & (i > 0) & _is_number(F.get(words, i - 1))
    return F.transform(words, lambda w, i: F.when(_is_number(w), NUMBER).when(unit(w, i), UNIT).otherwise(w))


def _all_tokens(rows: DataFrame, key: str) -> DataFrame:
    """(key, and the tokens of each kind: t0, t1, t2) of rows (key, text)."""
    cut = rows.select(key, template(F.col("text")).alias("t0"), folded_words(F.col("text")).alias("t2"))
    return cut.select(key, "t0", folded_template(F.col("t2")).alias("t1"), "t2")


def _marks(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _hash(marks: Column, at: Column, length: int, kind: int) -> Column:
    """Hash of the window of `length` tokens at a place; marks are hashes of tokens."""
    return F.xxhash64(F.lit(kind), *(F.get(marks, at + i) for i in range(length)))


def _part_hash(part: Column, window: int, kind: int) -> Column:
    """The same hash of a window that stands alone, of up to `window` tokens."""
    whole = [F.when(F.size(part) == n, _hash(_marks(part), F.lit(0), n, kind)) for n in range(1, window + 1)]
    return F.coalesce(*whole)


def _windows(marks: Column, length: int, kind: int, places: Column | None = None) -> Column:
    """Array of (dpos, hash), of all windows or of those at some places."""
    last = F.size(marks) - length
    shown = lambda i: F.struct(i.alias("dpos"), _hash(marks, i, length, kind).alias("hash"))
    at = F.sequence(F.lit(0), last) if places is None else F.filter(places, lambda i: i <= last)
    return F.when(last >= 0, F.transform(at, shown)).otherwise(F.array().cast("array<struct<dpos:int,hash:bigint>>"))


def _near_slots(tokens: Column, length: int) -> Column:
    """Places of the windows of a length with a number or unit in them."""
    slots = F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(NUMBER, UNIT), i)), lambda i: i.isNotNull())
    return F.array_distinct(F.flatten(F.transform(slots, lambda i: F.sequence(F.greatest(i - (length - 1), F.lit(0)), i))))


def _slots(rows: DataFrame, key: str) -> DataFrame:
    """(key, kind, pos, value) of every slot of rows (key, text); FOLDED and WORDS have the same."""
    cut = rows.select(key, template(F.col("text")).alias("t0"), slot_values(F.col("text")).alias("values"), folded_words(F.col("text")).alias("t2"))
    cut = cut.select(key, "t0", "values", folded_template(F.col("t2")).alias("t1"), "t2")
    places = lambda tokens: F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(NUMBER, UNIT, NAME), i)), lambda i: i.isNotNull())
    zipped = cut.select(key, F.lit(TEMPLATE).alias("kind"), F.explode(F.arrays_zip(places("t0").alias("pos"), F.col("values").alias("value"))).alias("z"))
    folded = F.filter(F.transform("t1", lambda t, i: F.when(t.isin(NUMBER, UNIT), F.struct(i.alias("pos"), F.get("t2", i).alias("value")))), lambda z: z.isNotNull())
    zipped = zipped.union(cut.select(key, F.explode(folded).alias("z")).select(key, F.explode(F.array(F.lit(FOLDED), F.lit(WORDS))).alias("kind"), "z"))
    return zipped.select(key, "kind", F.col("z.pos").alias("pos"), F.col("z.value").alias("value"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 5,
    coverage: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    run: int = 50,
) -> DataFrame:
    """(doc_id, item_id, matched, n_windows, coverage, n_slots): pairs of which coverage or more of the item, or `run` tokens of it on end, are found."""
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    items = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].cast("string").alias("text")).dropDuplicates(["item_id", "text"])
    cut = None
    for kind in (TEMPLATE, FOLDED):
        tokens = _all_tokens(items, "item_id").select("item_id", F.col(f"t{kind}").alias("tokens"), F.col("t2").alias("words"))
        tokens = tokens.where("item_id is not null and size(tokens) > 0").withColumn("length", F.least(F.lit(window), F.size("tokens")))
        slices = lambda i: F.struct(*(F.slice(c, i + 1, F.col("length")).alias(c) for c in ("tokens", "words")))
        part = tokens.select("item_id", "length", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("tokens") - F.col("length")), slices)).alias("ipos", "p"))
        literal = F.size(F.filter("p.tokens", lambda t: ~t.isin(NUMBER, UNIT, NAME)))
        rich = part.where(literal * 2 > F.col("length")).select("item_id", F.lit(kind).alias("kind"), F.lit(kind).alias("by"), "length", "ipos", _part_hash(F.col("p.tokens"), window, kind).alias("hash"))
        cut = rich if cut is None else cut.union(rich)
        if kind == FOLDED:
            poor = part.where((literal * 2 <= F.col("length")) & (F.col("length") == window))
            cut = cut.union(poor.select("item_id", F.lit(WORDS).alias("kind"), F.lit(WORDS).alias("by"), "length", "ipos", _part_hash(F.col("p.words"), window, WORDS).alias("hash")))
            both = rich.join(poor.select("item_id").distinct(), "item_id", "left_semi")
            cut = cut.union(both.withColumn("kind", F.lit(WORDS)))
    cut = materialize(cut, "item-windows")
    kinds = sorted((r["length"], r["by"]) for r in cut.select("length", "by").distinct().collect())  # at most 3 times `window` values
    hashes = cut.select("hash").distinct()
    many = hashes.count()

    docs = docs.where("doc_id is not null")
    tokens = _all_tokens(docs, "doc_id")
    used = sorted({by for _, by in kinds})
    # Windows of few literals are looked up as they are only where there are numbers or units.
    tokens = tokens.withColumn("near", _near_slots(F.col("t1"), window) if WORDS in used else F.array().cast("array<int>"))
    marks = {by: _marks(F.col(f"t{by}")) for by in used}
    if WORDS in used:
        marks[WORDS] = F.when(F.size("near") > 0, marks[WORDS]).otherwise(F.array().cast("array<bigint>"))
    tokens = tokens.select("doc_id", "near", *(c.alias(f"m{by}") for by, c in marks.items()))
    # One pass over the documents for windows of all lengths. Hashes of many windows are joined by a shuffle, which
    # Spark cuts down by a bloom filter of the hashes where it pays.
    none = F.array().cast("array<struct<dpos:int,hash:bigint>>")
    shown = F.concat(none, *(_windows(F.col(f"m{by}"), n, by, F.col("near") if by == WORDS else None) for n, by in kinds))
    shown = tokens.select("doc_id", F.explode(shown).alias("w")).select("doc_id", "w.dpos", "w.hash")
    found = materialize(shown.join(F.broadcast(hashes) if many <= BLOCK else hashes, "hash", "left_semi"), "window-hits")

    # Documents with enough different windows of an item; then their alignments. A document that leaks an item has one of
    # the item's rarest windows, more of them than it may lack, or the rarest of each stretch that a long run must hold
    # whole; so windows that very many documents and items have meet only where one of these does too.
    pair = ["doc_id", "item_id", "kind"]
    totals = cut.groupBy("item_id", "kind").agg(F.count("*").alias("n_windows"))
    seen = found.groupBy("hash").agg(F.count("*").alias("seen"))
    rare = cut.join(seen, "hash").join(totals, ["item_id", "kind"])
    stretch = max(1, (run - window + 1) // 2)
    by_rank = Window.partitionBy("item_id", "kind").orderBy("seen", "hash", "ipos")
    by_stretch = Window.partitionBy("item_id", "kind", F.floor(F.col("ipos") / stretch)).orderBy("seen", "hash", "ipos")
    # Windows that no document has are the rarest: all of them that are lacking count as lacking.
    lacking = F.col("n_windows") - F.count("*").over(Window.partitionBy("item_id", "kind"))
    may_lack = F.floor((1 - coverage) * F.col("n_windows") + 1e-9) - lacking
    rare = rare.select("item_id", "kind", "hash", (F.row_number().over(by_rank) <= may_lack + 1).alias("probe"), (F.row_number().over(by_stretch) == 1).alias("milestone"))
    rare = rare.where("probe or milestone").select("item_id", "kind", "hash").distinct()
    candidates = materialize(found.select("doc_id", "hash").distinct().join(rare, "hash").select(*pair).distinct(), "leak-pairs")
    met = candidates.join(cut.select("item_id", "kind", "hash", "ipos", "length"), ["item_id", "kind"]).join(found, ["doc_id", "hash"])
    met = met.select(*pair, "ipos", (F.col("dpos") - F.col("ipos")).alias("shift"), "length").distinct()
    enough = met.groupBy(*pair).agg(F.countDistinct("ipos").alias("matched")).join(totals, ["item_id", "kind"])
    least = F.least(coverage * F.col("n_windows"), F.lit(run / window))
    enough = materialize(enough.where(F.col("matched") >= least).select(*pair), "leak-candidates")
    met = materialize(met.join(enough.hint("shuffle_hash"), pair, "left_semi"), "leak-windows")
    lines = met.groupBy(*pair, "shift").agg(F.min("ipos").alias("lo"), F.max(F.col("ipos") + F.col("length")).alias("hi"))

    suspects = semi(docs, enough.select("doc_id").distinct(), "doc_id")
    doc_slots = _slots(suspects, "doc_id").select("doc_id", "kind", F.col("pos").alias("at"), F.col("value").alias("theirs"))
    item_slots = _slots(items, "item_id").select("item_id", "kind", F.col("pos").alias("ipos"), F.col("value").alias("ours"))
    slots = lines.join(item_slots, ["item_id", "kind"]).where("ipos >= lo and ipos < hi").withColumn("at", F.col("ipos") + F.col("shift"))
    slots = slots.join(doc_slots, ["doc_id", "kind", "at"]).groupBy(*pair, "shift")
    checked = slots.agg(
        F.countDistinct("ours", "theirs").alias("pairs"), F.countDistinct("ours").alias("n_ours"), F.countDistinct("theirs").alias("n_theirs"), F.count("*").alias("n_slots")
    )
    kept = met.join(checked, [*pair, "shift"], "left").where("pairs is null or (pairs = n_ours and pairs = n_theirs)")

    # Tokens on end: a window that starts beyond the end of the one before it starts a new run.
    order = Window.partitionBy(*pair, "shift").orderBy("ipos")
    gap = F.coalesce(F.col("ipos") - F.lag("ipos").over(order) > F.col("length"), F.lit(False))
    runs = kept.withColumn("part", F.sum(gap.cast("int")).over(order)).groupBy(*pair, "shift", "part")
    runs = runs.agg((F.max(F.col("ipos") + F.col("length")) - F.min("ipos")).alias("run")).groupBy(*pair).agg(F.max("run").alias("run"))

    final = kept.groupBy(*pair).agg(F.countDistinct("ipos").alias("matched"), F.coalesce(F.max("n_slots"), F.lit(0)).alias("n_slots"))
    final = final.join(totals, ["item_id", "kind"]).join(runs, pair).withColumn("coverage", F.col("matched") / F.col("n_windows"))
    final = final.where((F.col("coverage") >= coverage) | (F.col("run") >= run))
    best = F.max_by(F.struct("matched", "n_windows", "coverage", "n_slots"), F.struct("coverage", -F.col("kind"))).alias("best")
    return final.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


#: Ids that are broadcast at most.
SMALL = 2_000_000


def semi(rows: DataFrame, ids: DataFrame, key: str, kind: str = "left_semi") -> DataFrame:
    """Rows whose key is (left_semi) or is not (left_anti) among ids. Ids are broadcast if they are few, as counted."""
    return rows.join(F.broadcast(ids) if ids.count() <= SMALL else ids, key, kind)
