"""Benchmark decontamination by templates.

Numbers, units after a number, and names (capitalised words inside a sentence) become typed placeholders; other words
are levelled to lower case without punctuation. A question with other values, people or measures thus has the same
template. Windows of ``window`` template words of each item are joined, by hash, with those of every document.
Matches on one diagonal (the same distance between place in document and place in item) belong together; along it
each slot value of the item must stand for one value in the document, and each name in the document for one of the
item. Windows with a pair of values against this are left out, unless all values in them are the item's own. A
document is contaminated by an item when consistent matches cover the share ``coverage`` of the item's windows, or
``enough`` windows of one diagonal.

A window with fewer than ``min_plain`` words that are no placeholders is found by its words with their values; beside a
window found by its template on the same diagonal its template will do. The first window of an item is also sought with
its first word as a name, as a copy inside a sentence has it; that word must then be the same.

Only DataFrame operations, and one pass over the texts for windows of all sizes. The items' windows are broadcast while measured and small,
else a Bloom filter of them goes ahead and only windows that may match are shuffled. Wide
texts are not shuffled: only documents with matches are read again for their slot values. A passage that stands in a
third of all documents gives matches per document; all grouping is by document, item and diagonal, whose size the
item bounds.

Defined results: null and empty texts match nothing; an item with fewer than ``min_plain`` words that are no
placeholders is found where its words stand with its values; an item shorter than a window is one window of its own size, and one of
fewer than ``least_words`` words is common speech and is not sought. Texts of any length are read whole. Repeated rows and equal items are
reported once per key and item, however often an item matches; null keys are reported like any other. An empty table gives no
rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, bounded, join_few, without

WINDOW = 8
MIN_PLAIN = 4
LEAST_WORDS = 5
COVERAGE = 0.5
ENOUGH = 6

# Units of measure, time and money.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "ton", "tons",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "mph", "kmh", "celsius", "fahrenheit", "kelvin", "degree", "degrees", "percent",
    "meter", "meters", "metre", "metres", "kilometer", "kilometers", "centimeter", "centimeters",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur",
)

#: Private characters that mark a slot; its value follows.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
_MARKS = f"[{NAME}-{UNIT}]"
_NAME = r"\p{Lu}(?<=[^.!?:]\x20\p{Lu})\p{Ll}[\p{L}'-]*"
_NUMBER = rf"[0-9](?<![\p{{L}}\p{{N}}{NAME}-{UNIT}][0-9])[0-9]*(?:[.,:/][0-9]+)*"
_UNIT = rf"({_NUMBER})[\x20]?({'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
_DROPPED = rf"[^\p{{L}}\p{{N}}\x20{NAME}-{UNIT}]+"
#: White space that is not one space already.
_SPACE = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def slotted(text: Column) -> Column:
    """The words of a text in one line; a word in a slot has the slot's mark before it."""
    clean = F.coalesce(text, F.lit(""))
    clean = F.when(F.regexp_like(clean, F.lit(_MARKS)), F.regexp_replace(clean, _MARKS, "")).otherwise(clean)
    named = F.regexp_replace(F.regexp_replace(clean, _SPACE, " "), _NAME, f"{NAME}$0")
    measured = F.regexp_replace(named, f"(?i){_UNIT}", f"{NUMBER}$1 {UNIT}$2")
    numbered = F.regexp_replace(measured, _NUMBER, f"{NUMBER}$0")
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(numbered), _DROPPED, ""), "  +", " "))


def template(line: Column) -> Column:
    """The array of template words of a slotted line."""
    return F.split(F.regexp_replace(line, f"({_MARKS})[^ ]*", "$1"), " ")


def _kinds(words: Column) -> Column:
    """The template words of an array of slotted words."""
    return F.transform(words, lambda w: F.when(F.regexp_like(w, F.lit(f"^{_MARKS}")), F.substring(w, 1, 1)).otherwise(w))


def _hashes(kinds: Column) -> Column:
    """The hash of each template word."""
    return F.transform(kinds, lambda kind: F.xxhash64(kind))


def _dense(hashes: Column, min_plain: int) -> Column:
    """Whether a window, by its words' hashes, has fewer than ``min_plain`` words that are no placeholders."""
    return F.size(reduce(F.array_remove, [F.xxhash64(F.lit(slot)) for slot in (NAME, NUMBER, UNIT)], hashes)) < min_plain


def _mark(hashes: Column, values: Column, min_plain: int) -> Column:
    """The hash a window is found by: that of its template, or of its words with their values when too few are plain."""
    return F.when(_dense(hashes, min_plain), F.xxhash64(values)).otherwise(F.xxhash64(hashes))


def text_windows(lines: DataFrame, sizes: list[int], min_plain: int) -> DataFrame:
    """key, row_hash, size, at, mark: the windows of all ``sizes`` in slotted lines (key, row_hash, line).

    Each word is hashed once, and each window is a row before its mark is taken: generated code then cuts it out of the hashes, where a
    function over an array of windows would be interpreted, word by word.
    """
    hashes = _hashes(template(F.col("line"))).alias("hashes")
    words = lines.select("key", "row_hash", hashes, F.split("line", " ").alias("values"))
    last = F.size("hashes") - F.col("size")
    places = words.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    places = places.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at"))
    first, size = F.col("at") + 1, F.col("size")
    cut = places.select("key", "row_hash", "size", "at", "values", F.slice("hashes", first, size).alias("window"))
    return cut.select("key", "row_hash", "size", "at", _mark(F.col("window"), F.slice("values", first, size), min_plain).alias("mark"))


def item_windows(items: DataFrame, text: str, item: str, window: int, min_plain: int, least_words: int = LEAST_WORDS) -> DataFrame:
    """item, size, place, mark, shape, dense, named, slots: the windows of the items.

    shape: the hash of the template. dense: found by their values. named: the first window once more, with the first word
    as a name, where the words before a copy may make it one. slots: (offset, value) of the marked words.
    """
    plain = slotted(F.col(text))
    follows = F.substring(slotted(F.concat(F.lit("x "), F.btrim(F.col(text), F.lit(" \t\n\v\f\r")))), 3, 1 << 30)
    lines = items.select(F.col(item).alias("item"), plain.alias("line"), follows.alias("follows")).where("line <> ''").distinct()
    both = F.array(
        F.struct(F.lit(False).alias("named"), F.col("line")),
        F.when(F.col("follows") != F.col("line"), F.struct(F.lit(True).alias("named"), F.col("follows").alias("line"))),
    )
    rows = lines.select("item", F.explode(F.array_compact(both)).alias("form")).select("item", "form.*").distinct()
    rows = rows.select("item", "named", template(F.col("line")).alias("kinds"), F.split("line", " ").alias("values"))
    rows = rows.where(F.size("kinds") >= least_words).withColumn("size", F.least(F.lit(window), F.size("kinds")))
    last = F.when(F.col("named"), 0).otherwise(F.size("kinds") - F.col("size"))
    rows = rows.withColumn("place", F.explode(F.sequence(F.lit(0), last)))
    part = F.slice("kinds", F.col("place") + 1, F.col("size"))
    values = F.slice("values", F.col("place") + 1, F.col("size"))
    slots = F.filter(
        F.transform(values, lambda v, i: F.struct(i.alias("offset"), v.alias("value"))),
        lambda slot: F.regexp_like(slot["value"], F.lit(f"^{_MARKS}")),
    )
    return rows.select(
        "item", "size", "place", _mark(_hashes(part), values, min_plain).alias("mark"), F.xxhash64(part).alias("shape"),
        _dense(_hashes(part), min_plain).alias("dense"), "named", slots.alias("slots"),
    )


def contaminations(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item: str = "item_id",
    window: int = WINDOW, min_plain: int = MIN_PLAIN, coverage: float = COVERAGE, enough: int = ENOUGH, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """key, row_hash, item, matched, windows: a row for each document and item found in it."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    known = scratch.write(item_windows(items, item_text, item, window, min_plain, least_words), "items")
    sizes = sorted(row["size"] for row in known.select("size").distinct().collect())  # at most ``window`` numbers
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("row_hash"))

    lines = rows.select("key", "row_hash", slotted(F.col("text")).alias("line"))

    columns = ("item", "place", "at", "size", "shape", "dense")
    if sizes:
        every = text_windows(lines, sizes, min_plain)
        sought = known.select("item", "place", F.col("mark").alias("k_mark"), F.col("size").alias("k_size"), "shape", "dense")
        met = join_few(every, sought, [(F.col("mark"), "k_mark"), (F.col("size"), "k_size")])
    else:
        met = rows.select("key", "row_hash", *[F.lit(None).alias(c) for c in columns]).where("false")
    found = scratch.write(met.select("key", "row_hash", *columns).distinct(), "matches")

    suspects = found.select(F.col("key").alias("s_key"), F.col("row_hash").alias("s_hash")).distinct()
    read_again = join_few(rows, suspects, [(rows["key"], "s_key"), (rows["row_hash"], "s_hash")], "left_semi")
    values = read_again.select(
        F.col("key").alias("v_key"), F.col("row_hash").alias("v_hash"), F.split(slotted(F.col("text")), " ").alias("values")
    ).dropDuplicates(["v_key", "v_hash"])
    of_item = known.select(
        F.col("item").alias("k_item"), F.col("place").alias("k_place"), F.col("size").alias("k_size"), F.col("shape").alias("k_shape"),
        F.col("dense").alias("k_dense"), "named", "slots",
    )
    same_item = F.col("item").eqNullSafe(F.col("k_item"))
    at_item = same_item & (F.col("place") == F.col("k_place")) & (F.col("size") == F.col("k_size")) & (F.col("shape") == F.col("k_shape"))
    direct = found.join(bounded(of_item), at_item).select(
        "key", "row_hash", "item", "place", (F.col("at") - F.col("place")).alias("diagonal"), "size", "shape", "named", "slots"
    )
    # Beside a window found by its template, those of few plain words may have other values too.
    anchors = found.where("not dense").select("key", "row_hash", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    beside = anchors.join(bounded(of_item.where("k_dense and not named")), same_item).select(
        "key", "row_hash", "item", F.col("k_place").alias("place"), "diagonal", F.col("k_size").alias("size"),
        F.col("k_shape").alias("shape"), "named", "slots",
    )
    at = F.col("diagonal") + F.col("place")
    pairs = F.transform("slots", lambda s: F.struct(s["value"].alias("one"), F.get("values", at + s["offset"]).alias("other")))
    here = F.when(at >= 0, F.slice("values", at + 1, F.col("size")))
    both = (
        direct.unionByName(beside)
        .join(values, F.col("key").eqNullSafe(F.col("v_key")) & (F.col("row_hash") == F.col("v_hash")))
        .where(F.xxhash64(_kinds(here)) == F.col("shape"))
        .select("key", "row_hash", "item", "place", "diagonal", "named", pairs.alias("pairs"))
        .where(~F.col("named") | (F.get("pairs", F.lit(0))["one"] == F.get("pairs", F.lit(0))["other"]))
    )
    both = both.withColumn("verbatim", F.forall("pairs", lambda p: p["one"] == p["other"]))
    diagonals = both.groupBy("key", "row_hash", "item", "diagonal").agg(
        F.collect_set(F.struct("place", "verbatim", "pairs")).alias("hits"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    all_pairs = F.col("pairs")

    def conflict(p: Column) -> Column:
        """Another pair of the diagonal gives the value another one, or the name another owner."""

        def against(q: Column) -> Column:
            owner = p["other"].startswith(NAME) & (p["other"] == q["other"]) & (p["one"] != q["one"])
            return ((p["one"] == q["one"]) & (p["other"] != q["other"])) | owner

        return F.exists(all_pairs, against)

    one, other = F.size(F.array_distinct("pairs.one")), F.size(F.array_distinct("pairs.other"))
    consistent = (F.size("pairs") == one) & (F.size("pairs") == other)
    bad = F.when(~consistent, F.filter("pairs", conflict)).otherwise(F.slice("pairs", 1, 0))
    diagonals = diagonals.withColumn("bad", bad)
    bad_pairs = F.col("bad")
    good = F.filter("hits", lambda hit: hit["verbatim"] | ~F.arrays_overlap(hit["pairs"], bad_pairs))
    diagonals = diagonals.select("key", "row_hash", "item", F.array_distinct(F.transform(good, lambda hit: hit["place"])).alias("places"))
    n_windows = known.where("not named").groupBy(F.col("item").alias("n_item")).agg(F.count(F.lit(1)).alias("windows"))
    covered = diagonals.where(F.size("places") > 0).groupBy("key", "row_hash", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"), F.max(F.size("places")).alias("longest")
    )
    return (
        covered.join(n_windows, F.col("item").eqNullSafe(F.col("n_item")))
        .where((F.col("matched") >= F.ceil(F.col("windows") * coverage)) | (F.col("longest") >= enough))
        .select("key", "row_hash", "item", F.col("matched").cast("long").alias("matched"), "windows")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` in which no item was found, as they were."""
    found = contaminations(docs, items, text, key, **settings).select("key", "row_hash").distinct()
    gone = Scratch(docs.sparkSession, "contaminated").write(found, "rows")
    return without(docs, gone, key, F.xxhash64(docs[text]))
