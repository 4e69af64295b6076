"""Benchmark decontamination in DataFrame functions alone.

1. Texts become lower-case words.  A window that is similar to an item holds most of
   the item's shingles (five words, or the whole item where it is shorter), so windows
   of the item's size are taken only where that many of them stand: nothing is lost.
2. Each such window gets a 64-bit SimHash of its words.  A multi-index finds every item
   of that size within ``RADIUS`` bits: fingerprints are cut into ``BLOCKS`` blocks, one
   of which differs in at most RADIUS // BLOCKS bits, and the index holds every item
   under all block values that near.
3. Multisets of shingles verify: sum of minima over sum of maxima of the counts, at
   least 0.75 in whole numbers.

Work follows the number of words and, beyond that, of windows near real hits; hot
shingles are never grouped, they only meet the item table.

Defined results: null and empty texts or items match nothing; an item of fewer than
five words is one shingle of that many words; equal rows (id and text) are one document
or item; rows that share an id but not the text are looked at each on their own and
reported under that id; the first of several equally similar windows is reported; empty
tables give no row.  Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import broadcast_below, pick, restored, row_key, with_number
from gristmill.scratch import materialize

SHINGLE = 5
#: Similarity of at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 3, 4
RADIUS, BLOCKS = 18, 6
#: Up to so many rows of item shingles or of hits are broadcast, larger tables are shuffled.
BROADCAST_ROWS = 1_000_000

_WIDTHS = [64 // BLOCKS + (i < 64 % BLOCKS) for i in range(BLOCKS)]
_STARTS = [sum(_WIDTHS[:i]) for i in range(BLOCKS)]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingles(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order."""
    last = F.size(hashes) - width
    run = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(width), *(F.get(hashes, i + k) for k in range(width))))
    return F.when(last >= 0, run).otherwise(F.array().cast("array<long>"))


def fingerprints(rows: DataFrame, keys: list[str], hashes: Column) -> DataFrame:
    """SimHash of the hashes of each row: bit b is set where more than half of them have it.

    Two counters of 32 bits share a long, so 32 sums count the 64 bits.
    """
    low = 0x0000000100000001
    each = rows.select(*keys, F.explode(hashes).alias("__h"))
    sums = each.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *(F.sum(F.shiftrightunsigned("__h", b).bitwiseAND(F.lit(low))).alias(f"__{b}") for b in range(32)),
    )

    def bit(b: int) -> Column:
        count = F.shiftrightunsigned(f"__{b % 32}", 32 * (b // 32)).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(2 * count > F.col("__n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return sums.select(*keys, out.alias("fingerprint"))


def block_values(fingerprint: Column) -> Column:
    """(block, value) of every block of a fingerprint."""
    return F.array(*(
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, start).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for i, (start, width) in enumerate(zip(_STARTS, _WIDTHS))
    ))


def near_values(fingerprint: Column) -> Column:
    """(block, value) of every block and of all values that differ from it in at most RADIUS // BLOCKS bits."""
    masks = {w: F.filter(F.sequence(F.lit(0).cast("long"), F.lit((1 << w) - 1)), lambda m: F.bit_count(m) <= RADIUS // BLOCKS) for w in set(_WIDTHS)}

    def near(i: int) -> Column:
        own = F.shiftrightunsigned(fingerprint, _STARTS[i]).bitwiseAND(F.lit((1 << _WIDTHS[i]) - 1))
        return F.transform(masks[_WIDTHS[i]], lambda m: F.struct(F.lit(i).alias("block"), own.bitwiseXOR(m).alias("value")))

    return F.concat(*(near(i) for i in range(BLOCKS)))


def contaminated_windows(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                         item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """Best verified window of each document and item.

    (key, doc id, item id, start_word, n_words, hamming, shared, total): ``shared`` over ``total`` is the weighted
    similarity; ``key`` is ``row_key`` of the document.
    """
    pool = pick(items, item_column, item_text_column).distinct()
    pool = pool.select(F.col(item_column).alias("item"), F.xxhash64(*pool.columns).alias("item_key"), word_hashes(F.col(item_text_column)).alias("item_hashes"))
    pool = pool.withColumn("n", F.size("item_hashes")).where("n > 0").withColumn("width", F.least("n", F.lit(SHINGLE)))
    by_width = F.when(F.col("width") == SHINGLE, shingles(F.col("item_hashes"), SHINGLE))
    for width in range(1, SHINGLE):
        by_width = by_width.when(F.col("width") == width, shingles(F.col("item_hashes"), width))
    pool = materialize(pool.withColumn("item_shingles", by_width), "items")
    widths = sorted(row["width"] for row in pool.select("width").distinct().collect())  # at most five numbers

    own = pick(docs, id_column, text_column)
    keyed = own.select(F.col(id_column).alias("doc"), row_key(F.col(id_column), F.col(text_column)).alias("key"), word_hashes(F.col(text_column)).alias("hashes"))
    wanted = pool.select("item_key", "n", "width", F.explode("item_shingles").alias("shingle")).distinct()
    wanted = wanted.withColumn("least", F.ceil((F.col("n") - F.col("width") + 1) * NUMERATOR / F.lit(DENOMINATOR)))
    if not widths:
        widths = [SHINGLE]
    runs = [F.transform(shingles(F.col("hashes"), w), lambda h: h) for w in widths]
    parts = [keyed.select("doc", "key", F.size("hashes").alias("length"), F.lit(w).alias("w"), F.posexplode(run).alias("at", "shingle")) for w, run in zip(widths, runs)]
    seen = parts[0]
    for part in parts[1:]:
        seen = seen.unionByName(part)
    hits = seen.join(broadcast_below(wanted, BROADCAST_ROWS), "shingle").where("w = width")
    hits = materialize(hits.select("doc", "key", "length", "item_key", "n", "width", "least", "at").distinct(), "hits")
    enough = hits.groupBy("key", "item_key").agg(F.count(F.lit(1)).alias("found"), F.max("least").alias("least")).where("found >= least")
    hits = hits.join(enough.select("key", "item_key"), ["key", "item_key"])
    first = F.greatest(F.lit(0), F.col("at") + F.col("width") - F.col("n"))
    last = F.least(F.col("at"), F.col("length") - F.col("n"))
    starts = hits.where(first <= last).withColumn("start", F.explode(F.sequence(first, last)))
    windows = starts.groupBy("doc", "key", "n", "start", "item_key").agg(F.count(F.lit(1)).alias("found"), F.max("least").alias("least"))
    windows = windows.where("found >= least").select("doc", "key", "n", "start").distinct()
    windows = materialize(windows, "windows")
    texts = keyed.select("key", "hashes").join(broadcast_below(windows.select("key").distinct(), BROADCAST_ROWS), "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("hashes").alias("hashes"))
    windows = materialize(windows.join(texts, "key").select("doc", "key", "n", "start", F.slice("hashes", F.col("start") + 1, F.col("n")).alias("hashes")), "windows")

    printed = fingerprints(windows, ["key", "n", "start"], F.col("hashes"))
    probes = printed.select("*", F.explode(block_values(F.col("fingerprint"))).alias("b")).select("key", "n", "start", "fingerprint", "b.*")
    pooled = fingerprints(pool, ["item_key", "n"], F.col("item_hashes")).withColumnRenamed("fingerprint", "item_fingerprint")
    index = pooled.select("*", F.explode(near_values(F.col("item_fingerprint"))).alias("b")).select("item_key", "n", "item_fingerprint", "b.*")
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    near = probes.join(index, ["n", "block", "value"]).where(distance <= RADIUS)
    near = near.select("key", "n", "start", "item_key", distance.alias("hamming")).distinct()

    counts = pool.select("item_key", "item", "n", "width", F.explode("item_shingles").alias("shingle")).groupBy("item_key", "item", "n", "width", "shingle").agg(F.count(F.lit(1)).alias("in_item"))
    by_width = F.when(F.col("width") == SHINGLE, shingles(F.col("hashes"), SHINGLE))
    for width in range(1, SHINGLE):
        by_width = by_width.when(F.col("width") == width, shingles(F.col("hashes"), width))
    cut = windows.withColumn("width", F.least("n", F.lit(SHINGLE))).select("doc", "key", "n", "start", F.explode(by_width).alias("shingle"))
    cut = cut.groupBy("doc", "key", "n", "start", "shingle").agg(F.count(F.lit(1)).alias("in_window"))
    shared = cut.join(near, ["key", "n", "start"]).join(counts, ["item_key", "n", "shingle"])
    shared = shared.groupBy("doc", "key", "item", "item_key", "n", "width", "start", "hamming").agg(F.sum(F.least("in_item", "in_window")).alias("shared"))
    shared = shared.withColumn("total", 2 * (F.col("n") - F.col("width") + 1) - F.col("shared"))
    shared = shared.where(F.col("shared") * DENOMINATOR >= F.col("total") * NUMERATOR)
    best = shared.groupBy("key", "doc", "item").agg(F.max(F.struct(
        F.col("shared") / F.col("total"), -F.col("start").alias("s"), F.col("n"), F.col("start"), F.col("hamming"), F.col("shared"), F.col("total"),
    )).alias("best"))
    return best.select(
        "key", F.col("doc").alias(id_column), F.col("item").alias(item_column), F.col("best.start").alias("start_word"),
        F.col("best.n").alias("n_words"), F.col("best.hamming").cast("int").alias("hamming"), F.col("best.shared").alias("shared"),
        F.col("best.total").alias("total"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents (all rows and columns) without those that hold a verified window of an item."""
    found = contaminated_windows(docs, items, id_column, text_column).select(F.col("key").alias("__found")).distinct()
    found = materialize(found, "contaminated")
    plain = with_number(docs, (id_column, text_column), lambda c: {"__key": row_key(c[id_column], c[text_column])})
    kept = plain.join(broadcast_below(found, BROADCAST_ROWS), F.col("__key") == F.col("__found"), "left_anti")
    return restored(kept, docs)
