"""Benchmark decontamination by SimHash over item-sized windows.

Texts are words (ASCII lower-cased) and shingles of five words; an item of N shingles is
compared with windows of N consecutive shingles of a document, or with the whole document
where it is shorter. The similarity is the weighted Jaccard similarity of the shingle
counts; documents with a window of 0.75 or more are found, but for the chance that the
fingerprints miss the window (below). An item of one to four words is one shingle, its whole
sequence, and is found where a document holds it verbatim.

1. Windows. A window of w shingles with that similarity holds at least 3(N + w)/7 of the
   item's. Document shingles are joined with the items'; of the windows whose first shared
   shingle is the same, the one that starts there shares most, so only these are looked at.
   The one that shares most places stays, and each that shares more places than the first
   one shares different shingles: no other can be more similar.
2. Index. Windows and items get 64-bit SimHash fingerprints of their shingle counts. The
   multi-index holds, for each of eight 8-bit blocks of an item's fingerprint, all values
   within ``radius // 8`` bits; of two fingerprints within the radius at least one block
   is that close, so looking up the blocks of a window misses none of them. It holds the
   items' keys and fingerprints, and a window asks for the items it shares shingles with.
3. Candidates within the radius are verified by the exact similarity of their counts, in
   time linear in the item.

Only windows that pass step 1 are made: their places are stored, and the texts they lie in
are read again. Items are dealt into blocks whose shingles can be broadcast (each block reads
the texts once); index, items and places are broadcast behind a check of their size, else
the joins shuffle rows of bounded size.

The radius (23) is four standard deviations above the distance that a similarity of 0.75
gives (11 of 64 bits on average). A window of exactly 0.75 differs in more bits, and is
missed, with a chance of 2e-6 to 3.4e-4 (exact binomials for distinct shingles and
independent bits: 1.8e-5 for windows of 7 shingles, 8.3e-5 for 280, 3.4e-4 for a document
that is 3 of the 4 shingles of an item).

Defined results: null and empty texts match nothing; a text below five words holds short
items only; an item without words matches nothing; equal rows give one result row, and so do
items with equal ids (the best of their texts); null ids are ids; an empty table on either
side gives an empty result; extra columns are ignored. Of the best windows the first that
starts with a shared shingle is given (``start``: its place in shingles, the document's last
window if that shingle lies behind its start).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respengine.llm.common import stored, text_of
from respengine.operators.joins import broadcast_byte_limit, broadcast_row_limit

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 23
BLOCKS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# An upper bound of a broadcast row of a few numbers, with its share of the hash table.
ROW_BYTES = 96
RESULT = ["doc_id", "item_id", "similarity", "start", "n_shingles", "distance"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of the runs of ``width`` words, in order."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)]))


def shingles(rows: DataFrame, text: Column, *keep: Column, width: int = SHINGLE) -> DataFrame:
    """``keep``, ``hashes``: the hashes of the text's shingles.

    No filter may depend on ``hashes`` below a join: pushed down, it would compute the
    words again for every shingle. Hence the outer explode of the callers.
    """
    worded = rows.select(*keep, words_of(text).alias("_words"))
    names = [c for c in worded.columns if c != "_words"]
    return worded.select(*names, shingle_hashes(F.col("_words"), width).alias("hashes"))


def with_simhash(rows: DataFrame, hashes: str, name: str) -> DataFrame:
    """Adds a 64-bit fingerprint: a bit is set where more than half of the hashes have it.

    A long counts two bits that are 32 apart, so any number of hashes can be counted.
    """
    lanes = F.lit((1 << 32) + 1).cast("long")

    def counts(shift: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"),
                           lambda acc, h: acc + F.shiftrightunsigned(h, shift).bitwiseAND(lanes))

    def bit(i: int) -> Column:
        count = F.shiftright(F.get("_counts", F.lit(i % 32)), 32 * (i // 32)).bitwiseAND(
            F.lit(0xFFFFFFFF).cast("long"))
        return F.when(count * 2 > F.size(hashes), F.shiftleft(F.lit(1).cast("long"), i)) \
            .otherwise(F.lit(0).cast("long"))

    total = bit(0)
    for i in range(1, 64):
        total = total.bitwiseOR(bit(i))
    return rows.withColumn("_counts", F.array(*[counts(k) for k in range(32)])) \
        .withColumn(name, total).drop("_counts")


def block(fingerprint: Column, j: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * j).bitwiseAND(F.lit(255).cast("long")).cast("int")


def near_values(bits: int = 8, radius: int = RADIUS // BLOCKS) -> list[int]:
    """Differences of a block that are within the block's radius."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def numbered(rows: DataFrame, hashes: str, name: str) -> DataFrame:
    """Adds an array of distinct numbers: a hash, then one for each repetition of it."""
    s, starts = F.col("_sorted"), F.col("_starts")
    first = lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(s)))
    run = lambda i, end: F.transform(
        F.sequence(F.lit(0), end - i - 1), lambda k: F.when(k == 0, F.get(s, i)).otherwise(F.xxhash64(F.get(s, i), k)))
    return rows.withColumn("_sorted", F.sort_array(hashes)) \
        .withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size(s) - 1), first)) \
        .withColumn(name, F.flatten(F.zip_with(starts, ends, run))).drop("_sorted", "_starts")


def fits(spark: SparkSession, rows: int, width: int = ROW_BYTES) -> bool:
    """Whether so many rows of ``width`` bytes may be broadcast."""
    return rows <= broadcast_row_limit(spark) and rows * width <= broadcast_byte_limit(spark)


def small(df: DataFrame, rows: int, width: int = ROW_BYTES) -> DataFrame:
    return F.broadcast(df) if fits(df.sparkSession, rows, width) else df


def places(docs: DataFrame, text: Column, id_col: str, items: DataFrame, rows: int) -> DataFrame:
    """``doc_id, row, key, n, start``: the windows that can be most similar to an item."""
    anchors = items.select("key", "n", F.explode("item").alias("h")).distinct()
    hashed = shingles(docs, text, F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"))
    hits = hashed.withColumn("total", F.size("hashes")) \
        .select("doc_id", "row", "total", F.posexplode_outer("hashes").alias("p", "h")) \
        .join(small(anchors, rows), "h")
    n, total, last, need, shared = (F.col(c) for c in ("n", "total", "last", "need", "shared"))
    found = hits.groupBy("doc_id", "row", "key", "n", "total") \
        .agg(F.sort_array(F.collect_set(F.struct("p", "h"))).alias("shared")) \
        .withColumn("need", F.floor((3 * (n + F.least(n, total)) + 6) / 7).cast("int")) \
        .withColumn("last", F.greatest(total - n, F.lit(0))) \
        .where(F.size("shared") >= need)

    def start(x: Column, k: Column) -> Column:
        """The window of the k-th shared place, unless too few places lie in it."""
        s = F.least(x["p"], last)
        new = (k == 0) | (F.get(shared, k - 1)["p"] < last)
        enough = F.get(shared, k + need - 1)["p"] < s + n
        held = F.size(F.filter(F.slice(shared, k + 1, n), lambda y: y["p"] < s + n))
        return F.when(new & enough, F.struct(held.alias("held"), (-s).alias("back")))

    best = found.withColumn("starts", F.filter(F.transform(shared, start), lambda x: x.isNotNull())) \
        .withColumn("top", F.array_max("starts"))
    begin = -F.col("top")["back"]
    inside = F.filter(shared, lambda y: (y["p"] >= begin) & (y["p"] < begin + n))
    kept = best.withColumn("sure", F.size(F.array_distinct(F.transform(inside, lambda y: y["h"])))) \
        .withColumn("starts", F.filter("starts", lambda x: (x["back"] == F.col("top")["back"])
                                       | (x["held"] > F.col("sure"))))
    return kept.select("doc_id", "row", "key", "n", F.explode_outer("starts").alias("w")) \
        .select("doc_id", "row", "key", "n", (-F.col("w.back")).alias("start")).where("start is not null")


def windows_at(docs: DataFrame, text: Column, id_col: str, at: DataFrame) -> DataFrame:
    """``doc_id, key, n, start, window``: the hashes of the windows, from the texts they lie in."""
    wanted = at.groupBy("doc_id", "row").agg(F.collect_set(F.struct("key", "n", "start")).alias("wanted"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row")).alias("d")
    side = small(wanted, at.count()).alias("w")
    held = rows.join(side, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.row") == F.col("w.row"))) \
        .select("d.doc_id", "d.text", "w.wanted")
    return shingles(held, F.col("text"), F.col("doc_id"), F.col("wanted")) \
        .select("doc_id", "hashes", F.explode_outer("wanted").alias("w")) \
        .select("doc_id", "w.key", "w.n", "w.start", F.slice("hashes", F.col("w.start") + 1, F.col("w.n")).alias("window"))


def index_of(items: DataFrame) -> DataFrame:
    """``key, j, v, item_print``: the values near each block of an item's fingerprint."""
    blocks = F.array(*[F.struct(F.lit(j).alias("j"), block(F.col("item_print"), j).alias("v")) for j in range(BLOCKS)])
    near = F.transform(F.array(*[F.lit(x) for x in near_values()]), lambda x: x.bitwiseXOR(F.col("b.v")))
    return with_simhash(items.dropDuplicates(["key"]), "item", "item_print") \
        .select("key", "item_print", F.explode(blocks).alias("b")) \
        .select("key", "item_print", F.col("b.j").alias("j"), F.explode(near).alias("v"))


def long_items(docs: DataFrame, text: Column, id_col: str, items: DataFrame, count: int, hashes: int) -> DataFrame:
    """The result for items of five and more words."""
    at = stored(places(docs, text, id_col, items, hashes), "decontaminate")
    printed = with_simhash(windows_at(docs, text, id_col, at), "window", "print")
    looked = printed.select("*", F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), block(F.col("print"), j).alias("v")) for j in range(BLOCKS)])).alias("b")) \
        .select("doc_id", "key", "n", "start", "window", "print", F.col("b.j").alias("j"), F.col("b.v").alias("v"))
    index = small(index_of(items), count * BLOCKS * len(near_values()))
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # A pair may meet in several blocks; it counts in the first of them.
    first = F.coalesce(*[F.when(F.bit_count(block(differ, j)) <= RADIUS // BLOCKS, F.lit(j)) for j in range(BLOCKS)])
    close = looked.join(index, ["key", "j", "v"]).where((F.bit_count(differ) <= RADIUS) & (first == F.col("j"))) \
        .select("doc_id", "key", "n", "start", "window", F.bit_count(differ).alias("distance"))
    own = small(numbered(items, "item", "counted").select("item_id", "key", "counted"),
                count, ROW_BYTES + 8 * -(-hashes // max(1, count)))
    common = F.size(F.array_intersect("occurring", "counted"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.col("n"), "distance")).alias("best")
    return numbered(close, "window", "occurring").join(own, "key") \
        .withColumn("similarity", common / (F.size("occurring") + F.size("counted") - common)) \
        .where(F.col("similarity") >= SIMILARITY) \
        .groupBy("doc_id", "item_id").agg(best).select(
            "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"),
            F.col("best.n").alias("n_shingles"), F.col("best.distance").alias("distance"))


def short_items(docs: DataFrame, text: Column, id_col: str, items: DataFrame, count: int, width: int) -> DataFrame:
    """The result for items of ``width`` words: a window that is the item itself."""
    asked = items.where(F.col("width") == width).select("item_id", F.get("item", F.lit(0)).alias("h")).distinct()
    return shingles(docs, text, F.col(id_col).alias("doc_id"), width=width) \
        .select("doc_id", F.posexplode_outer("hashes").alias("p", "h")).join(small(asked, count), "h") \
        .groupBy("doc_id", "item_id").agg(F.min("p").alias("start")) \
        .select("doc_id", "item_id", F.lit(1.0).alias("similarity"), "start", F.lit(1).alias("n_shingles"),
                F.lit(0).alias("distance"))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, start, n_shingles, distance``: the best window of
    each contaminated document for each item in it."""
    spark, text = docs.sparkSession, text_of(text_col)
    worded = benchmark.select(F.col(item_col).alias("item_id"), words_of(text_of(item_text_col)).alias("_words"))
    whole = F.when(F.size("_words") == 0, F.array().cast("array<bigint>"))
    for width in range(1, SHINGLE):
        whole = whole.when(F.size("_words") == width, shingle_hashes(F.col("_words"), width))
    items = worded.select(
        "item_id", F.least(F.size("_words"), F.lit(SHINGLE)).alias("width"),
        whole.otherwise(shingle_hashes(F.col("_words"), SHINGLE)).alias("item")) \
        .select("item_id", "width", "item", F.size("item").alias("n"), F.xxhash64("item").alias("key"))
    items = stored(items, "decontaminate").where("n > 0")
    sizes = {r.width: r for r in items.groupBy("width").agg(F.count("*").alias("items"), F.sum("n").alias("n")).collect()}
    found = [short_items(docs, text, id_col, items, sizes[w].items, w) for w in range(1, SHINGLE) if w in sizes]
    long = items.where(F.col("width") == SHINGLE)
    blocks = 1
    if SHINGLE in sizes:
        most = min(broadcast_row_limit(spark), broadcast_byte_limit(spark) // ROW_BYTES)
        blocks = -(-int(sizes[SHINGLE].n) // max(1, most * 3 // 4)) if not fits(spark, sizes[SHINGLE].n) else 1
    part = F.pmod("key", F.lit(blocks))
    in_block = {r.b: r for r in long.groupBy(part.alias("b")).agg(
        F.count("*").alias("items"), F.sum("n").alias("n")).collect()}
    for b in range(blocks):
        if b in in_block or (not found and b == 0):
            count, hashes = (in_block[b].items, in_block[b].n) if b in in_block else (0, 0)
            found.append(long_items(docs, text, id_col, long.where(part == b), count, hashes))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    # A block or a width has one text of an item; an item id may have several.
    if len(found) > 1:
        best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_shingles", "distance")).alias("best")
        out = out.groupBy("doc_id", "item_id").agg(best).select(
            "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"),
            "best.n_shingles", "best.distance")
    return out.select(*RESULT)
