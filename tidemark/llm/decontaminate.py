"""Operator 7: benchmark passages in documents, with DataFrame functions only.

Windows have the size of a benchmark item and lie where the document shares a word shingle with
one, shifted so that both agree. Every window gets a weighted SimHash. A multi-index search cuts
fingerprints into ``radius + 1`` blocks: two within the radius agree in one block at least, so
joining on block values finds all of them. The exact weighted shingle similarity then decides.

Fingerprints and places in step leave passages out. So every document that holds one of an item's
anchors, the rarest shingles of which a passage cannot lack all, is also swept exactly: each place
of a shared shingle adds its weight to the starts whose window counts it, and all starts whose
sum is large enough are weighed. The result is the same for every radius.

A shingle weighs 1 / (items that hold it), so phrases common to many items count little. A
window's shingle that no item holds weighs as much as the item's mean shingle, so that copies of
an item and shared templates do not make an edited word outweigh the rest. A passage counts when
its weighted or its plain similarity is large enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored, without_ids

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BITS = 64
#: Fingerprints of windows with a similarity of 0.8 differ in about 13 bits of 64 if all shingles
#: weigh the same, and in more if they don't; what lies beyond the radius is found by the sweep.
RADIUS = 24
#: Sums of weights may be off by less than this.
SLACK = 1e-6


def words_of(text: Column) -> Column:
    """Words between blanks, A-Z in lower case; none for a null text."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingles_of(words: Column, size: Column) -> Column:
    """Hashes of all runs of ``size`` words, in order; none if there are fewer words."""
    last = F.size(words) - size + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<bigint>"))


def total(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)


def fingerprint(shingles: Column, weights: Column) -> Column:
    """SimHash: bit b is set where the weights of shingles with bit b outweigh the others."""
    pairs = F.arrays_zip(shingles.alias("h"), weights.alias("w"))
    side = lambda b: F.aggregate(
        pairs,
        F.lit(0.0),
        lambda a, p: a + F.when(F.getbit(p["h"], b) == 1, p["w"]).otherwise(-p["w"]),
    )
    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.when(side(b) > 0, F.expr("1L")).otherwise(F.expr("0L")))
    return F.aggregate(bits, F.expr("0L"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x))


def blocks_of(print_: Column, radius: int) -> Column:
    """(block number, block value) of a fingerprint cut into radius + 1 blocks."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    cut = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(print_, a).bitwiseAND((1 << (b - a)) - 1).alias("value"))
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return F.array(*cut)


def item_words(benchmark: DataFrame) -> DataFrame:
    """``(item_id, item, words)`` of items with words; equal texts have the same ``item`` key."""
    words = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words_of(F.col("text")).alias("words"))
    return words.where(F.size("words") > 0).select("item_id", F.xxhash64("words").alias("item"), "words").distinct()


def prepared_items(named: DataFrame) -> DataFrame:
    """``(item, n_words, size, shingles, weights, own, mean, print)``: a row for each distinct text.

    ``own`` is the weight of all its shingles, ``mean`` that of one.
    """
    texts = named.groupBy("item", "words").agg(F.count_distinct("item_id").alias("n_items"))
    sized = texts.select("*", F.size("words").alias("n_words"), F.least(F.lit(SHINGLE_WORDS), F.size("words")).alias("size"))
    keys = ["item", "n_words", "size"]
    each = sized.select(*keys, "n_items", F.posexplode(shingles_of(F.col("words"), F.col("size"))).alias("at", "h"))
    holders = each.select("item", "size", "h", "n_items").distinct()
    weight = holders.groupBy("size", "h").agg((F.lit(1.0) / F.sum("n_items")).alias("w"))
    back = each.join(weight, ["size", "h"]).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "h", "w"))).alias("_s"))
    shingles, weights = F.transform("_s", lambda s: s["h"]), F.transform("_s", lambda s: s["w"])
    own = back.select(*keys, shingles.alias("shingles"), weights.alias("weights")).withColumn("own", total(F.col("weights")))
    return own.withColumn("mean", F.col("own") / F.size("weights")).withColumn(
        "print", fingerprint(F.col("shingles"), F.col("weights"))
    )


def shared_places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, text_key, size, h, w, n_runs, places)``: where documents hold items' shingles.

    Rows with one doc_id and other words have other text keys; ``n_runs`` counts a row's shingles.
    """
    weight = items.select("size", F.explode(F.arrays_zip("shingles", "weights")).alias("_z")).select(
        F.col("size").alias("_size"), F.col("_z.shingles").alias("h"), F.col("_z.weights").alias("w")
    ).distinct()
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # 1 to 5
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    keyed = words.select("doc_id", F.xxhash64("words").alias("text_key"), F.size("words").alias("_n"), "words")
    found = None
    for size in sizes or [SHINGLE_WORDS]:
        n_runs = (F.col("_n") - size + 1).alias("n_runs")  # not the array's size: every run would carry the array
        runs = keyed.select(
            "doc_id", "text_key", F.lit(size).alias("size"), n_runs, F.posexplode(shingles_of(F.col("words"), F.lit(size))).alias("_pos", "h")
        )
        hits = runs.join(weight.where(F.col("_size") == size).drop("_size"), "h")
        found = hits if found is None else found.unionByName(hits)
    keys = ["doc_id", "text_key", "size", "h", "w", "n_runs"]
    return found.groupBy(*keys).agg(F.sort_array(F.collect_set("_pos")).alias("places"))


def seeded_windows(spots: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, start, n_words, size)``: windows of an item's size that share a shingle in place."""
    places = items.select("size", "n_words", F.posexplode("shingles").alias("_at", "h")).distinct()
    hits = spots.select("doc_id", "size", "h", F.explode("places").alias("_pos")).join(places, ["size", "h"])
    start = F.greatest(F.col("_pos") - F.col("_at"), F.lit(0))
    return hits.select("doc_id", start.alias("start"), "n_words", "size").distinct()


def swept_passages(spots: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``(doc_id, item, start, n_words, similarity)`` of all windows that reach the similarity.

    A shingle that the item holds c times counts at most c times: its place counts for the starts
    after the c-th place before it.
    """
    sized = items.select("item", "size", "n_words", "own", "mean", F.size("shingles").alias("m"), "shingles", "weights")
    marks = (
        sized.select("item", "size", "m", "own", F.explode(F.arrays_zip("shingles", "weights")).alias("_z"))
        .groupBy("item", "size", "m", "own", F.col("_z.shingles").alias("h"))
        .agg(F.count("*").cast("int").alias("c"), F.first("_z.weights").alias("_w"))
    )
    # Without its anchors an item keeps less than the similarity of its count and of its weight.
    rarest = Window.partitionBy("item").orderBy(F.desc("_w"), "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = 1 - similarity
    anchors = (
        marks.withColumn("_n", F.sum("c").over(rarest) - F.col("c"))
        .withColumn("_s", F.sum(F.col("c") * F.col("_w")).over(rarest) - F.col("c") * F.col("_w"))
        .where((F.col("_n") <= least * F.col("m") + SLACK) | (F.col("_s") <= least * F.col("own") + SLACK * F.col("own")))
        .select("item", "size", "h")
    )
    text = ["doc_id", "text_key", "size"]
    pairs = spots.select(*text, "h").join(anchors, ["size", "h"]).select(*text, "item").distinct()
    held = pairs.join(marks.select("item", "h", "c", "m"), "item").join(spots.select(*text, "h", "w", "places"), [*text, "h"])
    before = lambda i: F.when(i >= F.col("c"), F.get("places", i - F.col("c"))).otherwise(F.lit(-1))
    edge = lambda start, n, w: F.struct(start.alias("start"), n.alias("n"), w.alias("w"))
    edges = F.flatten(
        F.transform(
            "places",
            lambda p, i: F.array(
                edge(F.greatest(p - F.col("m"), before(i), F.lit(-1)) + 1, F.lit(1), F.col("w")), edge(p + 1, F.lit(-1), -F.col("w"))
            ),
        )
    )
    steps = (
        held.select(*text, "item", F.inline(edges))
        .groupBy(*text, "item", "start")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    )
    rising = Window.partitionBy(*text, "item").orderBy("start")
    so_far = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = steps.select(
        *text,
        "item",
        "start",
        F.lead("start").over(rising).alias("_until"),
        F.sum("n").over(so_far).alias("_n"),
        F.sum("w").over(so_far).alias("_w"),
    )
    enough = (F.col("_n") >= similarity * F.col("m") - SLACK) | (F.col("_w") >= (similarity - SLACK) * F.col("own"))
    kept = levels.where("_n > 0").join(sized.select("item", "n_words", "own", "mean", "m"), "item").where(enough)
    found = stored(
        kept.select(*text, "item", "n_words", "own", "mean", "m", "_n", "_w", F.explode(F.expr("sequence(start, _until - 1)")).alias("start")),
        "benchmark-levels",
    )
    known = spots.join(found.select(*text).distinct(), text, "left_semi").groupBy(*text).agg(
        F.first("n_runs").alias("n_runs"),
        F.flatten(F.collect_list(F.transform("places", lambda p: F.struct(p.alias("p"), F.col("w").alias("w"))))).alias("_known"),
    )
    inside = F.filter("_known", lambda k: (k["p"] >= F.col("start")) & (k["p"] < F.col("start") + F.col("m")))
    unknown = F.least(F.col("m"), F.col("n_runs") - F.col("start")) - F.size("_in")
    window = total(F.transform("_in", lambda k: k["w"])) + unknown * F.col("mean")
    weighted, plain = F.col("_w") / F.greatest(window, F.col("own")), F.col("_n") / F.col("m")
    return (
        found.join(known, text)
        .withColumn("_in", inside)
        .select("doc_id", "item", "start", "n_words", F.round(F.greatest(weighted, plain), 9).alias("similarity"))
        .where(F.col("similarity") >= similarity)
    )


def find_passages(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """``(doc_id, item_id, start, n_words, similarity)``: each document's best window per item.

    Similarity is the weight of the shingles that both hold, with multiplicity, over the larger
    weight of the two, once with weights and once with 1 for each; the larger of these counts. A
    window's shingle that no item holds weighs as much as the item's mean shingle. Documents and items
    without words match nothing; items of fewer than five words are one shingle. Rows without
    an id take no part; rows that repeat an id add windows to it. Ties go to the earliest window.
    """
    named = stored(item_words(benchmark), "benchmark-names")
    items = stored(prepared_items(named), "benchmark-items")
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    spots = stored(shared_places(known, items), "benchmark-places")
    windows = stored(seeded_windows(spots, items), "benchmark-windows")
    weight = items.select(F.explode(F.arrays_zip("shingles", "weights")).alias("_z")).select(
        F.col("_z.shingles").alias("h"), F.col("_z.weights").alias("w")
    ).distinct()
    starts = windows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words", "size")).alias("_w"))
    # By shuffle at every size: the windows grow with the documents.
    texts = known.join(starts.hint("merge"), "doc_id").withColumn("words", words_of(F.col("text"))).drop("text")
    each = texts.select("doc_id", "words", F.explode("_w").alias("_v")).select(
        "doc_id",
        F.col("_v.start").alias("start"),
        F.col("_v.n_words").alias("n_words"),
        shingles_of(F.slice("words", F.col("_v.start") + 1, F.col("_v.n_words")), F.col("_v.size")).alias("shingles"),
    )
    shingled = stored(each.distinct(), "benchmark-shingles")
    keys = ["doc_id", "start", "n_words", "shingles"]
    weighed = (
        shingled.select(*keys, F.posexplode("shingles").alias("_at", "h"))
        .join(weight, "h", "left")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_at", "w"))).alias("_s"), F.avg("w").alias("_mean"))
        .select(*keys, F.transform("_s", lambda s: s["w"]).alias("weights"), "_mean")
    )
    # A window is compared with many items: in its fingerprint, its own mean stands for theirs.
    filled = F.transform("weights", lambda w: F.coalesce(w, F.col("_mean"), F.lit(1.0)))
    printed = stored(weighed.withColumn("print", fingerprint(F.col("shingles"), filled)).drop("_mean"), "benchmark-prints")
    left = printed.select("*", F.inline(blocks_of(F.col("print"), radius)))
    right = items.select(
        "item", "n_words", F.col("print").alias("item_print"), F.inline(blocks_of(F.col("print"), radius))
    )
    near = (
        left.select("doc_id", "start", "n_words", "print", "block", "value")
        .join(right, ["n_words", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("doc_id", "start", "n_words", "print", "item")
        .distinct()
    )
    pairs = near.join(printed, ["doc_id", "start", "n_words", "print"]).join(
        items.select("item", "own", "mean", F.col("shingles").alias("_hs"), F.col("weights").alias("_ws")), "item"
    )
    times = lambda c, h: F.size(F.filter(c, lambda x: x == h))
    both = F.transform(
        F.array_distinct(F.arrays_zip(F.col("_hs").alias("h"), F.col("_ws").alias("w"))),
        lambda p: F.struct(p["w"].alias("w"), F.least(times(F.col("shingles"), p["h"]), times(F.col("_hs"), p["h"])).alias("n")),
    )
    shared = F.aggregate("_both", F.lit(0.0), lambda a, p: a + p["w"] * p["n"])
    held = F.aggregate("_both", F.lit(0), lambda a, p: a + p["n"])
    window = total(F.transform("weights", lambda w: F.coalesce(w, F.col("mean"))))
    weighted = shared / F.greatest(window, F.col("own"))
    plain = held / F.greatest(F.size("_hs"), F.size("shingles"))
    scored = pairs.withColumn("_both", both).select(
        "doc_id", "item", "start", "n_words", F.round(F.greatest(weighted, plain), 9).alias("similarity")
    )
    near_or_swept = scored.where(F.col("similarity") >= similarity).unionByName(swept_passages(spots, items, similarity))
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"))).alias("_b")
    found = near_or_swept.groupBy("doc_id", "item", "n_words").agg(best)
    return (
        found.join(named.select("item", "item_id"), "item")
        .groupBy("doc_id", "item_id", "n_words")
        .agg(F.max("_b").alias("_b"))
        .select("doc_id", "item_id", (-F.col("_b.s")).alias("start"), "n_words", F.col("_b.similarity").alias("similarity"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; null ids stay."""
    return without_ids(docs, find_passages(docs, benchmark).select("doc_id").distinct())
